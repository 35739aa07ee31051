"""Operators 11, 12 and 13 against plain versions on small, awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import prose

from yoyflow.llm import hard_negatives, prefix_trie, quality_rules

# --- 11: quality rules ---------------------------------------------------------------


def plain_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    held = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    out = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held))
    return *out, len(words) < 50 or 100 * len(held) > 50 * len(words)


def plain_distance(p, references):
    """The usual two-sided sum over all bins, for dense histograms."""
    best = math.inf
    for q in references:
        total = 0.0
        for a, b in zip(p, q, strict=True):
            m = (a + b) / 2
            total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
        best = min(best, math.sqrt(max(total, 0) / 2))
    return best


def test_plain_counts_on_awkward_texts(spark, messy):
    got = quality_rules.judge(messy, quality_rules.fit(messy)).collect()
    assert len(got) == messy.count()
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0, plain_rules(r["text"])) for r in messy.collect()))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[c] for c in names)) for r in got) == want
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_distances_are_the_plain_ones_and_junk_goes(spark):
    r = random.Random(5)
    common = {"en": "the of and to in".split(), "fr": "le la de et un".split()}

    def sentence(lang, n):
        return " ".join(r.choice(common[lang]) if r.random() < 0.4 else prose(r.randint(0, 10**9), 1) for _ in range(n))
    rows = [(i, sentence(("en", "fr")[i % 2], 300), ("en", "fr")[i % 2] if i % 3 else None) for i in range(40)]
    junk = [(100, " ".join(w + "|#$" for w in prose(1, 300).split()), "en"), (101, prose(2, 900, of="ABCXYZ0123456789"), None)]
    short = [(102, prose(3, 55, of="xyz0123"), "en")]
    docs = spark.createDataFrame(rows + junk + short, "doc_id long, text string, lang string")
    refs = quality_rules.fit(docs)
    got = {x["doc_id"]: x for x in quality_rules.judge(docs, refs).collect()}
    assert all(got[i]["kept"] for i, _, _ in rows)
    assert not got[100]["kept"] and not got[101]["kept"]
    assert not got[102]["base_failed"]
    raw = [t.encode() for _, t, _ in rows + junk]
    classes = quality_rules.class_counts(raw)
    for (i, text, _), c in zip(rows + junk, classes, strict=True):
        want = plain_distance(c / c.sum(), refs.class_shares)
        assert abs(got[i]["class_distance"] - want) < 1e-5
        words = re.findall("[a-z0-9]+", text.lower())
        bins = np.zeros(len(refs.words) + 1)
        for w in words:
            bins[refs.words.get(w.encode(), -1)] += 1
        assert abs(got[i]["word_distance"] - plain_distance(bins / bins.sum(), refs.word_shares)) < 1e-5


def test_rules_without_reference_and_without_rows(spark, no_rows):
    docs = spark.createDataFrame([(1, prose(1, 80), None), (2, "few", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, quality_rules.fit(docs)).collect()}
    assert got == {1: True, 2: False}
    assert quality_rules.judge(no_rows, quality_rules.fit(no_rows)).count() == 0


def test_character_classes_by_code_point():
    points = {0x09: "control", 0x20: "space", 0x21: "sentence", 0x24: "sign", 0x39: "digit", 0x5A: "upper", 0x7A: "lower", 0x7C: "sign", 0xA3: "latin_mark", 0xE9: "latin", 0x416: "other_letter", 0x2014: "symbol", 0x65E5: "east_asian", 0xFB01: "private", 0x1F642: "supplement"}
    for point, name in points.items():
        counts = quality_rules.class_counts([chr(point).encode()])[0]
        assert counts.sum() == 1 and counts[quality_rules.NAMES.index(name)] == 1


# --- 12: hard negatives --------------------------------------------------------------


def plain_negatives(rows):
    kept = {}
    for vec_id, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in vec)
        kept[vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, q] = 1
    rows = list(kept)
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a in rows:
        if a[0] is None or a[0] % 100:
            continue
        scores = [(sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in rows if b is not a and len(b[2]) == len(a[2])]
        for ps, p, _ in sorted((s for s in scores if s[2] == a[1]), key=order)[:5]:
            fit = sorted((s for s in scores if s[2] != a[1] and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:5]
            out += [(a[0], p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(fit)]
    return sorted(out, key=repr)


def vectors(seed, n, size=6):
    r = random.Random(seed)
    rows = [(i * 5, [r.gauss(0, 1) for _ in range(size)], r.randint(0, 3)) for i in range(n)]
    rows += [(i * 5 + 1, rows[i][1], rows[i + 1][2]) for i in range(0, n - 1, 3)]  # ties between ids
    rows += [rows[0], rows[20], (100, [0.5] * size, 2), (100, [0.4] * size, 2)]  # repeated rows, one id with other vectors
    rows += [(None, [r.gauss(0, 1) for _ in range(size)], 1), (900, None, 1), (903, [1.0] * size, None), (906, [None] * size, 1), (909, [math.nan] * size, 1)]
    rows += [(912, [math.inf] * size, 1), (1000, [0.0] * size, 1), (1100, [r.gauss(0, 1) for _ in range(3)], 1), (1200, [], 2)]
    rows += [(1100 + i, [r.gauss(0, 1) for _ in range(3)], i % 2) for i in range(1, 30)]
    return rows


@pytest.mark.parametrize("rows_a_group, anchors_a_block", [(4096, 1024), (40, 2)])
def test_negatives_match_all_pairs(spark, monkeypatch, rows_a_group, anchors_a_block):
    monkeypatch.setattr(hard_negatives, "ROWS", rows_a_group)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors_a_block)
    rows = vectors(3, 220)
    df = spark.createDataFrame([(*r, 5, 0.5) for r in rows], "vec_id long, embedding array<float>, label int, q int, norm double")
    got = sorted((tuple(r) for r in hard_negatives.mine(df).collect()), key=repr)
    want = plain_negatives(rows)
    assert want and got == want


def test_bounds_hold_every_score(spark):
    rng = np.random.default_rng(1)
    m = np.floor(256 * rng.normal(size=(500, 8))).astype(np.int32)
    m[10] = m[11] * 1
    m[12] = -m[13]
    refs = m[:4] / np.linalg.norm(m[:4], axis=1, keepdims=True)
    norms = np.linalg.norm(m.astype(float), axis=1)
    theta = np.arccos(np.clip(m @ refs.T / norms[:, None], -1, 1)).astype(np.float32)
    block = hard_negatives.Block(np.arange(500), np.zeros(500, np.int64), m, norms, theta)
    for a in range(0, 500, 7):
        low, high = block.bounds(norms[a], theta[a].astype(float), slice(None))
        score = block.scores(m[a], norms[a], np.arange(500))
        assert (low <= score).all() and (score <= high).all()
        for least in (1, 5000, 200_000, int(score.max())):
            part = block.stretch(norms[a], theta[a].astype(float), least)
            outside = np.ones(500, bool)
            outside[part] = False
            assert (score[outside] < least).all()


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df).count() == 0


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(0, [2.0**23], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="2\\*\\*23"):
        hard_negatives.mine(df).count()


# --- 13: prefix trie -----------------------------------------------------------------


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, (role, text)))
    convs = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for node, who in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:-1] == x for y in below if len(y) == len(x) + 1)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].split()) for x in below if x)
        ended = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children), len(leaves), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks():
    r = random.Random(9)
    rows = []
    for c in [*range(0, 70), 205, 215, -3, -20, -25]:  # 205 and 215: the block's first one is absent
        for t in range(r.choice((1, 2, 4, 9))):
            rows.append((c, t, r.choice(("user", None)), r.choice(("a b", "a  b c\n", "", None, "x"))))
    rows += [(300, None, "user", "first"), (300, 0, "user", "tie two"), (300, 0, "user", "tie one"), (300, 0, "user", "tie one")]
    rows += [(c, t, "u", "same words here") for c in (400, 401, 402, 420) for t in range(40)]
    return rows + [(None, 0, "user", "no conversation"), (500, 0, "user", "long " * 20_000)]


@pytest.mark.parametrize("small", [0, 6, 512])
def test_trie_matches_plain_version(spark, monkeypatch, small):
    """With 0, every component is split in Spark rounds; with 512, one task finishes the tree."""
    monkeypatch.setattr(prefix_trie, "SMALL", small)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = talks()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int").repartition(4)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=repr)
    assert got == plain_trie(rows)


def test_running_sums_over_split_groups(spark):
    df = spark.range(5000).selectExpr("case when id < 4000 then 1 else id end as g", "id as o", "id % 7 as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from pyspark.sql import functions as F

        got = {r["o"]: r["s"] for r in prefix_trie.running(df, "g", [F.col("o").asc()], {"s": F.col("v")}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total, want = 0, {}
    for o in range(5000):
        total = total + o % 7 if o < 4000 else o % 7
        want[o] = total
    assert got == want


def test_subtree_sums_on_random_trees():
    r = random.Random(2)
    for n in (1, 2, 50, 400):
        parent = [-1] + [r.choice((i - 1, r.randrange(i))) for i in range(1, n)]
        values = [[r.randint(0, 9) for _ in range(n)] for _ in range(2)]
        want = [list(v) for v in values]
        for w in want:
            for i in reversed(range(1, n)):
                w[parent[i]] += w[i]
        assert prefix_trie.subtree_sums(parent, [r.randint(1, 5) for _ in range(n)], values) == want


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

"""Operators 4, 5, 8, 9, 10 against brute force, and their defined results on awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest_llm import PIECES, prose, texts
from yoyflow.llm import decontaminate, language_id, lattice_lm, recompression, secrets
from yoyflow.llm.pieces import PieceModel, marginals

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, given_texts, **more):
    return spark.createDataFrame([(i, t) for i, t in enumerate(given_texts)], "doc_id long, text string")


# -- 5: benchmark passages


def hits(text, items, window=10):
    words, got, found = WORD.findall((text or "").translate(LOW)), set(), set()
    for name, item in items:
        own = WORD.findall((item or "").translate(LOW))
        for k in range(max(1, len(own) - window + 1)):
            w = own[k : k + window]
            for i in range(len(words) - len(w) + 1):
                if own and words[i : i + len(w)] == w:
                    got.update(range(i, i + len(w)))
                    found.add(str(name))
    return len(words), len(got), sorted(found)


def benchmark_rows():
    base = prose(1, 120).split()
    return [(1, " ".join(base[10:40])), (2, "Ab cd."), (10, " ".join(base[30:39])), (3, None), (4, "!!"), (5, "日本語のテキスト"), (1, "word"), (None, "x"), (7, prose(9, 30)), (8, "ab " * 25)]


@pytest.mark.parametrize("patterns", [1_000_000, 7])
def test_search_against_brute_force(spark, messy, patterns):
    rows = benchmark_rows()
    items = [(n, t) for n, t in rows if n is not None]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    got = decontaminate.search(messy, benchmark, patterns=patterns)
    assert got.columns.count("items") == 1 and got.count() == messy.count()
    for r in got.collect():
        assert (r.n_words, r.n_hit, r["items"]) == hits(r.text, items)


def test_search_on_random_small_alphabets(spark):
    r = random.Random(3)
    docs = [" ".join(r.choice("abc") for _ in range(r.randint(0, 60))) for _ in range(150)]
    items = [(i, " ".join(r.choice("abc") for _ in range(r.randint(1, 14)))) for i in range(25)]
    got = decontaminate.search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    for row in got.collect():
        assert (row.n_words, row.n_hit, row["items"]) == hits(row.text, items)


def test_search_without_rows(spark, messy, no_rows):
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    assert decontaminate.search(no_rows, benchmark).count() == 0
    none = decontaminate.search(messy, benchmark.where("false"))
    assert none.count() == messy.count() and none.where("n_hit > 0 or size(items) > 0").count() == 0


# -- 9: repeats


def brute_repeats(docs):
    """docs: (doc_id, text); windows of smaller ids."""
    seen: dict[tuple, int] = {}
    words = [(d, TOKEN.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            if d is not None:
                seen[k] = min(seen.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and seen[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return Counter(out)


def check_repeats(spark, docs):
    got = recompression.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    rows = got.collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == brute_repeats(docs)
    for r in rows:
        assert (r.kept is None) == (r.n_removed == 0) and (r.kept is None or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256)


def test_repeats_on_awkward_rows(spark, messy):
    check_repeats(spark, [(r.doc_id, r.text) for r in messy.collect()])


def test_repeats_on_copies_edits_passages_and_runs(spark):
    r, docs = random.Random(11), []
    pool = [prose(50 + i, 140, "abcdefghij") for i in range(8)]
    runs = ["a " * 200, "b a " * 130, "a b c " * 80, "a a b " * 90]
    for i in range(160):
        parts = []
        for _ in range(r.randint(1, 4)):
            w = r.choice(pool + runs).split()
            a = r.randint(0, len(w) - 1)
            w = w[a : a + r.randint(20, 130)]
            for _ in range(r.choice([0, 0, 1, 3])):
                w[r.randrange(len(w))] = f"new{r.randint(0, 9)}"
            parts.append(" ".join(w))
        docs.append((r.randint(0, 120), "\n".join(parts)))
    docs += docs[:10]
    check_repeats(spark, docs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=70, max_size=260), st.integers(0, 60), st.integers(0, 60), st.integers(2, 6))
def test_equal_stretches_have_equal_anchors(body, left, right, alphabet):
    """What lies REACH words inside an equal stretch is parsed alike, whatever stands around it."""
    r = np.random.default_rng(len(body) + left)
    names = r.integers(1, 1 << 63, 8, dtype=np.uint64)
    body = names[np.array(body) % alphabet]
    found = []
    for before, after in ((left, right), (right, left)):
        h = np.concatenate([names[r.integers(0, 8, before)], body, names[r.integers(0, 8, after)]])
        place, key = recompression.anchors(h, np.zeros(len(h), int), np.array([0]), np.array([len(h)]))
        inside = (place >= before + recompression.REACH) & (place <= before + len(body) - recompression.REACH)
        found.append([(p, k) for p, k in zip((place[inside] - before).tolist(), key[inside].tolist(), strict=True)])
    assert found[0] == found[1]


def test_repeats_without_rows(no_rows):
    assert recompression.remove_repeats(no_rows).count() == 0


# -- 8: lattice likelihood


def test_scores_against_plain_sums(spark, messy, monkeypatch):
    docs = messy.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)))
    rows = docs.collect()
    tokens = [[w.encode() for w in TOKEN.findall((r.text or "").translate(LOW))] for r in rows]
    count = Counter(w for r, t in zip(rows, tokens, strict=True) if r.train for w in [*t, None])
    n, v = sum(count.values()), len(count)
    counts = lattice_lm.word_counts(docs.select("text", "train"))
    model, end = lattice_lm.fit_pieces(counts, PieceModel.load(PIECES), ends=count[None])
    weights = np.exp(model.scores)
    assert abs(weights.sum() + math.exp(end) - 1) < 1e-9  # pieces and the end are one vocabulary
    piece = {model.text[i]: weights[i] for i in model.ids.tolist()}

    def forward(word: bytes) -> float:
        """All segmentations by a plain recursion over places; a character that is no piece stands for its bytes."""
        text = " " + word.decode("utf-8", "replace").replace("\u2581", " ")
        total = [1.0] + [0.0] * len(text)
        for at in range(len(text)):
            for to in range(at + 1, len(text) + 1):
                own = text[at:to].encode()
                if own in piece:
                    total[to] += total[at] * piece[own]
                elif to == at + 1:
                    total[to] += total[at] * math.prod(weights[model.byte_ids[b]] for b in own)
        return math.log10(total[-1]) if total[-1] > 1e-280 else math.nan

    spelled = {w: marginals(model, [w.decode()])[0] / math.log(10) for t in tokens for w in t}
    short = [w for w in spelled if len(w) <= 40]
    plain = {w: forward(w) for w in short}
    assert len(short) > 20 and all(abs(spelled[w] - x) < 1e-6 for w, x in plain.items() if x == x)
    spelled[None] = end / math.log(10)
    want = Counter()
    for r, t in zip(rows, tokens, strict=True):
        all_tokens = [*t, None]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in all_tokens)
        score = sum(spelled[w] for w in all_tokens)
        want[(r.doc_id, len(all_tokens), sum(count[w] > 0 for w in all_tokens), n, round(base, 4), round(score, 4))] += 1
    for hot in (250_000, 5, 0):  # all words broadcast, a few, none
        monkeypatch.setattr(lattice_lm, "HOT_WORDS", hot)
        monkeypatch.setattr(lattice_lm.hot_words, "__defaults__", (hot,))
        got = lattice_lm.score_documents(docs.drop("train"), PIECES, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)))
        assert got.columns.count("score") == 1
        assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got.collect()) == want


def test_a_word_is_more_likely_than_any_one_path(spark):
    model = PieceModel.load(PIECES)
    from yoyflow.llm.pieces import best_paths

    words = prose(4, 60).split()
    assert all(m >= b[1] - 1e-9 for m, b in zip(marginals(model, words), best_paths(model, words), strict=True))


def test_scores_without_training_or_rows(spark, messy, no_rows):
    got = lattice_lm.score_documents(messy, PIECES, F.lit(False)).collect()
    assert len(got) == messy.count() and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_lm.score_documents(no_rows, PIECES, F.lit(True)).count() == 0


# -- 4: language


def best_path(scores, price):
    value, back = list(scores[0]), []
    for row in scores[1:]:
        top = max(range(len(value)), key=lambda k: (value[k], -k))
        came = [k if value[k] >= value[top] - price else top for k in range(len(value))]
        value = [max(value[k], value[top] - price) + row[k] for k in range(len(value))]
        back.append(came)
    k = max(range(len(value)), key=lambda j: (value[j], -j))
    total = value[k]
    path = [k]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1], total


def worth(path, scores, price):
    return sum(s[k] for s, k in zip(scores, path, strict=True)) - price * sum(a != b for a, b in zip(path, path[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(*[st.integers(-9, 0)] * 3), max_size=40), min_size=1, max_size=6), st.integers(1, 20))
def test_labels_are_a_best_path(docs, price):
    count = np.array([len(d) for d in docs])
    flat = np.array([w for d in docs for w in d], float).reshape(-1, 3)
    first = np.cumsum(count) - count
    got = language_id.label(flat, first, count, price)
    for d, a, n in zip(docs, first.tolist(), count.tolist(), strict=True):
        if n:
            assert worth(got[a : a + n].tolist(), d, price) == pytest.approx(best_path(d, price)[1])


def test_spans_scripts_and_awkward_rows(spark, messy, no_rows):
    r = random.Random(2)
    words = {"aa": [prose(20 + i, 1, "abcde") for i in range(60)], "bb": [prose(90 + i, 1, "vwxyzé") for i in range(60)], "ru": ["слово", "текст", "язык", "книга"]}
    say = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    rows = [(say(lang, 60), lang) for lang in words for _ in range(20)] + [("no label", None), (None, "aa"), ("123", "bb")]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb", "ru"]
    scores = model.word_scores(["abc", "слово", "日本"])
    assert scores[0, 2] < -1e5 and scores[1, 0] < -1e5 and scores[1, 2] == 0 and scores[2].min() > -1e5
    held = [(i, say(lang, 40), lang) for i, lang in enumerate([*words] * 10)]
    got = language_id.predict(spark.createDataFrame(held, "doc_id long, text string, lang string"), model)
    assert got.where("lang = lang_pred and score > 0.9").count() == len(held)
    mixed = frame(spark, [say("aa", 30) + ". " + say("bb", 50) + " " + say("ru", 9)])
    (row,) = language_id.predict(mixed, model).collect()
    assert row.lang_pred == "bb" and [(s.first_word, s.words, s.lang) for s in row.spans] == [(0, 30, "aa"), (30, 50, "bb"), (80, 9, "ru")]
    for r_ in language_id.predict(messy, model).collect():
        letters = any(c.isalpha() for c in r_.text or "")
        assert (r_.lang_pred == "und") == (not letters) and 0 <= r_.score <= 1 and (r_.score > 0) == letters
    assert language_id.predict(messy, model).count() == messy.count()
    assert language_id.predict(no_rows, model).count() == 0
    nothing = language_id.predict(messy, language_id.fit(no_rows))
    assert nothing.where("lang_pred = 'und' and score = 0").count() == messy.count()


def test_held_out_accuracy(spark):
    got = __import__("yoyflow.llm.language_id", fromlist=["x"]).op4_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right, every = got.where("held_out").join(docs.where("lang is not null"), "doc_id").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / every > 0.97


# -- 10: secrets

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    spans = [("assign", m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [s[:3] for s in sorted(spans, key=lambda s: (s[1], s[3]))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["PassWord", "token", "secret", "api_key", "APIKEY", "=", ": ", '"', "'", " ", "é", "ſecret", "toKen", "abcd1234", "0" * 33, "AKIA", "ABCDEFGHIJKL", "x", "\n"]), max_size=14).map("".join))
def test_base_findings(text):
    found = secrets.find([text, text[::-1]])
    assert found.base == [plain_base(text), plain_base(text[::-1])]


def secret_rows(n, seed):
    r, out = random.Random(seed), []
    token = lambda k, a: "".join(r.choice(a) for _ in range(k))
    for i in range(n):
        word = prose(seed * 1000 + i, 25, "abcdefghijklmnop")
        kind = i % 5
        if kind == 0:
            word += f" password={token(20, 'abcdef0123456789')} " + prose(i, 5)
        elif kind == 1:
            word += f" token: \"{token(40, 'abcdef0123456789')}\" " + prose(i, 5)
        elif kind == 2:
            word += f" see file{r.randint(1, 9)}.readme.and.more or order-number-{r.randint(1, 99)} "
        elif kind == 3:
            word += " " + prose(i, 1, "abcdefgh") * 6
        out.append(word)
    return out


def test_model_finds_bare_secrets_and_spares_words(spark, messy, no_rows):
    model = secrets.fit(frame(spark, secret_rows(600, 1)))
    r = random.Random(9)
    bare = ["".join(r.choice("abcdef0123456789") for _ in range(30)) for _ in range(200)]
    found = secrets.find([f"word {b} word" for b in bare])
    recall = np.mean(model.probabilities(secrets.windows(found, np.flatnonzero(~found.positive))) >= model.threshold)
    clean = secrets.find([t for i, t in enumerate(secret_rows(500, 3)) if i % 5 in (2, 3, 4)], words=True)
    false = np.mean(model.probabilities(secrets.windows(clean, np.arange(len(clean.first)))) >= model.threshold)
    assert recall > 0.8 and false < 0.1
    text = f"é word {bare[0]} word"
    (row,) = secrets.scan(frame(spark, [text]), model).collect()
    assert [(s.kind, text[s.start : s.end]) for s in row.spans] == [("model", bare[0])]
    (row,) = secrets.redact(frame(spark, [text + " password=abcdefgh1 x"]), model).collect()
    assert row.text == "é word [SECRET] word [SECRET] x"
    for x in secrets.scan(messy, model).collect():
        assert [tuple(s) for s in x.spans if s.kind != "model"] == plain_base(x.text or "")
    again = secrets.redact(messy, None).collect()
    assert Counter(x.text for x in again) == Counter([*texts(), texts()[7], "no id", texts()[10]])
    assert secrets.scan(no_rows, None).count() == 0 and secrets.fit(no_rows) is None


def test_model_learns_from_every_example(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SHARD", 100)  # several shards, as on a large input
    rows = secret_rows(600, 4)
    model, again = secrets.fit(frame(spark, rows)), secrets.fit(frame(spark, rows).repartition(5))
    assert np.allclose(model.kernel, again.kernel, atol=1e-9) and model.threshold == pytest.approx(again.threshold, abs=1e-6)
    # each of the rows' tokens moves the model: no cap leaves the late ones out
    more = secrets.fit(frame(spark, [*rows, *secret_rows(20, 5)]))
    assert not np.allclose(model.kernel, more.kernel, atol=1e-9)
    assert not hasattr(secrets, "MOST")


def test_threshold_from_counts():
    model = secrets._model(secrets._start(1))
    bins, positive = np.array([-300, -100, 0, 100, 200]), np.array([False, True, False, True, True])
    model = secrets.calibrate(model, bins, positive, np.array([50.0, 1.0, 5.0, 49.0, 50.0]), recall=0.98)
    a, b = model.platt
    assert a > 0 and model.threshold == pytest.approx(1 / (1 + np.exp(-(a * 1.0 + b))))  # misses 1 of 100


def test_gradient(spark):
    rng = np.random.default_rng(1)
    model = secrets.SecretModel(rng.normal(0, 0.3, (secrets.WIDTH, secrets.SYMBOLS, secrets.FILTERS)), np.zeros(secrets.FILTERS), rng.normal(0, 0.3, 3 * secrets.FILTERS + 1), 0.1, (1.0, 0.0), 0.5)
    examples, y = [(b"ab", b"xyz012", b""), (b"", b"0123456789abcdef", b"!?")], np.array([0.0, 1.0])

    def loss(m):
        z = m.logits(examples)
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

    kernel, bias, weight, offset = secrets._step(model, examples, y)
    for name, grad in (("kernel", kernel), ("bias", bias), ("weight", weight)):
        flat = np.argsort(-np.abs(grad).ravel())[:3]
        for i in flat.tolist():
            moved = []
            for e in (1e-5, -1e-5):
                x = getattr(model, name).copy()
                x.ravel()[i] += e
                moved.append(loss(secrets.SecretModel(**{**model.__dict__, name: x})))
            assert grad.ravel()[i] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-3, abs=1e-6)


def test_overlapping_spans_are_one_mark():
    assert secrets.redact_text("abcdefgh", [("a", 1, 3), ("b", 2, 5), ("c", 6, 7)], "*") == "a*f*h"
    assert secrets.redact_text("abc", [], "*") == "abc"


def test_broadcast_words_go_round_the_lattice_once_a_worker(monkeypatch):
    """A full memo drops the other words' scores only; columns stay those of their words."""
    calls = []
    monkeypatch.setattr(lattice_lm, "marginals", lambda model, words: [calls.append(w) or float(len(w)) for w in words])
    scorer = lattice_lm._Scorer(None, {b"hot": 3, b"warmer": 0}, 10, 4)
    scorer.memo._limit = 4
    for part in ([b"hot", b"a"], [b"bb", b"ccc", b"warmer"], [b"dddd", b"hot", b"a"], [b"warmer", b"eeeee", b"bb"], [b"hot", b"a", b"bb"]):
        scorer.memo.ensure([part])
        ix = [scorer.memo[w] for w in part]
        assert len(set(ix)) == len(part)
        assert (scorer.score[ix] * lattice_lm.LOG10).round(9).tolist() == [len(w) for w in part]
        assert scorer.rare[ix].tolist() == [w not in scorer.hot for w in part]
        assert scorer.known[ix].tolist() == [w == b"hot" for w in part]
    assert calls.count("hot") == calls.count("warmer") == 1 and calls.count("a") > 1


def test_word_counts_name_words_by_their_key(spark):
    words = [b"x" * 64, b"y" * 65, b"z" * 300]
    docs = spark.createDataFrame([(b" ".join(words).decode(), True), ("z" * 300, False), (None, True)], "text string, train boolean")
    got = {bytes(r.word): (bytes(r.key), r.n_train, r.n_all) for r in lattice_lm.word_counts(docs).collect()}
    end = lattice_lm.END
    assert got == {words[0]: (words[0], 1, 1), words[1]: (lattice_lm.key_of(words[1]), 1, 1), words[2]: (lattice_lm.key_of(words[2]), 1, 2), end: (end, 2, 3)}

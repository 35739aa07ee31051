"""Operators 1 and 6, components and the pipeline, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest_llm import prose
from yoyflow.llm import bloom, kmeans_tree, ngram_join
from yoyflow.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(docs):
    """Counter of the operator's rows for (doc_id, text)."""
    by = defaultdict(list)
    for d, t in docs:
        by[shingles(t)].append(d)
    sets = [s for s in by if s]
    root = {s: s for s in sets}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    near = defaultdict(list)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                near[a].append(b)
                near[b].append(a)
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for s in sets:
        ids[find(s)] += by[s]
    least = lambda x: min((i for i in x if i is not None), default=None)
    out = []
    for d, t in docs:
        s = shingles(t)
        out.append((d, least(by[s]), len(by[s]), len(near[s]), sum(len(by[x]) for x in near[s]) + len(by[s]) - 1, least(ids[find(s)])) if s else (d, d, 1, 0, 0, d))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.copy_of, r.n_copies, r.n_text_links, r.n_links, r.class_id) for r in df.collect())


def near_copies(seed, groups=6, size=14):
    r, docs = random.Random(seed), []
    for g in range(groups):
        base = prose(100 * seed + g, r.choice([12, 60, 200])).split()
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = f"edit{r.randint(0, 3)}"
            docs.append(" ".join(w))
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("block", [1 << 18, 150])
def test_join_against_brute_force(spark, block):
    docs = [(i, t) for i, t in enumerate(near_copies(1) + [None, "", "!!", "one two", "One, two", "one two three"])]
    got = ngram_join.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), block=block)
    assert found(got) == brute_join(docs)


def test_join_on_awkward_rows(spark, messy, no_rows):
    assert found(ngram_join.jaccard_join(messy)) == brute_join([(r.doc_id, r.text) for r in messy.collect()])
    assert ngram_join.jaccard_join(no_rows).count() == 0


def test_pairs_are_pruned_and_none_is_lost():
    sets = [np.sort(np.array([hash(x) % (1 << 62) for x in shingles(t)], np.uint64)) for t in near_copies(2, 5, 30)]
    values = ngram_join.min_hashes(sets)[:, : ngram_join.VALUES]
    left, right = np.triu_indices(len(sets), 1)
    a, b = ngram_join.linked_pairs(values, sets, left, right)
    want = {(i, j) for i, j in zip(left.tolist(), right.tolist(), strict=True) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) - 1e-9}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and want
    least = ngram_join.least_matches(0.8, 1e-7)
    assert 0 < least[16] < 10 and 50 < least[96] < 77  # unlike pairs go early, a pair at 0.8 (77 of 96) stays


def test_min_hash_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    values = ngram_join.min_hashes([a[:2000], a[1000:]])
    assert abs((values[0] == values[1]).mean() - 1 / 3) < 0.1


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(80)] + [(5000, 5001 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r_.node: r_.component for r_ in got} == {x: find(x) for x in list(root)} and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_bloom_lets_all_its_keys_pass(spark):
    keys = spark.range(0, 3000, 3)
    bits = bloom.build(keys, bloom.bit("id"))
    places = np.array([x.b for x in spark.range(3000).select(bloom.bit("id").alias("b")).collect()])
    passed = bloom.passes(bits, places)
    assert passed[::3].all() and passed.sum() < 1050
    digests = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(500)]  # uniform, as the filter asks
    df = spark.createDataFrame([(d,) for d in digests[:50]], "d binary")
    hit = bloom.passes(bloom.build(df, bloom.digest_bit("d")), bloom.digest_bits(digests))
    assert hit[:50].all() and hit.sum() < 60


# -- 6


def brute_nearest(rows, k=20):
    out = {}
    for i, q in rows:
        if i % 20 == 0:
            # (sum() of Python rounds less often than additions in double precision do)
            score = [(-reduce(lambda t, ab: t + ab[0] * ab[1], zip(q, x, strict=True), 0.0), j) for j, x in rows if j != i]
            out[i] = [(j, -s) for s, j in sorted(score)[:k]]
    return out


def vectors(n, dim, seed, clusters=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dim))
    return [(i, [float(np.float32(v)) for v in centre[i % clusters] + 0.4 * rng.normal(size=dim)]) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int, score int"


def test_nearest_with_ties_and_rows_that_take_no_part(spark):
    rows = vectors(300, 8, 1)
    rows = [(i, rows[7][1]) if i % 3 == 0 else (i, v) for i, v in rows]  # a third are one vector
    extra = [(900, None), (920, [0.0] * 8), (940, [1.0] * 7 + [float("nan")]), (960, [1.0] * 7 + [None]), (980, [float("inf")] * 8), (None, [1.0] * 8), (1000, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in rows + extra + rows[:5]], SCHEMA).repartition(4)
    got = kmeans_tree.search(kmeans_tree.valid_vectors(df), F.col("vec_id") % 20 == 0, block=40, part=4).collect()
    want = brute_nearest(rows)
    assert {r.query_id for r in got} == set(want)
    for q, expected in want.items():
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(r.vec_id, r.score) for r in own] == expected


def test_recall_and_visits(spark):
    rows = vectors(6000, 16, 2, 60)
    df = kmeans_tree.valid_vectors(spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA))
    tree, index = kmeans_tree.build(df)
    assert index.count() == 6000 and tree.rows.sum() == 6000 and tree.leaves > 10
    visits = kmeans_tree.calibrate(tree, index, index.where("vec_id % 20 = 0").select("vec_id", "v"), 20)
    assert 1 <= visits < tree.leaves
    got = kmeans_tree.search(df, F.col("vec_id") % 20 == 0).collect()
    x = np.array([v for _, v in rows])
    hit = 0
    for q in range(0, 6000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:20].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert len(got) == 6000 and hit / 6000 >= 0.9


def test_few_and_no_vectors(spark):
    rows = vectors(7, 4, 3)
    df = spark.createDataFrame([(i * 10, v, 0, 0) for i, v in rows], SCHEMA)
    got = kmeans_tree.search(kmeans_tree.valid_vectors(df), F.col("vec_id") % 20 == 0).collect()
    assert Counter(r.query_id for r in got) == {0: 6, 20: 6, 40: 6, 60: 6}
    assert kmeans_tree.search(kmeans_tree.valid_vectors(df.where("false")), F.col("vec_id") % 20 == 0).count() == 0


def test_vectors_of_each_length_meet_their_like(spark):
    rows = [*vectors(50, 4, 5), *((100 + i, v) for i, v in vectors(30, 3, 6)), (1000, [1.0]), (1020, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = kmeans_tree.search(kmeans_tree.valid_vectors(df), F.col("vec_id") % 20 == 0, k=60).collect()
    held = Counter(r.query_id for r in got)
    assert held == {0: 49, 20: 49, 40: 49, 100: 29, 120: 29}  # one of length 1 has no candidate, a zero takes no part
    assert all((r.query_id < 100) == (r.vec_id < 100) for r in got)


# -- pipeline


def test_stages_keep_columns_and_have_their_effect(spark, messy, tmp_path):
    sf = str(tmp_path)
    passage = prose(700, 30)
    base = prose(701, 80, "klmnopqr")
    # the spans' names clash, and a column is extra
    rows = [(i, prose(800 + i, 60, "klmnopqr" if i % 2 else "abcdefgh"), "aa" if i % 2 else "bb", "s", 1, 0.5, "mine") for i in range(40)]
    rows += [(200, base, "aa", "s", 1, 0.5, "mine"), (201, base, "aa", "s", 1, 0.5, "mine"), (202, base + " one more", "aa", "s", 1, 0.5, "mine"), (200, base, "aa", "s", 1, 0.5, "mine")]
    rows += [(300, prose(702, 50) + " " + passage + " end", "bb", "s", 1, 0.5, "mine"), (301, prose(703, 50) + " password=abcdef0123456789 x", "bb", "s", 7, 0.5, "mine")]
    rows += [(400, None, None, "s", 1, 0.5, "mine"), (401, "123 !!", "aa", "s", 1, 0.5, "mine"), (402, "", "aa", "s", 1, 0.5, "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, _rows string")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        if name != "encode":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{sf}/{k}")
        now = spark.read.parquet(f"{sf}/{k}")
        kept[name] = now.collect()
    ids = {n: sorted(r.doc_id for r in x) for n, x in kept.items()}
    assert ids["language"] == sorted([*range(40), 200, 200, 201, 202, 300, 301])
    assert ids["near_duplicates"] == [*range(40), 200, 300, 301]
    assert ids["decontaminate"] == ids["secrets"] == ids["encode"] == [*range(40), 200, 301]
    (row,) = (r for r in kept["secrets"] if r.doc_id == 301)
    assert row.text.endswith(" [SECRET] x") and row.n_chars == len(row.text)
    assert all(r.n_chars == 1 and r._rows == "mine" and r.score == 0.5 for r in kept["secrets"] if r.doc_id != 301)
    assert all(len(r.piece_ids) > 10 for r in kept["encode"])
    whole = corpus_pipeline.run(spark, sf)
    assert Counter(r.doc_id for r in whole.collect()) == Counter(ids["encode"])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0
        assert stage(spark, docs.where("doc_id >= 400"), sf).count() == (0 if name == "language" else 3)


def test_near_duplicates_go_by_row_not_by_id(spark):
    """Rows that share an id, copies of them, repeated rows, rows without words, a very long text, odd column names."""
    a, b, c, d = (prose(900 + i, 60) for i in range(4))
    long = prose(910, 30_000)
    rows = [
        (1, a, "x"), (1, b, "x"),  # one id, two texts, no copies of anything: both stay
        (2, c, "x"), (3, c + " more", "x"), (3, d, "x"),  # 3 is a near copy of 2 by one of its rows only
        (5, long, "x"), (6, long + " end", "x"), (6, long + " end", "y"), (6, long + " end", "y"),
        (7, "", "x"), (7, "", "x"), (8, None, "x"), (8, " .. ", "x"), (None, c, "x"), (None, c, "x"),
        (9, prose(920, 80), "z"), (9, prose(920, 80), "z"), (9, prose(920, 80), "w"),  # one row of these
    ]
    docs = spark.createDataFrame([(i, t, s, "k", 3) for i, t, s in rows], "doc_id long, text string, _doc string, _text string, class_no int").repartition(4)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"], r["_doc"]) for r in out.collect())
    nine = [k for k in got if k[0] == 9]
    assert len(nine) == 1 and got.pop(nine[0]) == 1
    want = [rows[i] for i in (0, 1, 2, 4, 5, 9, 10, 11, 12, 13, 14)]
    assert got == Counter(want)
    again = {r["_doc"] for _ in range(2) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(7), "").where("doc_id = 9").collect()}
    assert again == {nine[0][2]}


def test_other_stages_keep_odd_columns(spark, tmp_path):
    spark.createDataFrame([(1, prose(930, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, prose(940 + i, 80, "klmnopqr" if i % 2 else "abcdefgh"), "aa" if i % 2 else "bb", "k", 3, 4, True) for i in range(12)]
    rows += [(20, prose(950, 60_000), "bb", "k", 3, 4, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _doc string, _text int, n_chars long, _changed boolean")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert sorted(map(tuple, out.collect())) == sorted(rows), name


def test_a_worker_keeps_the_state_of_one_operator():
    from yoyflow.llm.common import Memo, worker_state

    a = worker_state("a", list)
    assert worker_state("a", list) is a
    b = worker_state("b", dict)
    assert worker_state("b", dict) is b and worker_state("a", list) is not a
    memo = Memo(lambda words: [len(w) for w in words], 1000, most=40_000)  # some 190 words of ten letters
    for k in range(30):
        words = [f"{k:03d}-{i:06d}" for i in range(50)]
        assert memo.lookup([words, words[:3]]) == [[10] * 50, [10] * 3]
        assert len(memo) <= 200


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()

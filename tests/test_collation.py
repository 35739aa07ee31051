"""Text keys compare without case and trailing blanks, in lines and in every dimension."""

from collections import Counter

from pyspark.sql import functions as F

from yoyflow.operators.collated import NAMED, group
from yoyflow.operators.joins import hashed_join
from yoyflow.operators.temporal import year_offset_join
from yoyflow.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


def test_group_takes_the_normal_form_and_shows_the_least_spelling(spark):
    df = spark.createDataFrame([("Ab ", 1, 5), ("ab", 1, 6), ("AB", 1, 7), ("ab", 2, 8), (None, 1, 9), (None, 1, 1), ("a b", 1, 2)], "k string, n int, v int")
    got = sorted((tuple(r) for r in group(df, ["k", "n"], F.sum("v").alias("v")).collect()), key=repr)
    assert got == sorted([("AB", 1, 18), ("ab", 2, 8), (None, 1, 10), ("a b", 1, 2)], key=repr)
    assert group(df, ["k", "n"]).count() == 4


def test_collated_join_keeps_the_left_spelling(spark):
    left = spark.createDataFrame([("X1", 1), ("x2 ", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("x1  ", "a"), ("X2", "b"), (None, "c")], "k string, w string")
    got = {(r["k"], r["v"], r["w"]) for r in hashed_join(left, right, ["k"], "left", collated=True).collect()}
    assert got == {("X1", 1, "a"), ("x2 ", 2, "b"), (None, 3, None)}
    same = {(r["v"], r["w"]) for r in hashed_join(left, right, ["k"], "left", null_safe=True, collated=True).collect()}
    assert same == {(1, "a"), (2, "b"), (3, "c")}
    assert [r["v"] for r in hashed_join(left, right, ["k"], "left_anti", collated=True).collect()] == [3]
    assert {(r["k"], r["w"]) for r in hashed_join(left, right, ["k"], "inner").collect()} == set()  # binary unless asked


def test_unused_spellings_are_not_shuffled(spark):
    df = spark.range(100).selectExpr("cast(id % 7 as string) k", "cast(id % 3 as string) g", "id v")
    plan = group(df, ["k", "g"], F.sum("v").alias("v")).select("v")._jdf.queryExecution().executedPlan().toString()
    assert "min(" not in plan and "HashAggregate" in plan


def test_year_offsets_meet_other_spellings(spark):
    lines = spark.createDataFrame([("acc", 2024), ("ACC ", 2023)], "a string, fy int")
    snap = spark.createDataFrame([("Acc", 2023, "p"), ("acc  ", 2024, "q")], "a string, fy int, t string")
    out = year_offset_join(lines, snap, [("a", "a")], "fy", "fy", {-1: {"before": "t"}, 0: {"now": "t"}})
    assert {(r["a"], r["before"], r["now"]) for r in out.collect()} == {("acc", "p", "q"), ("ACC ", None, "p")}


def test_respelled_inputs_give_the_same_extract(spark):
    queries = {q.name: q.run for q in all_queries()}

    def rows(name):
        return Counter(tuple(v.rstrip(" ").lower() if isinstance(v, str) else v for v in r) for r in queries[name](spark, SF).collect())

    assert rows("extract_respelled") == rows("revenue_extract")


def test_many_text_keys_group_as_few(spark):
    """Keys named by hashes: NULL is neither '' nor at another place, and only two longs are keys."""
    names = [f"k{i}" for i in range(NAMED)]
    rows = [("a ",) + (None, "x") + ("",) * 5, ("A",) + (None, "X ") + ("",) * 5, ("a",) + ("x", None) + ("",) * 5, ("a",) + ("", "x") + ("",) * 5]
    df = spark.createDataFrame([(*r, 1) for r in rows], ", ".join(f"{n} string" for n in names) + ", v int")
    got = group(df, names, F.sum("v").alias("n")).collect()
    assert sorted((r.k0, r.k1, r.k2, r.n) for r in got if r.k1 is not None) == [("a", "", "x", 1), ("a", "x", None, 1)]
    assert [(r.k0, r.k1, r.k2, r.n) for r in got if r.k1 is None] == [("A", None, "X ", 2)]
    plan = group(df, names, F.sum("v").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan

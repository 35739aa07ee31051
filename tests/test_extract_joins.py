"""The extract's wide lines are shuffled once per step, not once per dimension or statistic."""

import re

import pytest
from pyspark.sql import functions as F

from yoyflow.operators.groups import group_flag
from yoyflow.operators.joins import hashed_join
from yoyflow.operators.temporal import year_offset_join_many
from yoyflow.plans import registry_extract as rex
from yoyflow.plans import revenue_extract as rx
from yoyflow.plans.registry import TEST_PARAMS
from yoyflow.sources.adapters import SparkInputs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _exchanges(df, column: str) -> int:
    """Shuffles of the plan that carry ``column``."""
    fresh = df.select("*")  # not run yet, so that its plan is shown once
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(fresh._jdf.queryExecution(), "formatted")
    details = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return sum(any(c.split("#")[0].strip() == column for c in d.split(",")) for d in details)


def test_flag_groups_are_enriched_before_the_lines_meet_them(spark, shuffled):
    lines = spark.createDataFrame(
        [("a", "x", 1, "w1"), ("A ", "x", 2, "w2"), ("a", None, 4, "w3"), (None, "x", 8, "w4"), ("b", "y", 16, "w5"), (None, None, 32, "w6"), (None, "x", 64, "w7")],
        "k string, s string, v int, wide string",
    )
    dim = spark.createDataFrame([("A", 10), ("b", 20), ("none", 30)], "k string, d int")
    total = {"n": F.sum("v")}
    both = group_flag(lines, ["k", "s"], total, enrich=lambda g: hashed_join(g, dim, ["k"], "left", collated=True))
    apart = hashed_join(group_flag(lines, ["k", "s"], total), dim, ["k"], "left", collated=True)
    assert _rows(both) == _rows(apart)
    assert {r.wide: (r.n, r.d) for r in both.collect()} == {
        "w1": (3, 10), "w2": (3, 10), "w3": (None, 10), "w4": (None, None), "w5": (16, 20), "w6": (None, None), "w7": (None, None),
    }
    assert (_exchanges(both, "wide"), _exchanges(apart, "wide")) == (1, 2)


def test_snapshots_are_pivoted_to_the_line_years_only(spark):
    snap = spark.createDataFrame([("a", y, y - 2000) for y in range(2020, 2027)], "acct string, y int, t int")
    lines = spark.createDataFrame([("a", 2023, "l1"), ("a", 2024, "l2"), ("b", 2024, "l3")], "acct string, fy int, line string")
    attrs = {-1: {"before": "t"}, 0: {"now": "t"}, 1: {"after": "t"}}
    limited, whole = (
        year_offset_join_many(lines, [(snap, "y", attrs, "snap")], [("acct", "acct")], "fy", line_years=years) for years in ((2023, 2024), None)
    )
    assert _rows(limited) == _rows(whole)
    assert "_target" in limited._jdf.queryExecution().analyzed().toString().split("Filter", 1)[1]
    found = {r.line: (r.before, r.now, r.after) for r in limited.collect()}
    assert found == {"l1": (22, 23, 24), "l2": (23, 24, 25), "l3": (None, None, None)}


def test_a_duplicate_snapshot_of_any_year_in_reach_still_fails(spark):
    lines = spark.createDataFrame([("a", 2023), ("a", 2024)], "acct string, fy int")
    attrs = {-1: {"before": "t"}, 0: {"now": "t"}, 1: {"after": "t"}}
    for year in (2022, 2023, 2024, 2025):
        snap = spark.createDataFrame([("a", year, 1), ("a", year, 2)], "acct string, y int, t int")
        out = year_offset_join_many(lines, [(snap, "y", attrs, "snap")], [("acct", "acct")], "fy", line_years=(2023, 2024))
        with pytest.raises(Exception, match="duplicate key in snap"):
            out.collect()


def test_the_final_cut_fails_on_a_duplicate_snapshot_whatever_is_read(spark):
    inp = rex.extract_inputs(SparkInputs(spark, SF))
    inp.other_packages = inp.other_packages.unionByName(inp.other_packages)
    pool = rx.prior_contracted_pool(rx.stages(inp, TEST_PARAMS).final_once, TEST_PARAMS)
    with pytest.raises(Exception, match="duplicate key in other packages"):
        pool.collect()


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    inp = rex.extract_inputs(SparkInputs(spark, SF))
    old = spark.conf.get(limit, None)
    try:
        spark.conf.unset(limit)
        rx.stages(inp, TEST_PARAMS)
        assert int(spark.conf.get(limit)) <= 8000
        spark.conf.set(limit, "20000")  # the session's own choice stays
        rx.stages(inp, TEST_PARAMS)
        assert spark.conf.get(limit) == "20000"
    finally:
        spark.conf.unset(limit) if old is None else spark.conf.set(limit, old)


def _inputs(spark):
    """Inputs with NULL keys in the lines, and accounts and packages that come twice."""
    inp = rex.extract_inputs(SparkInputs(spark, SF))
    size = F.col("ContactQuantity")
    inp.program_lines = inp.program_lines.withColumns(
        {
            "AccountID": F.when(size % 10 == 3, None).otherwise(F.col("AccountID")),
            "PackageID": F.when(size % 10 == 4, None).otherwise(F.col("PackageID")),
            "ProgramID": F.when(size % 10 > 7, None).otherwise(F.col("ProgramID")),
        }
    )
    inp.accounts = inp.accounts.unionByName(inp.accounts.where(F.length("ID") == 2))
    inp.program_packages = inp.program_packages.unionByName(inp.program_packages.where(F.col("ID").like("%7")))
    return inp


def test_lines_get_from_their_key_tuple_what_they_got_themselves(spark, shuffled):
    inp = _inputs(spark)
    alone, by_tuple = rx.raw_cut(inp, TEST_PARAMS), rx.raw_cut(inp, TEST_PARAMS, "table")
    assert by_tuple.count() > 1000
    assert _rows(by_tuple) == _rows(alone.drop(*rx.NOT_ROLLED))
    assert _exchanges(by_tuple, "ProgramCost") == 1


def test_final_cut_joins_the_lines_once_and_carries_what_is_read(spark, shuffled):
    inp = _inputs(spark)
    st = rx.stages(inp, TEST_PARAMS)
    assert _exchanges(st.final_once, "ProgramPackageName") == 1
    pool = rx.prior_contracted_pool(st.final_once, TEST_PARAMS)
    assert _exchanges(pool, "ProgramCost") >= 1 and _exchanges(pool, "AccountSegment") == 0
    assert set(rx.stages(inp, TEST_PARAMS, reads=()).final.columns) == rx.FINAL_READS
    apart = rx.final_cut(rx.stages(inp, TEST_PARAMS).data)  # flagged in a step of its own
    assert _rows(st.final_once) == _rows(apart)

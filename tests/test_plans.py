"""Physical-plan checks: the shapes the design relies on at scale."""

import io
import tempfile
from contextlib import redirect_stdout

import pytest

from yoyflow.plans import registry_extract as rex
from yoyflow.plans import revenue_extract as rx
from yoyflow.plans import renewal_pool as rp
from yoyflow.plans.registry import TEST_PARAMS, renewal_inputs
from yoyflow.sources.adapters import SparkInputs

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


class _Stored:
    """Adapter outputs written to parquet and read back, like stored inputs."""

    def __init__(self, spark):
        self.x, self.root, self.spark = SparkInputs(spark, SF), tempfile.mkdtemp(prefix="yoyflow-test-"), spark

    def __getitem__(self, name):
        path = f"{self.root}/{name}"
        self.x[name].write.parquet(path)
        return self.spark.read.parquet(path)


@pytest.fixture(scope="module")
def extract_plan(spark):
    inp = rex.extract_inputs(_Stored(spark))
    return _plan(rx.revenue_extract(inp, TEST_PARAMS, materialize="none"))


def test_extract_plan_shapes(extract_plan):
    assert "LeftAnti" in extract_plan  # roll-forward anti-join, not LEFT + IS NULL
    assert "BroadcastHashJoin" in extract_plan  # fixed code tables
    assert "Window" not in extract_plan  # per-group totals are aggregate-and-join
    for op in FORBIDDEN:
        assert op not in extract_plan


def test_best_match_plan_has_no_pairs(spark):
    inp = renewal_inputs(SparkInputs(spark, SF))
    pool = rp.build_pool(inp, TEST_PARAMS)
    cands = rp.candidate_subscriptions(inp.cpq_subscriptions, inp.raw_subscriptions, inp.opportunities)
    plan = _plan(rp.best_matches(pool, inp.cpq_subscriptions, cands))
    assert "Window" in plan
    for op in FORBIDDEN:
        assert op not in plan


def test_filters_reach_the_scan(spark):
    """Stored by fiscal year, the program lines are pruned to two partitions
    and the remaining predicates are pushed into the parquet reader."""
    lines = SparkInputs(spark, SF)["x_program_lines"]
    path = tempfile.mkdtemp(prefix="yoyflow-test-") + "/program_lines"
    lines.write.partitionBy("FiscalYear").parquet(path)
    stored = spark.read.parquet(path)
    plan = _plan(stored.where(rx.scope_filter(TEST_PARAMS)).select("AccountID", "ProgramCost"))
    assert "PartitionFilters: [FiscalYear" in plan and "IN (1997,1998)" in plan
    assert "PushedFilters: [IsNotNull(JobNumber)" in plan
    scan = plan[plan.index("Scan parquet"):]
    read_schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "Full_CVExclude" not in read_schema and "TermEndDate" not in read_schema


def test_wide_pool_rows_are_shuffled_once(spark):
    """The dimensions meet the narrow key tuples of the renewals, the rows only the result."""
    inp = renewal_inputs(_Stored(spark))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = _plan(rp.build_pool(inp, TEST_PARAMS)).split("\n\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [n for n in nodes if ") Exchange\n" in n]
    assert len(exchanges) > 5 and sum("SourceObjectName" in n for n in exchanges) == 1


def test_lines_read_twice_are_stored(spark, monkeypatch):
    """Rolled-up lines, lines with their year's context, and flagged lines."""
    stored = []
    monkeypatch.setattr(rx, "cut_lineage", lambda df, how="table": stored.append(how) or df)
    rx.stages(rex.extract_inputs(SparkInputs(spark, SF)), TEST_PARAMS).final
    assert stored == ["table"] * 3

"""Whole-job properties on the sf0.001 adapter inputs."""

import pytest
from pyspark.sql import functions as F

from yoyflow.operators.lookup import lookup_by_code
from yoyflow.plans import revenue_extract as rx
from yoyflow.plans import renewal_pool as rp
from yoyflow.plans.registry import TEST_PARAMS, renewal_inputs
from yoyflow.plans.registry_extract import extract_inputs
from yoyflow.sources import codetables
from yoyflow.sources.adapters import SparkInputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def st(spark):
    return rx.stages(extract_inputs(SparkInputs(spark, SF)), TEST_PARAMS, materialize="table")


def test_lookup_joins_keep_row_count(spark):
    lines = SparkInputs(spark, SF)["x_program_lines"]
    n = lines.count()
    out = lookup_by_code(lines, F.col("JobNumber").substr(-2, 2), codetables.campaign_group_rows(), codetables.CAMPAIGN_GROUPS_SCHEMA, "lk_code")
    out = lookup_by_code(out, F.left("JobNumber", F.lit(3)), codetables.CONSORTIUM_CLIENTS, codetables.CONSORTIUM_SCHEMA, "lk_client_code")
    assert out.count() == n


def test_raw_cut_keeps_scoped_line_count(spark, st):
    lines = SparkInputs(spark, SF)["x_program_lines"]
    assert st.raw.count() == lines.where(rx.scope_filter(TEST_PARAMS)).count()


def test_union_is_sum_of_branches(st):
    roll = rx.rollforward_branch(st.pool, TEST_PARAMS).count()
    cur = rx.current_branch(st.contracted, TEST_PARAMS).count()
    assert st.extract.count() == roll + cur
    assert st.extract.columns == rx.EXTRACT_COLUMNS


def test_rolled_forward_units_absent_from_control_year(st):
    keys = ["AccountID", "Audience", "CampaignCode", "Model_ProductGroup"]
    assert st.pool.join(st.contracted.select(*keys), keys, "inner").count() == 0
    assert st.pool.count() > 0


def test_pool_keeps_rows_and_links_at_most_once(spark):
    inp = renewal_inputs(SparkInputs(spark, SF))
    pool = rp.build_pool(inp, TEST_PARAMS)
    linked = rp.renewal_pool(inp, TEST_PARAMS)
    assert linked.count() == pool.count()
    assert linked.groupBy("SourceObjectSFID").count().where("count > 1").count() == 0
    assert linked.where(F.col("SCProof_Mapping").isNotNull()).count() > 0


def test_rule_coverage(spark, st):
    """Every accrual-type outcome and every current revenue type occurs in the test data."""
    types = {r[0] for r in st.raw.select("RevAccrual_Type").distinct().collect()}
    assert {"Discount Allocation", "Cross-sell Discount", "Up-sell Discount", "Discount", "Cost Movement", "Re-engagement"} <= types
    eb = {r[0] for r in st.extract.select("EB_RevType").distinct().collect()}
    assert {"Lost Client", "Campaign Drop", "New Sale", "Pending Renewal", "Discount Drop"} <= eb


def test_every_match_tier_wins_somewhere(spark):
    from yoyflow.operators.match import CASE_ORDER

    inp = renewal_inputs(SparkInputs(spark, "/root/testdata/sf0.01"))
    pool = rp.build_pool(inp, TEST_PARAMS)
    cands = rp.candidate_subscriptions(inp.cpq_subscriptions, inp.raw_subscriptions, inp.opportunities)
    best = rp.best_matches(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS))
    assert {r[0] for r in best.select("MatchCat").distinct().collect()} == set(CASE_ORDER)

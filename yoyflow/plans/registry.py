"""Registry of named queries: one per operator or job.

Each entry has

* a Spark callable ``(spark, sf_dir) -> DataFrame`` that reads the driver's
  tables, maps them to job inputs with the adapters and runs the operator, and
* (where SQL can express it) an independent DuckDB SQL text over the same
  tables, used as the correctness oracle.

Both sides present their columns the same way (see ``present``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.operators.audit import duplicate_keys
from yoyflow.operators.groups import distinct_indicator, parent_hop
from yoyflow.params import RunParams
from yoyflow.plans import oracle_renewal as orn
from yoyflow.plans import renewal_pool as rp
from yoyflow.plans.present import present, sql_present
from yoyflow.session import cut_lineage
from yoyflow.sources.adapters import SparkInputs, duckdb_with

# Parameters of the test-data runs: the driver's orders span 1995-2001.
TEST_PARAMS = RunParams(control_year=1998, as_of="1998-12-15 00:00:00")

RENEWAL_ADAPTERS = [
    "x_cpq_subscriptions", "x_raw_subscriptions", "x_opportunities", "x_program_renewals",
    "x_account_segments", "x_programs", "x_predecessors", "x_subscription_periods",
    "x_program_subscriptions", "x_shared_enrolments", "x_standard_contracts",
]

POOL_KINDS = """Vertical:s, ProductGroup:s, SourceObjectSFID:s, SourceObjectName:s, AccountSFID:s, AccountName:s,
AccountSegment:s, SharedUG_Ind:s, Program:s, Acronym:s, DecisionType:s, AutoRenew:i, Stage:s,
PreviousYearCredit:m, ProposalValue:m, RenewalCredit:m, AccountHealth:s, RenewalHealth:s, PoolDate:d,
PoolYear_FY:i, PoolHalf_FY:s, PoolQuarter_FY:s, PeriodStartDate:d, CPQ_SubscriptionID:s,
StandardContract:s, SubscriptionSFID_Program:s, StandardContractSFID_Proof:s,
StandardContractNum_Proof:s, SCProof_Mapping:s"""

CANDS_KINDS = """SubscriptionSFID:s, SubscriptionSFID_ProgramSub:s, StandardContractSFID:s, AccountSFID:s,
RecordType_Sub:s, StartDate:d, EndDate:d, CustomerAmount:m, ListPrice:m, ProgramSFID:s, ProgramAcronym:s,
Class_1:s, CreatedDate:t, CPQ_Type:s, ContractStartDate:d, ContractEndDate:d,
StandardContractSFID_Prior:s, StandardContractSFID_Prior_PHXMig:s"""


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def renewal_inputs(x: SparkInputs) -> rp.RenewalInputs:
    return rp.RenewalInputs(
        cpq_subscriptions=x["x_cpq_subscriptions"],
        raw_subscriptions=x["x_raw_subscriptions"],
        opportunities=x["x_opportunities"],
        program_renewals=x["x_program_renewals"],
        account_segments=x["x_account_segments"],
        programs=x["x_programs"],
        predecessors=x["x_predecessors"],
        subscription_periods=x["x_subscription_periods"],
        program_subscriptions=x["x_program_subscriptions"],
        shared_enrolments=x["x_shared_enrolments"],
        standard_contracts=x["x_standard_contracts"],
    )


def _renewal_sql(upto: str, final: str, kinds: str, params: RunParams = TEST_PARAMS) -> str:
    inner = duckdb_with(RENEWAL_ADAPTERS) + ",\n" + orn.renewal_ctes(params, upto) + "\n" + final
    return sql_present(inner, kinds)


# --- renewal pool queries ----------------------------------------------------------


def q_filter_cross_table_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SparkInputs(spark, sf_dir)
    return present(rp.candidate_subscriptions(x["x_cpq_subscriptions"], x["x_raw_subscriptions"], x["x_opportunities"]))


def q_parent_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SparkInputs(spark, sf_dir)
    opps = x["x_opportunities"]
    out = parent_hop(opps, "Parent_Opportunity__c", opps, "Id", {"Parent_RenewedContract": "SO_RenewedContract"})
    return present(out.select("Id", "SO_RenewedContract", "Parent_Opportunity__c", "Parent_RenewedContract"))


def q_distinct_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SparkInputs(spark, sf_dir)
    shared = x["x_shared_enrolments"].where(
        (F.lower(F.rtrim("Audience")) == "ug accounts") & F.lower(F.rtrim("AccountType")).isin("renewal", "first year free")
    )
    pr = x["x_program_renewals"].select("SourceObjectSFID", "AccountSFID", "PoolYear_FY")
    out = distinct_indicator(pr, shared, ["AccountSFID", "PoolYear_FY"], ["AccountID", "FiscalYear"], "_ind")
    return present(
        out.select(
            "SourceObjectSFID", "AccountSFID", "PoolYear_FY",
            F.when(F.col("_ind") == 1, "Shared").otherwise("Standalone").alias("SharedUG_Ind"),
        )
    )


def q_filter_overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SparkInputs(spark, sf_dir)
    pr = x["x_program_renewals"].select("SourceObjectSFID", "SubPeriodSFID")
    sp = x["x_subscription_periods"]
    j = pr.join(sp, pr["SubPeriodSFID"] == sp["Id"], "left")
    parsed = rp.notification_date()
    return present(
        j.select(
            "SourceObjectSFID",
            "Autorenewal_Notification_Date__c",
            parsed.alias("notification_date"),
            rp.notification_state().alias("date_state"),
            F.coalesce(parsed.cast("timestamp_ntz") < TEST_PARAMS.as_of_col(), F.lit(False)).cast("int").alias("is_overdue"),
        )
    )


def q_date_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many notification dates are read, absent and unreadable (the source would abort on the last)."""
    periods = SparkInputs(spark, sf_dir)["x_subscription_periods"]
    return present(periods.groupBy(rp.notification_state().alias("date_state")).agg(F.count(F.lit(1)).alias("n_rows")))


def q_pool_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rp.build_pool(renewal_inputs(SparkInputs(spark, sf_dir)), TEST_PARAMS))


def q_drop_unused_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rp.build_pool(renewal_inputs(SparkInputs(spark, sf_dir)), TEST_PARAMS, keep_unused_joins=True))


# what the match reads of the pool, and what the link patches
MATCHED_COLUMNS = ["SourceObjectSFID", "SubscriptionSFID_Program", "PeriodStartDate"]
PROOF_COLUMNS = ["StandardContractSFID_Proof", "StandardContractNum_Proof", "SCProof_Mapping"]


def _pool_and_cands(spark: SparkSession, sf_dir: str, *columns: str):
    """The job's pool, in the columns that the query reads, and its candidates.  Pool and
    opportunities (a table to the job, a join of the test tables here) are read twice and stored."""
    inp = renewal_inputs(SparkInputs(spark, sf_dir))
    inp.opportunities = cut_lineage(inp.opportunities)
    pool = cut_lineage(rp.build_pool(inp, TEST_PARAMS).select(*MATCHED_COLUMNS, *columns))
    cands = rp.candidate_subscriptions(inp.cpq_subscriptions, inp.raw_subscriptions, inp.opportunities)
    return inp, pool, cands


def q_range_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, pool, cands = _pool_and_cands(spark, sf_dir)
    return present(rp.range_candidate_counts(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS)))


def q_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, pool, cands = _pool_and_cands(spark, sf_dir)
    return present(rp.best_matches(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS)).drop("match_rank"))


def q_match_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, pool, cands = _pool_and_cands(spark, sf_dir)
    best = rp.best_matches(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS))
    return present(best.groupBy("MatchCat").agg(F.count(F.lit(1)).alias("n_pool_rows")))


def q_match_pair_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, pool, cands = _pool_and_cands(spark, sf_dir)
    return present(rp.pair_tier_histogram(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS)))


def q_update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, pool, cands = _pool_and_cands(spark, sf_dir, *PROOF_COLUMNS)
    best = rp.best_matches(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS))
    out = rp.link_contracts(pool, best, inp.standard_contracts)
    return present(out.select("SourceObjectSFID", "StandardContractSFID_Proof", "StandardContractNum_Proof", "SCProof_Mapping"))


def q_renewal_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rp.renewal_pool(renewal_inputs(SparkInputs(spark, sf_dir)), TEST_PARAMS, materialize="table"))


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return present(duplicate_keys(li, ["l_orderkey", "l_linenumber"]))


def q_pool_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SparkInputs(spark, sf_dir)
    inp = renewal_inputs(x)
    inp.subscription_periods = x["x_subscription_periods_dup"]
    return present(duplicate_keys(rp.build_pool(inp, TEST_PARAMS), ["SourceObjectSFID"]))


def renewal_queries() -> list[Query]:
    pool_final = "SELECT * FROM o_pool"
    return [
        Query("filter_cross_table_or", q_filter_cross_table_or, _renewal_sql("o_cands", "SELECT * FROM o_cands", CANDS_KINDS)),
        Query(
            "parent_hop",
            q_parent_hop,
            sql_present(
                duckdb_with(["x_opportunities"])
                + """
SELECT o.Id, o.SO_RenewedContract, o.Parent_Opportunity__c, po.SO_RenewedContract AS Parent_RenewedContract
FROM x_opportunities o LEFT JOIN x_opportunities po ON o.Parent_Opportunity__c = po.Id""",
                "Id:s, SO_RenewedContract:s, Parent_Opportunity__c:s, Parent_RenewedContract:s",
            ),
        ),
        Query(
            "distinct_indicator",
            q_distinct_indicator,
            sql_present(
                duckdb_with(["x_program_renewals", "x_shared_enrolments"])
                + """
SELECT pr.SourceObjectSFID, pr.AccountSFID, pr.PoolYear_FY,
       CASE WHEN ug.Shared_Ind = 1 THEN 'Shared' ELSE 'Standalone' END AS SharedUG_Ind
FROM x_program_renewals pr
LEFT JOIN (SELECT AccountID, FiscalYear, 1 AS Shared_Ind FROM x_shared_enrolments
           WHERE lower(rtrim(Audience)) = 'ug accounts'
             AND lower(rtrim(AccountType)) IN ('renewal', 'first year free')
           GROUP BY AccountID, FiscalYear) ug
       ON ug.AccountID = pr.AccountSFID AND ug.FiscalYear = pr.PoolYear_FY""",
                "SourceObjectSFID:s, AccountSFID:s, PoolYear_FY:i, SharedUG_Ind:s",
            ),
        ),
        Query(
            "filter_overdue",
            q_filter_overdue,
            sql_present(
                duckdb_with(["x_program_renewals", "x_subscription_periods"])
                + f"""
SELECT pr.SourceObjectSFID, sp.Autorenewal_Notification_Date__c,
       {orn.notification_sql('sp.Autorenewal_Notification_Date__c')} AS notification_date,
       {orn.notification_state_sql('sp.Autorenewal_Notification_Date__c')} AS date_state,
       CASE WHEN {orn.notification_sql('sp.Autorenewal_Notification_Date__c')} < TIMESTAMP '{TEST_PARAMS.as_of}'
            THEN 1 ELSE 0 END AS is_overdue
FROM x_program_renewals pr LEFT JOIN x_subscription_periods sp ON pr.SubPeriodSFID = sp.Id""",
                "SourceObjectSFID:s, Autorenewal_Notification_Date__c:s, notification_date:d, date_state:s, is_overdue:i",
            ),
        ),
        Query(
            "date_states",
            q_date_states,
            sql_present(
                duckdb_with(["x_subscription_periods"])
                + f"\nSELECT {orn.notification_state_sql('Autorenewal_Notification_Date__c')} AS date_state, count(*) AS n_rows FROM x_subscription_periods GROUP BY ALL",
                "date_state:s, n_rows:i",
            ),
        ),
        Query("pool_classify", q_pool_classify, _renewal_sql("o_pool", pool_final, POOL_KINDS)),
        Query(
            "drop_unused_join",
            q_drop_unused_join,
            sql_present(
                duckdb_with(RENEWAL_ADAPTERS) + ",\no_pool AS (" + orn.pool_sql(TEST_PARAMS, keep_unused_joins=True) + "\n)\n" + pool_final,
                POOL_KINDS,
            ),
        ),
        Query(
            "range_candidates",
            q_range_candidates,
            _renewal_sql(
                "o_pairs",
                "SELECT SourceObjectSFID, count(*) AS n_candidates FROM o_pairs GROUP BY SourceObjectSFID",
                "SourceObjectSFID:s, n_candidates:i",
            ),
        ),
        Query(
            "best_match",
            q_best_match,
            _renewal_sql("o_best", "SELECT * FROM o_best", "SourceObjectSFID:s, StandardContractSFID:s, MatchCat:s"),
        ),
        Query(
            "match_tiers",
            q_match_tiers,
            _renewal_sql(
                "o_best",
                "SELECT MatchCat, count(*) AS n_pool_rows FROM o_best GROUP BY MatchCat",
                "MatchCat:s, n_pool_rows:i",
            ),
        ),
        Query(
            "match_pair_tiers",
            q_match_pair_tiers,
            _renewal_sql(
                "o_pairs",
                "SELECT MatchCat, count(*) AS n_pairs FROM o_pairs GROUP BY MatchCat",
                "MatchCat:s, n_pairs:i",
            ),
        ),
        Query(
            "update_from",
            q_update_from,
            _renewal_sql(
                "o_linked",
                "SELECT SourceObjectSFID, StandardContractSFID_Proof, StandardContractNum_Proof, SCProof_Mapping FROM o_linked",
                "SourceObjectSFID:s, StandardContractSFID_Proof:s, StandardContractNum_Proof:s, SCProof_Mapping:s",
            ),
        ),
        Query("renewal_pool", q_renewal_pool, _renewal_sql("o_linked", "SELECT * FROM o_linked", POOL_KINDS)),
        Query(
            "pool_duplicate_keys",
            q_pool_duplicate_keys,
            sql_present(
                duckdb_with([*RENEWAL_ADAPTERS, "x_subscription_periods_dup"])
                + ",\no_pool AS (" + orn.pool_sql(TEST_PARAMS, periods="x_subscription_periods_dup")
                + "\n)\nSELECT SourceObjectSFID, count(*) AS n_rows FROM o_pool GROUP BY SourceObjectSFID HAVING count(*) > 1",
                "SourceObjectSFID:s, n_rows:i",
            ),
        ),
        Query(
            "duplicate_keys",
            q_duplicate_keys,
            sql_present(
                "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
                "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
                "l_orderkey:i, l_linenumber:i, n_rows:i",
            ),
        ),
    ]


def extract_queries(params: RunParams = TEST_PARAMS) -> list[Query]:
    from yoyflow.plans.registry_extract import build

    return [Query(name, run, sql) for name, run, sql in build(params)]


def all_queries() -> list[Query]:
    return extract_queries() + renewal_queries()

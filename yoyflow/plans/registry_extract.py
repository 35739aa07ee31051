"""Registered revenue-extract queries (Spark callables + DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.functions.keys import decode_client, decode_code, encode_key, key_length, year_suffix
from yoyflow.functions.text import concat_null, eq_ci, like_ci, not_isin_ci
from yoyflow.operators.allocate import alignment_stats, allocation_conservation, prior_contracted_pool
from yoyflow.operators.collated import group
from yoyflow.operators.audit import conservation, fanout_report
from yoyflow.operators.rollforward import POOL_GROUP, discount_counts
from yoyflow.plans import oracle_extract as ox
from yoyflow.plans import revenue_extract as rx
from yoyflow.plans.present import present, sql_present
from yoyflow.sources.adapters import SparkInputs, duckdb_with

EXTRACT_ADAPTERS = [
    "x_program_lines", "x_accounts", "x_account_segments", "x_program_packages", "x_program_optouts",
    "x_enrolment_packages", "x_other_packages", "x_all_packages",
]

_TS = {
    "SignatureDate", "Renewal_Package_FirstSigned", "Renewal_Campaign_FirstSigned", "Campaign_First_Sign",
    "First_Re_engagement", "First_Cross_Sell", "First_Modification", "First_DA", "First_Discount",
    "ContractSentDate", "ProposalSentDate", "TermStartDate", "TermEndDate",
}
_MONEY = {
    "ProgramCost", "ContactQuantity", "Extra1Cost", "Extra2Cost", "CV_Prior", "ContactQuant_Prior", "CV_Current",
    "ContactQuant_Current", "Extra1Cost_Current", "Extra2Cost_Current", "pool_value", "allocated_value", "remainder", "residual",
    "sum_cv_current", "sum_cv_prior",
}
_INT = {
    "FiscalYear", "NBB", "OptOut_Ind", "Client_Current_Tenure_Index", "Client_NY_Tenure_Index", "Current_Tenure_Index",
    "Upcoming_Tenure_Index", "DiscountCurrent_Count", "PriorNonDiscount_Count", "n_rows", "key_length",
    "is_cross_sell", "has_discount", "discount_prefix", "is_pending", "in_control_year", "right_matches", "n_left_rows",
    *ox.STAT_COLUMNS[:8],
}


def kind(col: str) -> str:
    if col in _TS:
        return "t"
    if col in _MONEY:
        return "m"
    if col in _INT:
        return "i"
    if col == "CreatedDate":
        return "d"
    return "s"


def spec(cols: Sequence[str]) -> str:
    return ", ".join(f"{c}:{kind(c)}" for c in cols)


def extract_inputs(x: SparkInputs) -> rx.ExtractInputs:
    return rx.ExtractInputs(
        program_lines=x["x_program_lines"],
        accounts=x["x_accounts"],
        account_segments=x["x_account_segments"],
        program_packages=x["x_program_packages"],
        program_optouts=x["x_program_optouts"],
        enrolment_packages=x["x_enrolment_packages"],
        other_packages=x["x_other_packages"],
        all_packages=x["x_all_packages"],
    )


def _stages(spark: SparkSession, sf_dir: str, params, reads: Collection[str] | None = None) -> rx.ExtractStages:
    return rx.stages(extract_inputs(SparkInputs(spark, sf_dir)), params, materialize="table", reads=reads)


def _sql(params, upto: str | None, final: str, cols: Sequence[str], tables: dict[str, str] | None = None) -> str:
    head = duckdb_with([*EXTRACT_ADAPTERS, *(tables or {}).values()])
    if upto is not None:
        head += ",\n" + ox.extract_ctes(params, upto, tables)
    return sql_present(head + "\n" + final, spec(cols))


def build(params) -> list[tuple[str, Callable[[SparkSession, str], DataFrame], str]]:
    out: list[tuple[str, Callable, str]] = []

    def stage_query(name: str, stage: str, cols: Sequence[str], oracle_stage: str, reads: Collection[str] | None = None) -> None:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(getattr(_stages(spark, sf_dir, params, reads), stage).select(*cols))

        out.append((name, run, _sql(params, oracle_stage, f"SELECT {', '.join(cols)} FROM {oracle_stage}", cols)))

    # -- filters on the raw program lines ------------------------------------------------
    def q_scope(spark, sf_dir):
        lines = SparkInputs(spark, sf_dir)["x_program_lines"]
        return present(lines.where(rx.scope_filter(params)).groupBy("FiscalYear", "ProgramStatus").agg(F.count(F.lit(1)).alias("n_rows")))

    out.append((
        "filter_scope_two_year", q_scope,
        _sql(params, None, f"SELECT FiscalYear, ProgramStatus, count(*) AS n_rows FROM x_program_lines rap "
                           f"WHERE {ox.scope_where(params)} GROUP BY FiscalYear, ProgramStatus",
             ["FiscalYear", "ProgramStatus", "n_rows"]),
    ))

    def q_nulls(spark, sf_dir):
        lines = SparkInputs(spark, sf_dir)["x_program_lines"]
        keep = (
            not_isin_ci(concat_null("Audience", "PType"), rx.EXCLUDED_AUDIENCE_TYPES)
            & not_isin_ci("Campaign", rx.EXCLUDED_CAMPAIGNS)
            & F.col("JobNumber").isNotNull()
            & ((F.col("SignatureDate") <= params.as_of_col()) | F.col("SignatureDate").isNull())
        )
        return present(lines.where(keep).groupBy("FiscalYear", "Audience").agg(F.count(F.lit(1)).alias("n_rows")))

    out.append((
        "filter_null_semantics", q_nulls,
        _sql(params, None, f"SELECT FiscalYear, Audience, count(*) AS n_rows FROM x_program_lines rap "
                           f"WHERE {ox.null_semantics_where(params)} GROUP BY FiscalYear, Audience",
             ["FiscalYear", "Audience", "n_rows"]),
    ))

    flag_cols = ["is_cross_sell", "has_discount", "discount_prefix", "is_pending", "in_control_year"]

    def q_pattern(spark, sf_dir):
        lines = SparkInputs(spark, sf_dir)["x_program_lines"]
        flags = [
            eq_ci("PType", "Cross-sell").cast("int").alias("is_cross_sell"),
            like_ci("Campaign", "%Discount%").cast("int").alias("has_discount"),
            like_ci("Campaign", "Discount%").cast("int").alias("discount_prefix"),
            like_ci("ProgramStatus", "Pending%").cast("int").alias("is_pending"),
            # a numeric year compared like text: plain integer equality
            (F.col("FiscalYear") == params.control_year).cast("int").alias("in_control_year"),
        ]
        return present(lines.select(*flags).groupBy(*flag_cols).agg(F.count(F.lit(1)).alias("n_rows")))

    out.append((
        "pattern_ci", q_pattern,
        _sql(params, None, f"""SELECT CAST({ox.eq('PType', 'Cross-sell')} AS INT) AS is_cross_sell,
       CAST({ox.like('Campaign', '%Discount%')} AS INT) AS has_discount,
       CAST({ox.like('Campaign', 'Discount%')} AS INT) AS discount_prefix,
       CAST({ox.like('ProgramStatus', 'Pending%')} AS INT) AS is_pending,
       CAST(FiscalYear = {params.control_year} AS INT) AS in_control_year,
       count(*) AS n_rows
FROM x_program_lines GROUP BY ALL""", [*flag_cols, "n_rows"]),
    ))

    key_cols = ["JobNumber", "FiscalYear", "client_code", "campaign_code", "key_length", "year_code", "rebuilt"]

    def q_keys(spark, sf_dir):
        lines = SparkInputs(spark, sf_dir)["x_program_lines"].select("JobNumber", "FiscalYear").distinct()
        client = decode_client("JobNumber", params.code_width, params.year_width)
        code = decode_code("JobNumber", params.code_width)
        return present(
            lines.select(
                "JobNumber", "FiscalYear", client.alias("client_code"), code.alias("campaign_code"),
                key_length("JobNumber").alias("key_length"), year_suffix("FiscalYear", params.year_width).alias("year_code"),
                encode_key(client, "FiscalYear", code, params.year_width).alias("rebuilt"),
            )
        )

    out.append((
        "key_decode", q_keys,
        _sql(params, None, f"""SELECT JobNumber, FiscalYear, {ox.dclient('JobNumber')} AS client_code,
       right(JobNumber, 2) AS campaign_code, length(rtrim(JobNumber)) AS key_length,
       right(CAST(FiscalYear AS VARCHAR), 2) AS year_code,
       {ox.dclient('JobNumber')} || right(CAST(FiscalYear AS VARCHAR), 2) || right(JobNumber, 2) AS rebuilt
FROM (SELECT DISTINCT JobNumber, FiscalYear FROM x_program_lines) k""", key_cols),
    ))

    repair_cols = ["AccountID", "FiscalYear", "Campaign", "ClientCode", "BinderClientCode", "JobNumber_Source", "JobNumber"]

    def q_repair(spark, sf_dir):
        raw = _stages(spark, sf_dir, params).raw
        return present(
            raw.select(
                "AccountID", "FiscalYear", "Campaign", "ClientCode", "BinderClientCode",
                F.col("JobNumber").alias("JobNumber_Source"), rx.repaired_job_number(params).alias("JobNumber"),
            )
        )

    out.append((
        "key_repair", q_repair,
        _sql(params, "o_raw", f"""SELECT AccountID, FiscalYear, Campaign, ClientCode, BinderClientCode, JobNumber AS JobNumber_Source,
       {ox.repair_sql(params, 'a')} AS JobNumber FROM o_raw a""", repair_cols),
    ))

    stage_query("lookup_by_code", "raw",
                ["ProgramID", "JobNumber", "Account", "ClientCode", "Campaign", "CampaignCode", "Model_ProductGroup", "Audience"],
                "o_raw")
    stage_query("dim_enrich", "raw",
                ["ProgramID", "AccountID", "BinderClientCode", "AccountSegment", "ProgramPackageName", "OptOut_Ind", "CreatedDate"],
                "o_raw")

    def q_optout(spark, sf_dir):
        opts = SparkInputs(spark, sf_dir)["x_program_optouts"]
        return present(rx.optout_counts(opts, params).withColumnRenamed("_optout_id", "Id"))

    out.append((
        "optout_agg", q_optout,
        _sql(params, None, f"SELECT Id, sum(CASE WHEN Opt_Out__c = 1 THEN 1 ELSE 0 END) AS OptOut_Ind "
                           f"FROM x_program_optouts WHERE Fiscal_Year__c >= {params.prior_year} GROUP BY Id",
             ["Id", "OptOut_Ind"]),
    ))

    def grouped(name: str, stage: str, keys: Sequence[str], oracle_stage: str) -> None:
        def run(spark, sf_dir):
            df = getattr(_stages(spark, sf_dir, params), stage)
            return present(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")))

        k = ", ".join(keys)
        out.append((name, run, _sql(params, oracle_stage, f"SELECT {k}, count(*) AS n_rows FROM {oracle_stage} GROUP BY {k}", [*keys, "n_rows"])))

    grouped("classify_accrual", "raw", ["PType", "Campaign", "RevAccrual_Type"], "o_raw")
    grouped("classify_opportunity", "data", ["OppType", "ProgramStatus"], "o_data")

    data_cols = [
        "FiscalYear", "DataSource", "AccountStatus", "AccountID", "Account", "AccountParent", "ClientCode",
        "BinderClientCode", "Campaign", "CampaignCode", "Model_ProductGroup", "Audience", "JobNumber",
        "ProgramPackageName", "PackageID", "Package_Engagement_Status", "SignatureDate", "Renewal_Package_FirstSigned",
        "Renewal_Campaign_FirstSigned", "RevAccrual_Type", "NBB", "Campaign_First_Sign", "OppType", "ProgramStatus",
        "ProgramCost", "ContactQuantity", "Extra1Cost", "Extra2Cost", "CurrentSL", "RevAccrualType", "AccountSegment",
        "Client_Current_RenewalType", "Client_Current_Tenure_Index", "Client_Current_Tenure", "Client_NY_Tenure_Index",
        "Client_NY_Tenure",
    ]
    stage_query("rollup_lines", "data", data_cols, "o_data")
    def q_dup_snapshots(spark, sf_dir):
        x = SparkInputs(spark, sf_dir)
        inp = extract_inputs(x)
        inp.enrolment_packages = x["x_enrolment_packages_dup"]
        raw = rx.raw_cut(inp, params)
        return present(rx.summarise(raw, inp, params, on_duplicate="keep", materialize="table").select(*data_cols))

    out.append((
        "rollup_duplicate_snapshots", q_dup_snapshots,
        _sql(params, "o_data", f"SELECT {', '.join(data_cols)} FROM o_data", data_cols, {"enrolment_packages": "x_enrolment_packages_dup"}),
    ))

    # lines whose labels come in mixed case and with trailing blanks, rolled up
    text_cols = ["FiscalYear", "Audience", "RevAccrual_Type", "OppType", "ProgramStatus", "n_rows", "sum_cv_current"]

    def q_text(spark, sf_dir):
        x = SparkInputs(spark, sf_dir)
        inp = extract_inputs(x)
        inp.program_lines = x["x_program_lines_spelled"]
        rolled = group(rx.raw_cut(inp, params), rx.ROLLUP_KEYS, F.sum("ProgramCost").alias("cost"))
        return present(rolled.groupBy(*text_cols[:5]).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cost").alias("sum_cv_current")))

    out.append((
        "key_text_semantics", q_text,
        _sql(params, "o_raw", f"""SELECT {', '.join(text_cols[:5])}, count(*) AS n_rows, sum(cost) AS sum_cv_current
FROM (SELECT {', '.join(f'min({k}) AS {k}' for k in ox.LINE_KEYS)}, sum(ProgramCost) AS cost FROM o_raw
      GROUP BY {', '.join(f'lower(rtrim(CAST({k} AS VARCHAR)))' for k in ox.LINE_KEYS)}) GROUP BY ALL""", text_cols, {"program_lines": "x_program_lines_spelled"}),
    ))

    # the whole job over inputs of which every text key is respelled, lines and dimensions each in their own way
    respelled = {n: f"x_{n}_respelled" for n in ox.INPUTS}

    def q_respelled(spark, sf_dir):
        x = SparkInputs(spark, sf_dir)
        inp = rx.ExtractInputs(**{n: x[t] for n, t in respelled.items()})
        return present(rx.revenue_extract(inp, params, materialize="table"))

    out.append((
        "extract_respelled", q_respelled,
        _sql(params, "o_extract", "SELECT * FROM o_extract", rx.EXTRACT_COLUMNS, respelled),
    ))
    stage_query("first_event_flag", "data",
                ["AccountID", "CampaignCode", "Audience", "FiscalYear", "SignatureDate", "Campaign_First_Sign", "OppType"], "o_data")
    stage_query("year_offset_join", "data",
                ["AccountID", "FiscalYear", "Audience", "Client_Current_RenewalType", "Client_Current_Tenure_Index",
                 "Client_Current_Tenure", "Client_NY_Tenure_Index", "Client_NY_Tenure"], "o_data")
    stage_query("group_flag", "final_once",
                ["FiscalYear", "AccountID", "CampaignCode", "Audience", "ProgramStatus", "RevAccrualType", "Model_ProductGroup"],
                "o_final")
    stage_query("classify_secured", "final_once",
                ["AccountID", "JobNumber", "OppType", "RevAccrualType", "ProgramStatus", "SecuredCV_Classification"], "o_final")

    stat_cols = ["FiscalYear", "AccountID", "CampaignCode", "Audience", "Model_ProductGroup", "JobNumber", *ox.STAT_COLUMNS]

    def q_stats(spark, sf_dir):
        return present(alignment_stats(_stages(spark, sf_dir, params).final_once, params).select(*stat_cols))

    out.append(("alignment_stats", q_stats, _sql(params, "o_stats", f"SELECT {', '.join(stat_cols)} FROM o_stats", stat_cols)))

    prior_cols = ["AccountID", "ClientCode", "Audience", "CampaignCode", "JobNumber", "Model_ProductGroup",
                  "JobNumber_ClientCode", "CV_Prior", "ContactQuant_Prior"]

    def q_prior(spark, sf_dir):
        return present(prior_contracted_pool(_stages(spark, sf_dir, params).final_once, params).select(*prior_cols))

    out.append(("prior_pool", q_prior, _sql(params, "o_prior", f"SELECT {', '.join(prior_cols)} FROM o_prior", prior_cols)))

    stage_query("allocate_prior_value", "contracted_once",
                ["AccountID", "Audience", "Model_ProductGroup", "ClientCode", "CampaignCode", "JobNumber", "Campaign",
                 "RevAccrualType", "ProgramStatus", "SignatureDate", "CV_Prior", "ContactQuant_Prior"], "o_contracted", reads=())

    unit = ["AccountID", "Audience", "Model_ProductGroup", "ClientCode", "CampaignCode"]
    audit_cols = [*unit, "pool_value", "allocated_value", "remainder", "residual"]

    def q_audit(spark, sf_dir):
        st = _stages(spark, sf_dir, params, reads=())
        pool = prior_contracted_pool(st.final, params)
        return present(allocation_conservation(pool, st.contracted_once, unit).select(*audit_cols))

    u = ", ".join(unit)
    out.append((
        "allocation_audit", q_audit,
        _sql(params, "o_contracted", f"""SELECT {', '.join(f'coalesce(p.{c}, a.{c}) AS {c}' for c in unit)},
       coalesce(p.pool_value, 0) AS pool_value, coalesce(a.allocated_value, 0) AS allocated_value,
       coalesce(a.remainder, 0) AS remainder,
       coalesce(p.pool_value, 0) - coalesce(a.allocated_value, 0) - coalesce(a.remainder, 0) AS residual
FROM (SELECT {u}, sum(CV_Prior) AS pool_value FROM o_prior GROUP BY {u}) p
FULL JOIN (SELECT {u}, sum(CV_Prior) AS allocated_value, sum(CASE WHEN parts > 0 THEN left_over / parts END) AS remainder
           FROM o_contracted GROUP BY {u}) a
  ON {' AND '.join(f'p.{c} IS NOT DISTINCT FROM a.{c}' for c in unit)}""", audit_cols),
    ))

    # How many alignment groups each control-year line meets (the source's own
    # doubt about this join's uniqueness, measured from key counts only).
    fan_keys = ["AccountID", "Audience", "Model_ProductGroup", "ClientCode", "CampaignCode"]

    def q_fanout(spark, sf_dir):
        st = _stages(spark, sf_dir, params, reads=())
        lines = st.final.where(F.col("FiscalYear") == params.control_year)
        stats = alignment_stats(st.final, params).select(
            "AccountID", "Audience", "Model_ProductGroup",
            decode_client("JobNumber", params.code_width, params.year_width).alias("ClientCode"),
            decode_code("JobNumber", params.code_width).alias("CampaignCode"),
        )
        return present(fanout_report(lines, stats, fan_keys, fan_keys))

    fk = ", ".join(fan_keys)
    out.append((
        "alignment_fanout", q_fanout,
        _sql(params, "o_stats", f"""SELECT coalesce(r.right_matches, 0) AS right_matches, sum(l.n) AS n_left_rows
FROM (SELECT {fk}, count(*) AS n FROM o_final WHERE FiscalYear = {params.control_year} GROUP BY {fk}) l
LEFT JOIN (SELECT AccountID, Audience, Model_ProductGroup, {ox.dclient('JobNumber')} AS ClientCode,
                  right(JobNumber, 2) AS CampaignCode, count(*) AS right_matches
           FROM o_stats GROUP BY ALL) r
  ON {' AND '.join(f'l.{c} = r.{c}' for c in fan_keys)}
GROUP BY coalesce(r.right_matches, 0)""", ["right_matches", "n_left_rows"]),
    ))

    pool_cols = [
        *POOL_GROUP,
        "CV_Prior", "ContactQuant_Prior", "PriorContracted_Account_Audience", "PackageId_Current",
        "PackageEngagementStatus_Current", "CurrentContracted_Account_Audience_ProductGroup", "DiscountCurrent_Count",
        "PriorNonDiscount_Count",
    ]
    stage_query("roll_forward", "pool", pool_cols, "o_pool", reads=rx.POOL_READS)

    dc_cols = ["FiscalYear", "DataSource", "AccountID", "Account", "Model_ProductGroup", "Audience", "DiscountCurrent_Count"]

    def q_discounts(spark, sf_dir):
        return present(discount_counts(_stages(spark, sf_dir, params, reads=dc_cols).contracted_once).select(*dc_cols))

    out.append(("discount_counts", q_discounts, _sql(params, "o_discounts", f"SELECT {', '.join(dc_cols)} FROM o_discounts", dc_cols)))

    stage_query("window_partition_count", "pool",
                ["AccountID", "Account", "Audience", "CampaignCode", "Model_ProductGroup", "PriorNonDiscount_Count"], "o_pool", reads=rx.POOL_READS)

    ex = rx.EXTRACT_COLUMNS

    def branch(name: str, which: str) -> None:
        def run(spark, sf_dir):
            st = _stages(spark, sf_dir, params, rx.POOL_READS if which == "roll" else None)
            df = rx.rollforward_branch(st.pool, params) if which == "roll" else rx.current_branch(st.contracted_once, params)
            return present(df.select(*ex))

        # roll-forward rows carry the "N/A" job number; current rows never do
        cond = "JobNumber = 'N/A - In PP prior yr'" if which == "roll" else "JobNumber <> 'N/A - In PP prior yr'"
        out.append((name, run, _sql(params, "o_extract", f"SELECT * FROM o_extract WHERE {cond}", ex)))

    branch("classify_rollforward", "roll")
    branch("classify_current", "current")

    union_cols = ["SourceTracker", "EB_RevType", "Secured_Classification", "n_rows", "sum_cv_current", "sum_cv_prior"]

    def q_union(spark, sf_dir):
        df = _stages(spark, sf_dir, params).extract
        return present(
            df.groupBy("SourceTracker", "EB_RevType", "Secured_Classification").agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.sum("CV_Current").alias("sum_cv_current"),
                F.sum("CV_Prior").alias("sum_cv_prior"),
            )
        )

    out.append((
        "union_extract", q_union,
        _sql(params, "o_extract", """SELECT SourceTracker, EB_RevType, Secured_Classification, count(*) AS n_rows,
       sum(CV_Current) AS sum_cv_current, sum(CV_Prior) AS sum_cv_prior
FROM o_extract GROUP BY SourceTracker, EB_RevType, Secured_Classification""", union_cols),
    ))

    def q_extract(spark, sf_dir):
        return present(rx.revenue_extract(extract_inputs(SparkInputs(spark, sf_dir)), params, materialize="table"))

    out.append(("revenue_extract", q_extract, _sql(params, "o_extract", "SELECT * FROM o_extract", ex)))
    return out

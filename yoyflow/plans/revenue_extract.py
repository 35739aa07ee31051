"""Fiscal-year revenue extract.

Stages (each a function returning a lazy DataFrame):

1. ``raw_cut``        program lines of the control year and the year before,
                      filtered, classified and enriched (code tables, accounts,
                      segments, packages, opt-out counts).
2. ``summarise``      lines rolled up; key repair; initial vs incremental
                      renewal; renewal type and tenure from yearly snapshots.
3. ``final_cut``      per-group up-sell correction, discount-allocation group,
                      accounting classification.
4. ``contracted``     control-year lines with the prior-year contract value
                      allocated onto them (``operators.allocate``).
5. ``prior_pool``     prior-year contracted units with no control-year
                      counterpart (``operators.rollforward``).
6. ``extract``        both branches in one 33-column result.

Column names follow the inputs; the year-bearing outputs are named
``*_Current`` / ``*_Prior`` because the year is a parameter, and year-bearing
labels (``FY24Contracted_PP`` ...) are generated from the control year.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yoyflow.functions.keys import decode_client, decode_code, drop_right, key_length, year_suffix
from yoyflow.functions.rules import Rule, classify
from yoyflow.functions.text import (
    concat_null,
    eq_ci,
    eq_ci_cols,
    isin_ci,
    like_ci,
    ne_ci_cols,
    not_isin_ci,
    spelled,
)
from yoyflow.operators.allocate import SHARE, allocate_prior_value, alignment_stats, prior_contracted_pool
from yoyflow.operators.collated import group
from yoyflow.operators.groups import group_flag
from yoyflow.operators.joins import hashed_join
from yoyflow.operators.lookup import lookup_by_code
from yoyflow.operators.rollforward import roll_forward
from yoyflow.operators.temporal import first_dates, first_event_flag, year_offset_join_many
from yoyflow.params import RunParams
from yoyflow.session import METHOD_LIMIT, configure, cut_lineage
from yoyflow.sources import codetables
from yoyflow.sources.schemas import check_inputs

# --- fixed values ----------------------------------------------------------------
AUDIENCES = ("UG Group", "HD Group", "ALR Group", "Agency", "Adv Group")
EXCLUDED_AUDIENCE_TYPES = ("HD GroupLine of Business Transfer",)
EXCLUDED_CAMPAIGNS = ("Discount - Program / Inquiries",)
CURRENT_STATUSES = ("Contracted", "Declined", "Pending - Opt Out")
ADV_HD = ("Adv Group", "HD Group")
DISCOUNT_TYPES = ("Discount", "Discount Modification", "Cross-Sell Discount")
PENDING_STATUSES = ("Pending Signature", "Pending - Opt Out")
NEW_SALE_TYPES = ("New Sale-Discount", "New Sale-NBB")
NOT_IN_PRIOR = "N/A - In PP prior yr"
# ---------------------------------------------------------------------------------

EXTRACT_COLUMNS = [
    "SourceTracker", "AccountStatus", "FiscalYear", "DataSource", "ProgramPackageName",
    "PackageEngagementStatus_Current", "AccountID", "Account", "AccountParent", "BinderClientCode",
    "ClientCode", "Campaign", "CampaignCode", "Model_ProductGroup", "Audience", "JobNumber",
    "SignatureDate", "OppType", "RevAccrualType", "ProgramStatus", "CV_Current", "ContactQuant_Current",
    "Extra1Cost_Current", "Extra2Cost_Current", "CurrentSL", "AccountSegment", "Current_Renewal_Type",
    "Current_Tenure_Index", "Current_Tenure", "CV_Prior", "ContactQuant_Prior", "EB_RevType",
    "Secured_Classification",
]


@dataclass
class ExtractInputs:
    program_lines: DataFrame
    accounts: DataFrame
    account_segments: DataFrame
    program_packages: DataFrame
    program_optouts: DataFrame
    enrolment_packages: DataFrame
    other_packages: DataFrame
    all_packages: DataFrame


# What the joined dimensions depend on, and line columns that the roll-up does not read.
DIMENSION_KEYS = ["AccountID", "PackageID", "ProgramID"]
NOT_ROLLED = ["CreatedDate", "Full_CVExclude", "ContractSentDate", "ProposalSentDate", "TermStartDate", "TermEndDate"]


# --- stage 1 ------------------------------------------------------------------------


def scope_filter(params: RunParams) -> Column:
    """Lines that enter the extract (evaluated on the raw program lines)."""
    cy, py = params.control_year, params.prior_year
    fy = F.col("FiscalYear")
    in_years = (
        ((fy == py) & like_ci("ProgramStatus", "Contracted"))
        | ((fy == cy) & isin_ci("ProgramStatus", CURRENT_STATUSES))
        | ((fy == cy) & like_ci("ProgramStatus", "Pending Signature") & like_ci("FYVertAccountStatus", "Existing Client"))
    )
    return (
        fy.isin(py, cy)  # implied by in_years; a plain IN pushes down to the scan
        & isin_ci("Audience", AUDIENCES)
        & not_isin_ci(concat_null("Audience", "PType"), EXCLUDED_AUDIENCE_TYPES)
        & not_isin_ci("Campaign", EXCLUDED_CAMPAIGNS)
        & F.col("JobNumber").isNotNull()
        & ((F.col("SignatureDate") <= params.as_of_col()) | F.col("SignatureDate").isNull())
        & in_years
    )


def optout_counts(optouts: DataFrame, params: RunParams) -> DataFrame:
    """Opt-out flags per program over the prior and control years."""
    rows = optouts.where(F.col("Fiscal_Year__c") >= params.prior_year).withColumnRenamed("Id", "_optout_id")
    return group(rows, ["_optout_id"], F.sum(F.when(F.col("Opt_Out__c") == 1, 1).otherwise(0)).alias("OptOut_Ind"))


def accrual_type(params: RunParams) -> Column:
    """Revenue accrual type of a raw line (first match wins)."""
    ptype = F.col("PType")
    cost_negative = F.coalesce(F.col("ProgramCost"), F.lit(0)) < 0
    job_client = decode_client("JobNumber", params.code_width, params.year_width)
    discount_campaign = classify(
        [Rule(like_ci(ptype, "Cross-sell"), "Cross-sell Discount"), Rule(like_ci(ptype, "Up-sell"), "Up-sell Discount")],
        "Discount",
    )
    other = classify(
        [
            Rule(like_ci(ptype, "Modification") & like_ci("DiscountReason", "NA-Cost/Volume Movement"), "Cost Movement"),
            Rule(isin_ci(ptype, ["Up-sell", "Cross-sell"]) & cost_negative, concat_null(ptype, F.lit(" Discount"))),
            Rule(
                isin_ci(ptype, ["Re-engagement", "Line of Business Transfer"])
                & eq_ci_cols("_acct_client_code", job_client)
                & cost_negative,
                "Discount",
            ),
            Rule(like_ci(ptype, "Line of Business Transfer"), "Re-engagement"),
            Rule(like_ci(ptype, "Modification") & ne_ci_cols("_acct_client_code", job_client), "Re-engagement"),
        ],
        ptype,
    )
    return classify(
        [
            Rule(like_ci(ptype, "Discount Allocation"), "Discount Allocation"),
            Rule(like_ci("Campaign", "%Discount%"), discount_campaign),
        ],
        other,
    )


def opportunity_type() -> Column:
    new_sale_flag = (F.col("NBB") == 1) | eq_ci("SystemCrossSellType", "UG to ALR")
    return classify(
        [
            Rule(new_sale_flag & eq_ci("OppType", "Discount"), "New Sale-Discount"),
            Rule(new_sale_flag, "New Sale-NBB"),
            Rule(eq_ci("OppType", "New Sale") & (F.col("NBB") == 0), "New Sale-Shadow"),
        ],
        F.col("OppType"),
    )


def account_dimension(inp: ExtractInputs) -> DataFrame:
    """Account codes and segment in one table keyed by account id.

    Both dimensions are keyed by the account id; joining them to each other
    first (small x small) lets the large line table meet them in a single
    join, which adaptive execution can split when one account is hot.  A
    duplicated id on either side multiplies exactly as two left joins would.
    """
    acc = inp.accounts.select(
        F.col("ID").alias("_acct_id"),
        F.col("Client_Code_Adv__c").alias("_acct_adv_code"),
        F.col("r_Client_Code__c").alias("_acct_client_code"),
        F.col("Counter_ID__c").alias("BinderClientCode"),
        F.col("Record_Type_Text__c").alias("_acct_record_type"),
    )
    seg = inp.account_segments.select(F.col("AccountSFID").alias("_seg_id"), "AccountSegment")
    both = acc.join(seg, eq_ci_cols(acc["_acct_id"], seg["_seg_id"]), "full")
    return both.select(F.coalesce("_acct_id", "_seg_id").alias("_acct_id"), *[c for c in both.columns if c not in ("_acct_id", "_seg_id")])


def attach_dimensions(lines: DataFrame, inp: ExtractInputs, params: RunParams) -> DataFrame:
    """Account, segment, package and opt-out count of every line (or key tuple)."""
    pkg = inp.program_packages.select(F.col("ID").alias("_pkg_id"), F.col("Name").alias("ProgramPackageName"))
    opt = optout_counts(inp.program_optouts, params)
    acct = account_dimension(inp)
    lines = lines.join(acct, eq_ci_cols(lines["AccountID"], acct["_acct_id"]), "left").join(
        pkg, eq_ci_cols("PackageID", pkg["_pkg_id"]), "left"
    )
    return hashed_join(lines, opt, [("ProgramID", "_optout_id")], "left", collated=True)  # per-program aggregate joined back


def raw_cut(inp: ExtractInputs, params: RunParams, materialize: str = "none") -> DataFrame:
    """``materialize`` stores the lines in scope, in the columns that the roll-up reads: the
    dimensions then meet the distinct key tuples, which are narrow, and the wide lines meet
    the result once.  Every line gets what its own tuple got, duplicates multiplying as in
    joins of the lines themselves."""
    lines = inp.program_lines.where(scope_filter(params))
    if materialize != "none":
        lines = cut_lineage(lines.drop(*NOT_ROLLED), materialize)
        tuples = attach_dimensions(lines.select(*DIMENSION_KEYS).distinct(), inp, params)
        lines = hashed_join(lines, tuples, DIMENSION_KEYS, "left", null_safe=True)
    else:
        lines = attach_dimensions(lines, inp, params)
    # labels in one spelling, so that grouping and joining by them compares as the source does
    lines = lines.withColumns({c: spelled(c, v) for c, v in codetables.LABELS.items()})
    job = F.col("JobNumber")
    lines = lookup_by_code(
        lines, F.left(job, F.lit(3)), codetables.CONSORTIUM_CLIENTS, codetables.CONSORTIUM_SCHEMA, "lk_client_code"
    )
    lines = lookup_by_code(
        lines, decode_code(job, params.code_width), codetables.campaign_group_rows(params.code_width), codetables.CAMPAIGN_GROUPS_SCHEMA, "lk_code"
    )
    consortium = like_ci("Account", codetables.CONSORTIUM_ACCOUNT)
    audience = F.col("Audience")
    carried = [c for c in NOT_ROLLED if c in lines.columns]
    return lines.select(
        "FiscalYear",
        "DataSource",
        *[F.col(c).cast("date").alias(c) if c == "CreatedDate" else F.col(c) for c in carried],
        F.col("FYVertAccountStatus").alias("AccountStatus"),
        "ProgramID",
        "AccountID",
        F.when(consortium, F.col("lk_client_name")).otherwise(F.col("Account")).alias("Account"),
        F.col("SystemParent").alias("AccountParent"),
        classify(
            [Rule(eq_ci(audience, "Adv Group"), F.col("_acct_adv_code")), Rule(consortium, F.left(job, F.lit(3)))],
            F.col("_acct_client_code"),
        ).alias("ClientCode"),
        "BinderClientCode",
        F.when(consortium & like_ci("Campaign", "Other ALR"), F.lit("STPL")).otherwise(F.col("Campaign")).alias("Campaign"),
        decode_code(job, params.code_width).alias("CampaignCode"),
        F.col("ProductGroup").alias("DB_ProductGroup"),
        F.col("Audience").alias("DB_Audience"),
        classify(
            [
                Rule(like_ci("Campaign", "%Discount%"), "Discount"),
                Rule(like_ci(audience, "ALR Group"), F.col("lk_alr_group")),
                Rule(like_ci(audience, "Adv Group"), F.col("lk_adv_group")),
                Rule(like_ci(audience, "HD Group"), F.col("lk_hd_group")),
            ],
            F.col("ProductGroup"),
        ).alias("Model_ProductGroup"),
        F.when(isin_ci(audience, ["ALR Group", "Adv Group"]), audience)
        .otherwise(F.when(like_ci("_acct_record_type", "ALR"), F.lit("ALR Group")).otherwise(F.lit("UG Group")))
        .alias("Audience"),
        "JobNumber",
        "ProgramPackageName",
        "SignatureDate",
        "Renewal_Package_FirstSigned",
        "Renewal_Campaign_FirstSigned",
        "PType",
        "NBB",
        "SystemCrossSellType",
        accrual_type(params).alias("RevAccrual_Type"),
        opportunity_type().alias("OppType"),
        "PackageID",
        "ProgramStatus",
        F.col("FYVertEngagementStatus").alias("Package_Engagement_Status"),
        F.coalesce("ProgramCost", F.lit(0)).alias("ProgramCost"),
        F.coalesce("ContactQuantity", F.lit(0)).alias("ContactQuantity"),
        F.coalesce("Extra1Cost", F.lit(0)).alias("Extra1Cost"),
        F.coalesce("Extra2Cost", F.lit(0)).alias("Extra2Cost"),
        "CurrentSL",
        "DiscountReason",
        "AccountSegment",
        "OptOut_Ind",
    )


# --- stage 2 ------------------------------------------------------------------------

ROLLUP_KEYS = [
    "FiscalYear", "DataSource", "AccountStatus", "AccountID", "Account", "AccountParent", "ClientCode",
    "BinderClientCode", "Campaign", "CampaignCode", "DB_ProductGroup", "Model_ProductGroup", "Audience",
    "JobNumber", "ProgramPackageName", "PackageID", "Package_Engagement_Status", "SignatureDate",
    "Renewal_Package_FirstSigned", "Renewal_Campaign_FirstSigned", "RevAccrual_Type", "NBB", "OppType",
    "ProgramStatus", "CurrentSL", "AccountSegment",
]
SNAPSHOT_ATTRS = ["_first_signed", "_enr_renewal_type", "_enr_tenure", "_enr_tenure_next",
                  "_oth_first_prior", "_oth_first", "_oth_tenure", "_oth_tenure_next"]


def _attach_year_context(
    df: DataFrame, source: DataFrame, inp: ExtractInputs, params: RunParams, on_duplicate: str, check_unread: bool = False
) -> DataFrame:
    """Campaign first signature and the yearly-snapshot attributes.

    ``source`` holds the lines the first signature is taken from: the rolled-up
    lines themselves when possible (year, account, campaign code, audience and
    signature date are all roll-up keys, so the minimum is the same and the
    roll-up's shuffle is reused), the raw lines otherwise.
    """
    # Computed over the control year only but joined without the year, so
    # prior-year lines receive the control-year first signature as well.
    firsts = first_dates(
        source, ["AccountID", "CampaignCode", "Audience"], "SignatureDate",
        F.col("FiscalYear") == params.control_year, "_first_signed",
    )
    df = hashed_join(df, firsts, ["AccountID", "CampaignCode", "Audience"], "left", collated=True)
    keys = [("AccountID", "AccountID"), ("Audience", "Audience")]
    snapshots = [
        (
            inp.enrolment_packages, "FiscalYear",
            {0: {"_enr_renewal_type": "RenewalType", "_enr_tenure": "Tenure"}, 1: {"_enr_tenure_next": "Tenure"}},
            "enrolment packages",
        ),
        (
            inp.other_packages, "FiscalYear",
            {
                -1: {"_oth_first_prior": "FirstSigned"},
                0: {"_oth_first": "FirstSigned", "_oth_tenure": "Tenure"},
                1: {"_oth_tenure_next": "Tenure"},
            },
            "other packages",
        ),
    ]
    return year_offset_join_many(
        df, snapshots, keys, "FiscalYear", on_duplicate=on_duplicate, line_years=(params.prior_year, params.control_year),
        check_unread=check_unread,
    )


def repaired_job_number(params: RunParams) -> Column:
    """Job number repair (first match): no client code -> rebuild from the binder
    code; discount campaign -> recode the suffix; too short -> rebuild from the
    client code; else keep."""
    job = F.col("JobNumber")
    yy = year_suffix("FiscalYear", params.year_width)
    code = decode_code(job, params.code_width)
    return classify(
        [
            Rule(F.col("ClientCode").isNull(), F.concat(F.col("BinderClientCode"), yy, code)),
            Rule(like_ci("Campaign", "Discount%"), F.concat(drop_right(job, params.code_width), F.lit(params.discount_code))),
            Rule(key_length(job) < params.code_width + params.year_width + 1, F.concat(F.col("ClientCode"), yy, code)),
        ],
        job,
    )


def tenure_tag(index: Column, first: int = 0) -> Column:
    return classify([Rule(index == first, "1st Year"), Rule(index == first + 1, "2nd Year")], "Tenured")


UPSELL_KEYS = ["FiscalYear", "AccountID", "CampaignCode", "Audience", "ProgramStatus"]
UPSELL_FLAGS = ["_usell_sum", "_usell_count"]


def rolled_accrual_type() -> Column:
    """Revenue accrual type of a rolled-up line."""
    cost_sum = F.coalesce(F.col("ProgramCost"), F.lit(0))
    return classify(
        [
            Rule(isin_ci("RevAccrual_Type", ["Modification"]) & (cost_sum < 0), "Discount Modification"),
            Rule(isin_ci("RevAccrual_Type", ["Re-engagement"]) & (cost_sum < 0), "Discount"),
        ],
        F.col("RevAccrual_Type"),
    )


def upsell_flags(accrual: Column) -> dict[str, Column]:
    """Value and number of a group's up-sell lines."""
    upsell = like_ci(accrual, "Up-sell")
    return {
        "_usell_sum": F.sum(F.when(upsell, F.col("ProgramCost")).otherwise(F.lit(0))),
        "_usell_count": F.sum(F.when(upsell, F.lit(1)).otherwise(F.lit(0))),
    }


def summarise(
    raw: DataFrame, inp: ExtractInputs, params: RunParams, on_duplicate: str = "fail", materialize: str = "none", flagged: bool = False
) -> DataFrame:
    """``materialize`` stores the lines that are read several times (joined, and for their
    groups): the readers want different columns, so Spark would compute them twice.
    ``flagged`` keeps the up-sell flags that come with the year context, for ``final_cut``."""
    sums = [
        F.sum("ProgramCost").alias("ProgramCost"),
        F.sum("ContactQuantity").alias("ContactQuantity"),
        F.sum("Extra1Cost").alias("Extra1Cost"),
        F.sum("Extra2Cost").alias("Extra2Cost"),
        F.sum("OptOut_Ind").alias("_optout_sum"),
    ]
    if on_duplicate == "keep":
        # Source order: join first (duplicates fan out and multiply the sums).
        raw = cut_lineage(raw, materialize)
        rows = _attach_year_context(raw, raw, inp, params, on_duplicate)
        data = group(rows, [*ROLLUP_KEYS, *SNAPSHOT_ATTRS], *sums)
    else:
        # Every attached attribute is a function of (account, year, audience,
        # campaign code), all of them roll-up keys: roll up first, attach after, and to
        # the up-sell groups, which have these keys too, so that the lines are joined once.
        rolled = cut_lineage(group(raw, ROLLUP_KEYS, *sums), materialize)
        data = group_flag(
            rolled, UPSELL_KEYS, upsell_flags(rolled_accrual_type()),
            enrich=lambda groups: _attach_year_context(groups, rolled, inp, params, on_duplicate, check_unread=flagged),
        )

    adv_hd = isin_ci("Audience", ADV_HD)
    optout_any = F.col("_optout_sum") > 0
    tenure_now = F.when(adv_hd, F.col("_oth_tenure")).otherwise(F.col("_enr_tenure"))
    tenure_next = F.when(adv_hd, F.col("_oth_tenure_next")).otherwise(F.col("_enr_tenure_next"))
    renewal_type = F.when(
        adv_hd,
        classify(
            [Rule(F.col("_oth_first") == F.col("_oth_first_prior"), "Secured"), Rule(optout_any, "Opt Out")],
            "Decision",
        ),
    ).otherwise(
        classify(
            [
                Rule(eq_ci("_enr_renewal_type", "Fixed Term"), "Secured"),
                Rule(eq_ci("_enr_renewal_type", "Decision") & optout_any, "Opt Out"),
            ],
            F.col("_enr_renewal_type"),
        )
    )
    return data.select(
        "FiscalYear", "DataSource", "AccountStatus", "AccountID", "Account", "AccountParent", "ClientCode",
        "BinderClientCode", "Campaign", "CampaignCode", "Model_ProductGroup", "Audience",
        repaired_job_number(params).alias("JobNumber"),
        "ProgramPackageName", "PackageID", "Package_Engagement_Status", "SignatureDate",
        "Renewal_Package_FirstSigned", "Renewal_Campaign_FirstSigned", "RevAccrual_Type", "NBB",
        F.col("_first_signed").alias("Campaign_First_Sign"),
        F.when(
            eq_ci("OppType", "Renewal"),
            first_event_flag(F.col("SignatureDate"), F.col("_first_signed"), "Initial Renewal", "Incr. Renewal"),
        )
        .otherwise(F.col("OppType"))
        .alias("OppType"),
        "ProgramStatus", "ProgramCost", "ContactQuantity", "Extra1Cost", "Extra2Cost", "CurrentSL",
        rolled_accrual_type().alias("RevAccrualType"),
        "AccountSegment",
        renewal_type.alias("Client_Current_RenewalType"),
        tenure_now.alias("Client_Current_Tenure_Index"),
        tenure_tag(tenure_now).alias("Client_Current_Tenure"),
        tenure_next.alias("Client_NY_Tenure_Index"),
        tenure_tag(tenure_next).alias("Client_NY_Tenure"),
        *(UPSELL_FLAGS if flagged and on_duplicate != "keep" else []),
    )


# --- stage 3 ------------------------------------------------------------------------

FINAL_COLUMNS = [
    "FiscalYear", "DataSource", "AccountStatus", "AccountID", "Account", "AccountParent", "BinderClientCode",
    "ClientCode", "Campaign", "CampaignCode", "Model_ProductGroup", "Audience", "JobNumber",
    "ProgramPackageName", "Package_Engagement_Status", "SignatureDate", "Renewal_Package_FirstSigned",
    "Renewal_Campaign_FirstSigned", "RevAccrualType", "OppType", "ProgramStatus", "ProgramCost",
    "ContactQuantity", "Extra1Cost", "Extra2Cost", "CurrentSL", "AccountSegment", "Client_Current_RenewalType",
    "Client_Current_Tenure_Index", "Client_Current_Tenure", "Client_NY_Tenure_Index", "Client_NY_Tenure",
    "Campaign_First_Sign", "SecuredCV_Classification",
]


# What the allocation and its two aggregates read of the final cut.
FINAL_READS = {
    "FiscalYear", "AccountID", "ClientCode", "Campaign", "CampaignCode", "Audience", "Model_ProductGroup", "JobNumber",
    "RevAccrualType", "ProgramStatus", "ProgramCost", "ContactQuantity", "SignatureDate", "Campaign_First_Sign",
}
# What the roll-forward reads besides.
POOL_READS = {
    "DataSource", "Account", "AccountParent", "BinderClientCode", "CurrentSL", "Package_Engagement_Status", "AccountSegment",
    "Client_NY_Tenure_Index", "Client_NY_Tenure",
}


def secured_classification(rat: Column) -> Column:
    opp = F.col("OppType")
    return classify(
        [
            Rule(like_ci("ProgramStatus", "Declined"), "Declined"),
            Rule(isin_ci(opp, ["New Sale-NBB", "New Sale-Discount"]), "New Sale"),
            Rule(
                like_ci(opp, "New Sale-Shadow"),
                classify(
                    [Rule(like_ci(rat, "Up-Sell%"), "Up-sell on New Sale"), Rule(like_ci(rat, "Cross-Sell%"), "Cross-Sell on New Sale")],
                    "Modification on New Sale",
                ),
            ),
            Rule(isin_ci(rat, ["Up-sell", "Up-sell Discount", "Final Invoice adjustment"]), "Up-sell"),
            Rule(isin_ci(opp, ["Cross-Sell", "Cross-Sell Discount"]), "Cross-Sell"),
            Rule(like_ci(rat, "Modification%"), "Modification"),
        ],
        "Re-engagement",
    )


def final_cut(data: DataFrame) -> DataFrame:
    flagged = data if set(UPSELL_FLAGS) <= set(data.columns) else group_flag(data, UPSELL_KEYS, upsell_flags(F.col("RevAccrualType")))
    rat = F.col("RevAccrualType")  # the type before the up-sell correction
    updated = F.when(
        like_ci(rat, "Up-sell Discount") & (F.col("_usell_count") < 1) & (F.col("_usell_sum") <= 0), F.lit("Up-sell")
    ).otherwise(rat)
    cols = {
        "Model_ProductGroup": F.when(like_ci(rat, "Discount Allocation"), F.lit("Discount Allocation")).otherwise(
            F.col("Model_ProductGroup")
        ),
        "RevAccrualType": updated,
        "SecuredCV_Classification": secured_classification(rat),
    }
    return flagged.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in FINAL_COLUMNS])


# --- stage 6 ------------------------------------------------------------------------


def rollforward_branch(pool: DataFrame, params: RunParams) -> DataFrame:
    cy, prior = params.fy_tag(0), params.fy_tag(-1)
    status = F.col("PackageEngagementStatus_Current")
    lost = like_ci(status, "Lost")
    idx = F.col("Upcoming_Tenure_Index")
    return pool.select(
        F.when(lost, F.lit(f"{cy}Declined_PP")).otherwise(F.lit(f"No{cy}PP_{prior}PP")).alias("SourceTracker"),
        F.lit("Existing Client").alias("AccountStatus"),
        F.lit(params.control_year).alias("FiscalYear"),
        "DataSource",
        F.lit(NOT_IN_PRIOR).alias("ProgramPackageName"),
        F.coalesce(status, F.lit("blank")).alias("PackageEngagementStatus_Current"),
        "AccountID", "Account", "AccountParent", "BinderClientCode", "ClientCode",
        F.col("Last_yr_Campaign").alias("Campaign"),
        "CampaignCode", "Model_ProductGroup", "Audience",
        F.lit(NOT_IN_PRIOR).alias("JobNumber"),
        F.lit(None).cast("timestamp_ntz").alias("SignatureDate"),
        F.lit(NOT_IN_PRIOR).alias("OppType"),
        F.when(like_ci("Last_yr_Campaign", "%Discount%") | (F.col("CV_Prior") < 0), F.lit(f"Discount_{prior}PP"))
        .otherwise(F.lit(f"Re-engagement_from_{prior}PP"))
        .alias("RevAccrualType"),
        F.lit(NOT_IN_PRIOR).alias("ProgramStatus"),
        F.lit(0).cast("decimal(19,4)").alias("CV_Current"),
        F.lit(0).cast("decimal(19,4)").alias("ContactQuant_Current"),
        F.lit(0).cast("decimal(19,4)").alias("Extra1Cost_Current"),
        F.lit(0).cast("decimal(19,4)").alias("Extra2Cost_Current"),
        "CurrentSL", "AccountSegment",
        F.lit("Decision").alias("Current_Renewal_Type"),
        idx.alias("Current_Tenure_Index"),
        tenure_tag(idx, first=1).alias("Current_Tenure"),
        F.col("CV_Prior").cast(SHARE).alias("CV_Prior"),
        "ContactQuant_Prior",
        classify(
            [
                Rule(eq_ci(status, "Lost"), "Lost Client"),
                Rule(eq_ci("Model_ProductGroup", "Discount Allocation"), "Discount Drop"),
                Rule(F.col("PriorNonDiscount_Count") == 0, "Discount Drop"),
                Rule(F.col("CurrentContracted_Account_Audience_ProductGroup").isNotNull(), "Campaign Drop"),
            ],
            "Pending Renewal",
        ).alias("EB_RevType"),
        F.when(lost, F.lit("Declined")).otherwise(F.lit("Not Secured")).alias("Secured_Classification"),
    )


def current_revenue_type() -> Column:
    opp, rat = F.col("OppType"), F.col("RevAccrualType")
    not_new_or_cross = not_isin_ci(opp, [*NEW_SALE_TYPES, "Cross-sell"])
    contracted = classify(
        [
            Rule(isin_ci(opp, NEW_SALE_TYPES), "New Sale"),
            Rule(isin_ci(opp, ["Cross-sell"]), "Cross-sell"),
            Rule(not_new_or_cross & like_ci(rat, "Up-sell%"), "Up-sell"),
        ],
        opp,
    )
    pending = classify(
        [
            Rule(isin_ci(opp, NEW_SALE_TYPES), "New Sale - Pending"),
            Rule(isin_ci(opp, ["Cross-sell"]), "Cross-sell - Pending"),
            Rule(isin_ci(opp, ["Incr. Renewal"]), "Up-sell - Pending"),
            Rule(not_new_or_cross & like_ci(rat, "Up-sell%"), "Up-sell - Pending"),
        ],
        "Pending Renewal",
    )
    return classify(
        [
            Rule(eq_ci("Package_Engagement_Status", "Lost"), "Lost Client"),
            Rule(eq_ci("ProgramStatus", "Declined"), "Campaign Drop"),
            Rule(eq_ci("ProgramStatus", "Contracted"), contracted),
            Rule(isin_ci("ProgramStatus", PENDING_STATUSES), pending),
        ],
        opp,
    )


def current_branch(contracted: DataFrame, params: RunParams) -> DataFrame:
    cy = params.fy_tag(0)
    status = F.col("ProgramStatus")
    return contracted.select(
        classify(
            [Rule(eq_ci(status, "Contracted"), f"{cy}Contracted_PP"), Rule(eq_ci(status, "Declined"), f"{cy}Declined_PP")],
            f"{cy}Pending_PP",
        ).alias("SourceTracker"),
        "AccountStatus", "FiscalYear", "DataSource", "ProgramPackageName",
        F.col("Package_Engagement_Status").alias("PackageEngagementStatus_Current"),
        "AccountID", "Account", "AccountParent", "BinderClientCode", "ClientCode", "Campaign", "CampaignCode",
        "Model_ProductGroup", "Audience", "JobNumber", "SignatureDate", "OppType", "RevAccrualType", "ProgramStatus",
        F.col("ProgramCost").alias("CV_Current"),
        F.col("ContactQuantity").alias("ContactQuant_Current"),
        F.col("Extra1Cost").alias("Extra1Cost_Current"),
        F.col("Extra2Cost").alias("Extra2Cost_Current"),
        "CurrentSL", "AccountSegment",
        F.col("Client_Current_RenewalType").alias("Current_Renewal_Type"),
        F.col("Client_Current_Tenure_Index").alias("Current_Tenure_Index"),
        F.col("Client_Current_Tenure").alias("Current_Tenure"),
        "CV_Prior", "ContactQuant_Prior",
        current_revenue_type().alias("EB_RevType"),
        F.col("SecuredCV_Classification").alias("Secured_Classification"),
    )


def combine(pool: DataFrame, contracted: DataFrame, params: RunParams) -> DataFrame:
    """Roll-forward rows then current rows, one 33-column schema (by name)."""
    return rollforward_branch(pool, params).unionByName(current_branch(contracted, params))


# --- the job --------------------------------------------------------------------------


class ExtractStages:
    """The job's stages, built lazily; stages read several times are
    materialised once, on first use (``session.cut_lineage``).

    ``final_once`` and ``contracted_once`` are the same stages for one reader: not
    stored, so that only the columns it reads are carried through their joins.
    ``reads`` lists the columns of the final cut that the caller reads besides those
    of the allocation; only they are stored then, of all rows."""

    def __init__(
        self, inp: ExtractInputs, params: RunParams, materialize: str = "table", on_duplicate: str = "fail", reads: Collection[str] | None = None
    ):
        self.inp, self.params, self.materialize, self.on_duplicate = inp, params, materialize, on_duplicate
        self.columns = [c for c in FINAL_COLUMNS if reads is None or c in FINAL_READS or c in reads]

    @cached_property
    def raw(self) -> DataFrame:
        return raw_cut(self.inp, self.params)

    def _rolled(self, flagged: bool) -> DataFrame:
        raw = raw_cut(self.inp, self.params, self.materialize)
        return summarise(raw, self.inp, self.params, on_duplicate=self.on_duplicate, materialize=self.materialize, flagged=flagged)

    @cached_property
    def data(self) -> DataFrame:
        return self._rolled(flagged=False)

    @cached_property
    def final_once(self) -> DataFrame:
        data = self._rolled(flagged=True)
        if self.on_duplicate == "keep":  # read twice, for the groups' flags and to be flagged
            data = cut_lineage(data, self.materialize)
        return final_cut(data).select(*self.columns)

    @cached_property
    def final(self) -> DataFrame:  # read by four later steps
        return cut_lineage(self.final_once, self.materialize)

    @cached_property
    def contracted_once(self) -> DataFrame:
        return allocate_prior_value(self.final, self.params)

    @cached_property
    def contracted(self) -> DataFrame:  # read three times
        return cut_lineage(self.contracted_once, self.materialize)

    @cached_property
    def pool(self) -> DataFrame:
        return roll_forward(self.final, self.contracted, self.inp, self.params, self.materialize)

    @cached_property
    def extract(self) -> DataFrame:
        return combine(self.pool, self.contracted, self.params)


def stages(
    inp: ExtractInputs, params: RunParams, materialize: str = "table", on_duplicate: str = "fail", reads: Collection[str] | None = None
) -> ExtractStages:
    check_inputs(vars(inp))
    configure(inp.program_lines.sparkSession, [METHOD_LIMIT])
    return ExtractStages(inp, params, materialize, on_duplicate, reads)


def revenue_extract(inp: ExtractInputs, params: RunParams, materialize: str = "table", on_duplicate: str = "fail") -> DataFrame:
    return stages(inp, params, materialize, on_duplicate).extract


__all__ = [
    "ExtractInputs", "raw_cut", "summarise", "final_cut", "alignment_stats", "prior_contracted_pool",
    "allocate_prior_value", "roll_forward", "combine", "stages", "revenue_extract",
]

"""Allocation of prior-year contract value onto control-year lines (waterfall).

For every control-year line, the prior-year contracted value of the same unit
(account, audience, product group, client code, campaign code) is deposited on
the line(s) that carry the unit forward, by a first-match rule table:

1. discount-allocation lines of a discount campaign split it evenly
   (declined lines get 0);
2. other discount lines of a discount campaign split it among the contracted
   discount lines, else the pending ones, else all of them;
3. otherwise the value goes to the re-engagement line(s), else cross-sell,
   else modification / accounting adjustment, else discount allocation -- the
   sole such line, or the one(s) signed on the group's first date;
4. anything else gets 0.

Per-group counts and first dates come from one conditional aggregation over
the control-year lines (``alignment_stats``), the prior-year value from one
aggregation over prior-year contracted lines (``prior_contracted_pool``); both
are joined to the lines on keys decoded from the job number.

Money is exact.  The rule table names the number of parts a line's share is of
(0: none, 1: all); the share is the value divided by it, cut to six decimals as
the source's DECIMAL(38,4) / INT is, and what the cut leaves over from all parts
stands beside it (``CV_Prior_Remainder``), so that a unit split among all its
lines adds up to the last digit (``allocation_conservation``).  A zero divisor
gives NULL, where the source would abort.

Value is not always conserved (several lines tied on the first date each get
the full value; a unit with only up-sell lines gets nothing; key fan-out
multiplies) -- ``allocation_conservation`` reports the residual per unit.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yoyflow.functions.keys import decode_client, decode_code
from yoyflow.functions.rules import Rule, classify
from yoyflow.functions.text import eq_ci, eq_ci_cols, isin_ci, like_ci, not_isin_ci, not_like_ci
from yoyflow.operators.collated import group
from yoyflow.params import RunParams

# --- fixed values -------------------------------------------------------------------
DISCOUNT_TYPES = ("Discount", "Discount Modification", "Cross-Sell Discount")
# Note: 'Pending%' inside a list is a literal, not a pattern (as in the source).
NOT_DISCOUNT_BUCKET = ("Contracted", "Pending%")
# type of a share of money: six decimals are kept, the rest is cut
SHARE = "decimal(38,6)"
SMALLEST = Decimal("0.000001")
# -------------------------------------------------------------------------------------

STAT_KEYS = ["FiscalYear", "AccountID", "CampaignCode", "Audience", "Model_ProductGroup", "JobNumber"]
STAT_COLUMNS = [
    "Re_engagement_Count", "Contracted_Re_engage_Count", "Cross_Sell_Count", "Modification_Count", "DA_Count",
    "Contracted_Discount_Count", "Pending_Discount_Count", "All_Discount_Count", "First_Re_engagement",
    "First_Cross_Sell", "First_Modification", "First_DA", "First_Discount",
]
POOL_KEYS = ["AccountID", "ClientCode", "Audience", "CampaignCode", "JobNumber", "Model_ProductGroup"]


def _count(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _first(cond: Column) -> Column:
    return F.min(F.when(cond, F.col("SignatureDate")))


def alignment_stats(final: DataFrame, params: RunParams) -> DataFrame:
    """Counts and first signature dates per control-year group (one aggregation)."""
    rat, st = F.col("RevAccrualType"), F.col("ProgramStatus")
    re_eng = like_ci(rat, "Re-engagement")
    discount = isin_ci(rat, DISCOUNT_TYPES)
    return group(
        final.where(F.col("FiscalYear") == params.control_year),
        STAT_KEYS,
        _count(re_eng).alias("Re_engagement_Count"),
        _count(re_eng & like_ci(st, "Contracted") & (F.col("SignatureDate") == F.col("Campaign_First_Sign"))).alias(
            "Contracted_Re_engage_Count"
        ),
        _count(like_ci(rat, "Cross-sell")).alias("Cross_Sell_Count"),
        _count(isin_ci(rat, ["Modification"])).alias("Modification_Count"),
        _count(like_ci(rat, "Discount Allocation") & not_like_ci(st, "Declined")).alias("DA_Count"),
        _count(discount & like_ci(st, "Contracted")).alias("Contracted_Discount_Count"),
        _count(discount & like_ci(st, "Pending%")).alias("Pending_Discount_Count"),
        _count(discount & not_isin_ci(st, NOT_DISCOUNT_BUCKET)).alias("All_Discount_Count"),
        _first(re_eng).alias("First_Re_engagement"),
        _first(like_ci(rat, "Cross-sell")).alias("First_Cross_Sell"),
        _first(like_ci(rat, "Modification")).alias("First_Modification"),
        _first(like_ci(rat, "Discount Allocation")).alias("First_DA"),
        _first(discount).alias("First_Discount"),
    )


def prior_contracted_pool(final: DataFrame, params: RunParams) -> DataFrame:
    """Prior-year contracted value and contacts per unit and job number."""
    return group(
        final.where(eq_ci("ProgramStatus", "Contracted") & (F.col("FiscalYear") == params.prior_year)),
        POOL_KEYS,
        F.sum(F.coalesce("ProgramCost", F.lit(0))).alias("CV_Prior"),
        F.sum(F.coalesce("ContactQuantity", F.lit(0))).alias("ContactQuant_Prior"),
    ).withColumn("JobNumber_ClientCode", decode_client("JobNumber", params.code_width, params.year_width))


def cut_remainder(value: Column, parts: Column) -> Column:
    """What is left of ``value`` when each of ``parts`` gets a quotient cut to six decimals."""
    return F.when(parts == 0, F.lit(0).cast(SHARE)).otherwise(
        (value.cast(SHARE) % (F.nullif(parts, F.lit(0)).cast("decimal(20,0)") * F.lit(SMALLEST))).cast(SHARE)
    )


def exact_share(value: Column, parts: Column) -> Column:
    """``value`` divided among ``parts``, cut (not rounded) to six decimals; no parts get 0."""
    # without its remainder the value divides evenly, so the quotient is not rounded
    even = value.cast(SHARE) - cut_remainder(value, parts)
    return F.when(parts == 0, F.lit(0).cast(SHARE)).otherwise(F.try_divide(even, F.nullif(parts, F.lit(0)).cast("decimal(20,0)")).cast(SHARE))


def allocation_rule(cv: Column) -> Column:
    """A line's share of the value ``cv`` by the waterfall."""
    return exact_share(cv, allocation_parts())


def allocation_parts() -> Column:
    """The waterfall as one rule table over a line joined to its stats: the number
    of parts the line's share is of, 1 for the whole value, 0 for nothing."""
    c = F.col
    rat, st = c("RevAccrualType"), c("ProgramStatus")
    zero, whole = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    sd = c("SignatureDate")

    def share(n: str) -> Column:
        return F.nullif(c(n), F.lit(0)).cast("bigint")

    discount_campaign = like_ci("Campaign", "%Discount%")
    discount_lines = classify(
        [
            Rule((c("Contracted_Discount_Count") > 0) & like_ci(st, "Contracted"), share("Contracted_Discount_Count")),
            Rule(
                (c("Pending_Discount_Count") > 0) & like_ci(st, "Pending%") & (c("Contracted_Discount_Count") == 0),
                share("Pending_Discount_Count"),
            ),
            Rule(
                (c("All_Discount_Count") > 0)
                & not_isin_ci(st, NOT_DISCOUNT_BUCKET)
                & (c("Contracted_Discount_Count") == 0)
                & (c("Pending_Discount_Count") == 0),
                share("All_Discount_Count"),
            ),
        ],
        zero,
    )
    re_engagement = classify(
        [
            Rule(c("Re_engagement_Count") == 1, whole),
            Rule(c("First_Re_engagement").isNull(), share("Re_engagement_Count")),
            Rule(sd == c("First_Re_engagement"), share("Contracted_Re_engage_Count")),
        ],
        zero,
    )

    def sole_or_first(prior_counts: Column, count: str, first: str) -> Column:
        return classify(
            [Rule(prior_counts > 0, zero), Rule(c(count) == 1, whole), Rule(sd == c(first), whole)],
            zero,
        )

    others = classify(
        [
            Rule(like_ci(rat, "Re-engagement"), re_engagement),
            Rule(like_ci(rat, "Cross-sell"), sole_or_first(c("Re_engagement_Count"), "Cross_Sell_Count", "First_Cross_Sell")),
            Rule(
                isin_ci(rat, ["Modification", "Accounting Adjustment"]),
                sole_or_first(c("Re_engagement_Count") + c("Cross_Sell_Count"), "Modification_Count", "First_Modification"),
            ),
            Rule(
                like_ci(rat, "Discount Allocation"),
                sole_or_first(
                    c("Re_engagement_Count") + c("Cross_Sell_Count") + c("Modification_Count"), "DA_Count", "First_DA"
                ),
            ),
        ],
        zero,
    )
    return classify(
        [
            Rule(
                discount_campaign & eq_ci(rat, "Discount Allocation"),
                F.when(like_ci(st, "Declined"), zero).otherwise(share("DA_Count")),
            ),
            Rule(discount_campaign & isin_ci(rat, DISCOUNT_TYPES), discount_lines),
        ],
        others,
    )


def allocate_prior_value(final: DataFrame, params: RunParams) -> DataFrame:
    """Control-year lines with their share of the prior-year value (``CV_Prior``), the
    number of parts it is of and the remainder of that division."""
    cw, yw = params.code_width, params.year_width
    lines = final.where(F.col("FiscalYear") == params.control_year)
    stats = alignment_stats(final, params)
    s = stats.select(
        F.col("AccountID").alias("_s_acct"),
        F.col("Audience").alias("_s_aud"),
        F.col("Model_ProductGroup").alias("_s_group"),
        decode_client("JobNumber", cw, yw).alias("_s_client"),
        decode_code("JobNumber", cw).alias("_s_code"),
        *STAT_COLUMNS,
    )
    pool = prior_contracted_pool(final, params)
    p = pool.select(
        F.col("AccountID").alias("_p_acct"),
        F.col("Audience").alias("_p_aud"),
        F.col("Model_ProductGroup").alias("_p_group"),
        F.col("ClientCode").alias("_p_client"),
        F.col("CampaignCode").alias("_p_code"),
        F.col("JobNumber_ClientCode").alias("_p_job_client"),
        F.col("CV_Prior").alias("_p_cv"),
    )
    j = lines.join(
        s,
        eq_ci_cols(lines["AccountID"], s["_s_acct"])
        & eq_ci_cols(lines["Audience"], s["_s_aud"])
        & eq_ci_cols(lines["Model_ProductGroup"], s["_s_group"])
        & eq_ci_cols(lines["ClientCode"], s["_s_client"])
        & eq_ci_cols(lines["CampaignCode"], s["_s_code"]),
        "left",
    )
    j = j.join(
        p,
        eq_ci_cols(j["AccountID"], p["_p_acct"])
        & eq_ci_cols(j["Audience"], p["_p_aud"])
        & eq_ci_cols(j["Model_ProductGroup"], p["_p_group"])
        & eq_ci_cols(j["ClientCode"], p["_p_client"])
        & eq_ci_cols(j["CampaignCode"], p["_p_code"])
        & eq_ci_cols(decode_client(j["JobNumber"], cw, yw), p["_p_job_client"]),
        "left",
    )
    cv, parts = F.coalesce(F.col("_p_cv"), F.lit(0)).cast(SHARE), F.col("CV_Prior_Parts")
    j = j.withColumn("CV_Prior_Parts", allocation_parts())
    return j.select(
        *[F.col(c) for c in final.columns],
        *STAT_COLUMNS,
        exact_share(cv, parts).alias("CV_Prior"),
        "CV_Prior_Parts",
        cut_remainder(cv, parts).alias("CV_Prior_Remainder"),
        F.lit(0).cast("decimal(19,4)").alias("ContactQuant_Prior"),
    )


def allocation_conservation(pool: DataFrame, allocated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per unit: value in the pool, value allocated, what the cut divisions left over,
    and the residual, all exact.

    Each of n lines that share a value states the same remainder, so the lines of
    equal n add up to n times it.  Where a unit's value went to all its parts, once
    each, the residual is 0 to the last digit.
    """
    parts = F.col("CV_Prior_Parts")
    # sums of sums, so that hot units are combined in the map tasks; units with a NULL key meet, too
    by_parts = allocated.groupBy(*keys, "CV_Prior_Parts").agg(F.sum("CV_Prior").alias("_given"), F.sum("CV_Prior_Remainder").alias("_left"))
    none = F.lit(0).cast(SHARE)
    given = by_parts.select(
        *keys,
        none.alias("pool_value"),
        F.coalesce("_given", none).alias("allocated_value"),
        F.when(parts > 0, F.try_divide(F.col("_left"), parts.cast("decimal(20,0)"))).otherwise(none).cast(SHARE).alias("remainder"),
    )
    held = pool.select(*keys, F.col("CV_Prior").cast(SHARE).alias("pool_value"), none.alias("allocated_value"), none.alias("remainder"))
    values = ("pool_value", "allocated_value", "remainder")
    unit = held.unionByName(given).groupBy(*keys).agg(*[F.coalesce(F.sum(v), none).cast(SHARE).alias(v) for v in values])
    residual = F.col("pool_value") - F.col("allocated_value") - F.col("remainder")
    return unit.withColumn("residual", residual.cast(SHARE))

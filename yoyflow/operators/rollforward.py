"""Roll-forward of prior-year units that have no control-year counterpart.

A unit is (account, audience, campaign code, product group).  Prior-year
contracted lines are rolled up per unit (all discount campaigns condensed into
one label), units that reappear among the control-year lines are removed with
an anti-join *first* -- so the enrichment joins only touch survivors -- and
the survivors get the control-year package, its status, the control-year
discount-line count of their group and the count of non-discount units of
their account and audience.

That last count is a per-group total put back on every row; it is computed as
an aggregate joined back (null-safe, so rows whose group key is NULL share one
group as they would in a window) -- adaptive execution can split a hot group,
which it cannot do for a window partition.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yoyflow.functions.text import concat_null, eq_ci, eq_ci_cols, isin_ci, like_ci, not_like_ci
from yoyflow.operators.collated import group
from yoyflow.operators.joins import hashed_join
from yoyflow.params import RunParams
from yoyflow.session import cut_lineage

if TYPE_CHECKING:  # pragma: no cover
    from yoyflow.plans.revenue_extract import ExtractInputs

UNIT_KEYS = ["AccountID", "Audience", "CampaignCode", "Model_ProductGroup"]
POOL_GROUP = [
    "FiscalYear", "DataSource", "AccountID", "Account", "AccountParent", "ClientCode", "BinderClientCode",
    "Last_yr_Campaign", "CampaignCode", "Model_ProductGroup", "Audience", "CurrentSL", "PackageStatus_Prior",
    "AccountSegment", "Upcoming_Tenure_Index", "Upcoming_Tenure",
]


def prior_units(final: DataFrame, params: RunParams) -> DataFrame:
    """Prior-year contracted value per unit (discount campaigns condensed)."""
    prior = final.where((F.col("FiscalYear") == params.prior_year) & eq_ci("ProgramStatus", "Contracted")).select(
        "FiscalYear", "DataSource", "AccountID", "Account", "AccountParent", "ClientCode", "BinderClientCode",
        F.when(like_ci("CampaignCode", params.discount_code), F.lit("Discount")).otherwise(F.col("Campaign")).alias("Last_yr_Campaign"),
        "CampaignCode", "Model_ProductGroup", "Audience", "ProgramCost", "ContactQuantity", "CurrentSL",
        F.col("Package_Engagement_Status").alias("PackageStatus_Prior"),
        "AccountSegment",
        F.col("Client_NY_Tenure_Index").alias("Upcoming_Tenure_Index"),
        F.col("Client_NY_Tenure").alias("Upcoming_Tenure"),
    )
    return group(prior, POOL_GROUP, F.sum("ProgramCost").alias("CV_Prior"), F.sum("ContactQuantity").alias("ContactQuant_Prior"))


def discount_counts(contracted: DataFrame) -> DataFrame:
    """Control-year discount lines per (source, account, product group, audience)."""
    keys = ["FiscalYear", "DataSource", "AccountID", "Account", "Model_ProductGroup", "Audience"]
    return group(contracted, keys, F.sum(F.when(like_ci("Campaign", "%Discount%"), F.lit(1)).otherwise(F.lit(0))).alias("DiscountCurrent_Count"))


def roll_forward(final: DataFrame, contracted: DataFrame, inp: "ExtractInputs", params: RunParams, materialize: str = "table") -> DataFrame:
    """Prior-year units without a control-year counterpart, enriched (the joined rows
    are read twice -- counted per group, joined back -- and stored before that)."""
    cy = params.control_year
    units = prior_units(final, params)
    alive = hashed_join(units, group(contracted, UNIT_KEYS), UNIT_KEYS, "left_anti", collated=True)

    ap = inp.all_packages.where((F.col("Rk") == 1) & (F.col("FiscalYear") == cy)).select(
        F.col("AccountID").alias("_ap_acct"), F.col("Audience").alias("_ap_aud"), F.col("PackageId").alias("PackageId_Current")
    )
    op = inp.other_packages.where(F.col("FiscalYear") == cy).select(
        F.col("PackageID").alias("_op_pkg"), F.col("Adj_Renewal_Status").alias("_adj_status")
    )
    ep = inp.enrolment_packages.where(F.col("FiscalYear") == cy).select(
        F.col("AccountID").alias("_ep_acct"), F.col("Audience").alias("_ep_aud"), F.col("Renewal_Status").alias("_renewal_status")
    )
    dc = discount_counts(contracted).select(
        F.col("AccountID").alias("_dc_acct"),
        F.col("Account").alias("_dc_account"),
        F.col("Model_ProductGroup").alias("_dc_group"),
        F.col("Audience").alias("_dc_aud"),
        "DiscountCurrent_Count",
    )
    # The package ranking and the enrolment snapshot share the (account,
    # audience) key: combined first (both are control-year dimensions), the
    # units meet them in one join instead of being shuffled twice on that key.
    # Duplicates multiply exactly as two left joins would.
    acct_aud = ap.join(
        ep, eq_ci_cols(ap["_ap_acct"], ep["_ep_acct"]) & eq_ci_cols(ap["_ap_aud"], ep["_ep_aud"]), "full"
    ).select(
        F.coalesce("_ap_acct", "_ep_acct").alias("_aa_acct"),
        F.coalesce("_ap_aud", "_ep_aud").alias("_aa_aud"),
        "PackageId_Current",
        "_renewal_status",
    )
    rows = (
        alive.join(acct_aud, eq_ci_cols(alive["AccountID"], acct_aud["_aa_acct"]) & eq_ci_cols(alive["Audience"], acct_aud["_aa_aud"]), "left")
        .join(op, eq_ci_cols("PackageId_Current", op["_op_pkg"]), "left")
        .join(
            dc,
            eq_ci_cols("AccountID", dc["_dc_acct"]) & eq_ci_cols("Audience", dc["_dc_aud"]) & eq_ci_cols("Model_ProductGroup", dc["_dc_group"]),
            "left",
        )
    )
    rows = rows.select(
        *POOL_GROUP,
        "CV_Prior",
        "ContactQuant_Prior",
        concat_null("Account", "Audience").alias("PriorContracted_Account_Audience"),
        "PackageId_Current",
        F.when(isin_ci("Audience", ["Adv Group"]), F.col("_adj_status"))
        .otherwise(F.coalesce(F.col("_renewal_status"), F.lit("blank")))
        .alias("PackageEngagementStatus_Current"),
        concat_null("_dc_account", "_dc_aud", "_dc_group").alias("CurrentContracted_Account_Audience_ProductGroup"),
        "DiscountCurrent_Count",
    )
    rows = cut_lineage(rows, materialize)
    # Non-discount units per account+audience, over the rows as they stand now
    # (after the anti-join and any fan-out of the joins above).
    if params.discount_test == "code":
        non_discount = ~eq_ci("CampaignCode", params.discount_code)
    else:
        non_discount = not_like_ci(concat_null("Account", "Audience", "CampaignCode"), f"%{params.discount_code}%")
    counts = group(
        rows.withColumn("_grp", F.col("PriorContracted_Account_Audience")),
        ["_grp"],
        F.sum(F.when(non_discount, F.lit(1)).otherwise(F.lit(0))).alias("PriorNonDiscount_Count"),
    )
    return hashed_join(rows, counts, [("PriorContracted_Account_Audience", "_grp")], "left", null_safe=True, collated=True)

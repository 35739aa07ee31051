"""Renewal pool with contract links.

Stages:

1. ``candidate_subscriptions`` -- subscriptions with their raw attributes, the
   contract their opportunity renews and the one its parent opportunity renews
   (the migrated prior contract), restricted to rows with value.
2. ``build_pool`` -- the renewable programs in scope, classified (segment,
   shared-client flag, hub tier, decision type, auto-renew, proposal value,
   probability-weighted credit) with three empty "proof" columns.
3. ``link_contracts`` -- best later contract per pool row (tiered match, see
   ``operators.match``) patched into the proof columns (``update_from``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yoyflow.functions.dates import date_state, read_date
from yoyflow.functions.rules import Rule, classify
from yoyflow.functions.text import eq_ci, isin_ci, like_ci, not_like_ci
from yoyflow.operators.groups import distinct_indicator, parent_hop
from yoyflow.operators.joins import hashed_join
from yoyflow.operators.match import best_match, candidate_counts, tier_pair_counts
from yoyflow.operators.patch import update_from
from yoyflow.params import RunParams
from yoyflow.session import cut_lineage
from yoyflow.sources.schemas import check_inputs

# --- fixed values --------------------------------------------------------------
SUB_COLUMNS = [
    "SubscriptionSFID", "SubscriptionSFID_ProgramSub", "StandardContractSFID", "AccountSFID",
    "RecordType_Sub", "StartDate", "EndDate", "CustomerAmount", "ListPrice", "ProgramSFID",
    "ProgramAcronym", "Class_1", "CreatedDate", "CPQ_Type", "ContractStartDate", "ContractEndDate",
]
SHARED_AUDIENCE = "UG accounts"
SHARED_ACCOUNT_TYPES = ("renewal", "first year free")
NOTIFICATION_SENTINEL = "//"
# -------------------------------------------------------------------------------

POOL_COLUMNS = [
    "Vertical", "ProductGroup", "SourceObjectSFID", "SourceObjectName", "AccountSFID", "AccountName",
    "AccountSegment", "SharedUG_Ind", "Program", "Acronym", "DecisionType", "AutoRenew", "Stage",
    "PreviousYearCredit", "ProposalValue", "RenewalCredit", "AccountHealth", "RenewalHealth", "PoolDate",
    "PoolYear_FY", "PoolHalf_FY", "PoolQuarter_FY", "PeriodStartDate", "CPQ_SubscriptionID",
    "StandardContract", "SubscriptionSFID_Program", "StandardContractSFID_Proof",
    "StandardContractNum_Proof", "SCProof_Mapping",
]


# a renewal's id and the columns that its dimensions are joined by
POOL_JOIN_KEYS = ["SourceObjectSFID", "AccountSFID", "PoolYear_FY", "SubscriptionSFID", "SubPeriodSFID"]


@dataclass
class RenewalInputs:
    cpq_subscriptions: DataFrame
    raw_subscriptions: DataFrame
    opportunities: DataFrame
    program_renewals: DataFrame
    account_segments: DataFrame
    programs: DataFrame
    predecessors: DataFrame
    subscription_periods: DataFrame
    program_subscriptions: DataFrame
    shared_enrolments: DataFrame
    standard_contracts: DataFrame


def candidate_subscriptions(subs: DataFrame, raw_subs: DataFrame, opps: DataFrame) -> DataFrame:
    """Subscriptions with value, their prior contract and migrated prior contract."""
    raw = raw_subs.select(
        F.col("Id").alias("_raw_id"), F.col("RevenueListPrice__c").alias("_rev_list"), F.col("SBQQ__ListPrice__c").alias("_list")
    )
    opp = opps.select(
        F.col("Id").alias("_opp_id"),
        F.col("SO_RenewedContract").alias("StandardContractSFID_Prior"),
        F.col("Parent_Opportunity__c").alias("_parent_opp"),
    )
    s = subs.select(*SUB_COLUMNS, "OppSFID_Source")
    joined = s.join(raw, s["SubscriptionSFID"] == raw["_raw_id"], "inner").join(
        opp, s["OppSFID_Source"] == opp["_opp_id"], "inner"
    )
    joined = parent_hop(joined, "_parent_opp", opps, "Id", {"StandardContractSFID_Prior_PHXMig": "SO_RenewedContract"})
    has_value = (
        (F.col("CustomerAmount") != 0)
        | (eq_ci("CPQ_Type", "NewMigration") & (F.col("_rev_list") > 0))
        | (eq_ci("CPQ_Type", "Legacy") & (F.col("_list") > 0))
    )
    return joined.where(has_value).select(*SUB_COLUMNS, "StandardContractSFID_Prior", "StandardContractSFID_Prior_PHXMig")


def notification_date(raw: str = "Autorenewal_Notification_Date__c"):
    """The notification date; the sentinel is an empty month/day/year, so dates come
    as ``6/30/2024`` as well as in ISO form.  NULL where absent or unreadable (the
    source would abort the whole batch); ``notification_state`` tells which."""
    return read_date(F.col(raw), [NOTIFICATION_SENTINEL])


def notification_state(raw: str = "Autorenewal_Notification_Date__c"):
    return date_state(F.col(raw), [NOTIFICATION_SENTINEL])


def pool_scope(renewals: DataFrame, params: RunParams) -> DataFrame:
    """Renewable programs in scope: pool years, verticals, not void (NULL stage dropped)."""
    return renewals.where(
        F.col("PoolYear_FY").isin(list(params.pool_years))
        & isin_ci("Class_3", params.pool_classes)
        & ~eq_ci("Stage", "void")
    )


def earliest_period(inp: RenewalInputs, params: RunParams):
    """Lower bound of every pool row's period start: a scalar subquery over one
    column of the scoped renewals (no joins), used to prune match candidates."""
    return pool_scope(inp.program_renewals, params).select(F.min("PeriodStartDate")).scalar()


def _fixed_term():
    return like_ci("DecisionType", "Fixed Term%")


def segment_label(segment: str = "AccountSegment"):
    """KDA* -> KDA; the literal 'Other%' (an equality, not a pattern) -> Others."""
    return classify(
        [Rule(like_ci(segment, "KDA%"), "KDA"), Rule(eq_ci(segment, "Other%"), "Others")],
        F.col(segment),
    )


def program_label():
    """Moonshot hubs split by the renewal's own segment; otherwise the reporting group."""
    moonshot = like_ci("ReportingGroup", "%Moonshot%")
    return classify(
        [
            Rule(moonshot & eq_ci("AccountSegment", "2 Year"), "Tier 1 Hub"),
            Rule(moonshot & ~eq_ci("AccountSegment", "2 Year"), "Tier 2 Hub"),
        ],
        F.col("ReportingGroup"),
    )


def auto_renew(autorenew: str = "Autorenew__c"):
    return F.when(eq_ci("DecisionType", "Need Renewal Contract") & eq_ci(autorenew, "Yes"), 1).otherwise(0)


def proposal_value():
    research, pending = eq_ci("Class_3", "Research"), eq_ci("Stage", "Pending")
    return classify(
        [
            Rule(research & pending & _fixed_term(), F.lit(0).cast("decimal(19,4)")),
            Rule(research & pending, F.col("ProposalValue")),
        ],
        F.col("AnticipatedRenewalCredit"),
    )


def renewal_credit(params: RunParams, autorenew: str = "Autorenew__c"):
    """Probability-weighted credit: 80 -> full proposal, 50 -> half; an overdue
    auto-renewing VTVT contract still needing renewal -> the proposal."""
    c = F.col
    fixed, pending, research = _fixed_term(), eq_ci("Stage", "Pending"), eq_ci("Class_3", "Research")
    # a notification date on the as-of day is overdue from midnight on (DATE widens to a timestamp)
    overdue = notification_date().cast("timestamp_ntz") < params.as_of_col()
    return classify(
        [
            Rule(fixed & pending & research & (c("Projection_80_50") == "80"), c("ProposalValue")),
            Rule(fixed & pending & research & (c("Projection_80_50") == "50"), c("ProposalValue") * F.lit(0.5).cast("decimal(2,1)")),
            Rule(
                eq_ci("Class_2", "VTVT")
                & eq_ci("DecisionType", "Need Renewal Contract")
                & not_like_ci("Stage", "%Drop%")
                & (c("RenewalHealth").isNull() | ~eq_ci("RenewalHealth", "Drop"))
                & eq_ci(autorenew, "Yes")
                & (c("RenewalCredit") == 0)
                & overdue,
                c("ProposalValue"),
            ),
        ],
        c("RenewalCredit"),
    )


def build_pool(inp: RenewalInputs, params: RunParams, keep_unused_joins: bool = False) -> DataFrame:
    pr = pool_scope(inp.program_renewals, params)
    seg = inp.account_segments.select(F.col("AccountSFID").alias("_seg_acct"), F.col("AccountSegment").alias("_acct_segment"))
    subs = inp.cpq_subscriptions.select(F.col("SubscriptionSFID").alias("_sub_id"), F.col("SubscriptionSFID").alias("SubscriptionSFID_Program"))
    periods = inp.subscription_periods.select(
        F.col("Id").alias("_period_id"),
        F.col("Autorenew__c").alias("_autorenew"),
        F.col("Autorenewal_Notification_Date__c"),
        F.col("Account_Health_YV__c").alias("AccountHealth"),
    )
    prog_subs = inp.program_subscriptions.select(F.col("ProgramSubSFID").alias("_ps_id"), F.col("ProgramSubName").alias("CPQ_SubscriptionID"))
    raw = inp.raw_subscriptions.select(F.col("Id").alias("_raw_id"), F.col("DB_ContractNumber").alias("_contract_number"))
    shared = inp.shared_enrolments.where(
        eq_ci("Audience", SHARED_AUDIENCE) & isin_ci("AccountType", SHARED_ACCOUNT_TYPES)
    )

    # The dimensions meet the distinct key tuples of the rows, which are narrow, and the
    # wide rows meet the result once: every row gets what its own tuple got, duplicates
    # multiplying as in left joins of the rows themselves.
    keys = POOL_JOIN_KEYS + (["ProgramSFID", "PredecessorSFID_PreviousContract"] if keep_unused_joins else [])
    # Tuples without a key match nothing: in every left join below they are dealt by
    # their row's id instead of meeting in one task.
    p = pr.select(*keys).distinct()
    p = hashed_join(p, seg, [("AccountSFID", "_seg_acct")], scatter=["SourceObjectSFID"])
    if keep_unused_joins:
        # Joined by the source but never projected: only their fan-out shows.
        p = p.join(inp.programs.select(F.col("ProgramSFID").alias("_p_id")), F.col("ProgramSFID") == F.col("_p_id"), "left").drop("_p_id")
        p = p.join(
            inp.predecessors.select(F.col("PredecessorSFID").alias("_pd_id")),
            F.col("PredecessorSFID_PreviousContract") == F.col("_pd_id"),
            "left",
        ).drop("_pd_id")
    # Three tables keyed by the subscription id, one left join each, every one between
    # shuffles of its own: adaptive execution can broadcast the table or split a hot id
    # (a chain over one partitioning could not be split).
    for dim, key in ((subs, "_sub_id"), (prog_subs, "_ps_id"), (raw, "_raw_id")):
        p = hashed_join(p, dim, [("SubscriptionSFID", key)], scatter=["SourceObjectSFID"])
    p = hashed_join(p, periods, [("SubPeriodSFID", "_period_id")], scatter=["SourceObjectSFID"])
    p = distinct_indicator(p, shared, ["AccountSFID", "PoolYear_FY"], ["AccountID", "FiscalYear"], "_shared_ind")
    p = hashed_join(pr, p, [(k, k) for k in keys], "inner", null_safe=True)

    c = F.col
    return p.select(
        c("Class_3").alias("Vertical"),
        c("Class_2").alias("ProductGroup"),
        "SourceObjectSFID",
        "SourceObjectName",
        "AccountSFID",
        "AccountName",
        segment_label("_acct_segment").alias("AccountSegment"),
        F.when(c("_shared_ind") == 1, "Shared").otherwise("Standalone").alias("SharedUG_Ind"),
        program_label().alias("Program"),
        c("ProgramAcronym").alias("Acronym"),
        F.when(_fixed_term(), F.lit("Fixed Term")).otherwise(c("DecisionType")).alias("DecisionType"),
        auto_renew("_autorenew").alias("AutoRenew"),
        "Stage",
        "PreviousYearCredit",
        proposal_value().alias("ProposalValue"),
        renewal_credit(params, "_autorenew").alias("RenewalCredit"),
        "AccountHealth",
        F.when(eq_ci("Stage", "Pending"), c("RenewalHealth")).alias("RenewalHealth"),
        "PoolDate",
        "PoolYear_FY",
        "PoolHalf_FY",
        "PoolQuarter_FY",
        "PeriodStartDate",
        "CPQ_SubscriptionID",
        c("_contract_number").cast("string").alias("StandardContract"),
        "SubscriptionSFID_Program",
        F.lit(None).cast("string").alias("StandardContractSFID_Proof"),
        F.lit(None).cast("string").alias("StandardContractNum_Proof"),
        F.lit(None).cast("string").alias("SCProof_Mapping"),
    )


def match_probes(pool: DataFrame, subs: DataFrame) -> DataFrame:
    """Each pool row seen through its own subscription (inner: no subscription, no match).

    A plain join: when the pool is small enough, adaptive execution broadcasts
    it and the subscription table is streamed without a shuffle.
    """
    own = subs.select(
        F.col("SubscriptionSFID").alias("_own_sub"),
        F.col("AccountSFID").alias("account"),
        F.col("Class_1").alias("class"),
        F.col("StandardContractSFID").alias("own_contract"),
        F.col("ProgramSFID").alias("own_program"),
    )
    p = pool.select(F.col("SourceObjectSFID").alias("probe_id"), "SubscriptionSFID_Program", F.col("PeriodStartDate").alias("day"))
    return p.join(own, p["SubscriptionSFID_Program"] == own["_own_sub"], "inner").select(
        "probe_id", "account", "class", "own_contract", "own_program", "day"
    )


def match_candidates(cands: DataFrame) -> DataFrame:
    return cands.select(
        F.col("AccountSFID").alias("account"),
        F.col("Class_1").alias("class"),
        F.col("StandardContractSFID").alias("contract"),
        F.col("StandardContractSFID_Prior").alias("prior"),
        F.col("StandardContractSFID_Prior_PHXMig").alias("prior_phx"),
        F.col("ProgramSFID").alias("program"),
        F.col("StartDate").alias("start"),
        F.col("SubscriptionSFID").alias("sub"),
    )


def best_matches(pool: DataFrame, subs: DataFrame, cands: DataFrame, earliest=None) -> DataFrame:
    """SourceObjectSFID, StandardContractSFID, MatchCat (+ match_rank) of the best link."""
    m = best_match(match_probes(pool, subs), match_candidates(cands), earliest)
    return m.select(
        F.col("probe_id").alias("SourceObjectSFID"),
        F.col("contract").alias("StandardContractSFID"),
        F.col("match_label").alias("MatchCat"),
        "match_rank",
    )


def range_candidate_counts(pool: DataFrame, subs: DataFrame, cands: DataFrame, earliest=None) -> DataFrame:
    return candidate_counts(match_probes(pool, subs), match_candidates(cands), earliest).select(
        F.col("probe_id").alias("SourceObjectSFID"), "n_candidates"
    )


def pair_tier_histogram(pool: DataFrame, subs: DataFrame, cands: DataFrame, earliest=None) -> DataFrame:
    """(MatchCat, n_pairs): how many (pool row, candidate) pairs carry each label."""
    return tier_pair_counts(match_probes(pool, subs), match_candidates(cands), earliest)


def link_contracts(pool: DataFrame, best: DataFrame, contracts: DataFrame, on_duplicate: str = "fail") -> DataFrame:
    """Patch the proof columns of pool rows whose best link has a known contract."""
    sc = contracts.select(
        F.col("StandardContractSFID").alias("_sc_id"), F.col("ContractNumber").cast("string").alias("_sc_number")
    )
    source = best.join(sc, best["StandardContractSFID"] == sc["_sc_id"], "inner").select(
        "SourceObjectSFID", "_sc_id", "_sc_number", "MatchCat"
    )
    return update_from(
        pool,
        source,
        ["SourceObjectSFID"],
        {"StandardContractSFID_Proof": "_sc_id", "StandardContractNum_Proof": "_sc_number", "SCProof_Mapping": "MatchCat"},
        on_duplicate=on_duplicate,
    )


def renewal_pool(inp: RenewalInputs, params: RunParams, materialize: str = "table", on_duplicate: str = "fail") -> DataFrame:
    """The whole job: the pool with its proof columns filled where a link exists."""
    check_inputs(vars(inp))
    cands = candidate_subscriptions(inp.cpq_subscriptions, inp.raw_subscriptions, inp.opportunities)
    pool = cut_lineage(build_pool(inp, params), materialize)  # read twice below
    best = best_matches(pool, inp.cpq_subscriptions, cands, earliest_period(inp, params))
    return link_contracts(pool, best, inp.standard_contracts, on_duplicate)

"""Reusable DataFrame operators (all native expressions, no UDFs)."""

from yoyflow.operators.allocate import allocate_prior_value, alignment_stats, allocation_rule, prior_contracted_pool
from yoyflow.operators.asof import count_on_or_after, first_on_or_after
from yoyflow.operators.audit import assert_unique, conservation, duplicate_keys, fanout_report, guard_unique
from yoyflow.operators.groups import distinct_indicator, group_flag, parent_hop
from yoyflow.operators.joins import hashed_join
from yoyflow.operators.lookup import lookup_by_code
from yoyflow.operators.match import best_match, candidate_counts, tier_pair_counts
from yoyflow.operators.patch import update_from
from yoyflow.operators.rollforward import discount_counts, prior_units, roll_forward
from yoyflow.operators.temporal import first_dates, first_event, first_event_flag, year_offset_join, year_offset_join_many

__all__ = [
    "allocate_prior_value", "alignment_stats", "allocation_rule", "assert_unique", "best_match", "candidate_counts",
    "conservation", "count_on_or_after", "discount_counts", "distinct_indicator", "duplicate_keys", "fanout_report",
    "first_dates", "first_event", "first_event_flag", "first_on_or_after", "group_flag", "guard_unique", "hashed_join",
    "lookup_by_code", "parent_hop", "prior_contracted_pool", "prior_units", "roll_forward", "tier_pair_counts",
    "update_from", "year_offset_join", "year_offset_join_many",
]

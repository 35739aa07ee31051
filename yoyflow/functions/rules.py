"""Ordered first-match rule tables.

Every classification in the workload is a CASE block: an ordered list of
(condition, result) pairs and a default.  ``classify`` compiles such a table to
one chained ``when`` expression -- a single codegen'd expression, no UDF.  A
condition that evaluates to NULL does not match (falls through), like CASE.

``classify_with_id`` additionally returns the id of the rule that fired, which
the coverage audit counts per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    when: Column
    then: Any
    rule_id: str | None = None


def _as_col(value: Any) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value)


def classify(rules: Sequence[Rule], default: Any = None) -> Column:
    if not rules:
        return _as_col(default)
    expr = F.when(rules[0].when, _as_col(rules[0].then))
    for rule in rules[1:]:
        expr = expr.when(rule.when, _as_col(rule.then))
    return expr.otherwise(_as_col(default))


def classify_with_id(rules: Sequence[Rule], default: Any = None, default_id: str = "default") -> tuple[Column, Column]:
    ids = [Rule(r.when, r.rule_id or f"rule{i + 1}") for i, r in enumerate(rules)]
    return classify(rules, default), classify(ids, default_id)

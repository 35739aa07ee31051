"""Group-level helpers: per-group flags, set-membership indicators, parent hop."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yoyflow.operators.collated import group
from yoyflow.operators.joins import hashed_join


def group_flag(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], enrich: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Attach per-group aggregates to every line of the group (text keys collated).

    Aggregated with partial (map-side) combining, then joined back on the keys.
    A line with a NULL key meets no group and gets NULL statistics, as the
    source's self-join does.  An aggregate-and-join (rather than a window over
    the keys) lets adaptive execution split a hot group across tasks.

    ``enrich`` attaches to the groups, one narrow row each, what depends on their keys
    alone (at most one match a group), so that the wide lines are shuffled once for all
    of it.  Lines with a NULL key then meet their group for what was attached, but
    still get NULL statistics.
    """
    stats = group(df, keys, *[expr.alias(name) for name, expr in aggregates.items()])
    if enrich is not None:
        whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
        stats = enrich(stats.select(*keys, *[F.when(whole, F.col(name)).alias(name) for name in aggregates]))
        return hashed_join(df, stats, list(keys), "left", null_safe=True, collated=True)
    return hashed_join(df, stats, list(keys), "left", collated=True)


def distinct_indicator(
    df: DataFrame,
    members: DataFrame,
    df_keys: Sequence[str],
    member_keys: Sequence[str],
    flag: str,
) -> DataFrame:
    """Add ``flag`` = 1 where ``df``'s key is in ``members``, NULL otherwise.

    ``members`` is deduplicated first (a GROUP BY with partial aggregation), so
    the left join can never fan out.
    """
    renamed = [F.col(m).alias(f"_m{i}") for i, m in enumerate(member_keys)]
    distinct = group(members.select(*renamed), [f"_m{i}" for i in range(len(renamed))], F.lit(1).alias(flag))
    return hashed_join(df, distinct, [(k, f"_m{i}") for i, k in enumerate(df_keys)], "left", collated=True)


def parent_hop(
    df: DataFrame,
    parent_key: str,
    parents: DataFrame,
    parent_id: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """Attributes of the parent record, one hop (left join of a table to itself).

    ``columns`` maps output name -> column of ``parents``.
    """
    p = parents.select(F.col(parent_id).alias("_parent_id"), *[F.col(src).alias(dst) for dst, src in columns.items()])
    return df.join(p, df[parent_key] == p["_parent_id"], "left").drop("_parent_id")

"""``hashed_join``: an equi-join whose inputs are always shuffle stages.

Adaptive execution splits a skewed partition of a sort-merge join only when
both join inputs come straight from a shuffle.  When one side is an aggregate
over the join keys -- the "compute per group, join back" shape used for every
per-group statistic here -- its output is already partitioned by those keys,
no shuffle sits under the join, and a hot key (one account holding a third of
the rows) would stay in one task.

Joining on the keys *plus* a 64-bit hash of the keys changes that: with
Spark's default ``spark.sql.requireAllClusterKeysForCoPartition`` a side
partitioned by the keys alone no longer satisfies the join, so both sides are
shuffled (the aggregate side is small) and the hot key can be split.  The
hash also leads the sort order, so most sort comparisons stop at one long.
The full keys stay in the condition: a hash collision cannot create a match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yoyflow.operators.collated import key

Key = str | tuple[str, str]


def hashed_join(
    left: DataFrame, right: DataFrame, on: Sequence[Key], how: str = "left", null_safe: bool = False, collated: bool = False, scatter: Sequence[str] = ()
) -> DataFrame:
    """Join ``left`` and ``right`` on ``on`` (names, or (left, right) pairs).

    With plain names and ``null_safe=False`` the result has one copy of each
    key column, as ``DataFrame.join(other, on=[...])``.  Otherwise the right
    key columns are dropped and the left ones kept.  ``null_safe`` makes NULL
    keys meet each other (the grouping of a window over a NULL key).
    ``collated`` compares text keys as the source does, by their normal form
    (``operators.collated``); the left spelling is kept.

    ``scatter`` names left columns (a row id) that spread the rows with a NULL key:
    they match nothing, so any task will do, while by their key they would all be
    dealt to one.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    of = key if collated else lambda df, name: df[name]
    hashed = F.xxhash64(*[of(left, lk) for lk, _ in pairs])
    if scatter and not null_safe:
        missing = F.lit(False)
        for lk, _ in pairs:
            missing = missing | left[lk].isNull()
        hashed = F.when(missing, F.xxhash64(*[left[c] for c in scatter])).otherwise(hashed)
    lh = left.withColumn("_jk", hashed)
    rh = right.withColumn("_jk", F.xxhash64(*[of(right, rk) for _, rk in pairs]))
    same_names = all(lk == rk for lk, rk in pairs)
    if same_names and not null_safe and not collated:
        return lh.join(rh, ["_jk", *[lk for lk, _ in pairs]], how).drop("_jk")
    renamed = rh.select(*[F.col(c).alias(f"_r_{c}") for c in rh.columns])
    cond = [lh["_jk"] == renamed["_r__jk"]]
    for lk, rk in pairs:
        l, r = of(lh, lk), of(renamed, f"_r_{rk}")
        cond.append(l.eqNullSafe(r) if null_safe else l == r)
    out = lh.join(renamed, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi", "leftanti", "leftsemi"):
        return out.drop("_jk")
    keep_right = [c for c in rh.columns if c != "_jk" and c not in {rk for _, rk in pairs}]
    return out.select(*[lh[c] for c in left.columns], *[F.col(f"_r_{c}").alias(c) for c in keep_right])

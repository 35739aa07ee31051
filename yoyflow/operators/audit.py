"""Key-uniqueness and value-conservation audits.

Audits are ordinary aggregations: they return DataFrames and never collect
rows to the driver, except ``assert_unique`` which pulls at most ``sample``
offending keys to build its error message.

``guard_unique`` is the lazy form used inside jobs: it adds no action, it
makes the plan itself fail (``raise_error``) when a key that must be unique is
not, at the aggregation that already groups by that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their multiplicity (``HAVING count > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "input", sample: int = 5) -> None:
    dups = duplicate_keys(df, keys).limit(sample).collect()
    if dups:
        raise ValueError(f"{name}: key {list(keys)} is not unique, e.g. {[r.asDict() for r in dups]}")


def guard_unique(count: Column, what: str) -> Column:
    """NULL when ``count`` <= 1, a runtime error otherwise (lazy uniqueness check)."""
    return F.when(count > 1, F.raise_error(F.lit(f"duplicate key in {what}")))


def fanout_report(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """How many right rows each left key meets in an equi-join.

    Returns one row per multiplicity: (right_matches, n_left_rows).  Computed
    from key counts, never from the joined pairs.
    """
    rk = right.groupBy(*[F.col(r).alias(l) for l, r in zip(left_keys, right_keys)]).agg(
        F.count(F.lit(1)).alias("right_matches")
    )
    lk = left.groupBy(*left_keys).agg(F.count(F.lit(1)).alias("n_left_rows"))
    return (
        lk.join(rk, list(left_keys), "left")
        .select(F.coalesce("right_matches", F.lit(0)).alias("right_matches"), "n_left_rows")
        .groupBy("right_matches")
        .agg(F.sum("n_left_rows").alias("n_left_rows"))
    )


def conservation(pool: DataFrame, allocated: DataFrame, keys: Sequence[str], pool_value: str, allocated_value: str) -> DataFrame:
    """Per unit: value in the pool, value allocated, and the residual."""
    p = pool.groupBy(*keys).agg(F.sum(pool_value).alias("pool_value"))
    a = allocated.groupBy(*keys).agg(F.sum(allocated_value).alias("allocated_value"))
    both = p.select(*keys, "pool_value", F.lit(None).cast(a.schema["allocated_value"].dataType).alias("allocated_value")).unionByName(
        a.select(*keys, F.lit(None).cast(p.schema["pool_value"].dataType).alias("pool_value"), "allocated_value")
    )
    # one more grouping instead of a full join: units with a NULL key meet, too
    return (
        both.groupBy(*keys)
        .agg(F.coalesce(F.max("pool_value"), F.lit(0)).alias("pool_value"), F.coalesce(F.max("allocated_value"), F.lit(0)).alias("allocated_value"))
        .withColumn("residual", F.col("pool_value") - F.col("allocated_value"))
    )

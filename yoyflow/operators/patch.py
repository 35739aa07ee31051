"""``update_from``: set columns of matched rows from a source, keep the rest.

Equivalent of ``UPDATE target SET c = s.v FROM target JOIN source ...``.  The
source is first reduced to one row per key (partial aggregation, so a hot key
costs one row per map task); a key that still has several rows either fails
the job (default) or keeps the smallest row, which makes the choice
deterministic where the source system picks an arbitrary one.  A matched row
takes the source values even when they are NULL; unmatched rows and columns not
listed keep their values; the row count never changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yoyflow.operators.audit import guard_unique
from yoyflow.operators.joins import hashed_join


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    assignments: Mapping[str, str],
    on_duplicate: str = "fail",
) -> DataFrame:
    if on_duplicate not in ("fail", "smallest"):
        raise ValueError("on_duplicate must be 'fail' or 'smallest'")
    value_cols = list(assignments.values())
    packed = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(value_cols)])
    keys_present = F.lit(True)
    for k in on:
        keys_present = keys_present & F.col(k).isNotNull()
    src = source.where(keys_present)  # a NULL key never matches an equi-join
    reduced = src.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)]).agg(
        F.min(packed).alias("_vals"), F.count(F.lit(1)).alias("_n")
    )
    if on_duplicate == "fail":
        reduced = reduced.withColumn(
            "_vals", F.when(F.col("_n") > 1, guard_unique(F.col("_n"), "update_from source")).otherwise(F.col("_vals"))
        )
    joined = hashed_join(target, reduced, [(k, f"_k{i}") for i, k in enumerate(on)], "left")
    matched = F.col("_n").isNotNull()
    out = []
    for name in target.columns:
        if name in assignments:
            i = value_cols.index(assignments[name])
            out.append(F.when(matched, F.col(f"_vals.v{i}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)

"""Skew-safe forward as-of search: "first candidate on or after this day".

For every probe (key, day) find, among candidates with the same key and a day
on or after the probe's day, the one with the smallest (day, value).

Naively this is a range join that emits every (probe, candidate) pair of a key
-- quadratic in the size of the key's group, and one hot key (say a third of
all rows) would produce a third-squared pairs in one task.  Instead:

1. candidates and probes are put one under the other and reduced together to
   one row per (key, day) -- the best value of that day, and whether a probe
   asks for it -- with one partial aggregation (map-side combine, hot keys cost
   one row per day and map task);
2. a window per key, ordered by day descending, carries the most recent
   non-NULL candidate forward (a running frame, O(n) per key).

After step 1 a key holds at most one row per calendar day that occurs in the
data, so the per-key window input is bounded by the calendar (a century of
history is under 37k rows), however many rows the key has.  Results are joined
back to the original probe rows on (key, day) by the caller; adaptive
execution can split a skewed probe side there.  ``pair_totals`` needs no join
back: the number of probes of a (key, day) is summed beside the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _all_present(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def first_on_or_after(
    probes: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str | Sequence[str],
    found: str = "found",
    with_day: bool = False,
) -> DataFrame:
    """Distinct probe (keys, day) -> smallest candidate value on or after ``day``.

    ``probes`` needs ``keys`` + ``day``; ``candidates`` needs ``keys`` + ``day`` +
    the value column(s) (orderable, typically structs whose first fields are
    the tie-break).  With several value columns each is searched on its own
    (NULL where a candidate has no value in that column) and the results are
    ``found`` + "_" + column name; with one it is ``found``.  ``with_day`` adds
    the day of each result under its name + "_day", so that values need not
    carry it.  Rows with a NULL key or day never match.
    """
    values = [value] if isinstance(value, str) else list(value)
    cols = list(keys) + [day]
    cand = candidates.where(_all_present(cols)).select(*cols, *values, F.lit(False).alias("_probe"))
    empty = [F.lit(None).cast(cand.schema[v].dataType).alias(v) for v in values]
    prob = probes.where(_all_present(cols)).select(*cols, *empty, F.lit(True).alias("_probe"))
    days = cand.unionByName(prob).groupBy(*cols).agg(*[F.min(v).alias(v) for v in values], F.max("_probe").alias("_probe"))
    # Descending days: a candidate on the probe's own day counts as "on or after".
    w = Window.partitionBy(*keys).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [found] if isinstance(value, str) else [f"{found}_{v}" for v in values]
    carried = [F.last(v, ignorenulls=True).over(w).alias(name) for v, name in zip(values, names)]
    if with_day:
        carried += [F.last(F.when(F.col(v).isNotNull(), F.col(day)), ignorenulls=True).over(w).alias(f"{name}_day") for v, name in zip(values, names)]
        names = [*names, *(f"{name}_day" for name in names)]
    return days.select(*cols, "_probe", *carried).where(F.col("_probe")).select(*cols, *names)


def pair_totals(probes: DataFrame, candidates: DataFrame, keys: Sequence[str], day: str, counts: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per ``by`` (some of the keys), over all pairs of a probe and a candidate of
    equal keys: the summed candidate columns ``counts``.

    ``<name>_from`` covers candidates on or after the probe's day, ``<name>_at``
    those on that day.  One sweep: probes and candidates of a (key, day) are
    counted together, a running sum per key goes from the last day to the first,
    and each day's number of probes multiplies it.  Rows with a NULL key or day
    pair with nothing.
    """
    cols = list(keys) + [day]
    zero = F.lit(0).cast("bigint")
    cand = candidates.where(_all_present(cols)).select(*cols, *[F.col(c).cast("bigint").alias(c) for c in counts], zero.alias("_probes"))
    prob = probes.where(_all_present(cols)).select(*cols, *[zero.alias(c) for c in counts], F.lit(1).cast("bigint").alias("_probes"))
    days = cand.unionByName(prob).groupBy(*cols).agg(*[F.sum(c).alias(c) for c in (*counts, "_probes")])
    w = Window.partitionBy(*keys).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = days.select(*by, "_probes", *counts, *[F.sum(c).over(w).alias(f"{c}_from") for c in counts]).where(F.col("_probes") > 0)
    return swept.groupBy(*by).agg(
        *[F.sum(F.col("_probes") * F.col(f"{c}_from")).alias(f"{c}_from") for c in counts],
        *[F.sum(F.col("_probes") * F.col(c)).alias(f"{c}_at") for c in counts],
    )


def count_on_or_after(
    probes: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    day: str,
    found: str = "n_candidates",
) -> DataFrame:
    """Distinct probe (keys, day) -> number of candidates on or after ``day``.

    Same bounded shape as ``first_on_or_after``: a per-(key, day) histogram and
    a running sum, never the pairs.
    """
    cols = list(keys) + [day]
    hist = (
        candidates.where(_all_present(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_probe", F.lit(0))
    )
    prob = (
        probes.where(_all_present(cols))
        .select(*cols)
        .distinct()
        .withColumn("_n", F.lit(0).cast("bigint"))
        .withColumn("_probe", F.lit(1))
    )
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.col(day).desc(), F.col("_probe").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        hist.unionByName(prob)
        .withColumn(found, F.sum("_n").over(w))
        .where(F.col("_probe") == 1)
        .select(*cols, found)
    )

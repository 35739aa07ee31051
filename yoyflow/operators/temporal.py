"""Year-offset joins and first-event flags.

``year_offset_join`` attaches attributes of the same entity taken from a yearly
snapshot at several offsets (prior, same, next year).  Instead of one join per
offset (each re-shuffling the large side on a different shifted key), every
snapshot row is emitted once per offset with the target year it serves, the
rows are pivoted to one row per (entity, target year) with a partial
aggregation, and a single left join attaches all offsets at once.

The pivot is only equivalent to the per-offset joins if the snapshot has one
row per (entity, year).  With ``on_duplicate="fail"`` (default) the pivot
counts rows per slot and the query fails at run time when a slot is
duplicated -- no extra pass over the data, no driver round trip.  The check
sits on the attached columns, so it fires whenever one of them is read; a
query that reads none of them is unaffected by the duplicate anyway (the pivot
never multiplies rows).  With
``on_duplicate="keep"`` the per-offset joins are used, reproducing the fan-out
a duplicate causes in the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yoyflow.operators.audit import guard_unique
from yoyflow.operators.collated import group, key
from yoyflow.operators.joins import hashed_join


def _exploded(snapshot: DataFrame, keys, snap_year: str, attrs: Mapping[int, Mapping[str, str]], tag: str) -> DataFrame:
    """Snapshot rows once per offset, with the target year each copy serves and
    every output column of every offset (NULL outside its own slot)."""
    offsets = sorted(attrs)
    base = snapshot.select(
        *[F.col(sk).alias(f"_k{i}") for i, (_, sk) in enumerate(keys)],
        F.col(snap_year).alias("_y"),
        *[F.col(c).alias(f"_src_{c}") for c in sorted({c for m in attrs.values() for c in m.values()})],
        F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_off"),
    )
    slot_cols = []
    for off in offsets:
        slot = F.col("_off") == off
        slot_cols.append(F.when(slot, F.lit(1)).alias(f"_n_{tag}_{off}"))
        for dst, src in attrs[off].items():
            slot_cols.append(F.when(slot, F.col(f"_src_{src}")).alias(dst))
    return base.select(
        *[f"_k{i}" for i in range(len(keys))], (F.col("_y") - F.col("_off")).alias("_target"), *slot_cols
    )


def year_offset_join(
    lines: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[tuple[str, str]],
    line_year: str,
    snap_year: str,
    attrs: Mapping[int, Mapping[str, str]],
    on_duplicate: str = "fail",
    name: str = "snapshot",
) -> DataFrame:
    """Attach snapshot attributes at year offsets.

    keys   pairs (line column, snapshot column) identifying the entity.
    attrs  offset -> {output column: snapshot column}; offset k reads the
           snapshot row of year ``line_year + k``.
    """
    return year_offset_join_many(lines, [(snapshot, snap_year, attrs, name)], keys, line_year, on_duplicate)


def year_offset_join_many(
    lines: DataFrame,
    snapshots: Sequence[tuple[DataFrame, str, Mapping[int, Mapping[str, str]], str]],
    keys: Sequence[tuple[str, str]],
    line_year: str,
    on_duplicate: str = "fail",
    line_years: Sequence[int] | None = None,
    check_unread: bool = False,
) -> DataFrame:
    """``year_offset_join`` for several snapshots keyed the same way.

    snapshots  (snapshot, its year column, attrs, name) -- the snapshot key
               columns are given by the second element of each ``keys`` pair.

    ``line_years``, when the caller knows which years the lines carry, limits
    each snapshot to the years some offset can reach (a plain ``IN`` on the
    snapshot's year column, pushed into its scan), and the pivot to these line years.

    ``check_unread`` fails on a duplicated slot also where no attached column is read.

    All snapshots are pivoted together into one table, so the large side is
    joined once.  A single join directly over its shuffles is also what lets
    adaptive execution split a hot entity across tasks; a chain of joins on
    the same key would reuse one partitioning and could not be split.
    """
    if line_years is not None:
        snapshots = [
            (s.where(F.col(y).isin(sorted({ly + off for ly in line_years for off in a}))), y, a, n)
            for s, y, a, n in snapshots
        ]
    if on_duplicate == "keep":
        out = lines
        for snapshot, snap_year, attrs, _ in snapshots:
            for off, cols in attrs.items():
                s = snapshot.select(
                    *[F.col(sk).alias(f"_k{i}") for i, (_, sk) in enumerate(keys)],
                    F.col(snap_year).alias("_y"),
                    *[F.col(src).alias(dst) for dst, src in cols.items()],
                )
                cond = [key(out, lk) == key(s, f"_k{i}") for i, (lk, _) in enumerate(keys)]
                cond.append(s["_y"] == out[line_year] + F.lit(off))
                out = out.join(s, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))], "_y")
        return out
    if on_duplicate != "fail":
        raise ValueError("on_duplicate must be 'fail' or 'keep'")

    parts = [_exploded(s, keys, y, a, f"s{i}") for i, (s, y, a, _) in enumerate(snapshots)]
    exploded = parts[0]
    for part in parts[1:]:
        exploded = exploded.unionByName(part, allowMissingColumns=True)
    if line_years is not None:
        exploded = exploded.where(F.col("_target").isin(sorted(line_years)))
    key_cols = [f"_k{i}" for i in range(len(keys))]
    aggs: list[Column] = []
    outputs: list[Column] = []
    single = F.lit(True)
    for i, (_, _, attrs, name) in enumerate(snapshots):
        for off in sorted(attrs):
            n = f"_n_s{i}_{off}"
            aggs.append(F.count(n).alias(n))
            single = single & F.when(F.col(n) > 1, guard_unique(F.col(n), f"{name} at offset {off}").cast("boolean")).otherwise(True)
            for dst in attrs[off]:
                aggs.append(F.max(dst).alias(dst))
                # a slot holding two snapshot rows fails the query here, inside the
                # aggregation that already groups by the slot: no extra pass
                outputs.append(
                    F.when(F.col(n) > 1, guard_unique(F.col(n), f"{name} at offset {off}")).otherwise(F.col(dst)).alias(dst)
                )
    pivot = group(exploded, [*key_cols, "_target"], *aggs)
    pivot = (pivot.where(single) if check_unread else pivot).select(*key_cols, "_target", *outputs)
    on = [(lk, f"_k{i}") for i, (lk, _) in enumerate(keys)] + [(line_year, "_target")]
    return hashed_join(lines, pivot, on, "left", collated=True)


def first_dates(lines: DataFrame, keys: Sequence[str], date_col: str, scope: Column, out: str) -> DataFrame:
    """Earliest ``date_col`` per ``keys`` among rows in ``scope`` (one row per key)."""
    return group(lines.where(scope), keys, F.min(date_col).alias(out))


def first_event(lines: DataFrame, keys: Sequence[str], date_col: str, scope: Column, out: str) -> DataFrame:
    """``first_dates`` joined back to every line with the same keys (also lines
    outside the scope, e.g. prior-year lines receive the control-year date)."""
    return hashed_join(lines, first_dates(lines, keys, date_col, scope, out), list(keys), "left", collated=True)


def first_event_flag(event_date: Column, first_date: Column, when_first: str, when_later: str) -> Column:
    """``when_first`` if the event is on the first date (or both are unknown)."""
    return F.when(first_date.eqNullSafe(event_date), F.lit(when_first)).otherwise(F.lit(when_later))

"""Grouping by text keys under the source's collation.

The source compares text without regard to case and trailing blanks, in ``=``
with a literal (``functions.text``) as well as in GROUP BY and in the ON of a
join.  Keys are therefore grouped and joined by their normal form
(``functions.text.norm``), computed beside the stored spelling; no dictionary
and no pass to respell the data is needed.

A group shows the least spelling of
each of its text keys (the source shows an arbitrary one).  That costs nothing
where the result's spelling is not used: an unused minimum is pruned, and only the normal forms are shuffled.  Where it is used,
the aggregation is sort-based (spilling, no bound on its groups).

From ``NAMED`` text keys on, their normal forms are named together by 128 bits (two
differently seeded 64-bit hashes; among 10^12 groups two share a name with
probability below 1e-14, as in ``match``), so that rows and sorts carry two longs
beside the spellings, not every text twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yoyflow.functions.text import norm

NAMED = 8


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def key(df: DataFrame, name: str) -> Column:
    """The column as a key: text in its normal form, other types as they are."""
    return norm(df[name]) if is_text(df, name) else df[name]


def _names(parts: Sequence[Column]) -> list[Column]:
    """Two longs that name the texts together; the hash passes over NULL, so which are NULL counts, too."""
    absent = F.concat(*[F.when(p.isNull(), "1").otherwise("0") for p in parts])
    return [F.xxhash64(absent, *parts), F.xxhash64(F.lit("second"), absent, *parts)]


def group(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row for each distinct normal form of ``keys``: the keys in their least spelling, and the aggregates."""
    text = [k for k in keys if is_text(df, k)]
    if not text:
        return df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()
    forms = [key(df, k) for k in text]
    by = [n.alias(f"_g{i}") for i, n in enumerate(_names(forms) if len(text) >= NAMED else forms)]
    by += [df[k].alias(f"_g_{k}") for k in keys if k not in text]
    out = df.groupBy(*by).agg(*[F.min(k).alias(k) for k in text], *aggregates)
    rest = [c for c in out.columns[len(by) :] if c not in text]
    return out.select(*[F.col(k) if k in text else F.col(f"_g_{k}").alias(k) for k in keys], *rest)

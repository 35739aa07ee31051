"""Text comparison with the source system's semantics.

The source compares text case-insensitively and ignores trailing blanks in
``=`` (the same label appears as ``Cross-sell`` and ``Cross-Sell``).  Spark's
default collation is binary, so every comparison against a literal goes through
these helpers.  They normalise with ``lower(rtrim(...))`` which stays inside
whole-stage codegen and has a one-to-one DuckDB spelling for the oracle.

Three-valued logic is kept: a NULL input gives a NULL predicate, so a NULL row
is dropped by a filter and falls through a CASE, exactly like the source.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: ColumnOrName) -> Column:
    """Case- and trailing-blank-insensitive form of a string column."""
    return F.lower(F.rtrim(_col(c)))


def _norm_lit(value: str) -> str:
    return value.rstrip(" ").lower()


def eq_ci(c: ColumnOrName, value: str) -> Column:
    return norm(c) == F.lit(_norm_lit(value))


def eq_ci_cols(a: ColumnOrName, b: ColumnOrName) -> Column:
    return norm(a) == norm(b)


def ne_ci_cols(a: ColumnOrName, b: ColumnOrName) -> Column:
    return norm(a) != norm(b)


def isin_ci(c: ColumnOrName, values: Iterable[str]) -> Column:
    return norm(c).isin([_norm_lit(v) for v in values])


def not_isin_ci(c: ColumnOrName, values: Iterable[str]) -> Column:
    """``NOT IN``: a NULL input yields NULL (row dropped / CASE falls through)."""
    return ~isin_ci(c, values)


def spelled(c: ColumnOrName, labels: Iterable[str]) -> Column:
    """The label that ``c`` equals under the source's comparison, in its listed
    spelling; any other text without its trailing blanks.  Grouping and joining by
    the result then follows that comparison."""
    out = F.rtrim(_col(c))
    for label in reversed(list(labels)):
        out = F.when(eq_ci(c, label), F.lit(label)).otherwise(out)
    return out


def _has_wildcard(pattern: str) -> bool:
    return "%" in pattern or "_" in pattern


def like_ci(c: ColumnOrName, pattern: str) -> Column:
    """``LIKE`` under a case-insensitive collation.

    A pattern without wildcards is plain equality (trailing blanks ignored).
    """
    if not _has_wildcard(pattern):
        return eq_ci(c, pattern)
    return F.lower(_col(c)).like(pattern.lower())


def not_like_ci(c: ColumnOrName, pattern: str) -> Column:
    return ~like_ci(c, pattern)


def concat_null(*cols: ColumnOrName) -> Column:
    """String ``+``: any NULL part makes the whole result NULL."""
    return F.concat(*[_col(c) for c in cols])

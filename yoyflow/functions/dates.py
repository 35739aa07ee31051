"""Dates that arrive as text, in any of several spellings.

``read_date`` tries the formats in order; ``date_state`` tells a text that is no
date in any of them (the source would abort its batch there) from one that is
absent, so that the first can be counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source casts text to a date: month first between slashes or dashes, else
# year first; the last one also takes a time after the day.
FORMATS = ("M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "yyyyMMdd")
READ, ABSENT, UNREADABLE = "read", "absent", "unreadable"


def _given(raw: Column, sentinels: Sequence[str]) -> Column:
    """The text without outer blanks; NULL if nothing is left or it is a sentinel."""
    text = F.trim(raw)
    return F.when(~text.isin("", *sentinels), text)


def read_date(raw: Column, sentinels: Sequence[str] = (), formats: Sequence[str] = FORMATS) -> Column:
    """The date in ``raw``, NULL where there is none or none of the formats fits."""
    text = _given(raw, sentinels)
    return F.coalesce(*[F.try_to_date(text, f) for f in formats], text.try_cast("date"))


def date_state(raw: Column, sentinels: Sequence[str] = (), formats: Sequence[str] = FORMATS) -> Column:
    """``read``, ``absent`` (NULL, blank or a sentinel) or ``unreadable``."""
    return (
        F.when(_given(raw, sentinels).isNull(), ABSENT)
        .when(read_date(raw, sentinels, formats).isNull(), UNREADABLE)
        .otherwise(READ)
    )

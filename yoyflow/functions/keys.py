"""Positional job-number keys.

A job number is ``client_code || yy || campaign_code`` where the client code
has variable length, ``yy`` is the last ``year_width`` digits of the fiscal year
and the campaign code is the last ``code_width`` characters.

``LEN`` ignores trailing blanks, so lengths are taken after ``rtrim``.  Taking
"all but the last n characters" of a string shorter than n is an error in the
source dialect; here it yields NULL (and can be counted by the audits).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from yoyflow.functions.text import ColumnOrName, _col


def key_length(c: ColumnOrName) -> Column:
    return F.length(F.rtrim(_col(c)))


def drop_right(c: ColumnOrName, n: int) -> Column:
    """All but the last ``n`` characters; NULL when the key is shorter than n."""
    col = _col(c)
    length = key_length(col)
    return F.when(length >= n, F.substring(col, F.lit(1), length - n))


def decode_client(c: ColumnOrName, code_width: int = 2, year_width: int = 2) -> Column:
    """Client-code part of a job number."""
    return drop_right(c, code_width + year_width)


def decode_code(c: ColumnOrName, code_width: int = 2) -> Column:
    """Campaign-code part (the last ``code_width`` characters, as ``RIGHT``)."""
    return F.right(_col(c), F.lit(code_width))


def year_suffix(year: ColumnOrName, year_width: int = 2) -> Column:
    """Last ``year_width`` digits of a numeric fiscal year, as text."""
    return F.right(_col(year).cast("string"), F.lit(year_width))


def encode_key(client: ColumnOrName, year: ColumnOrName, code: ColumnOrName, year_width: int = 2) -> Column:
    """``client || yy || code``; NULL if any part is NULL."""
    return F.concat(_col(client), year_suffix(year, year_width), _col(code))

"""``lookup_by_code``: translate a computed key through a small code table.

The code tables of this workload are fixed lists of at most a few dozen rows.
``lookup_by_code`` takes the rows themselves (not a DataFrame), so the size of
what is broadcast is known on the driver before anything runs -- a proven
bound, not an estimate.  Dimension tables that grow with the data are *not*
routed through here: they are joined plainly and adaptive execution picks
broadcast or sort-merge from their runtime size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yoyflow.functions.text import norm

BROADCAST_ROWS = 10_000


def lookup_by_code(df: DataFrame, key: Column, rows: Sequence[tuple], schema: T.StructType, table_key: str) -> DataFrame:
    """Left join the literal table ``rows`` on ``key == table_key``, compared as the source compares text.

    Broadcast up to ``BROADCAST_ROWS`` rows; a longer list is joined without the
    hint, as any other table."""
    table = df.sparkSession.createDataFrame(list(rows), schema)
    if len(rows) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return df.join(table, norm(key) == norm(table[table_key]), "left")

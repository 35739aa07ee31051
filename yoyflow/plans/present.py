"""Presentation of registered query results.

Registered queries are compared with an independent DuckDB SQL version.  The
two engines render some types differently (DuckDB hands decimals out as
floats; a DATE comes out as a date object from one and a timestamp from the
other), so both sides present their results the same way:

* money / fractional numbers -> DOUBLE rounded to 4 places (``-0.0`` -> ``0.0``)
* integers and flags         -> DOUBLE (a nullable integer column is handed
                                 out as float by one engine and as a nullable
                                 integer by the other; DOUBLE is the same in
                                 both and exact for every count used here)
* DATE                       -> text ``yyyy-MM-dd``
* TIMESTAMP                  -> text ``yyyy-MM-dd HH:mm:ss``
* text                       -> unchanged

The Spark side derives the rendering from the schema; the SQL side from a
per-query column-kind spec (``s`` text, ``i`` integer, ``m`` money, ``d`` date,
``t`` timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 4) + F.lit(0.0)
        elif isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.BooleanType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_SQL = {
    "s": "{c}",
    "i": "CAST({c} AS DOUBLE)",
    "m": "round(CAST({c} AS DOUBLE), 4) + 0.0",
    "d": "strftime({c}, '%Y-%m-%d')",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
}


def parse_kinds(spec: str) -> list[tuple[str, str]]:
    """``"a:s, b:i"`` -> [("a", "s"), ("b", "i")]."""
    out = []
    for part in spec.replace("\n", " ").split(","):
        part = part.strip()
        if not part:
            continue
        name, kind = part.rsplit(":", 1)
        out.append((name.strip(), kind.strip()))
    return out


def sql_present(inner: str, spec: str, alias: str = "q") -> str:
    """Wrap an oracle query so its columns are rendered as ``present`` does."""
    cols = ",\n  ".join(_SQL[k].format(c=f'{alias}."{n}"') + f' AS "{n}"' for n, k in parse_kinds(spec))
    return f"SELECT\n  {cols}\nFROM (\n{inner}\n) {alias}"

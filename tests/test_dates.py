"""Dates written in several ways, and what is no date."""

import datetime as dt

from pyspark.sql import functions as F

from yoyflow.functions.dates import date_state, read_date
from yoyflow.params import RunParams
from yoyflow.plans import renewal_pool as rp

CASES = [
    ("06/30/2024", dt.date(2024, 6, 30)), ("6/3/2024", dt.date(2024, 6, 3)), (" 6-30-2024 ", dt.date(2024, 6, 30)), ("2024/6/30", dt.date(2024, 6, 30)),
    ("20240630", dt.date(2024, 6, 30)), ("2024-06-30", dt.date(2024, 6, 30)), ("2024-06-30 08:15:00", dt.date(2024, 6, 30)), ("12/1/1999", dt.date(1999, 12, 1)),
    ("//", "absent"), (None, "absent"), ("", "absent"), ("   ", "absent"),
    ("n/a", "unreadable"), ("13/01/2024", "unreadable"), ("2/30/2024", "unreadable"), ("06/30", "unreadable"), ("2024-13-01", "unreadable"),
]


def test_every_spelling(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = df.select("i", read_date(F.col("raw"), ["//"]).alias("d"), date_state(F.col("raw"), ["//"]).alias("s")).orderBy("i").collect()
    for r, (raw, want) in zip(got, CASES, strict=True):
        assert (r["d"], r["s"]) == ((None, want) if isinstance(want, str) else (want, "read")), raw


def test_slash_dates_make_a_renewal_overdue(spark):
    cols = ("Class_2 string, DecisionType string, Stage string, RenewalHealth string, Autorenew__c string, RenewalCredit int, ProposalValue int, "
            "Class_3 string, Projection_80_50 string, Autorenewal_Notification_Date__c string")
    base = ("VTVT", "Need Renewal Contract", "Won", None, "Yes", 0, 100, "Technology", None)
    df = spark.createDataFrame([(*base, d) for d in ("6/29/2024", "07/01/2024", "13/1/2023", "//", "20240101")], cols)
    got = [float(r[0]) for r in df.select(rp.renewal_credit(RunParams(as_of="2024-06-30 00:00:00"))).collect()]
    assert got == [100.0, 0.0, 0.0, 0.0, 100.0]

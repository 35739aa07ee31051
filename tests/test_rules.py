"""Branch tests for the rule tables: one row per branch plus NULL rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from yoyflow.operators.allocate import allocation_conservation, allocation_rule, cut_remainder, exact_share
from yoyflow.params import RunParams
from yoyflow.plans import revenue_extract as rx
from yoyflow.plans.renewal_pool import notification_date

P = RunParams(control_year=2024, as_of="2024-06-30 00:00:00")


def test_accrual_type_branches(spark):
    rows = [
        ("discount allocation", "Campaign A", "x", 10.0, "001", "0012430"),  # Discount Allocation
        ("Cross-Sell", "Spring Discount", "x", 10.0, "001", "0012430"),  # Cross-sell Discount
        ("Up-sell", "discount - volume", "x", 10.0, "001", "0012430"),  # Up-sell Discount
        ("Modification", "Discount X", "x", 10.0, "001", "0012430"),  # Discount
        ("Modification", "Campaign", "NA-Cost/Volume Movement", 10.0, "001", "0012430"),  # Cost Movement
        ("Up-sell", "Campaign", "x", -1.0, "001", "0012430"),  # Up-sell Discount (PType + ' Discount')
        ("Re-engagement", "Campaign", "x", -1.0, "001", "0012430"),  # Discount (client codes match)
        ("Line of Business Transfer", "Campaign", "x", 5.0, "001", "0012430"),  # Re-engagement
        ("Modification", "Campaign", "x", 5.0, "002", "0012430"),  # Re-engagement (codes differ)
        ("Modification", "Campaign", "x", 5.0, None, "0012430"),  # NULL code: falls to PType
        ("Re-engagement", "Campaign", "x", None, "001", "0012430"),  # NULL cost counts as 0
        (None, "Campaign", "x", 5.0, "001", "0012430"),  # NULL PType
    ]
    df = spark.createDataFrame(rows, "PType string, Campaign string, DiscountReason string, ProgramCost double, _acct_client_code string, JobNumber string")
    got = [r[0] for r in df.select(rx.accrual_type(P)).collect()]
    assert got == [
        "Discount Allocation", "Cross-sell Discount", "Up-sell Discount", "Discount", "Cost Movement",
        "Up-sell Discount", "Discount", "Re-engagement", "Re-engagement", "Modification", "Re-engagement", None,
    ]


def test_opportunity_type_branches(spark):
    rows = [(1, "None", "Discount"), (0, "UG to ALR", "Renewal"), (0, "None", "new sale"), (None, None, "Renewal"), (0, "None", None)]
    df = spark.createDataFrame(rows, "NBB int, SystemCrossSellType string, OppType string")
    got = [r[0] for r in df.select(rx.opportunity_type()).collect()]
    assert got == ["New Sale-Discount", "New Sale-NBB", "New Sale-Shadow", "Renewal", None]


def test_secured_classification_branches(spark):
    rows = [
        ("Declined", "New Sale-NBB", "Up-sell"), ("Contracted", "new sale-nbb", "x"),
        ("Contracted", "New Sale-Shadow", "up-sell discount"), ("Contracted", "New Sale-Shadow", "Cross-sell"),
        ("Contracted", "New Sale-Shadow", "Modification"), ("Contracted", "Renewal", "Final Invoice adjustment"),
        ("Contracted", "Cross-sell", "Discount"), ("Contracted", "Renewal", "Modification x"),
        ("Contracted", "Renewal", "Re-engagement"), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "ProgramStatus string, OppType string, RevAccrualType string")
    got = [r[0] for r in df.select(rx.secured_classification(F.col("RevAccrualType"))).collect()]
    assert got == [
        "Declined", "New Sale", "Up-sell on New Sale", "Cross-Sell on New Sale", "Modification on New Sale",
        "Up-sell", "Cross-Sell", "Modification", "Re-engagement", "Re-engagement",
    ]


def test_current_revenue_type_branches(spark):
    rows = [
        ("Lost", "Contracted", "x", "x"), ("Active", "Declined", "x", "x"),
        ("Active", "Contracted", "New Sale-NBB", "x"), ("Active", "Contracted", "Cross-sell", "x"),
        ("Active", "Contracted", "Initial Renewal", "Up-sell Discount"), ("Active", "Contracted", "Initial Renewal", "x"),
        ("Active", "Pending Signature", "New Sale-Discount", "x"), ("Active", "Pending - Opt Out", "Cross-sell", "x"),
        ("Active", "Pending Signature", "Incr. Renewal", "x"), ("Active", "Pending Signature", "Renewal", "Up-sell"),
        ("Active", "Pending Signature", "Renewal", "x"), ("Active", "Other", "Renewal", "x"),
        ("Active", "Contracted", None, "Up-sell"),
    ]
    df = spark.createDataFrame(rows, "Package_Engagement_Status string, ProgramStatus string, OppType string, RevAccrualType string")
    got = [r[0] for r in df.select(rx.current_revenue_type()).collect()]
    assert got == [
        "Lost Client", "Campaign Drop", "New Sale", "Cross-sell", "Up-sell", "Initial Renewal", "New Sale - Pending",
        "Cross-sell - Pending", "Up-sell - Pending", "Up-sell - Pending", "Pending Renewal", "Renewal", None,
    ]


def test_allocation_rule_branches(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    cols = ("Campaign string, RevAccrualType string, ProgramStatus string, SignatureDate timestamp_ntz, "
            "Re_engagement_Count long, Contracted_Re_engage_Count long, Cross_Sell_Count long, Modification_Count long, "
            "DA_Count long, Contracted_Discount_Count long, Pending_Discount_Count long, All_Discount_Count long, "
            "First_Re_engagement timestamp_ntz, First_Cross_Sell timestamp_ntz, First_Modification timestamp_ntz, First_DA timestamp_ntz")
    z = (0, 0, 0, 0, 0, 0, 0, 0)
    rows = [
        ("Discount", "Discount Allocation", "Declined", d1, *z, None, None, None, None),  # 1 declined -> 0
        ("Discount", "Discount Allocation", "Contracted", d1, 0, 0, 0, 0, 4, 0, 0, 0, None, None, None, None),  # 1 -> cv/4
        ("Discount", "Discount Allocation", "Contracted", d1, *([None] * 8), None, None, None, None),  # 1 no stats -> NULL
        ("Discount", "Discount", "Contracted", d1, 0, 0, 0, 0, 0, 2, 0, 0, None, None, None, None),  # 2a -> cv/2
        ("Discount", "Discount", "Pending Signature", d1, 0, 0, 0, 0, 0, 0, 5, 0, None, None, None, None),  # 2b -> cv/5
        ("Discount", "Discount", "Declined", d1, 0, 0, 0, 0, 0, 0, 0, 8, None, None, None, None),  # 2c -> cv/8
        ("Discount", "Discount", "Declined", d1, 0, 0, 0, 0, 0, 1, 0, 8, None, None, None, None),  # 2d -> 0
        ("C", "Re-engagement", "Contracted", d2, 1, 0, 0, 0, 0, 0, 0, 0, d1, None, None, None),  # 3a -> cv
        ("C", "Re-engagement", "Contracted", d2, 2, 0, 0, 0, 0, 0, 0, 0, None, None, None, None),  # 3b -> cv/2
        ("C", "Re-engagement", "Contracted", d1, 3, 0, 0, 0, 0, 0, 0, 0, d1, None, None, None),  # 3c zero divisor -> NULL
        ("C", "Re-engagement", "Contracted", d2, 3, 1, 0, 0, 0, 0, 0, 0, d1, None, None, None),  # 3c not first -> 0
        ("C", "Cross-sell", "Contracted", d2, 1, 0, 1, 0, 0, 0, 0, 0, None, None, None, None),  # 4 re-eng present -> 0
        ("C", "cross-sell", "Contracted", d2, 0, 0, 2, 0, 0, 0, 0, 0, None, d2, None, None),  # 4 first date -> cv
        ("C", "Accounting Adjustment", "Contracted", d2, 0, 0, 0, 1, 0, 0, 0, 0, None, None, None, None),  # 5 sole -> cv
        ("C", "Modification", "Contracted", d2, 0, 0, 1, 1, 0, 0, 0, 0, None, None, None, None),  # 5 cross present -> 0
        ("C", "Discount Allocation", "Contracted", d2, 0, 0, 0, 0, 1, 0, 0, 0, None, None, None, None),  # 6 sole -> cv
        ("C", "Up-sell", "Contracted", d2, 0, 0, 0, 0, 0, 0, 0, 0, None, None, None, None),  # 7 -> 0
    ]
    df = spark.createDataFrame(rows, cols)
    got = [r[0] for r in df.select(allocation_rule(F.lit(40.0))).collect()]
    assert got == [0.0, 10.0, None, 20.0, 8.0, 5.0, 0.0, 40.0, 20.0, None, 0.0, 0.0, 40.0, 40.0, 0.0, 40.0, 0.0]


def test_shares_of_money_are_exact(spark):
    cases = [("20.0000", 3), ("-20.0000", 3), ("0.0001", 7), ("123456789012345.6789", 9_999_991), ("5.0000", 1), ("5.0000", 0), ("5.0000", None), ("0.0000", 4), (None, 2)]
    df = spark.createDataFrame([(i, None if v is None else Decimal(v), n) for i, (v, n) in enumerate(cases)], "i int, v decimal(29,4), n long")
    rows = df.select("i", exact_share(F.col("v"), F.col("n")).alias("share"), cut_remainder(F.col("v"), F.col("n")).alias("rest")).orderBy("i").collect()
    for (v, n), row in zip(cases, rows):
        if n == 0:
            assert (row.share, row.rest) == (0, 0)
        elif n is None or v is None:
            assert row.share is None
        else:
            millionths = int(Decimal(v) * 10**6)
            cut = abs(millionths) // n * (1 if millionths >= 0 else -1)
            assert row.share == Decimal(cut) / 10**6
            assert row.share * n + row.rest == Decimal(v)  # nothing is lost


def test_split_values_add_up_to_the_last_digit(spark):
    pool = spark.createDataFrame([("u", Decimal("20.0000")), ("v", Decimal("-0.0100")), ("w", Decimal("7.0000")), (None, Decimal("1.0000"))], "k string, CV_Prior decimal(29,4)")
    lines = spark.createDataFrame([("u", 3)] * 3 + [("v", 7)] * 7 + [("w", 2), ("x", 0), (None, 3), (None, 3), (None, 3)], "k string, CV_Prior_Parts long")
    lines = lines.join(pool.withColumnRenamed("CV_Prior", "cv"), lines["k"].eqNullSafe(pool["k"]), "left").select(lines["k"], "CV_Prior_Parts", F.coalesce("cv", F.lit(0)).alias("cv"))
    parts = F.col("CV_Prior_Parts")
    lines = lines.select("k", parts, exact_share(F.col("cv"), parts).alias("CV_Prior"), cut_remainder(F.col("cv"), parts).alias("CV_Prior_Remainder"))
    got = {r.k: r.residual for r in allocation_conservation(pool, lines, ["k"]).collect()}
    assert got == {"u": 0, "v": 0, "w": Decimal("3.5"), "x": 0, None: 0}
    assert lines.where("k = 'u'").agg(F.sum("CV_Prior")).first()[0] == Decimal("19.999998")


def test_notification_date_parse(spark):
    df = spark.createDataFrame([("//",), (None,), ("n/a",), ("2024-01-05",)], "Autorenewal_Notification_Date__c string")
    got = [r[0] for r in df.select(notification_date()).collect()]
    assert got == [None, None, None, dt.date(2024, 1, 5)]


def test_year_bearing_labels_follow_control_year():
    assert P.fy_tag(0) == "FY24" and P.fy_tag(-1) == "FY23"
    assert RunParams(control_year=2030).fy_tag(0) == "FY30"


# --- renewal pool blocks -------------------------------------------------------------

from yoyflow.plans import renewal_pool as rp  # noqa: E402


def test_segment_and_program_labels(spark):
    df = spark.createDataFrame(
        [("KDA East", "Moonshot Hub", "2 Year"), ("kda", "the moonshot x", "1 Year"), ("Other%", "Core", None),
         ("Other Segment", "Moonshot", None), (None, None, "2 Year")],
        "AccountSegment string, ReportingGroup string, Seg2 string",
    )
    got = [tuple(r) for r in df.select(rp.segment_label("AccountSegment"), F.col("ReportingGroup")).collect()]
    assert [g[0] for g in got] == ["KDA", "KDA", "Others", "Other Segment", None]
    prog = df.select(F.col("Seg2").alias("AccountSegment"), "ReportingGroup").select(rp.program_label())
    # hub tiers use the renewal's own segment; a NULL segment keeps the group name
    assert [r[0] for r in prog.collect()] == ["Tier 1 Hub", "Tier 2 Hub", "Core", "Moonshot", None]


def test_auto_renew_and_proposal_value(spark):
    rows = [
        ("Need Renewal Contract", "yes", "Research", "Pending", 10, 20),
        ("Fixed Term - 2yr", "Yes", "Research", "pending", 10, 20),
        ("Decision", "Yes", "Research", "Pending", 10, 20),
        ("Decision", None, "Technology", "Pending", 10, 20),
    ]
    df = spark.createDataFrame(rows, "DecisionType string, Autorenew__c string, Class_3 string, Stage string, ProposalValue int, AnticipatedRenewalCredit int")
    got = [(r[0], float(r[1])) for r in df.select(rp.auto_renew(), rp.proposal_value()).collect()]
    assert got == [(1, 10.0), (0, 0.0), (0, 10.0), (0, 20.0)]


def test_renewal_credit_branches_and_notification_dates(spark):
    params = RunParams(control_year=2024, as_of="2024-06-30 08:00:00")
    base = ("VTVT", "Need Renewal Contract", "Won", None, "Yes", 0, 100)
    cols = ("Class_2 string, DecisionType string, Stage string, RenewalHealth string, Autorenew__c string, "
            "RenewalCredit int, ProposalValue int, Class_3 string, Projection_80_50 string, "
            "Autorenewal_Notification_Date__c string")
    rows = [
        ("X", "Fixed Term", "Pending", None, None, 7, 100, "Research", "80", None),  # 80 -> proposal
        ("X", "fixed term x", "Pending", None, None, 7, 100, "Research", "50", None),  # 50 -> half
        (*base, "Technology", None, "2024-06-29"),  # overdue -> proposal
        (*base, "Technology", None, "2024-06-30"),  # the as-of day counts as overdue after midnight
        (*base, "Technology", None, "2024-07-01"),  # future -> credit
        (*base, "Technology", None, "//"),  # sentinel -> no date -> credit
        (*base, "Technology", None, None),  # NULL -> credit
        (*base, "Technology", None, "n/a"),  # malformed -> no date -> credit
        ("VTVT", "Need Renewal Contract", "Dropped", None, "Yes", 0, 100, "Technology", None, "2024-01-01"),  # %Drop%
        ("VTVT", "Need Renewal Contract", "Won", "drop", "Yes", 0, 100, "Technology", None, "2024-01-01"),  # health Drop
        ("VTVT", "Need Renewal Contract", "Won", "Good", "Yes", 5, 100, "Technology", None, "2024-01-01"),  # credit != 0
    ]
    df = spark.createDataFrame([(*r[:7], *r[7:]) for r in rows], cols)
    got = [float(r[0]) for r in df.select(rp.renewal_credit(params)).collect()]
    assert got == [100.0, 50.0, 100.0, 100.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 5.0]

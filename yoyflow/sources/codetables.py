"""Fixed code tables of the revenue extract.

Campaign codes are kept as published (four characters).  A job number holds the
last ``RunParams.code_width`` of them, so a table is keyed by that many of its
trailing characters when a run uses it; a width at which two codes of a table
meet is refused.

The tables are tiny and constant, so they are always broadcast.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source's code tables) ----------------------
# HD campaigns: code, product group
HD_GROUPS = [
    ("1181", "Product1181"),
    ("1182", "Product1182"),
    ("1184", "Product1184"),
    ("1185", "Product1185"),
    ("1187", "Product1187"),
    ("1199", "Discount (HD)"),
    ("1183", "Other (HD)"),
]

# ALR campaigns: code, campaign name, product group
ALR_GROUPS = [
    ("1199", "Discount - No Campaign", "Discount"),
    ("1139", "Product1139", "Digital"),
    ("1138", "Product1938", "Digital"),
    ("1175", "Product1175", "Digital"),
    ("1130", "Product1130", "PPIQ"),
    ("1176", "Product1176", "PPIQ"),
    ("1131", "Product1131", "SSJR"),
    ("1137", "Product1137", "SSJR"),
    ("1135", "Product1135", "AWSS"),
    ("1133", "Product1133", "AWSS"),
    ("1132", "Product1132", "Other ALR"),
    ("1136", "Product1136", "Other ALR"),
    ("1177", "Product1177", "Other ALR"),
    ("1178", "Product1178", "Other ALR"),
    ("1179", "Product1179", "Other ALR"),
    ("1180", "Product1180", "Other ALR"),
    ("1186", "Product1186", "Other ALR"),
]

# Adv campaigns: code, campaign name, product group
ADV_GROUPS = [
    ("1140", "Product1140", "AdvGroup1"),
    ("1141", "Product1141", "AdvGroup2"),
    ("1142", "Product1142", "AdvGroup2"),
    ("1143", "Product1143", "AdvGroup2"),
    ("1144", "Product1144", "AdvGroup3"),
    ("1145", "Product1145", "AdvGroup4"),
    ("1146", "Product1146", "AdvGroup4"),
    ("1147", "Product1147", "AdvGroup4"),
    ("1148", "Product1148", "AdvGroup5"),
    ("1149", "Product1149", "AdvGroup5"),
    ("1150", "Product1150", "AdvOthers"),
    ("1151", "Product1151", "AdvOthers"),
    ("1152", "Product1152", "AdvOthers"),
    ("1153", "Product1153", "AdvOthers"),
    ("1186", "Product1186", "AdvOthers"),
    ("1199", "Discount", "Discount"),
]

# Consortium clients booked under one account: client code, display name
CONSORTIUM_CLIENTS = [
    ("5DL", "BoA (NMSU)"),
    ("5LA", "BoA (SC)"),
    ("5KV", "BoA (CNMCC)"),
    ("5KW", "BoA (CCoD)"),
    ("5KN", "BoA (UoCFL)"),
    ("5KP", "BoA (SDS)"),
    ("5KX", "BoA (UCC)"),
    ("5KO", "BoA (MSoD)"),
    ("5KQ", "BoA (SEU)"),
    ("5KZ", "BoA (UoTRGV)"),
    ("5LB", "BoA (STC)"),
    ("5KY", "BoA (VC)"),
]

# Labels of the program lines' label columns, in the spelling that results carry.
LABELS = {
    "Audience": ["UG Group", "HD Group", "ALR Group", "Agency", "Adv Group"],
    "PType": [
        "Discount Allocation", "Cross-sell", "Up-sell", "Modification", "Re-engagement", "Line of Business Transfer",
        "Accounting Adjustment", "Final Invoice adjustment",
    ],
    "OppType": ["New Sale", "Renewal", "Cross-sell", "Discount"],
    "ProgramStatus": ["Contracted", "Declined", "Pending - Opt Out", "Pending Signature"],
    "FYVertAccountStatus": ["Existing Client", "New Client"],
    "FYVertEngagementStatus": ["Lost"],
}

# Account name that marks the consortium account.
CONSORTIUM_ACCOUNT = "BoA"
# ------------------------------------------------------------------------------


def by_suffix(rows: list[tuple], width: int) -> dict[str, tuple]:
    """The rows keyed by the last ``width`` characters of their code."""
    keyed = {r[0][-width:]: r for r in rows}
    if len(keyed) != len(rows):
        raise ValueError(f"codes are not unique in their last {width} characters")
    return keyed


CAMPAIGN_GROUPS_SCHEMA = T.StructType(
    [
        T.StructField("lk_code", T.StringType(), False),
        T.StructField("lk_hd_group", T.StringType(), True),
        T.StructField("lk_alr_group", T.StringType(), True),
        T.StructField("lk_adv_group", T.StringType(), True),
    ]
)
CONSORTIUM_SCHEMA = T.StructType(
    [
        T.StructField("lk_client_code", T.StringType(), False),
        T.StructField("lk_client_name", T.StringType(), True),
    ]
)


def campaign_group_rows(code_width: int = 2) -> list[tuple]:
    """One row per campaign code with the group each audience table gives it.

    The three per-audience tables are unique by code, so folding them into one
    table keyed by code is equivalent to three separate left joins and costs a
    single broadcast join.
    """
    hd, alr, adv = (by_suffix(t, code_width) for t in (HD_GROUPS, ALR_GROUPS, ADV_GROUPS))
    return [(c, *(t[c][-1] if c in t else None for t in (hd, alr, adv))) for c in sorted({*hd, *alr, *adv})]


def values_sql(rows, columns, alias: str = "t") -> str:
    """The same table as a SQL VALUES list (used by the DuckDB oracle)."""

    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(columns)})"

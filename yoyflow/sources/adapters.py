"""Adapters: driver test tables -> job inputs.

The driver ships TPC-H-like tables (``orders``, ``lineitem``, ``customer``).  The
jobs need program lines, account snapshots, subscriptions, renewals and so on.
Each adapter below is one portable SQL statement that both Spark SQL and DuckDB
run unchanged, so the Spark job and the DuckDB oracle see identical inputs.

Placeholders ``{name}`` refer to a base table or to another adapter.  On Spark
they are bound to DataFrames (``spark.sql(text, name=df)``); for DuckDB they
are replaced by CTE / view names.

Only row-local expressions, equi-joins and GROUP BY are used (no windows, no
pairs), so every adapter scales with its input and no customer is processed
in one task.  Every table is read whole: where a record is to be missing, its
row stays and carries a key that nothing refers to.  The rules that
inject NULLs, mixed letter case, short keys, duplicate-free snapshots and so on
are deterministic functions of the source keys.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from yoyflow.sources.io import read_input
from yoyflow.sources.schemas import REQUIRED

BASE_TABLES = ("lineitem", "orders", "customer")

# Client code of a customer: consortium customers carry one of the consortium
# codes (or an unknown one), everyone else a three-digit code.
_CLIENT_CODE = """CASE WHEN c.c_custkey % 37 = 5 THEN
           (CASE c.c_custkey % 4 WHEN 0 THEN '5DL' WHEN 1 THEN '5KV' WHEN 2 THEN '5LB' ELSE '5ZZ' END)
         ELSE lpad(CAST(c.c_custkey % 1000 AS STRING), 3, '0') END"""

# Audience the extract derives for a customer (ALR / Adv / UG).
_DERIVED_AUDIENCE = """CASE WHEN c.c_mktsegment = 'FURNITURE' THEN 'ALR Group'
         WHEN c.c_mktsegment = 'MACHINERY' THEN 'Adv Group'
         WHEN c.c_nationkey % 3 IN (0, 1) THEN 'ALR Group'
         ELSE 'UG Group' END"""

ADAPTERS: dict[str, str] = {}

ADAPTERS["x_program_lines"] = f"""
SELECT
  b.FiscalYear,
  CASE WHEN b.l_linestatus = 'O' THEN 'SF Open' ELSE 'SF Final' END AS DataSource,
  b.o_orderdate AS CreatedDate,
  CASE WHEN b.c_acctbal >= 0 THEN 'Existing Client' ELSE 'New Client' END AS FYVertAccountStatus,
  'PRG' || CAST(b.l_orderkey AS STRING) AS ProgramID,
  CAST(b.o_custkey AS STRING) AS AccountID,
  CASE WHEN b.c_custkey % 37 = 5 THEN 'BoA' ELSE b.c_name END AS Account,
  'Parent ' || CAST(b.c_nationkey AS STRING) AS SystemParent,
  CASE WHEN b.l_linenumber = 7 THEN 'Other Group'
       WHEN b.c_mktsegment = 'AUTOMOBILE' THEN 'UG Group'
       WHEN b.c_mktsegment = 'BUILDING' THEN 'HD Group'
       WHEN b.c_mktsegment = 'FURNITURE' THEN 'ALR Group'
       WHEN b.c_mktsegment = 'HOUSEHOLD' THEN 'Agency'
       ELSE 'Adv Group' END AS Audience,
  CASE WHEN b.l_orderkey % 97 = 0 THEN NULL
       WHEN b.l_orderkey % 89 = 0 THEN substring(b.job, 1, 4)
       ELSE b.job END AS JobNumber,
  CASE WHEN b.campaign_code = '99' THEN
            (CASE b.l_linenumber WHEN 1 THEN 'Discount - Program / Inquiries'
                                 WHEN 2 THEN 'discount - volume'
                                 WHEN 3 THEN 'Spring Discount'
                                 ELSE 'Discount - Multi Year' END)
       WHEN b.l_orderkey % 53 = 0 THEN NULL
       WHEN b.campaign_code IN ('32', '36') THEN 'Other ALR'
       ELSE 'Campaign ' || b.campaign_code END AS Campaign,
  'Source ' || CAST(b.l_partkey % 6 AS STRING) AS ProductGroup,
  CASE WHEN b.l_tax > 0.05 THEN 'Y' ELSE 'N' END AS Full_CVExclude,
  CASE WHEN b.o_orderstatus = 'O' AND b.l_linenumber % 3 = 0 THEN NULL ELSE b.l_shipdate END AS SignatureDate,
  b.o_orderdate AS ContractSentDate,
  b.o_orderdate AS ProposalSentDate,
  b.o_orderdate AS Renewal_Package_FirstSigned,
  CASE WHEN b.l_linenumber = 1 THEN NULL ELSE b.o_orderdate END AS Renewal_Campaign_FirstSigned,
  b.o_orderdate AS TermStartDate,
  b.l_shipdate AS TermEndDate,
  CASE (b.l_suppkey + b.l_linenumber) % 11
       WHEN 0 THEN 'Discount Allocation' WHEN 1 THEN 'Cross-sell' WHEN 2 THEN 'Up-sell'
       WHEN 3 THEN 'Modification' WHEN 4 THEN 'Re-engagement' WHEN 5 THEN 'Line of Business Transfer'
       WHEN 6 THEN 'Accounting Adjustment' WHEN 7 THEN 'Cross-Sell' WHEN 8 THEN 'up-sell'
       WHEN 9 THEN 'Final Invoice adjustment'
       ELSE (CASE WHEN b.l_orderkey % 2 = 0 THEN 'Modification' ELSE NULL END) END AS PType,
  CASE WHEN b.l_linenumber = 1 AND b.l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS NBB,
  CASE WHEN b.l_partkey % 13 = 0 THEN 'UG to ALR' ELSE 'None' END AS SystemCrossSellType,
  CASE WHEN b.l_tax >= 0.07 THEN 'NA-Cost/Volume Movement' ELSE 'Standard' END AS DiscountReason,
  CASE b.o_orderpriority WHEN '1-URGENT' THEN 'New Sale' WHEN '2-HIGH' THEN 'Renewal'
       WHEN '3-MEDIUM' THEN 'Cross-sell' WHEN '4-NOT SPECIFIED' THEN 'Discount' ELSE 'Renewal' END AS OppType,
  'PKG' || CAST(b.o_custkey AS STRING) || '-' || CAST(b.FiscalYear AS STRING) AS PackageID,
  CASE b.o_orderstatus WHEN 'F' THEN 'Contracted' WHEN 'P' THEN 'Declined'
       ELSE (CASE WHEN b.l_linenumber = 3 THEN 'Pending - Opt Out' ELSE 'Pending Signature' END) END AS ProgramStatus,
  CASE WHEN b.o_custkey % 11 = 0 THEN 'Lost' ELSE 'Active' END AS FYVertEngagementStatus,
  CASE WHEN b.l_linenumber = 4 AND b.l_orderkey % 5 = 0 THEN NULL
       WHEN b.campaign_code = '99' OR b.l_orderkey % 4 = 0 THEN -CAST(b.l_extendedprice AS DECIMAL(19,4))
       ELSE CAST(b.l_extendedprice AS DECIMAL(19,4)) END AS ProgramCost,
  CAST(b.l_quantity AS DECIMAL(19,4)) AS ContactQuantity,
  CAST(CAST(b.l_tax AS DECIMAL(19,4)) * 100 AS DECIMAL(19,4)) AS Extra1Cost,
  CAST(CAST(b.l_discount AS DECIMAL(19,4)) * 100 AS DECIMAL(19,4)) AS Extra2Cost,
  'SL' || CAST(b.o_custkey % 3 AS STRING) AS CurrentSL
FROM (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_linestatus, l.l_shipdate,
         o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority,
         c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
         CAST(year(o.o_orderdate) AS INT) AS FiscalYear,
         CASE WHEN l.l_discount >= 0.09 THEN '99' ELSE CAST(30 + (o.o_custkey * 7 + l.l_linenumber) % 58 AS STRING) END AS campaign_code,
         ({_CLIENT_CODE}) || right(CAST(CAST(year(o.o_orderdate) AS INT) AS STRING), 2)
           || (CASE WHEN l.l_discount >= 0.09 THEN '99' ELSE CAST(30 + (o.o_custkey * 7 + l.l_linenumber) % 58 AS STRING) END) AS job
  FROM {{lineitem}} l
  JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
  JOIN {{customer}} c ON o.o_custkey = c.c_custkey
) b
"""

# The same lines with labels in other spellings, as differing case and trailing
# blanks are equal to the source.
_RESPELLED = {
    "Audience": "CASE WHEN NBB = 1 THEN upper(Audience) ELSE Audience || ' ' END",
    "PType": "CASE WHEN DataSource = 'SF Open' THEN lower(PType) ELSE PType || '  ' END",
    "OppType": "CASE WHEN ContactQuantity > 25 THEN upper(OppType) ELSE OppType END",
    "ProgramStatus": "CASE WHEN ContactQuantity > 10 THEN lower(ProgramStatus) ELSE ProgramStatus || ' ' END",
    "FYVertAccountStatus": "upper(FYVertAccountStatus)",
}
ADAPTERS["x_program_lines_spelled"] = (
    "SELECT "
    + ", ".join(f"{_RESPELLED[c]} AS {c}" if c in _RESPELLED else c for c in REQUIRED["program_lines"])
    + " FROM {x_program_lines}"
)



# Columns that the source cuts by position or writes together with others, where a
# trailing blank is a character as any other: respelled in case only.
_BY_POSITION = {
    "program_lines": {"JobNumber", "Account", "Audience"},
    "accounts": {"Client_Code_Adv__c", "r_Client_Code__c", "Counter_ID__c"},
}


def _respell(table: str, row: str, columns: Iterable[str]) -> str:
    """All of ``table``, each text of ``columns`` in one of four spellings that the row's number picks."""
    listed = []
    for place, c in enumerate(REQUIRED[table]):
        if c not in columns:
            listed.append(c)
            continue
        one, two = ("", "") if c in _BY_POSITION.get(table, ()) else (" || ' '", " || '  '")
        listed.append(f"CASE ({row} + {place}) % 4 WHEN 0 THEN upper({c}) WHEN 1 THEN lower({c}){one} WHEN 2 THEN {c}{two} ELSE {c} END AS {c}")
    return f"SELECT {', '.join(listed)} FROM {{x_{table}}}"


# Every text key of the extract's inputs respelled, row by row.
for _table, _row, _columns in (
    ("program_lines", "CAST(ContactQuantity AS INT) + FiscalYear", ["DataSource", "ProgramID", "AccountID", "Account", "SystemParent", "Audience", "JobNumber", "Campaign", "ProductGroup", "PType", "OppType", "PackageID", "ProgramStatus", "FYVertAccountStatus", "FYVertEngagementStatus", "CurrentSL"]),
    ("accounts", "length(ID) + ascii(right(ID, 1))", ["ID", "Client_Code_Adv__c", "r_Client_Code__c", "Counter_ID__c", "Record_Type_Text__c"]),
    ("account_segments", "length(AccountSFID) + ascii(right(AccountSFID, 1))", ["AccountSFID", "AccountSegment"]),
    ("program_packages", "length(ID) + ascii(right(ID, 1))", ["ID", "Name"]),
    ("program_optouts", "ascii(right(Id, 1)) + Fiscal_Year__c", ["Id"]),
    ("enrolment_packages", "FiscalYear + Tenure", ["AccountID", "Audience", "RenewalType", "Renewal_Status"]),
    ("other_packages", "FiscalYear + Tenure", ["AccountID", "Audience", "PackageID", "Adj_Renewal_Status"]),
    ("all_packages", "FiscalYear + Rk", ["AccountID", "Audience", "PackageId"]),
):
    ADAPTERS[f"x_{_table}_respelled"] = _respell(_table, _row, _columns)

ADAPTERS["x_accounts"] = f"""
SELECT CAST(c.c_custkey AS STRING) AS ID,
       CASE WHEN c.c_custkey % 29 = 0 THEN 'A' || CAST(c.c_custkey AS STRING) ELSE {_CLIENT_CODE} END AS Client_Code_Adv__c,
       CASE WHEN c.c_custkey % 50 = 0 THEN NULL
            WHEN c.c_custkey % 23 = 0 THEN 'X' || lpad(CAST(c.c_custkey % 100 AS STRING), 2, '0')
            ELSE {_CLIENT_CODE} END AS r_Client_Code__c,
       'B' || lpad(CAST(c.c_custkey % 1000 AS STRING), 3, '0') AS Counter_ID__c,
       CASE c.c_nationkey % 3 WHEN 0 THEN 'ALR' WHEN 1 THEN 'alr' ELSE 'Standard' END AS Record_Type_Text__c
FROM {{customer}} c
"""

ADAPTERS["x_account_segments"] = """
SELECT CAST(c.c_custkey AS STRING) AS AccountSFID,
       CASE c.c_custkey % 6 WHEN 0 THEN 'KDA East' WHEN 1 THEN 'kda west' WHEN 2 THEN 'Other%'
            WHEN 3 THEN 'Other Segment' WHEN 4 THEN NULL ELSE c.c_mktsegment END AS AccountSegment
FROM {customer} c
"""

ADAPTERS["x_program_packages"] = """
SELECT DISTINCT
       'PKG' || CAST(o.o_custkey AS STRING) || '-' || CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) AS ID,
       'Package ' || CAST(o.o_custkey AS STRING) || '/' || CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) AS Name
FROM {orders} o
"""

ADAPTERS["x_program_optouts"] = """
SELECT 'PRG' || CAST(l.l_orderkey AS STRING) AS Id,
       CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS Opt_Out__c,
       CAST(year(l.l_shipdate) AS INT) AS Fiscal_Year__c
FROM {lineitem} l
"""

# One row per (customer, order year) with what the package snapshots derive from.
ADAPTERS["x_customer_years"] = f"""
SELECT g.o_custkey, g.y, g.min_priority, g.n_orders, g.n_declined, g.first_date,
       CAST(g.y - f.first_year AS INT) AS tenure,
       f.customer_first_date,
       {_DERIVED_AUDIENCE} AS audience
FROM (
  SELECT o.o_custkey, CAST(year(o.o_orderdate) AS INT) AS y, min(o.o_orderpriority) AS min_priority,
         count(*) AS n_orders, CAST(sum(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INT) AS n_declined,
         min(o.o_orderdate) AS first_date
  FROM {{orders}} o
  GROUP BY o.o_custkey, CAST(year(o.o_orderdate) AS INT)
) g
JOIN (
  SELECT o.o_custkey, CAST(min(year(o.o_orderdate)) AS INT) AS first_year, min(o.o_orderdate) AS customer_first_date
  FROM {{orders}} o
  GROUP BY o.o_custkey
) f ON g.o_custkey = f.o_custkey
JOIN {{customer}} c ON g.o_custkey = c.c_custkey
"""

ADAPTERS["x_enrolment_packages"] = """
SELECT -- no snapshot of the customer for a year whose only orders are low priority: the row names no account
       CASE WHEN cy.min_priority = '5-LOW' THEN 'none-' ELSE '' END || CAST(cy.o_custkey AS STRING) AS AccountID,
       cy.y AS FiscalYear,
       cy.audience AS Audience,
       CASE cy.min_priority WHEN '1-URGENT' THEN 'Fixed Term' WHEN '2-HIGH' THEN 'Decision'
            WHEN '3-MEDIUM' THEN 'decision' ELSE 'Auto Renew' END AS RenewalType,
       cy.tenure AS Tenure,
       CASE WHEN cy.n_declined = cy.n_orders THEN 'Lost' WHEN cy.n_orders = 1 THEN NULL ELSE 'Renewed' END AS Renewal_Status
FROM {x_customer_years} cy
"""

ADAPTERS["x_other_packages"] = """
SELECT -- a single-order year of unspecified priority names no account and no package
       CASE WHEN cy.n_orders = 1 AND cy.min_priority = '4-NOT SPECIFIED' THEN 'none-' ELSE '' END || CAST(cy.o_custkey AS STRING) AS AccountID,
       cy.y AS FiscalYear,
       cy.audience AS Audience,
       CASE WHEN cy.o_custkey % 4 = 0 THEN cy.customer_first_date ELSE cy.first_date END AS FirstSigned,
       cy.tenure AS Tenure,
       CASE WHEN cy.n_orders = 1 AND cy.min_priority = '4-NOT SPECIFIED' THEN 'none-' ELSE 'PKG' END
         || CAST(cy.o_custkey AS STRING) || '-' || CAST(cy.y AS STRING) AS PackageID,
       CASE WHEN cy.n_declined > 0 THEN 'Lost' ELSE 'Secured' END AS Adj_Renewal_Status
FROM {x_customer_years} cy
"""

ADAPTERS["x_all_packages"] = """
SELECT CASE WHEN cy.n_orders = 1 AND cy.min_priority = '3-MEDIUM' THEN 'none-' ELSE '' END || CAST(cy.o_custkey AS STRING) AS AccountID,
       cy.audience AS Audience, cy.y AS FiscalYear,
       1 AS Rk, 'PKG' || CAST(cy.o_custkey AS STRING) || '-' || CAST(cy.y AS STRING) AS PackageId
FROM {x_customer_years} cy
UNION ALL
SELECT CASE WHEN cy.n_orders >= 3 THEN '' ELSE 'none-' END || CAST(cy.o_custkey AS STRING) AS AccountID,
       cy.audience AS Audience, cy.y AS FiscalYear,
       2 AS Rk, 'PKG-ALT' || CAST(cy.o_custkey AS STRING) AS PackageId
FROM {x_customer_years} cy
"""

# The same snapshot with its "Decision" rows duplicated: exercises the source's
# fan-out when a snapshot slot is not unique (``on_duplicate="keep"``).
ADAPTERS["x_enrolment_packages_dup"] = """
SELECT * FROM {x_enrolment_packages}
UNION ALL
SELECT CASE WHEN RenewalType = 'Decision' THEN AccountID ELSE 'again-' || AccountID END AS AccountID,
       FiscalYear, Audience, RenewalType, Tenure, Renewal_Status
FROM {x_enrolment_packages}
"""

# --- renewal pool inputs -------------------------------------------------------

_CONTRACT = "'C' || CAST(o.o_custkey AS STRING) || '-' || CAST(CAST(year(o.o_orderdate) AS INT) AS STRING)"

ADAPTERS["x_cpq_subscriptions"] = f"""
SELECT 'S' || CAST(o.o_orderkey AS STRING) AS SubscriptionSFID,
       'PS' || CAST(o.o_orderkey AS STRING) AS SubscriptionSFID_ProgramSub,
       CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE {_CONTRACT} END AS StandardContractSFID,
       CAST(o.o_custkey AS STRING) AS AccountSFID,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'Renewal' ELSE 'New' END AS RecordType_Sub,
       CAST(o.o_orderdate AS DATE) AS StartDate,
       CAST(o.o_orderdate AS DATE) + 364 AS EndDate,
       CASE WHEN o.o_orderkey % 6 = 0 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(o.o_totalprice AS DECIMAL(19,4)) END AS CustomerAmount,
       CAST(o.o_totalprice AS DECIMAL(19,4)) AS ListPrice,
       'PRG' || CAST(o.o_orderkey % 4 AS STRING) AS ProgramSFID,
       'ACR' || CAST(o.o_orderkey % 4 AS STRING) AS ProgramAcronym,
       o.o_orderpriority AS Class_1,
       o.o_orderdate AS CreatedDate,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'NewMigration' WHEN 1 THEN 'Legacy' ELSE 'Other' END AS CPQ_Type,
       CAST(o.o_orderdate AS DATE) AS ContractStartDate,
       CAST(o.o_orderdate AS DATE) + 364 AS ContractEndDate,
       'OPP' || CAST(o.o_orderkey AS STRING) AS OppSFID_Source
FROM {{orders}} o
"""

ADAPTERS["x_raw_subscriptions"] = """
SELECT -- declined low-priority orders have no raw subscription record: the row has another id
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'none-' ELSE 'S' END || CAST(o.o_orderkey AS STRING) AS Id,
       CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(o.o_totalprice AS DECIMAL(19,4)) END AS RevenueListPrice__c,
       CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(o.o_totalprice AS DECIMAL(19,4)) END AS SBQQ__ListPrice__c,
       'CN-' || CAST(o.o_orderkey AS STRING) AS DB_ContractNumber
FROM {orders} o
"""

# The parent opportunity of an order is the customer's first order of the
# previous year (an aggregate and an equi-join; no window over a customer).
ADAPTERS["x_opportunities"] = """
SELECT CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT' THEN 'none-' ELSE 'OPP' END || CAST(o.o_orderkey AS STRING) AS Id,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
            ELSE 'C' || CAST(o.o_custkey AS STRING) || '-' || CAST(CAST(year(o.o_orderdate) AS INT) - 1 AS STRING) END AS SO_RenewedContract,
       'OPP' || CAST(p.first_order AS STRING) AS Parent_Opportunity__c
FROM {orders} o
LEFT JOIN (
  SELECT o2.o_custkey, CAST(year(o2.o_orderdate) AS INT) AS y, min(o2.o_orderkey) AS first_order
  FROM {orders} o2
  GROUP BY o2.o_custkey, CAST(year(o2.o_orderdate) AS INT)
) p ON p.o_custkey = o.o_custkey AND p.y = CAST(year(o.o_orderdate) AS INT) - 1
"""

ADAPTERS["x_program_renewals"] = """
SELECT 'RN' || CAST(o.o_orderkey AS STRING) AS SourceObjectSFID,
       'Renewal ' || CAST(o.o_orderkey AS STRING) AS SourceObjectName,
       CAST(o.o_custkey AS STRING) AS AccountSFID,
       c.c_name AS AccountName,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'VTVT' WHEN 1 THEN 'vtvt' ELSE 'Group ' || CAST(o.o_orderkey % 3 AS STRING) END AS Class_2,
       CASE o.o_orderkey % 7 WHEN 0 THEN 'Other' WHEN 1 THEN 'technology' WHEN 2 THEN 'Consulting' ELSE 'Research' END AS Class_3,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'Moonshot Hub' WHEN 1 THEN 'The moonshot program' ELSE 'Core ' || c.c_mktsegment END AS ReportingGroup,
       CASE o.o_custkey % 3 WHEN 0 THEN '2 Year' WHEN 1 THEN '1 Year' ELSE NULL END AS AccountSegment,
       'ACR' || CAST(o.o_orderkey % 4 AS STRING) AS ProgramAcronym,
       CASE o.o_orderkey % 6 WHEN 0 THEN 'Fixed Term - 3yr' WHEN 1 THEN 'fixed term' WHEN 2 THEN 'Need Renewal Contract'
            WHEN 3 THEN 'Need Renewal Contract' WHEN 4 THEN 'Decision' ELSE NULL END AS DecisionType,
       CASE o.o_orderstatus WHEN 'O' THEN 'Pending'
            WHEN 'F' THEN (CASE WHEN o.o_orderkey % 9 = 0 THEN 'void' ELSE 'Won' END)
            ELSE (CASE WHEN o.o_orderkey % 2 = 0 THEN 'Dropped' ELSE NULL END) END AS Stage,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'Drop' WHEN 1 THEN 'Healthy' WHEN 2 THEN 'drop' ELSE NULL END AS RenewalHealth,
       CASE o.o_orderkey % 3 WHEN 0 THEN '80' WHEN 1 THEN '50' ELSE NULL END AS Projection_80_50,
       CAST(o.o_totalprice AS DECIMAL(19,4)) AS PreviousYearCredit,
       CAST(o.o_totalprice AS DECIMAL(19,4)) AS ProposalValue,
       CAST(CAST(o.o_totalprice AS DECIMAL(19,4)) - 1000 AS DECIMAL(19,4)) AS AnticipatedRenewalCredit,
       CASE WHEN o.o_orderkey % 3 = 0 THEN CAST(0 AS DECIMAL(19,4)) ELSE CAST(o.o_totalprice AS DECIMAL(19,4)) END AS RenewalCredit,
       CAST(o.o_orderdate AS DATE) AS PoolDate,
       CAST(year(o.o_orderdate) AS INT) + 27 AS PoolYear_FY,
       CASE WHEN month(o.o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS PoolHalf_FY,
       'Q' || CAST(quarter(o.o_orderdate) AS STRING) AS PoolQuarter_FY,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 4 AS INT) * 120 AS PeriodStartDate,
       'PRG' || CAST(o.o_orderkey % 4 AS STRING) AS ProgramSFID,
       'PD' || CAST(o.o_orderkey % 500 AS STRING) AS PredecessorSFID_PreviousContract,
       CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE 'S' || CAST(o.o_orderkey AS STRING) END AS SubscriptionSFID,
       'SP' || CAST(o.o_orderkey AS STRING) AS SubPeriodSFID
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

ADAPTERS["x_subscription_periods"] = """
SELECT CASE WHEN o.o_orderstatus = 'O' AND o.o_orderpriority = '2-HIGH' THEN 'none-' ELSE 'SP' END || CAST(o.o_orderkey AS STRING) AS Id,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Autorenew__c,
       -- dates as people and systems write them, and what is none
       CASE o.o_orderkey % 11
            WHEN 0 THEN '//' WHEN 1 THEN NULL WHEN 2 THEN 'n/a' WHEN 3 THEN ' '
            WHEN 4 THEN '13/' || CAST(day(o.noted) AS STRING) || '/' || CAST(year(o.noted) AS STRING)
            WHEN 5 THEN '2/30/' || CAST(year(o.noted) AS STRING)
            WHEN 6 THEN lpad(CAST(month(o.noted) AS STRING), 2, '0') || '/' || lpad(CAST(day(o.noted) AS STRING), 2, '0') || '/' || CAST(year(o.noted) AS STRING)
            WHEN 7 THEN CAST(year(o.noted) * 10000 + month(o.noted) * 100 + day(o.noted) AS STRING)
            WHEN 8 THEN CAST(o.noted AS STRING)
            WHEN 9 THEN CAST(month(o.noted) AS STRING) || '-' || CAST(day(o.noted) AS STRING) || '-' || CAST(year(o.noted) AS STRING)
            ELSE CAST(month(o.noted) AS STRING) || '/' || CAST(day(o.noted) AS STRING) || '/' || CAST(year(o.noted) AS STRING) || ' '
       END AS Autorenewal_Notification_Date__c,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'Green' WHEN 1 THEN 'Red' ELSE NULL END AS Account_Health_YV__c
FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) + 30 AS noted FROM {orders}) o
"""

# Periods with the auto-renewing ones twice: pool rows then come twice, too.
ADAPTERS["x_subscription_periods_dup"] = """
SELECT * FROM {x_subscription_periods}
UNION ALL
SELECT CASE WHEN Autorenew__c = 'Yes' THEN Id ELSE 'again-' || Id END AS Id, Autorenew__c,
       Autorenewal_Notification_Date__c, Account_Health_YV__c
FROM {x_subscription_periods}
"""

ADAPTERS["x_program_subscriptions"] = """
SELECT CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN 'none-' ELSE 'S' END || CAST(o.o_orderkey AS STRING) AS ProgramSubSFID,
       'SUB-' || CAST(o.o_orderkey AS STRING) AS ProgramSubName
FROM {orders} o
"""

ADAPTERS["x_programs"] = """
SELECT DISTINCT 'PRG' || CAST(o.o_orderkey % 4 AS STRING) AS ProgramSFID FROM {orders} o
"""

ADAPTERS["x_predecessors"] = """
SELECT DISTINCT 'PD' || CAST(o.o_orderkey % 500 AS STRING) AS PredecessorSFID FROM {orders} o
"""

ADAPTERS["x_shared_enrolments"] = """
SELECT CAST(o.o_custkey AS STRING) AS AccountID,
       CAST(year(o.o_orderdate) AS INT) + 27 AS FiscalYear,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'UG accounts' ELSE 'ALR accounts' END AS Audience,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'renewal' WHEN 1 THEN 'first year free' ELSE 'new' END AS AccountType
FROM {orders} o
"""

ADAPTERS["x_standard_contracts"] = f"""
SELECT -- a contract is on file only for a customer-year with a fulfilled order
       CASE WHEN sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0 THEN '' ELSE 'none-' END || {_CONTRACT} AS StandardContractSFID,
       'SC-' || CAST(o.o_custkey AS STRING) || '/' || CAST(CAST(year(o.o_orderdate) AS INT) AS STRING) AS ContractNumber
FROM {{orders}} o
GROUP BY o.o_custkey, CAST(year(o.o_orderdate) AS INT)
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def dependencies(name: str) -> list[str]:
    return _PLACEHOLDER.findall(ADAPTERS[name])


def _closure(names: Iterable[str]) -> list[str]:
    """Adapters needed for ``names``, dependencies first."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in ordered:
            return
        for d in dependencies(n):
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    return ordered


# Session setting: over how many tasks the base tables are spread when read (unset:
# the scan's own splits).  For files of one row group each, which scan as one task.
INPUT_PARTITIONS = "spark.yoyflow.input.partitions"


class SparkInputs:
    """Lazily built adapter DataFrames for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE_TABLES:
                spread = self.spark.conf.get(INPUT_PARTITIONS, None)
                self._frames[name] = read_input(self.spark, f"{self.sf_dir}/{name}.parquet", partitions=int(spread) if spread else None)
            else:
                args = {d: self[d] for d in dependencies(name)}
                self._frames[name] = self.spark.sql(ADAPTERS[name], **args)
        return self._frames[name]


def duckdb_with(names: Iterable[str]) -> str:
    """``WITH`` clause defining the adapters (and their dependencies) for DuckDB."""
    parts = []
    for n in _closure(names):
        body = _PLACEHOLDER.sub(lambda m: m.group(1), ADAPTERS[n])
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts)

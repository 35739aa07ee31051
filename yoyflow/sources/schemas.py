"""Required input columns per dataset (see FIXTURES.md) and their check.

The check reads only schemas -- no Spark job runs -- and reports every missing
column of every input at once, before any work is planned.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

REQUIRED: dict[str, tuple[str, ...]] = {
    # revenue extract
    "program_lines": (
        "FiscalYear", "DataSource", "CreatedDate", "FYVertAccountStatus", "ProgramID", "AccountID", "Account",
        "SystemParent", "Audience", "JobNumber", "Campaign", "ProductGroup", "Full_CVExclude", "SignatureDate",
        "ContractSentDate", "ProposalSentDate", "Renewal_Package_FirstSigned", "Renewal_Campaign_FirstSigned",
        "TermStartDate", "TermEndDate", "PType", "NBB", "SystemCrossSellType", "DiscountReason", "OppType",
        "PackageID", "ProgramStatus", "FYVertEngagementStatus", "ProgramCost", "ContactQuantity", "Extra1Cost",
        "Extra2Cost", "CurrentSL",
    ),
    "accounts": ("ID", "Client_Code_Adv__c", "r_Client_Code__c", "Counter_ID__c", "Record_Type_Text__c"),
    "account_segments": ("AccountSFID", "AccountSegment"),
    "program_packages": ("ID", "Name"),
    "program_optouts": ("Id", "Opt_Out__c", "Fiscal_Year__c"),
    "enrolment_packages": ("AccountID", "FiscalYear", "Audience", "RenewalType", "Tenure", "Renewal_Status"),
    "other_packages": ("AccountID", "FiscalYear", "Audience", "FirstSigned", "Tenure", "PackageID", "Adj_Renewal_Status"),
    "all_packages": ("AccountID", "Audience", "FiscalYear", "Rk", "PackageId"),
    # renewal pool
    "cpq_subscriptions": (
        "SubscriptionSFID", "SubscriptionSFID_ProgramSub", "StandardContractSFID", "AccountSFID", "RecordType_Sub",
        "StartDate", "EndDate", "CustomerAmount", "ListPrice", "ProgramSFID", "ProgramAcronym", "Class_1",
        "CreatedDate", "CPQ_Type", "ContractStartDate", "ContractEndDate", "OppSFID_Source",
    ),
    "raw_subscriptions": ("Id", "RevenueListPrice__c", "SBQQ__ListPrice__c", "DB_ContractNumber"),
    "opportunities": ("Id", "SO_RenewedContract", "Parent_Opportunity__c"),
    "program_renewals": (
        "SourceObjectSFID", "SourceObjectName", "AccountSFID", "AccountName", "Class_2", "Class_3", "ReportingGroup",
        "AccountSegment", "ProgramAcronym", "DecisionType", "Stage", "RenewalHealth", "Projection_80_50",
        "PreviousYearCredit", "ProposalValue", "AnticipatedRenewalCredit", "RenewalCredit", "PoolDate", "PoolYear_FY",
        "PoolHalf_FY", "PoolQuarter_FY", "PeriodStartDate", "ProgramSFID", "PredecessorSFID_PreviousContract",
        "SubscriptionSFID", "SubPeriodSFID",
    ),
    "programs": ("ProgramSFID",),
    "predecessors": ("PredecessorSFID",),
    "subscription_periods": ("Id", "Autorenew__c", "Autorenewal_Notification_Date__c", "Account_Health_YV__c"),
    "program_subscriptions": ("ProgramSubSFID", "ProgramSubName"),
    "shared_enrolments": ("AccountID", "FiscalYear", "Audience", "AccountType"),
    "standard_contracts": ("StandardContractSFID", "ContractNumber"),
}


class MissingColumns(ValueError):
    pass


def check_inputs(frames: Mapping[str, DataFrame]) -> None:
    """Raise one error listing every missing column of every input.

    Column names compare case-insensitively, like Spark's default resolution.
    """
    problems = []
    for name, df in frames.items():
        have = {c.lower() for c in df.columns}
        missing = [c for c in REQUIRED[name] if c.lower() not in have]
        if missing:
            problems.append(f"{name}: missing {', '.join(missing)}")
    if problems:
        raise MissingColumns("input check failed -- " + "; ".join(problems))

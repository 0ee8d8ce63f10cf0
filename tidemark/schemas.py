"""Enforced schemas of the four sources. Money is double, raw data is all strings."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


ATTRIBUTES = _schema(
    Customer_ID="string",
    Name="string",
    Age="int",
    SSN="string",
    Occupation="string",
    snapshot_date="date",
)

FINANCIALS = _schema(
    Customer_ID="string",
    Annual_Income="double",
    Monthly_Inhand_Salary="double",
    Num_Bank_Accounts="int",
    Num_Credit_Card="int",
    Interest_Rate="double",
    Num_of_Loan="int",
    Type_of_Loan="string",
    Delay_from_due_date="int",
    Num_of_Delayed_Payment="int",
    Changed_Credit_Limit="double",
    Num_Credit_Inquiries="double",
    Credit_Mix="string",
    Outstanding_Debt="double",
    Credit_Utilization_Ratio="double",
    Credit_History_Age="string",
    Payment_of_Min_Amount="string",
    Total_EMI_per_month="double",
    Amount_invested_monthly="double",
    Payment_Behaviour="string",
    Monthly_Balance="double",
    snapshot_date="date",
)

CLICKSTREAM = _schema(
    **{f"fe_{i}": "int" for i in range(1, 21)}, Customer_ID="string", snapshot_date="date"
)

LOANS = _schema(
    loan_id="string",
    Customer_ID="string",
    loan_start_date="date",
    tenure="int",
    installment_num="int",
    loan_amt="double",
    due_amt="double",
    paid_amt="double",
    overdue_amt="double",
    balance="double",
    snapshot_date="date",
)

SOURCES = {
    "fe_attributes": ATTRIBUTES,
    "fe_financials": FINANCIALS,
    "fe_clickstream": CLICKSTREAM,
    "lms": LOANS,
}

# Validation rule inputs per source.
FINANCIALS_OPTIONAL = ("Type_of_Loan",)
FINANCIALS_NON_NEGATIVE = (
    "Annual_Income",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
)
UNDERSCORED_FINANCIALS = (
    "Num_of_Loan",
    "Annual_Income",
    "Num_of_Delayed_Payment",
    "Outstanding_Debt",
    "Amount_invested_monthly",
    "Monthly_Balance",
)


def raw_schema(schema: T.StructType) -> T.StructType:
    """The same columns as strings: what a CSV scan delivers before typing."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])

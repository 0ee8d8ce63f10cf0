"""Raw credit sources derived from the driver's customer and orders tables.

Integer arithmetic only, so that a SQL engine repeats it exactly (see oracle.py). Everything is
text, as a CSV scan would deliver it, except snapshot_date. Row counts grow with `customer`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Rows that one task derives at most, so that its sorts and hash tables do not grow with the input.
ROWS_A_TASK = 250_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str, fan_out: int = 1) -> DataFrame:
    """The customers, dealt over enough tasks for the `fan_out` rows that a source derives from each.

    Without that the file's layout decides: a row group with all customers is one task, and so are all rows
    derived from it. The count comes from the file footers; a table that fits one task stays as it is read.
    """
    rows = table(spark, folder, "customer")
    tasks = math.ceil(rows.count() * fan_out / ROWS_A_TASK)
    return rows if tasks <= 1 else rows.repartition(tasks, "c_custkey")


def _cohort_start(k: str) -> str:
    return f"add_months(date'2023-01-01', cast({k} % 24 as int))"


def raw_attributes(spark: SparkSession, folder: str) -> DataFrame:
    ids = customers(spark, folder).selectExpr(
        "c_custkey as k",
        "case when c_custkey % 97 = 96 then c_custkey - 1 else c_custkey end as j",
        "c_name",
        "c_mktsegment",
        "cast(100000000 + (c_custkey * 7919) % 900000000 as string) as d",
    )
    return ids.selectExpr(
        "concat('CUS_', j) as Customer_ID",
        "case when k % 89 = 0 then null else c_name end as Name",
        """case when k % 101 = 3 then 'abc' when k % 71 = 2 then '8698' when k % 53 = 1 then '-500'
             else concat(14 + (k * 37) % 60, case when k % 11 = 0 then '_' else '' end) end as Age""",
        """case when k % 13 = 0 then '#F%$D@*&8' when k % 59 = 5 then '123-45-6789'
             else concat(substr(d, 1, 3), '-', substr(d, 4, 2), '-', substr(d, 6, 4)) end as SSN""",
        "case when k % 17 = 0 then '_______' else c_mktsegment end as Occupation",
        f"{_cohort_start('j')} as snapshot_date",
    )


def raw_financials(spark: SparkSession, folder: str) -> DataFrame:
    base = (
        customers(spark, folder, 3)
        .selectExpr("c_custkey as k", "explode(sequence(0, 2)) as m")
        .selectExpr("k", "m", "k * 31 + m * 17 as h")
    )
    return base.selectExpr(
        "concat('CUS_', k) as Customer_ID",
        "concat(8000 + (h * 97) % 150000, case when h % 19 = 0 then '_' else '' end) as Annual_Income",
        "cast(case when h % 211 = 0 then 0 else 500 + h % 9000 end as string) as Monthly_Inhand_Salary",
        "cast(h % 11 as string) as Num_Bank_Accounts",
        "cast(h % 9 as string) as Num_Credit_Card",
        "cast(h % 30 as string) as Interest_Rate",
        "concat(h % 5, case when h % 23 = 0 then '_' else '' end) as Num_of_Loan",
        """case h % 6 when 0 then null when 1 then 'Auto Loan' when 2 then 'Payday Loan, and Student Loan'
             when 3 then 'Auto Loan, Auto Loan, and Mortgage Loan' when 4 then 'Not Specified'
             else 'Home Equity Loan and Personal Loan' end as Type_of_Loan""",
        "cast(case when h % 47 = 0 then -3 else h % 60 end as string) as Delay_from_due_date",
        "concat(h % 25, case when h % 29 = 0 then '_' else '' end) as Num_of_Delayed_Payment",
        "case when h % 31 = 0 then '_' else cast(h % 20 as string) end as Changed_Credit_Limit",
        "cast(h % 15 as string) as Num_Credit_Inquiries",
        "case h % 4 when 0 then 'Standard' when 1 then 'Good' when 2 then 'Bad' else '_' end as Credit_Mix",
        "concat(h % 5000, case when h % 37 = 0 then '_' else '' end) as Outstanding_Debt",
        "cast(20 + h % 45 as string) as Credit_Utilization_Ratio",
        """case when h % 83 = 0 then 'NA'
             else concat(h % 30, ' Years and ', h % 12, ' Months') end as Credit_History_Age""",
        "case h % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end as Payment_of_Min_Amount",
        "cast(h % 700 as string) as Total_EMI_per_month",
        "case when h % 43 = 0 then '__10000__' else cast(h % 1000 as string) end as Amount_invested_monthly",
        """case h % 10 when 0 then 'High_spent_Large_value_payments'
             when 1 then 'High_spent_Medium_value_payments' when 2 then 'High_spent_Small_value_payments'
             when 3 then 'Medium_spent_Large_value_payments' when 4 then 'Medium_spent_Medium_value_payments'
             when 5 then 'Medium_spent_Small_value_payments' when 6 then 'Low_spent_Large_value_payments'
             when 7 then 'Low_spent_Medium_value_payments' when 8 then 'Low_spent_Small_value_payments'
             else '!@9#%8' end as Payment_Behaviour""",
        "cast(h % 1200 as string) as Monthly_Balance",
        f"add_months({_cohort_start('k')}, m) as snapshot_date",
    )


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    base = customers(spark, folder, 3).selectExpr("c_custkey as k", "explode(sequence(0, 2)) as m")
    return base.selectExpr(
        *[f"cast((k * {i} * 13 + m * 7) % 200 - 50 as string) as fe_{i}" for i in range(1, 21)],
        "concat('CUS_', k) as Customer_ID",
        f"add_months({_cohort_start('k')}, m) as snapshot_date",
    )


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    base = (
        customers(spark, folder, 11)
        .selectExpr("c_custkey as k", "explode(sequence(0, 10)) as i")
        .selectExpr(
            "k",
            "i",
            "case when (k div 24) % 4 = 0 then greatest(i - (k div 96) % 6 - 1, 0) else 0 end as late",
        )
    )
    return base.selectExpr(
        "concat('CUS_', k, '_L') as loan_id",
        "concat('CUS_', k) as Customer_ID",
        f"cast({_cohort_start('k')} as string) as loan_start_date",
        "'10' as tenure",
        "cast(i as string) as installment_num",
        "'10000' as loan_amt",
        "case when i = 0 then '0' else '1000' end as due_amt",
        "case when late > 0 or i = 0 then '0' else '1000' end as paid_amt",
        "cast(1000 * late as string) as overdue_amt",
        "cast(10000 - 1000 * i + 1000 * late as string) as balance",
        f"add_months({_cohort_start('k')}, i) as snapshot_date",
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer and month; customers have gaps between months."""
    return (
        table(spark, folder, "orders")
        .selectExpr(
            "concat('CUS_', o_custkey) as Customer_ID",
            "trunc(cast(o_orderdate as date), 'MM') as snapshot_date",
            "o_totalprice",
        )
        .groupBy("Customer_ID", "snapshot_date")
        .agg({"*": "count", "o_totalprice": "sum"})
        .selectExpr(
            "Customer_ID", "snapshot_date", "`count(1)` as n_orders", "`sum(o_totalprice)` as total"
        )
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """One deterministic score per customer at the cohort's first month."""
    return customers(spark, folder).selectExpr(
        "concat('CUS_', c_custkey) as Customer_ID",
        f"{_cohort_start('c_custkey')} as snapshot_date",
        "'prod_model' as model_name",
        "((c_custkey * 7919) % 10007) / 10007.0D as model_predictions",
    )


def monthly_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every customer in the cohort's first three months."""
    base = customers(spark, folder, 3).selectExpr("c_custkey as k", "explode(sequence(0, 2)) as m")
    return base.selectExpr(
        "concat('CUS_', k) as Customer_ID",
        f"add_months({_cohort_start('k')}, m) as snapshot_date",
        "'prod_model' as model_name",
        "((k * 7919 + m * 613) % 10007) / 10007.0D as model_predictions",
    )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Labels six months after the scored months: one to three loans a customer, some customers without
    one in a month, and no month from June 2025 on."""
    base = (
        customers(spark, folder, 9)
        .selectExpr("c_custkey as k", "explode(sequence(0, 2)) as m")
        .selectExpr("k", "m", "explode(sequence(0, cast(k % 3 as int))) as j")
        .where("(k + m) % 4 <> 0")
    )
    return base.selectExpr(
        "concat('CUS_', k, '_L', j) as loan_id",
        "concat('CUS_', k) as Customer_ID",
        f"add_months({_cohort_start('k')}, m + 6) as snapshot_date",
        "cast((k * 31 + m * 17 + j * 7) % 5 = 0 as int) as label",
    ).where("snapshot_date < date'2025-06-01'")

"""Raw to silver: clean, type, validate, enrich. All snapshots in one plan.

Each `validated_*` frame holds every input row with its `errors`; clean and quarantined rows
are two filters over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import codes, schemas
from tidemark.functions import cleaning, numeric
from tidemark.operators import quality
from tidemark.operators.labels import delinquency_columns
from tidemark.operators.lookup import code_table, lookup
from tidemark.operators.typing import enforce_schema


# --- attributes -------------------------------------------------------------


def clean_attributes(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "Age": cleaning.strip_trailing_underscore(F.col("Age")),
            "SSN": cleaning.keep_if_match(F.col("SSN"), codes.SSN_PATTERN, codes.SSN_UNKNOWN),
            "Occupation": cleaning.default_if_no_match(
                F.col("Occupation"), codes.HAS_LETTER_PATTERN, codes.OCCUPATION_UNKNOWN
            ),
        }
    )


def validated_attributes(raw: DataFrame) -> DataFrame:
    """Typed attributes with errors. Ids are unique per snapshot; SSNs leave here masked."""
    schema = schemas.ATTRIBUTES
    cleaned = clean_attributes(raw)
    parsed = quality.parse(cleaned, schema).withColumn("_masked", cleaning.mask_ssn(F.col("SSN")))
    unknown = F.col("SSN") == codes.SSN_UNKNOWN
    flagged = quality.flag_repeated(parsed, ["snapshot_date", "Customer_ID"], "_same_id")
    flagged = quality.flag_repeated(
        flagged, ["snapshot_date", "SSN"], "_same_ssn", ignore=unknown, counted=parsed
    )
    errors = F.concat(
        "_parse_errors",
        quality.error_list(
            [
                quality.tagged("_same_id", "DUPLICATE_CUSTOMER_ID", "Customer_ID"),
                quality.tagged("_same_ssn", "DUPLICATE_SSN", "_masked"),
                quality.negative("Age", "NEGATIVE_VALUE"),
                quality.out_of_range("Age", codes.MIN_AGE, codes.MAX_AGE, "AGE_OUT_OF_RANGE"),
            ]
        ),
    )
    kept = ["_masked as SSN" if c == "SSN" else c for c in schema.fieldNames()]
    return flagged.select(*[F.expr(c) for c in kept], errors.alias("errors"))


def silver_attributes(validated: DataFrame) -> DataFrame:
    """Clean rows without personal data, with the age group."""
    return (
        quality.clean_rows(validated)
        .drop("SSN", "Name")
        .withColumn("Age_Group", numeric.fixed_bin(F.col("Age"), codes.AGE_CEILINGS))
    )


# --- financials --------------------------------------------------------------


def clean_financials(raw: DataFrame) -> DataFrame:
    cleaned = {
        c: cleaning.strip_outer_underscores(F.col(c)) for c in schemas.UNDERSCORED_FINANCIALS
    }
    cleaned["Num_of_Loan"] = cleaning.reconciled_count(F.col("Num_of_Loan"), F.col("Type_of_Loan"))
    cleaned["Credit_Mix"] = cleaning.replace_value(F.col("Credit_Mix"), "_", codes.NOT_MEASURED)
    cleaned["Changed_Credit_Limit"] = cleaning.replace_value(F.col("Changed_Credit_Limit"), "_", "0.0")
    cleaned["Payment_Behaviour"] = cleaning.keep_if_match(
        F.trim("Payment_Behaviour"), codes.PAYMENT_BEHAVIOUR_PATTERN, codes.NOT_MEASURED
    )
    return raw.withColumns(cleaned)


def validated_financials(raw: DataFrame) -> DataFrame:
    schema = schemas.FINANCIALS
    cleaned = clean_financials(raw)
    parsed = quality.parse(cleaned, schema, schemas.FINANCIALS_OPTIONAL)
    flagged = quality.flag_repeated(parsed, ["snapshot_date", "Customer_ID"], "_same_id")
    errors = F.concat(
        "_parse_errors",
        quality.error_list(
            [quality.tagged("_same_id", "DUPLICATE_CUSTOMER_ID", "Customer_ID")]
            + [quality.negative(c, "NEGATIVE") for c in schemas.FINANCIALS_NON_NEGATIVE]
        ),
    )
    return flagged.select(*schema.fieldNames(), errors.alias("errors"))


def add_code_ids(df: DataFrame) -> DataFrame:
    """Payment behaviour, minimum-payment and credit-mix ids; unmatched labels give NULL."""
    spark = df.sparkSession
    behaviour = code_table(spark, codes.PAYMENT_BEHAVIOUR, "Payment_Behavior_ID", "Payment_Behavior_Label")
    minimum = code_table(
        spark, codes.PAYMENT_OF_MIN_AMOUNT, "Payment_of_Min_Amount_ID", "Payment_of_Min_Amount_Label"
    )
    mix = code_table(spark, codes.CREDIT_MIX, "Credit_Mix_ID", "Credit_Mix_Label")
    df = lookup(df, behaviour, "Payment_Behaviour", "Payment_Behavior_Label", ignore_case=True)
    df = lookup(df, minimum, "Payment_of_Min_Amount", "Payment_of_Min_Amount_Label")
    return lookup(df, mix, "Credit_Mix", "Credit_Mix_Label")


def enrich_financials(typed_rows: DataFrame) -> DataFrame:
    salary = F.col("Monthly_Inhand_Salary")
    return add_code_ids(typed_rows).withColumns(
        {
            "Credit_History_Months": cleaning.duration_months(F.col("Credit_History_Age")),
            "Credit_Utilization_Ratio": F.col("Credit_Utilization_Ratio") / 100.0,
            "Annual_Income_Group": numeric.fixed_bin(F.col("Annual_Income"), codes.INCOME_CEILINGS),
            "dti": numeric.ratio_if_positive(F.col("Total_EMI_per_month"), salary),
            "savings_rate": numeric.ratio(F.col("Monthly_Balance"), salary),
        }
    )


def silver_financials(validated: DataFrame) -> DataFrame:
    return enrich_financials(quality.clean_rows(validated))


# --- clickstream and loans -------------------------------------------------------


def silver_clickstream(raw: DataFrame) -> DataFrame:
    return enforce_schema(raw, schemas.CLICKSTREAM)


def silver_loans(raw: DataFrame) -> DataFrame:
    return delinquency_columns(enforce_schema(raw, schemas.LOANS))

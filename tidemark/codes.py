"""Fixed values of the credit domain: code tables, bin edges, patterns, named feature sets.

Everything here is data that results depend on; no logic lives in this file.
"""

from __future__ import annotations

# --- fixed values: code tables (id -> label) --------------------------------
CREDIT_MIX = {1: "Standard", 2: "Good", 3: "Bad", 4: "NM"}

PAYMENT_BEHAVIOUR = {
    1: "High_spent_Large_value_payments",
    2: "High_spent_Medium_value_payments",
    3: "High_spent_Small_value_payments",
    4: "Medium_spent_Large_value_payments",
    5: "Medium_spent_Medium_value_payments",
    6: "Medium_spent_Small_value_payments",
    7: "Low_spent_Large_value_payments",
    8: "Low_spent_Medium_value_payments",
    9: "Low_spent_Small_value_payments",
    10: "NM",
}

PAYMENT_OF_MIN_AMOUNT = {1: "Yes", 2: "No", 3: "NM"}

LOAN_TYPE = {
    1: "Auto Loan",
    2: "Credit-Builder Loan",
    3: "Debt Consolidation Loan",
    4: "Home Equity Loan",
    5: "Mortgage Loan",
    6: "Payday Loan",
    7: "Personal Loan",
    8: "Student Loan",
    99: "Not Specified",
}

# --- fixed values: bin ceilings (group id = position, last group is open) ----
AGE_CEILINGS = [18.0, 25.0, 35.0, 45.0, 55.0, 65.0]
INCOME_CEILINGS = [18000.0, 30000.0, 50000.0, 80000.0, 120000.0]

AGE_LABELS = {
    1: "[0, 18)",
    2: "[18, 25)",
    3: "[25, 35)",
    4: "[35, 45)",
    5: "[45, 55)",
    6: "[55, 65)",
    7: "[65, inf)",
}
INCOME_LABELS = {
    1: "[0, 18k)",
    2: "[18k, 30k)",
    3: "[30k, 50k)",
    4: "[50k, 80k)",
    5: "[80k, 120k)",
    6: "[120k, inf)",
}

MIN_AGE = 18
MAX_AGE = 150

# --- fixed values: text patterns and placeholders -----------------------------
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
SSN_UNKNOWN = "Unidentified"
SSN_KEEP_LAST_FOUR = r".*(\d{4})"
SSN_MASK = "*****$1"
HAS_LETTER_PATTERN = r"[a-zA-Z]"
OCCUPATION_UNKNOWN = "Missing"
PAYMENT_BEHAVIOUR_PATTERN = r"(?i)^(High|Medium|Low)_spent_(Large|Medium|Small)_value_payments$"
NOT_MEASURED = "NM"
LOAN_LIST_SEPARATOR = r"\s*,\s*and\s*|\s*,\s*|\s+and\s+"
TRAILING_UNDERSCORE = r"_$"
OUTER_UNDERSCORES = r"^_+|_+$"

# --- fixed values: named feature sets -----------------------------------------
FEATURES_0 = [
    "Age_Group",
    "Annual_Income_Group",
    "savings_rate_avg_3m",
    "crs",
    "dti",
    "Payment_Behavior_ID",
    "Payment_of_Min_Amount_ID",
]
CLICKSTREAM_FIVE = ["fe_1", "fe_2", "fe_3", "fe_4", "fe_5"]
FEATURE_SETS = {
    "FEATURES_0": FEATURES_0,
    "FEATURES_0_1": FEATURES_0 + ["delinquency_score_log"],
    "FEATURES_0_2": FEATURES_0 + ["delinquency_flag"],
    "FEATURES_1_0": FEATURES_0 + CLICKSTREAM_FIVE,
    "FEATURES_1_1": FEATURES_0 + ["delinquency_score_log"] + CLICKSTREAM_FIVE,
    "FEATURES_1_2": FEATURES_0 + ["delinquency_flag"] + CLICKSTREAM_FIVE,
}
DEFAULT_FEATURES = FEATURE_SETS["FEATURES_1_1"]

"""The registered queries as plain SQL over the driver's tables, for an independent check.

Written against the query definitions, not generated from the Spark plans. `_CTES` holds the
shared building blocks; each query lists the ones it needs through `_sql`.
"""

from __future__ import annotations

from tidemark import codes, schemas
from tidemark.operators.models import GBT_DRAWS, GBT_SPACE, LR_DRAWS, LR_SPACE, draw_params
from tidemark.operators.tree_search import Problem

_START = "CAST(DATE '2023-01-01' + to_months(CAST({k} % 24 AS INTEGER)) AS DATE)"


def _months(day: str, n: str) -> str:
    return f"CAST({day} + to_months(CAST({n} AS INTEGER)) AS DATE)"


def _values(mapping: dict) -> str:
    return ", ".join(f"({k}, '{v}')" for k, v in mapping.items())


def _bin(column: str, ceilings: list[float]) -> str:
    steps = " ".join(f"WHEN {column} < {c} THEN {i}" for i, c in enumerate(ceilings, start=1))
    return f"CASE WHEN {column} IS NULL THEN NULL {steps} ELSE {len(ceilings) + 1} END"


def _list(items: list[str]) -> str:
    return f"[x FOR x IN [{', '.join(items)}] IF x IS NOT NULL]"


def _round(*columns: str) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)


_SEP = codes.LOAN_LIST_SEPARATOR
_STRIP = "regexp_replace({c}, '^_+|_+$', '', 'g')"

# --- raw sources -------------------------------------------------------------------

_RAW_ATTRIBUTES = f"""
SELECT 'CUS_' || j AS Customer_ID,
  CASE WHEN k % 89 = 0 THEN NULL ELSE c_name END AS Name,
  CASE WHEN k % 101 = 3 THEN 'abc' WHEN k % 71 = 2 THEN '8698' WHEN k % 53 = 1 THEN '-500'
    ELSE (14 + (k * 37) % 60) || CASE WHEN k % 11 = 0 THEN '_' ELSE '' END END AS Age,
  CASE WHEN k % 13 = 0 THEN '#F%$D@*&8' WHEN k % 59 = 5 THEN '123-45-6789'
    ELSE substr(d, 1, 3) || '-' || substr(d, 4, 2) || '-' || substr(d, 6, 4) END AS SSN,
  CASE WHEN k % 17 = 0 THEN '_______' ELSE c_mktsegment END AS Occupation,
  {_START.format(k='j')} AS snapshot_date
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 97 = 96 THEN c_custkey - 1 ELSE c_custkey END AS j,
  c_name, c_mktsegment, CAST(100000000 + (c_custkey * 7919) % 900000000 AS VARCHAR) AS d FROM customer)
"""

_RAW_FINANCIALS = f"""
SELECT 'CUS_' || k AS Customer_ID,
  (8000 + (h * 97) % 150000) || CASE WHEN h % 19 = 0 THEN '_' ELSE '' END AS Annual_Income,
  CAST(CASE WHEN h % 211 = 0 THEN 0 ELSE 500 + h % 9000 END AS VARCHAR) AS Monthly_Inhand_Salary,
  CAST(h % 11 AS VARCHAR) AS Num_Bank_Accounts,
  CAST(h % 9 AS VARCHAR) AS Num_Credit_Card,
  CAST(h % 30 AS VARCHAR) AS Interest_Rate,
  (h % 5) || CASE WHEN h % 23 = 0 THEN '_' ELSE '' END AS Num_of_Loan,
  CASE h % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Auto Loan' WHEN 2 THEN 'Payday Loan, and Student Loan'
    WHEN 3 THEN 'Auto Loan, Auto Loan, and Mortgage Loan' WHEN 4 THEN 'Not Specified'
    ELSE 'Home Equity Loan and Personal Loan' END AS Type_of_Loan,
  CAST(CASE WHEN h % 47 = 0 THEN -3 ELSE h % 60 END AS VARCHAR) AS Delay_from_due_date,
  (h % 25) || CASE WHEN h % 29 = 0 THEN '_' ELSE '' END AS Num_of_Delayed_Payment,
  CASE WHEN h % 31 = 0 THEN '_' ELSE CAST(h % 20 AS VARCHAR) END AS Changed_Credit_Limit,
  CAST(h % 15 AS VARCHAR) AS Num_Credit_Inquiries,
  CASE h % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Good' WHEN 2 THEN 'Bad' ELSE '_' END AS Credit_Mix,
  (h % 5000) || CASE WHEN h % 37 = 0 THEN '_' ELSE '' END AS Outstanding_Debt,
  CAST(20 + h % 45 AS VARCHAR) AS Credit_Utilization_Ratio,
  CASE WHEN h % 83 = 0 THEN 'NA' ELSE (h % 30) || ' Years and ' || (h % 12) || ' Months' END AS Credit_History_Age,
  CASE h % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount,
  CAST(h % 700 AS VARCHAR) AS Total_EMI_per_month,
  CASE WHEN h % 43 = 0 THEN '__10000__' ELSE CAST(h % 1000 AS VARCHAR) END AS Amount_invested_monthly,
  CASE h % 10 WHEN 0 THEN 'High_spent_Large_value_payments' WHEN 1 THEN 'High_spent_Medium_value_payments'
    WHEN 2 THEN 'High_spent_Small_value_payments' WHEN 3 THEN 'Medium_spent_Large_value_payments'
    WHEN 4 THEN 'Medium_spent_Medium_value_payments' WHEN 5 THEN 'Medium_spent_Small_value_payments'
    WHEN 6 THEN 'Low_spent_Large_value_payments' WHEN 7 THEN 'Low_spent_Medium_value_payments'
    WHEN 8 THEN 'Low_spent_Small_value_payments' ELSE '!@9#%8' END AS Payment_Behaviour,
  CAST(h % 1200 AS VARCHAR) AS Monthly_Balance,
  {_months(_START.format(k='k'), 'm')} AS snapshot_date
FROM (SELECT c_custkey AS k, m, c_custkey * 31 + m * 17 AS h FROM customer, range(3) r(m))
"""

_CLICKSTREAM = f"""
SELECT {', '.join(f'CAST((k * {i} * 13 + m * 7) % 200 - 50 AS INTEGER) AS fe_{i}' for i in range(1, 21))},
  'CUS_' || k AS Customer_ID, {_months(_START.format(k='k'), 'm')} AS snapshot_date
FROM (SELECT c_custkey AS k, m FROM customer, range(3) r(m))
"""

_LOANS = f"""
SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
  overdue_amt, balance, snapshot_date, mob, installments_missed, first_missed_date,
  CASE WHEN overdue_amt > 0 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
FROM (SELECT *, CASE WHEN installments_missed > 0
    THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM (SELECT *, coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS INTEGER), 0) AS installments_missed
    FROM (SELECT 'CUS_' || k || '_L' AS loan_id, 'CUS_' || k AS Customer_ID,
        {_START.format(k='k')} AS loan_start_date, 10 AS tenure, CAST(i AS INTEGER) AS installment_num,
        10000.0::DOUBLE AS loan_amt, CASE WHEN i = 0 THEN 0.0::DOUBLE ELSE 1000.0::DOUBLE END AS due_amt,
        CASE WHEN late > 0 OR i = 0 THEN 0.0::DOUBLE ELSE 1000.0::DOUBLE END AS paid_amt,
        CAST(1000 * late AS DOUBLE) AS overdue_amt, CAST(10000 - 1000 * i + 1000 * late AS DOUBLE) AS balance,
        {_months(_START.format(k='k'), 'i')} AS snapshot_date, CAST(i AS INTEGER) AS mob
      FROM (SELECT c_custkey AS k, i, CASE WHEN (c_custkey // 24) % 4 = 0
          THEN greatest(i - (c_custkey // 96) % 6 - 1, 0) ELSE 0 END AS late
        FROM customer, range(11) r(i)))))
"""

_SCORES = f"""
SELECT 'CUS_' || c_custkey AS Customer_ID, {_START.format(k='c_custkey')} AS snapshot_date,
  'prod_model' AS model_name, ((c_custkey * 7919) % 10007) / 10007.0::DOUBLE AS model_predictions
FROM customer
"""

_ACTIVITY = """
SELECT 'CUS_' || o_custkey AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  count(*) AS n_orders, sum(o_totalprice) AS total
FROM orders GROUP BY 1, 2
"""

# --- silver ------------------------------------------------------------------------

_CLEAN_ATTRIBUTES = f"""
SELECT Customer_ID, Name, regexp_replace(Age, '_$', '') AS Age,
  CASE WHEN regexp_matches(SSN, '{codes.SSN_PATTERN}') THEN SSN ELSE 'Unidentified' END AS SSN,
  CASE WHEN Occupation IS NULL OR regexp_matches(Occupation, '[a-zA-Z]') THEN Occupation ELSE 'Missing' END AS Occupation,
  snapshot_date
FROM raw_attributes
"""

_MASK = "CASE WHEN SSN = 'Unidentified' THEN SSN ELSE '*****' || right(SSN, 4) END"
_FLAGGED_ATTRIBUTES = """
SELECT *, TRY_CAST(Age AS INTEGER) AS age_int,
  count(*) OVER (PARTITION BY snapshot_date, Customer_ID) > 1 AS same_id,
  count(*) OVER (PARTITION BY snapshot_date, SSN) > 1 AND SSN <> 'Unidentified' AS same_ssn
FROM clean_attributes
"""


def _missing(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'MISSING:{c}' END"


def _cast_error(c: str, kind: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL THEN 'TYPE_CAST_ERROR:{c}:' || {c} END"


_ATTRIBUTE_RULES = [
    *[_missing(c) for c in schemas.ATTRIBUTES.fieldNames()],
    _cast_error("Age", "INTEGER"),
    "CASE WHEN same_id THEN 'DUPLICATE_CUSTOMER_ID:' || Customer_ID END",
    f"CASE WHEN same_ssn THEN 'DUPLICATE_SSN:' || ({_MASK}) END",
    "CASE WHEN age_int < 0 THEN 'NEGATIVE_VALUE:Age' END",
    "CASE WHEN age_int >= 0 AND (age_int < 18 OR age_int > 150) THEN 'AGE_OUT_OF_RANGE:' || age_int END",
]
_VALID_ATTRIBUTES = f"""
SELECT Customer_ID, Name, age_int AS Age, {_MASK} AS SSN, Occupation, snapshot_date,
  {_list(_ATTRIBUTE_RULES)} AS errors
FROM flagged_attributes
"""
_SILVER_ATTRIBUTES = f"""
SELECT Customer_ID, Age, Occupation, snapshot_date,
  {_bin('Age', codes.AGE_CEILINGS)} AS Age_Group
FROM valid_attributes WHERE len(errors) = 0
"""

_KIND = {"int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR"}
_FIN_KINDS = {f.name: _KIND[f.dataType.simpleString()] for f in schemas.FINANCIALS.fields}


def _clean_financial(c: str) -> str:
    if c == "Num_of_Loan":
        return f"""CASE WHEN TRY_CAST({_STRIP.format(c=c)} AS INTEGER) <> n_listed
          THEN CAST(n_listed AS VARCHAR) ELSE {_STRIP.format(c=c)} END AS {c}"""
    if c in schemas.UNDERSCORED_FINANCIALS:
        return f"{_STRIP.format(c=c)} AS {c}"
    if c == "Credit_Mix":
        return "CASE WHEN Credit_Mix = '_' THEN 'NM' ELSE Credit_Mix END AS Credit_Mix"
    if c == "Changed_Credit_Limit":
        return f"CASE WHEN {c} = '_' THEN '0.0' ELSE {c} END AS {c}"
    if c == "Payment_Behaviour":
        return f"CASE WHEN regexp_matches(trim({c}), '{codes.PAYMENT_BEHAVIOUR_PATTERN}') THEN trim({c}) ELSE 'NM' END AS {c}"
    return c


_CLEAN_FINANCIALS = f"""
SELECT {', '.join(_clean_financial(c) for c in _FIN_KINDS)}
FROM (SELECT *, CASE WHEN Type_of_Loan IS NULL THEN 0
  ELSE len(regexp_split_to_array(Type_of_Loan, '{_SEP}')) END AS n_listed FROM raw_financials)
"""
_TYPED_FINANCIALS = f"""
SELECT {', '.join(c if k in ('VARCHAR', 'DATE') else f'TRY_CAST({c} AS {k}) AS {c}' for c, k in _FIN_KINDS.items())}
FROM clean_financials
"""
_FIN_RULES = [
    *[_missing(c) for c in _FIN_KINDS if c != "Type_of_Loan"],
    *[_cast_error(c, k) for c, k in _FIN_KINDS.items() if k in ("INTEGER", "DOUBLE")],
    "CASE WHEN same_id THEN 'DUPLICATE_CUSTOMER_ID:' || Customer_ID END",
    *[
        f"CASE WHEN TRY_CAST({c} AS DOUBLE) < 0 THEN 'NEGATIVE:{c}' END"
        for c in schemas.FINANCIALS_NON_NEGATIVE
    ],
]
_VALID_FINANCIALS = f"""
SELECT {', '.join(c if k in ('VARCHAR', 'DATE') else f'TRY_CAST({c} AS {k}) AS {c}' for c, k in _FIN_KINDS.items())},
  {_list(_FIN_RULES)} AS errors
FROM (SELECT *, count(*) OVER (PARTITION BY snapshot_date, Customer_ID) > 1 AS same_id FROM clean_financials)
"""


def _history_part(unit: str) -> str:
    text = rf"regexp_extract(Credit_History_Age, '(\d+)\s+{unit}', 1)"
    return f"CASE WHEN {text} = '' THEN 0 ELSE TRY_CAST({text} AS INTEGER) END"


_DURATION = f"({_history_part('Years')}) * 12 + ({_history_part('Months')})"


def _enrich(source: str) -> str:
    return f"""
SELECT f.* REPLACE (Credit_Utilization_Ratio / 100.0::DOUBLE AS Credit_Utilization_Ratio),
  pb.id AS Payment_Behavior_ID, pm.id AS Payment_of_Min_Amount_ID, cm.id AS Credit_Mix_ID,
  {_DURATION} AS Credit_History_Months,
  {_bin('Annual_Income', codes.INCOME_CEILINGS)} AS Annual_Income_Group,
  CASE WHEN Monthly_Inhand_Salary > 0 THEN Total_EMI_per_month / Monthly_Inhand_Salary END AS dti,
  Monthly_Balance / nullif(Monthly_Inhand_Salary, 0) AS savings_rate
FROM {source} f
LEFT JOIN (SELECT id::BIGINT AS id, label FROM (VALUES {_values(codes.PAYMENT_BEHAVIOUR)}) t(id, label)) pb
  ON lower(f.Payment_Behaviour) = lower(pb.label)
LEFT JOIN (SELECT id::BIGINT AS id, label FROM (VALUES {_values(codes.PAYMENT_OF_MIN_AMOUNT)}) t(id, label)) pm
  ON f.Payment_of_Min_Amount = pm.label
LEFT JOIN (SELECT id::BIGINT AS id, label FROM (VALUES {_values(codes.CREDIT_MIX)}) t(id, label)) cm
  ON f.Credit_Mix = cm.label
"""


_CLEAN_VALID_FINANCIALS = "SELECT * EXCLUDE (errors) FROM valid_financials WHERE len(errors) = 0"

# --- gold ----------------------------------------------------------------------------

_CRS = """CASE WHEN dti > 0.4 THEN 3 ELSE 0 END + CASE WHEN Credit_Utilization_Ratio > 0.5 THEN 2 ELSE 0 END
  + CASE WHEN Credit_Mix_ID IN (3, 99) THEN 2 ELSE 0 END + CASE WHEN Credit_History_Months < 24 THEN 1 ELSE 0 END
  + CASE WHEN Changed_Credit_Limit > 15 THEN 1 ELSE 0 END + CASE WHEN Num_Credit_Inquiries > 10 THEN 1 ELSE 0 END"""


def _scored_financials(source: str) -> str:
    return f"""
SELECT *, {_CRS} AS crs, '1.0' AS crs_version,
  CASE WHEN Outstanding_Debt * Delay_from_due_date >= 0
    THEN ln(1 + Outstanding_Debt * Delay_from_due_date) END AS delinquency_score_log
FROM {source}
"""


def _rolling(source: str, value: str, target: str) -> str:
    return f"""
SELECT r.Customer_ID, r.snapshot_date, CASE WHEN g.present = 3 THEN r.value END AS {target}
FROM (SELECT Customer_ID, snapshot_date, avg({value}) OVER (PARTITION BY Customer_ID
    ORDER BY year(snapshot_date) * 12 + month(snapshot_date) RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS value
  FROM {source}) r
JOIN (SELECT a.snapshot_date, count(DISTINCT b.snapshot_date) AS present
  FROM (SELECT DISTINCT snapshot_date FROM {source}) a JOIN (SELECT DISTINCT snapshot_date FROM {source}) b
    ON b.snapshot_date BETWEEN CAST(a.snapshot_date - to_months(2) AS DATE) AND a.snapshot_date
  GROUP BY 1) g ON r.snapshot_date = g.snapshot_date
"""


_GOLD_FINANCIALS = """
SELECT s.Customer_ID, s.snapshot_date, s.Annual_Income_Group, s.delinquency_score_log, s.crs, s.dti,
  s.Payment_Behavior_ID, s.Payment_of_Min_Amount_ID, r.savings_rate_avg_3m
FROM scored_financials s LEFT JOIN rolled_savings r USING (Customer_ID, snapshot_date)
"""
_FE = ", ".join(f"fe_{i}" for i in range(1, 21))
_STORE = f"""
SELECT Customer_ID, snapshot_date, Age_Group, Annual_Income_Group, delinquency_score_log, crs, dti,
  Payment_Behavior_ID, Payment_of_Min_Amount_ID, savings_rate_avg_3m, {_FE}, mob, dpd
FROM (SELECT Customer_ID, Age_Group, snapshot_date FROM silver_attributes)
FULL JOIN gold_financials USING (Customer_ID, snapshot_date)
FULL JOIN clickstream USING (Customer_ID, snapshot_date)
FULL JOIN (SELECT Customer_ID, mob, dpd, snapshot_date FROM loans) USING (Customer_ID, snapshot_date)
"""
_PRIMARY = """
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def,
  '1.0' AS rule_version, snapshot_date
FROM loans WHERE mob = 6
"""
_SURROGATE = """
SELECT Customer_ID, CASE WHEN delinquency_score_log >= 10 THEN 1 ELSE 0 END AS label,
  '10dsl_0mob' AS label_def, snapshot_date
FROM store WHERE mob = 0
"""
_TRAINING = f"""
SELECT f.Customer_ID, f.snapshot_date, {_months('f.snapshot_date', '6')} AS label_snapshot_date,
  {', '.join(f'f.{c}' for c in codes.DEFAULT_FEATURES)}, p.label, s.label AS delinquency_flag,
  CASE WHEN p.label IS NULL THEN 1 ELSE 0 END AS label_missing,
  CASE WHEN s.label IS NULL THEN 1 ELSE 0 END AS delinquency_missing
FROM store f
LEFT JOIN primary_label p ON p.Customer_ID = f.Customer_ID
  AND p.snapshot_date = {_months('f.snapshot_date', '6')}
LEFT JOIN surrogate_label s ON s.Customer_ID = f.Customer_ID AND s.snapshot_date = f.snapshot_date
WHERE f.mob = 0 AND coalesce({', '.join(f'CAST(f.{c} AS DOUBLE)' for c in codes.DEFAULT_FEATURES)}) IS NOT NULL
"""
_SPLIT = """
SELECT * EXCLUDE (part, place, n_label), CASE WHEN part = 'oot' THEN 'oot'
  WHEN place <= ceil(round(0.2 * n_label, 9)) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label, part ORDER BY h) AS place,
    count(*) OVER (PARTITION BY label, part) AS n_label
  FROM (SELECT *, CASE WHEN snapshot_date BETWEEN DATE '2024-01-01' AND DATE '2024-02-29' THEN 'oot'
      WHEN snapshot_date BETWEEN DATE '2023-01-01' AND DATE '2023-12-31' THEN 'fit' END AS part,
      substr(md5('88|' || Customer_ID || '|' || CAST(snapshot_date AS VARCHAR)), 1, 13) AS h
    FROM training WHERE label IS NOT NULL)
  WHERE part IS NOT NULL)
"""

# --- monitoring -------------------------------------------------------------------------

_MONTHLY_SCORES = f"""
SELECT 'CUS_' || k AS Customer_ID, {_months(_START.format(k='k'), 'm')} AS snapshot_date, 'prod_model' AS model_name,
  ((k * 7919 + m * 613) % 10007) / 10007.0::DOUBLE AS model_predictions
FROM (SELECT c_custkey AS k, m FROM customer, range(3) r(m))
"""
_OUTCOMES = f"""
SELECT * FROM (
  SELECT 'CUS_' || k || '_L' || j AS loan_id, 'CUS_' || k AS Customer_ID,
    {_months(_START.format(k='k'), 'm + 6')} AS snapshot_date,
    CASE WHEN (k * 31 + m * 17 + j * 7) % 5 = 0 THEN 1 ELSE 0 END AS label
  FROM (SELECT c_custkey AS k, m, j FROM customer, range(3) r(m), range(3) s(j) WHERE j <= c_custkey % 3)
  WHERE (k + m) % 4 <> 0)
WHERE snapshot_date < DATE '2025-06-01'
"""
_SCORED = """
SELECT s.*, o.snapshot_date AS label_date, o.label
FROM monthly_scores s JOIN outcomes o
  ON o.Customer_ID = s.Customer_ID AND o.snapshot_date = s.snapshot_date + INTERVAL 6 MONTH
"""


def _auc(source: str, by: str, score: str, label: str) -> str:
    return f"""
SELECT {by}, n_pos, n_neg, CASE WHEN n_pos > 0 AND n_neg > 0
    THEN pairs / (CAST(n_pos AS DOUBLE) * n_neg) END AS auc
FROM (SELECT {by}, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
    sum(pos * (below + neg / 2.0::DOUBLE)) AS pairs
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY score
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT {by}, {score} AS score, count(*) FILTER ({label} = 1) AS pos,
      count(*) FILTER ({label} = 0) AS neg FROM {source} GROUP BY {by}, {score}))
  GROUP BY {by})
"""


_CLASSIFICATION = """
SELECT model_name, snapshot_date, count(*) AS n_rows, count(*) FILTER (label = 1) AS n_pos,
  count(*) - count(*) FILTER (label = 1) AS n_neg,
  count(*) FILTER (label = 1) / CAST(count(*) AS DOUBLE) AS prevalence,
  avg(CASE WHEN (model_predictions >= 0.5) = (label = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
  avg(-(label * ln(p) + (1 - label) * ln(1 - p))) AS logloss
FROM (SELECT *, least(greatest(model_predictions, 1e-7), 1 - 1e-7) AS p FROM scored)
GROUP BY model_name, snapshot_date
"""
_PERFORMANCE = f"""
SELECT s.model_name, s.snapshot_date, strftime(s.snapshot_date + to_months(5), '%Y-%m') AS period_month,
  'PROD' AS period_tag, a.auc, c.logloss, c.accuracy, 2 * a.auc - 1 AS gini, coalesce(c.n_rows, s.n) AS n_rows, c.n_pos, c.n_neg
FROM (SELECT model_name, snapshot_date, count(*) AS n FROM monthly_scores GROUP BY 1, 2) s
LEFT JOIN classification c ON c.model_name = s.model_name AND c.snapshot_date = s.snapshot_date
LEFT JOIN score_auc a ON a.snapshot_date = s.snapshot_date
"""

_STEPS = ", ".join(f"{i * (1.0 / 10)!r}::DOUBLE" for i in range(10)) + ", 1.0::DOUBLE"
_SCORE_ROWS = "SELECT 'model_predictions' AS feature, model_predictions AS value, snapshot_date FROM scores"
_CLICK_ROWS = " UNION ALL ".join(
    f"SELECT 'fe_{i}' AS feature, CAST(fe_{i} AS DOUBLE) AS value, snapshot_date FROM clickstream"
    for i in range(1, 6)
)
_LINE_ROWS = " UNION ALL ".join(
    f"""SELECT '{name}' AS feature, CAST({expr} AS DOUBLE) AS value,
      CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date FROM lineitem"""
    for name, expr in (
        ("l_quantity", "l_quantity"),
        ("l_extendedprice", "l_extendedprice"),
        ("l_discount", "l_discount"),
        ("l_tax", "l_tax"),
        ("high_tax", "CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END"),
    )
)


def _drift_ctes(prefix: str, rows: str, months: str, kind: str, model: str) -> dict[str, str]:
    """CTEs for edges, shares and stability of long rows; `months` lists the reference."""
    low = "q[1]"
    high = "q[11]"
    pad = f"(CASE WHEN {low} = {high} THEN 1e-9::DOUBLE ELSE 0 END)"
    start, stop = f"({low} - {pad})", f"({high} + {pad})"
    even = ", ".join(f"{start} + {i} * (({stop} - {start}) / 10)" for i in range(10))
    return {
        f"{prefix}_rows": rows,
        f"{prefix}_reference": f"SELECT feature, value FROM {prefix}_rows WHERE snapshot_date IN ({months})",
        f"{prefix}_edges": f"""
SELECT feature, CASE WHEN len(list_distinct(q)) < 3 THEN [{even}, {stop}]
  ELSE list_sort(list_distinct(q)) END AS edges
FROM (SELECT feature, quantile_cont(value, [{_STEPS}]) AS q FROM {prefix}_reference GROUP BY feature)
""",
        f"{prefix}_binned": f"""
SELECT r.feature, r.snapshot_date, len([e FOR e IN edges IF e <= value]) - 1 AS bin, len(edges) - 1 AS n_bins
FROM {prefix}_rows r JOIN {prefix}_edges USING (feature)
""",
        f"{prefix}_grid": f"""
SELECT g.feature, g.snapshot_date, g.n, b.bin, g.inside, coalesce(c.n, 0) AS hits
FROM (SELECT feature, snapshot_date, count(*) AS n,
    count(*) FILTER (bin BETWEEN 0 AND n_bins - 1) AS inside
  FROM {prefix}_binned GROUP BY 1, 2) g
JOIN (SELECT feature, unnest(range(len(edges) - 1)) AS bin FROM {prefix}_edges) b USING (feature)
LEFT JOIN (SELECT feature, snapshot_date, bin, count(*) AS n FROM {prefix}_binned GROUP BY 1, 2, 3) c
  ON c.feature = g.feature AND c.snapshot_date = g.snapshot_date AND c.bin = b.bin
""",
        f"{prefix}_shares": f"""
SELECT feature, snapshot_date, n, bin,
  CASE WHEN inside > 0 THEN hits / CAST(inside AS DOUBLE) ELSE 0 END AS proportion
FROM {prefix}_grid
""",
        f"{prefix}_base": f"""
SELECT feature, bin, sum(hits) / nullif(CAST(sum(inside) AS DOUBLE), 0) AS proportion
FROM {prefix}_grid WHERE snapshot_date IN ({months}) GROUP BY 1, 2
""",
        f"{prefix}_drift": f"""
SELECT '{model}' AS model_name, '{kind}' AS type, snapshot_date,
  strftime(snapshot_date - to_months(1), '%Y-%m') AS period_month, feature,
  sum((p - q) * ln(p / q)) AS psi, max(n) AS n
FROM (SELECT s.feature, s.snapshot_date, s.n, least(greatest(s.proportion, 1e-10), 1.0) AS p,
    least(greatest(coalesce(b.proportion, 0), 1e-10), 1.0) AS q
  FROM {prefix}_shares s JOIN {prefix}_base b ON b.feature = s.feature AND b.bin = s.bin)
GROUP BY feature, snapshot_date
""",
    }


_REF = "DATE '2023-01-01', DATE '2023-02-01'"
_CTES: dict[str, str] = {
    "raw_attributes": _RAW_ATTRIBUTES,
    "raw_financials": _RAW_FINANCIALS,
    "clickstream": _CLICKSTREAM,
    "loans": _LOANS,
    "scores": _SCORES,
    "activity": _ACTIVITY,
    "clean_attributes": _CLEAN_ATTRIBUTES,
    "flagged_attributes": _FLAGGED_ATTRIBUTES,
    "valid_attributes": _VALID_ATTRIBUTES,
    "silver_attributes": _SILVER_ATTRIBUTES,
    "clean_financials": _CLEAN_FINANCIALS,
    "typed_financials": _TYPED_FINANCIALS,
    "valid_financials": _VALID_FINANCIALS,
    "good_financials": _CLEAN_VALID_FINANCIALS,
    "silver_financials": _enrich("good_financials"),
    "enriched_typed": _enrich("typed_financials"),
    "scored_financials": _scored_financials("silver_financials"),
    "rolled_savings": _rolling("silver_financials", "savings_rate", "savings_rate_avg_3m"),
    "gold_financials": _GOLD_FINANCIALS,
    "store": _STORE,
    "primary_label": _PRIMARY,
    "surrogate_label": _SURROGATE,
    "training": _TRAINING,
    "split_rows": _SPLIT,
    "monthly_scores": _MONTHLY_SCORES,
    "outcomes": _OUTCOMES,
    "scored": _SCORED,
    "classification": _CLASSIFICATION,
    "score_auc": _auc("scored", "snapshot_date", "model_predictions", "label"),
    "performance": _PERFORMANCE,
    **_drift_ctes("score", _SCORE_ROWS, _REF, "PSI", "prod_model"),
    **_drift_ctes("click", _CLICK_ROWS, _REF, "CSI", "prod_model"),
    **_drift_ctes("line", _LINE_ROWS, "DATE '1996-01-01', DATE '1996-02-01'", "CSI", "lines"),
    "stability": "SELECT * FROM score_drift UNION ALL SELECT * FROM click_drift",
}


def _needed(text: str) -> list[str]:
    """Building blocks a statement refers to, in definition order."""
    import re

    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & _CTES.keys()) - found:
            found.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in found]


def _sql(body: str) -> str:
    blocks = [f"{name} AS ({_CTES[name].strip()})" for name in _needed(body)]
    return (f"WITH {', '.join(blocks)} " if blocks else "") + body.strip()


_MONTH_OF = "CAST(date_trunc('month', {c}) AS DATE)"
_LOAN_COUNTS = ", ".join(
    f"""CASE WHEN parts IS NULL THEN 0 ELSE CAST(len([p FOR p IN parts IF p = '{name}']) AS INTEGER) END
      AS "{name.replace(' ', '_')}\""""
    for name in codes.LOAN_TYPE.values()
)
_PARTS = f"regexp_split_to_array(Type_of_Loan, '{_SEP}')"


def _profile_union(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


_GOLD_ROUNDED = "delinquency_score_log", "dti", "savings_rate_avg_3m"
_CAPPED = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt"]
_CORRELATED = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Outstanding_Debt",
    "Monthly_Balance",
]


def _cap(source: str, keep: str) -> str:
    caps = ", ".join(f"quantile_disc({c}, 0.95) AS cap_{c}" for c in _CAPPED)
    capped = ", ".join(f"CASE WHEN {c} > cap_{c} THEN cap_{c} ELSE {c} END AS {c}" for c in _CAPPED)
    return f"SELECT {keep}, {capped} FROM {source}, (SELECT {caps} FROM {source})"


def _histogram(source: str, column: str, high: str) -> str:
    return f"""
SELECT '{column}' AS column_name, bin, round(low + bin * (high - low) / 20, 6) AS bin_start, count(*) AS n
FROM (SELECT low, high, CAST(least(coalesce(floor((v - low) / nullif((high - low) / 20, 0)), 0), 19) AS INTEGER) AS bin
  FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL),
    (SELECT min({column}) AS low, {high} AS high FROM {source})
  WHERE v <= high)
GROUP BY bin, low, high
"""


_MOMENTS = """
SELECT '{c}' AS column_name, count(*) AS total, count(*) FILTER (raw IS NULL) AS missing,
  count(*) FILTER (raw IS NOT NULL AND v IS NULL) AS non_numeric, count(*) FILTER (v < 0) AS negative,
  round(min(v), 6) AS min_value, round(max(v), 6) AS max_value,
  round(avg(((v - mu) / sd) ** 3), 6) AS skewness, round(avg(((v - mu) / sd) ** 4) - 3, 6) AS kurtosis
FROM (SELECT {c} AS raw, TRY_CAST({c} AS DOUBLE) AS v FROM raw_financials),
  (SELECT avg(TRY_CAST({c} AS DOUBLE)) AS mu, stddev_pop(TRY_CAST({c} AS DOUBLE)) AS sd FROM raw_financials)
"""
_OUTLIERS = """
SELECT '{c}' AS column_name, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
  count(*) FILTER ({c} < lo OR {c} > hi) AS outliers, count(*) AS total,
  round(count(*) FILTER ({c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*), 6) AS outlier_pct
FROM lineitem, (SELECT q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi
  FROM (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM lineitem))
GROUP BY lo, hi
"""
_SCALED = ["fe_1", "fe_2", "fe_3", "fe_4", "fe_5", "Annual_Income_Group"]
_CLOSED = "'No thresholds breached or no label yet.'"


def _digits(c: str) -> str:
    return f"CAST(CAST(round({c}, 3) AS DECIMAL(18, 3)) AS VARCHAR)"


_REASONS = _list(
    [
        f"CASE WHEN auc < 0.62 THEN 'auc ' || {_digits('auc')} || ' < 0.62' END",
        f"CASE WHEN gini < 0.24 THEN 'gini ' || {_digits('gini')} || ' < 0.24' END",
        f"CASE WHEN accuracy < 0.7 THEN 'accuracy ' || {_digits('accuracy')} || ' < 0.7' END",
        f"CASE WHEN logloss > 0.6 THEN 'logloss ' || {_digits('logloss')} || ' > 0.6' END",
        f"CASE WHEN psi >= 0.25 THEN 'PSI ' || {_digits('psi')} || ' ≥ 0.25' END",
        f"CASE WHEN csi >= 0.25 THEN 'max CSI ' || {_digits('csi')} || ' ≥ 0.25' END",
    ]
)

_HASH = "CAST('0x' || substr(md5('{seed}|' || Customer_ID || '|' || CAST(snapshot_date AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"
_MANY_DATES = f"""
    SELECT s.*, c.n_fit, c.cut FROM (
      SELECT train_date, label, count(*) FILTER (part = 'fit' AND place > ceil(round(0.2 * n, 9))) AS n_train,
        count(*) FILTER (part = 'fit' AND place <= ceil(round(0.2 * n, 9))) AS n_test,
        count(*) FILTER (part = 'oot') AS n_oot
      FROM placed GROUP BY 1, 2) s
    LEFT JOIN (SELECT train_date, label, any_value(n) AS n_fit, max(h) FILTER (place <= ceil(round(0.2 * n, 9))) AS cut
      FROM placed WHERE part = 'fit' GROUP BY 1, 2) c ON s.train_date = c.train_date AND s.label = c.label"""
_PLACED = f"""
SELECT train_date, part, label, h, row_number() OVER (PARTITION BY train_date, part, label ORDER BY h) AS place,
  count(*) OVER (PARTITION BY train_date, part, label) AS n
FROM (SELECT *, {_HASH.format(seed=88)} AS h FROM training WHERE label IS NOT NULL)
JOIN (SELECT CAST(DATE '2024-03-01' + to_months(CAST(k AS INTEGER)) AS DATE) AS train_date FROM range(-5, 7) r(k)) ON true
JOIN (VALUES ('fit', -14, -2), ('oot', -2, 0)) w(part, low, high)
  ON snapshot_date >= train_date + to_months(low) AND snapshot_date < train_date + to_months(high)
"""
_DRAWS = ", ".join(
    f"({i}, CAST('{d['C']!r}' AS DOUBLE), '{d['penalty']}', '{d['class_weight']}')"
    for i, d in enumerate(draw_params(LR_SPACE, LR_DRAWS))
)
_LR_ROWS = f"""
SELECT label, CAST(floor({_HASH.format(seed=42)} * 3) AS INTEGER) AS fold, 1.0::DOUBLE AS constant,
  {', '.join(f'(x_{c} - avg(x_{c}) OVER ()) / CASE WHEN stddev_pop(x_{c}) OVER () = 0 THEN 1 ELSE stddev_pop(x_{c}) OVER () END AS {c}' for c in codes.DEFAULT_FEATURES)}
FROM (SELECT *, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0) AS x_{c}' for c in codes.DEFAULT_FEATURES)}
  FROM split_rows WHERE split = 'train')
"""
_LR_SUMS = f"""
SELECT k AS fold, count(*) / (2.0::DOUBLE * sum(label)) AS balanced,
  {', '.join(f'sum({c}) FILTER (label = 1) AS {c}' for c in [*codes.DEFAULT_FEATURES, 'constant'])}
FROM lr_rows JOIN (SELECT CAST(k AS INTEGER) AS k FROM range(3) r(k)) ON fold <> k GROUP BY 1
"""
_CTES |= {"placed": _PLACED, "lr_rows": _LR_ROWS, "lr_sums": _LR_SUMS}
_TRAIN_LR = " UNION ALL ".join(
    f"""SELECT CAST(draw AS INTEGER) AS draw, fold, C, penalty, class_weight, '{c}' AS feature,
      round({c} * CASE WHEN class_weight = 'balanced' THEN balanced ELSE 1 END, 3) + 0.0::DOUBLE AS moment
    FROM lr_sums, (VALUES {_DRAWS}) d(draw, C, penalty, class_weight)"""
    for c in [*codes.DEFAULT_FEATURES, "constant"]
)

_CTES |= {
    "zero_rows": """SELECT Customer_ID, snapshot_date, CAST(Age_Group AS DOUBLE) AS a, CAST(crs AS DOUBLE) AS b,
      CAST(dti AS DOUBLE) AS c, CAST(fe_1 AS DOUBLE) AS d FROM store WHERE mob = 0""",
    "zero_moments": "SELECT snapshot_date AS month, " + ", ".join(
        f"avg({c}) AS m{c}, nullif(stddev_pop({c}), 0) AS s{c}" for c in "abcd") + " FROM zero_rows GROUP BY 1",
    "zero_models": """SELECT CAST(v.day AS DATE) AS snapshot_date, CAST(v.month AS DATE) AS month
      FROM (VALUES ('2024-01-01', '2023-12-01'), ('2024-02-01', '2023-12-01'), ('2024-03-01', '2024-02-01')) v(day, month)""",
}

# First trees of the boosted search: p is 1/2 for every row, so G = n / 2 - positives and H = n / 4.
_GBT = draw_params(GBT_SPACE, GBT_DRAWS)
_FEATURES = list(enumerate(codes.DEFAULT_FEATURES))
_GBT_CTES = {
    "gbt_draws": f"""SELECT CAST(draw AS INTEGER) AS draw, depth, CAST(eta AS DOUBLE) AS eta, CAST(share AS DOUBLE) AS share,
      CAST(gamma AS DOUBLE) AS gamma, child, CAST(alpha AS DOUBLE) AS alpha, CAST(ridge AS DOUBLE) AS ridge, CAST(turn AS DOUBLE) AS turn
    FROM (VALUES {', '.join(
        f"({i}, {d['max_depth']}, {d['learning_rate']}, {d['subsample']}, {d['gamma']}, {d['min_child_weight']}, {d['reg_alpha']}, {d['reg_lambda']}, {Problem(d, 0, i).turn(0)!r})"
        for i, d in enumerate(_GBT))}) v(draw, depth, eta, share, gamma, child, alpha, ridge, turn)""",
    "gbt_columns": f"""SELECT * FROM (VALUES {', '.join(
        f"({i}, {j})" for i, d in enumerate(_GBT) for j in Problem(d, 0, i).columns(0, len(_FEATURES)))}) v(draw, f)""",
    "gbt_rows": f"""SELECT row_number() OVER () AS id, label, CAST(floor({_HASH.format(seed=42)} * 3) AS INTEGER) AS fold,
      {_HASH.format(seed=43)} AS h, {', '.join(f'CAST({c} AS DOUBLE) AS x{j}' for j, c in _FEATURES)}
    FROM split_rows WHERE split = 'train'""",
    "gbt_values": " UNION ALL ".join(f"SELECT id, {j} AS f, x{j} AS x FROM gbt_rows" for j, _ in _FEATURES),
    "gbt_cuts": """SELECT f, list_sort(list_distinct([v[CAST(greatest(ceil(round((i + 1) / 32.0::DOUBLE * len(v), 9)), 1) AS INTEGER)]
        FOR i IN range(31)])) AS cuts
      FROM (SELECT f, list(x ORDER BY x) AS v FROM gbt_values WHERE x IS NOT NULL GROUP BY f)""",
    "gbt_bins": """SELECT id, v.f, CASE WHEN x IS NULL THEN 32 ELSE len([c FOR c IN coalesce(cuts, []) IF c <= x]) END AS b
      FROM gbt_values v LEFT JOIN gbt_cuts c ON v.f = c.f""",
    "gbt_at0": """SELECT draw, CAST(k AS INTEGER) AS k, id, label, 0 AS node FROM gbt_draws, gbt_rows, (VALUES (0), (1), (2), (-1)) ks(k)
      WHERE fold <> k AND h + turn - floor(h + turn) < share""",
}


def _soft(g: str) -> str:
    return f"(sign({g}) * greatest(abs({g}) - alpha, 0))"


def _worth(g: str, h: str) -> str:
    return f"({_soft(g)} * {_soft(g)} / ({h} + ridge))"


for _level in range(3):
    _GBT_CTES |= {
        f"gbt_whole{_level}": f"""SELECT draw, k, node, count(*) / 2.0::DOUBLE - sum(label) AS g, count(*) / 4.0::DOUBLE AS h
          FROM gbt_at{_level} GROUP BY ALL""",
        f"gbt_hist{_level}": f"""SELECT a.draw, k, node, b.f, b, count(*) / 2.0::DOUBLE - sum(label) AS g, count(*) / 4.0::DOUBLE AS h
          FROM gbt_at{_level} a JOIN gbt_columns c ON a.draw = c.draw JOIN gbt_bins b ON b.id = a.id AND b.f = c.f GROUP BY ALL""",
        # left sums at every cut, missing values right (0) and left (1)
        f"gbt_left{_level}": f"""SELECT draw, k, node, f, cut, side,
            coalesce(sum(g) FILTER (b < cut OR (b = 32 AND side = 1)), 0) AS gl,
            coalesce(sum(h) FILTER (b < cut OR (b = 32 AND side = 1)), 0) AS hl
          FROM gbt_hist{_level}, range(1, 33) c(cut), (VALUES (0), (1)) s(side) GROUP BY ALL""",
        f"gbt_best{_level}": f"""SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY draw, k, node ORDER BY gain DESC, f, cut, side) AS nth FROM (
            SELECT l.*, w.g, w.h, d.*, {_worth('gl', 'hl')} + {_worth('(g - gl)', '(h - hl)')} - {_worth('g', 'h')} AS gain
            FROM gbt_left{_level} l JOIN gbt_whole{_level} w ON l.draw = w.draw AND l.k = w.k AND l.node = w.node
            JOIN gbt_draws d ON d.draw = l.draw WHERE hl >= child AND h - hl >= child AND depth > {_level}))
          WHERE nth = 1 AND gain > 1e-6 AND gain >= gamma""",
        f"gbt_at{_level + 1}": f"""SELECT a.draw, a.k, a.id, label,
            2 * a.node + CASE WHEN b = 32 THEN 2 - side WHEN b < cut THEN 1 ELSE 2 END AS node
          FROM gbt_at{_level} a JOIN gbt_best{_level} s ON a.draw = s.draw AND a.k = s.k AND a.node = s.node
          JOIN gbt_bins b ON b.id = a.id AND b.f = s.f""",
    }
_GBT_CTES["gbt_whole3"] = _GBT_CTES["gbt_whole2"].replace("gbt_at2", "gbt_at3")
_CTES |= _GBT_CTES
_FIRST_TREES = " UNION ALL ".join(
    f"""SELECT w.draw, w.k AS fold, CAST(w.node AS INTEGER) AS node, {feature} AS feature,
      {cut} AS cut, {gain} AS gain, round(-{_soft('w.g').replace('alpha', 'd.alpha')} / (w.h + d.ridge) * d.eta, 6) AS value
    FROM gbt_whole{level} w JOIN gbt_draws d ON d.draw = w.draw {join}"""
    for level in range(4)
    for feature, cut, gain, join in [
        (
            f"[{', '.join(repr(c) for c in codes.DEFAULT_FEATURES)}][s.f + 1]", "round(CAST(cuts[s.cut] AS DOUBLE), 6)",
            "round(s.gain, 6)",
            f"LEFT JOIN gbt_best{level} s ON s.draw = w.draw AND s.k = w.k AND s.node = w.node LEFT JOIN gbt_cuts c ON c.f = s.f",
        ) if level < 3 else ("NULL", "NULL", "NULL", "")
    ]
)

_BODIES: dict[str, str] = {
    "score_deployed": """
    SELECT Customer_ID, z.snapshot_date, 'model_lr_' || strftime(p.month, '%Y_%m_%d') AS model_name,
      round(1 / (1 + exp(-(coalesce(coalesce(a, 0) / sa, 0) + coalesce(coalesce(b, 0) / sb, 0) + coalesce(coalesce(c, 0) / sc, 0)
        + coalesce(coalesce(d, 0) / sd, 0) - coalesce(ma / sa, 0) - coalesce(mb / sb, 0) - coalesce(mc / sc, 0) - coalesce(md / sd, 0)))), 6)
        AS model_predictions
    FROM zero_rows z JOIN zero_models p ON z.snapshot_date = p.snapshot_date JOIN zero_moments m ON m.month = p.month
    WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL OR d IS NOT NULL""",
    "train_gbt_first_trees": _FIRST_TREES,
    "split_many_dates": _MANY_DATES,
    "train_lr": _TRAIN_LR,
    "scan_project": "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem",
    "snapshot_filter": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-04-01'""",
    "scan_timestamp_range": """SELECT event_id, user_id FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'""",
    "scan_snapshot_range": """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS snapshot_date FROM orders
        WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""",
    "snapshot_range": " UNION ALL ".join(
        f"SELECT '{t}' AS source, CAST(min({c}) AS DATE) AS min_date, CAST(max({c}) AS DATE) AS max_date FROM {t}"
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ),
    "month_spine": """SELECT CAST(unnest(generate_series(date_trunc('month', low), high, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date
        FROM (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders)""",
    "snapshot_union": " UNION ".join(
        f"SELECT {_MONTH_OF.format(c=c)} AS snapshot_date FROM {t}"
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ),
    "history_complete_guard": """
        SELECT a.snapshot_date, CAST(count(DISTINCT b.snapshot_date) AS INTEGER) AS months_present,
          count(DISTINCT b.snapshot_date) = 3 AS is_complete
        FROM (SELECT DISTINCT snapshot_date FROM activity) a JOIN (SELECT DISTINCT snapshot_date FROM activity) b
          ON b.snapshot_date BETWEEN CAST(a.snapshot_date - to_months(2) AS DATE) AND a.snapshot_date
        GROUP BY 1""",
    "snapshot_completeness": """
        SELECT Customer_ID, CAST(past AS INTEGER) AS months_complete, past = 3 AS is_ready,
          recent = 2 AS is_recent_ready, has_current, past = 3 AS can_train, recent = 2 AS can_retrain,
          false AS can_infer, true AS can_monitor
        FROM (SELECT Customer_ID, count(*) FILTER (sets = 2 AND m < DATE '2024-01-01') AS past,
            count(*) FILTER (sets = 2 AND m >= DATE '2023-11-01' AND m < DATE '2024-01-01') AS recent,
            coalesce(bool_or(m = DATE '2024-01-01' AND f), false) AS has_current
          FROM (SELECT Customer_ID, m, count(DISTINCT src) AS sets, bool_or(src = 'f') AS f
            FROM (SELECT Customer_ID, snapshot_date AS m, 'f' AS src FROM clickstream
              UNION ALL SELECT Customer_ID, snapshot_date, 'l' FROM loans)
            WHERE m >= DATE '2023-10-01' AND m < DATE '2024-02-01' GROUP BY 1, 2)
          GROUP BY 1)""",
    "dataset_readiness": """
        SELECT CAST(past AS INTEGER) AS months_complete, past = 14 AS is_ready, recent = 2 AS is_recent_ready,
          has_current, past = 14 AS can_train, false AS can_retrain, has_current AS can_infer, true AS can_monitor
        FROM (SELECT count(*) FILTER (sets = 2 AND m < DATE '2024-03-01') AS past,
            count(*) FILTER (sets = 2 AND m >= DATE '2024-01-01' AND m < DATE '2024-03-01') AS recent,
            coalesce(bool_or(m = DATE '2024-03-01' AND f), false) AS has_current
          FROM (SELECT m, count(DISTINCT src) AS sets, bool_or(src = 'f') AS f
            FROM (SELECT snapshot_date AS m, 'f' AS src FROM clickstream
              UNION ALL SELECT CAST(snapshot_date - to_months(6) AS DATE), 'l' FROM primary_label)
            WHERE m >= DATE '2023-01-01' AND m < DATE '2024-04-01' GROUP BY 1))""",
    "period_month": """
        SELECT snapshot_date, strftime(snapshot_date - to_months(1), '%Y-%m') AS period_month,
          strftime(snapshot_date + to_months(5), '%Y-%m') AS performance_period,
          CAST(snapshot_date - to_months(2) AS DATE) AS reference_month_1,
          CAST(snapshot_date - to_months(1) AS DATE) AS reference_month_2
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)""",
    "cast_enforce": "SELECT Customer_ID, Name, SSN, TRY_CAST(Age AS INTEGER) AS Age, snapshot_date FROM raw_attributes",
    "clickstream_typing": f"SELECT {_FE}, Customer_ID, snapshot_date FROM clickstream",
    "clean_underscore": f"""SELECT Customer_ID, snapshot_date,
        {', '.join(f'{_STRIP.format(c=c)} AS {c}' for c in schemas.UNDERSCORED_FINANCIALS)} FROM raw_financials""",
    "clean_regex_default": "SELECT Customer_ID, Name, SSN, Occupation, Age FROM clean_attributes",
    "clean_financial_defaults": """SELECT Customer_ID, snapshot_date, Credit_Mix, Changed_Credit_Limit,
        Payment_Behaviour FROM clean_financials""",
    "mask_ssn": f"SELECT Customer_ID, Name, {_MASK} AS SSN FROM clean_attributes",
    "split_list_count": f"""SELECT Customer_ID, snapshot_date, array_to_string({_PARTS}, '|') AS parts,
        CAST(CASE WHEN Type_of_Loan IS NULL THEN 0 ELSE len({_PARTS}) END AS INTEGER) AS n_parts FROM raw_financials""",
    "reconcile_count": """SELECT r.Customer_ID, r.snapshot_date, r.Num_of_Loan AS stated, c.Num_of_Loan
        FROM raw_financials r JOIN clean_financials c USING (Customer_ID, snapshot_date)""",
    "parse_duration_months": f"""SELECT Customer_ID, snapshot_date, Credit_History_Age,
        {_DURATION} AS Credit_History_Months FROM raw_financials""",
    "ratio_features": f"""SELECT Customer_ID, snapshot_date,
        {_round('dti', 'savings_rate', 'Credit_Utilization_Ratio')} FROM enriched_typed""",
    "duplicate_flag_window": """SELECT Customer_ID, Name, SSN, snapshot_date, same_id AS duplicate_id,
        same_ssn AS duplicate_ssn FROM flagged_attributes""",
    "quarantine_split": """SELECT Customer_ID, Name, Age, SSN, array_to_string(errors, '|') AS error_text,
        len(errors) > 0 AS quarantined FROM valid_attributes""",
    "quarantine_financials": """SELECT Customer_ID, snapshot_date, Delay_from_due_date,
        array_to_string(errors, '|') AS error_text FROM valid_financials WHERE len(errors) > 0""",
    "quarantine_error_counts": """SELECT source, split_part(e, ':', 1) AS error_type, count(*) AS n_errors
        FROM (SELECT 'fe_attributes' AS source, unnest(errors) AS e FROM valid_attributes
          UNION ALL SELECT 'fe_financials', unnest(errors) FROM valid_financials) GROUP BY 1, 2""",
    "silver_attributes_clean": "SELECT * FROM silver_attributes",
    "silver_financials_clean": f"""SELECT * REPLACE ({_round('dti', 'savings_rate', 'Credit_Utilization_Ratio')})
        FROM silver_financials""",
    "lms_mob_dpd": "SELECT * FROM loans",
    "code_table_join_left": """SELECT Customer_ID, snapshot_date, Payment_Behavior_ID, Payment_of_Min_Amount_ID,
        Credit_Mix_ID FROM enriched_typed""",
    "bin_fixed_edges": f"""SELECT p_partkey, {_bin('p_size', codes.AGE_CEILINGS)} AS size_group,
        {_bin('(p_retailprice * 60)', codes.INCOME_CEILINGS)} AS price_group FROM part""",
    "bin_label_counts": f"""SELECT Age_Group, n, label AS Age_Range
        FROM (SELECT Age_Group, count(*) AS n FROM silver_attributes GROUP BY 1)
        LEFT JOIN (VALUES {_values(codes.AGE_LABELS)}) t(id, label) ON id = Age_Group""",
    "one_hot_encode": f"""SELECT Customer_ID, snapshot_date,
        {', '.join(f'CASE WHEN Annual_Income_Group = {i} THEN 1 ELSE 0 END AS Annual_Income_Group_{i}' for i in range(1, 7))}
        FROM silver_financials""",
    "count_encode_list": f"""SELECT Customer_ID, snapshot_date, Num_of_Loan, {_LOAN_COUNTS}
        FROM (SELECT *, {_PARTS} AS parts FROM silver_financials)""",
    "list_normalize_counts": f"""SELECT Customer_ID, snapshot_date, id::BIGINT AS Loan_Type_ID, n AS Loan_Type_Count
        FROM (SELECT Customer_ID, snapshot_date, part, count(*) AS n
          FROM (SELECT Customer_ID, snapshot_date, unnest({_PARTS}) AS part FROM silver_financials
            WHERE Type_of_Loan IS NOT NULL) GROUP BY 1, 2, 3)
        LEFT JOIN (VALUES {_values(codes.LOAN_TYPE)}) t(id, label) ON label = part""",
    "risk_score_rules": "SELECT Customer_ID, snapshot_date, crs, crs_version FROM scored_financials",
    "delinquency_score_log": f"""SELECT Customer_ID, snapshot_date, {_round('delinquency_score_log')}
        FROM ({_scored_financials('enriched_typed')})""",
    "gold_financials": f"SELECT * REPLACE ({_round(*_GOLD_ROUNDED)}) FROM gold_financials",
    "rolling_avg_3m": f"""SELECT Customer_ID, snapshot_date, round(total_avg_3m, 4) AS total_avg_3m
        FROM ({_rolling('activity', 'total', 'total_avg_3m')})""",
    "clickstream_avg_3m": f"""SELECT Customer_ID, snapshot_date, {_round('fe_1_avg_3m')}
        FROM ({_rolling('clickstream', 'fe_1', 'fe_1_avg_3m')})""",
    "label_primary_dpd_mob": "SELECT * FROM primary_label",
    "label_audit": """SELECT snapshot_date, count(*) AS n_loans, count(*) FILTER (label = 1) AS n_pos
        FROM primary_label GROUP BY 1""",
    "label_primary_with_crs": """SELECT loan_id, l.Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
        '30dpd_2mob_5crs' AS label_def, '1.0_crs1.0' AS rule_version, l.snapshot_date
        FROM loans l JOIN scored_financials s ON s.Customer_ID = l.Customer_ID AND s.snapshot_date = l.snapshot_date
        WHERE mob = 2 AND crs >= 5""",
    "label_surrogate_dsl": "SELECT * FROM surrogate_label",
    "feature_merge_outer": f"SELECT * REPLACE ({_round(*_GOLD_ROUNDED)}) FROM store",
    "feature_select": f"""SELECT Customer_ID, snapshot_date,
        {', '.join(c for c in codes.DEFAULT_FEATURES if c not in _GOLD_ROUNDED)}, {_round(*_GOLD_ROUNDED)} FROM store""",
    "fill_null_numeric": f"""SELECT Customer_ID, snapshot_date,
        {', '.join(f'coalesce({c}, 0) AS {c}' for c in codes.FEATURES_0 if c not in _GOLD_ROUNDED)},
        round(coalesce(dti, 0), 6) AS dti, round(coalesce(savings_rate_avg_3m, 0), 6) AS savings_rate_avg_3m FROM store""",
    "dropna_all_features": f"""SELECT Customer_ID, snapshot_date, Age_Group, crs, {_round('dti')} FROM store
        WHERE mob = 0 AND (Age_Group IS NOT NULL OR crs IS NOT NULL OR dti IS NOT NULL)""",
    "training_set_pit_join": f"SELECT * REPLACE ({_round(*_GOLD_ROUNDED)}) FROM training",
    "train_test_oot_split": "SELECT Customer_ID, snapshot_date, label, split FROM split_rows",
    "split_stats": "SELECT split, count(*) AS n_rows, round(avg(label), 2) AS label_rate FROM split_rows GROUP BY 1",
    "standard_scale": f"""SELECT Customer_ID, snapshot_date, split,
        {', '.join(f'round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}' for c in _SCALED)}
        FROM split_rows, (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALED)}
          FROM split_rows WHERE split = 'train')""",
    "profile_missing": _profile_union(
        """SELECT '{c}' AS column_name, count(*) AS total, count(*) FILTER ({c} IS NULL) AS missing,
        count({c}) AS non_missing, round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct,
        round(count({c}) * 100.0::DOUBLE / count(*), 6) AS non_missing_pct FROM raw_financials""",
        list(_FIN_KINDS),
    ),
    "profile_string": _profile_union(
        """SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS total,
        CAST(coalesce(max(n) FILTER (v IS NULL), 0) AS BIGINT) AS missing, count(*) AS distinct_values,
        count(*) FILTER (n > 1) AS repeated_values, CAST(sum(n - 1) AS BIGINT) AS rows_beyond_first,
        CAST(count(*) FILTER (n > 1) + sum(n - 1) AS BIGINT) AS duplicate_rows,
        round(count(*) * 100.0::DOUBLE / sum(n), 6) AS distinct_pct,
        round((count(*) FILTER (n > 1) + sum(n - 1)) * 100.0::DOUBLE / sum(n), 6) AS duplicate_pct
        FROM (SELECT {c} AS v, count(*) AS n FROM raw_attributes GROUP BY 1)""",
        ["Customer_ID", "Name", "SSN", "Occupation"],
    ),
    "duplicate_values": "SELECT SSN, count(*) AS n FROM raw_attributes GROUP BY 1 HAVING count(*) > 1",
    "profile_numeric": _profile_union(
        _MOMENTS, ["Annual_Income", "Delay_from_due_date", "Outstanding_Debt", "Changed_Credit_Limit"]
    ),
    "profile_quantiles": _profile_union(
        """SELECT '{c}' AS column_name, quantile_disc({c}, 0.05) AS p5, quantile_disc({c}, 0.25) AS p25,
        quantile_disc({c}, 0.75) AS p75, quantile_disc({c}, 0.95) AS p95 FROM lineitem""",
        ["l_quantity", "l_extendedprice", "l_discount"],
    ),
    "iqr_outliers": _profile_union(_OUTLIERS, ["l_quantity", "l_extendedprice", "l_tax"]),
    "null_counts_per_column": _profile_union(
        "SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM training",
        [*codes.DEFAULT_FEATURES, "label"],
    ),
    "histogram": " UNION ALL ".join(
        _histogram("typed_financials", c, f"max({c})") for c in ("Annual_Income", "Outstanding_Debt")
    ),
    "histogram_to_p95": _histogram("orders", "o_totalprice", "quantile_cont(o_totalprice, 0.95)"),
    "winsorize_cap": _cap("typed_financials", "Customer_ID, snapshot_date"),
    "correlation_matrix": f"""
        SELECT a.name AS column_a, b.name AS column_b, round(CASE WHEN a.name = b.name THEN 1 ELSE corr(a.v, b.v) END, 6) AS corr
        FROM tall a JOIN tall b ON a.Customer_ID = b.Customer_ID AND a.snapshot_date = b.snapshot_date
        GROUP BY 1, 2""",
    "prediction_label_join": f"SELECT * REPLACE ({_round('model_predictions')}) FROM scored",
    "score_stats": """SELECT snapshot_date, count(*) AS n_rows, round(avg(model_predictions), 6) AS score_mean,
        round(stddev_samp(model_predictions), 6) AS score_std,
        round(quantile_disc(model_predictions, 0.5), 6) AS score_median FROM scores GROUP BY 1""",
    "classification_metrics": f"""SELECT * EXCLUDE (model_name) REPLACE ({_round('prevalence', 'accuracy', 'logloss')})
        FROM classification""",
    "auc_gini": f"""SELECT lang, n_pos, n_neg, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini
        FROM ({_auc('(SELECT lang, n_chars, quality FROM labels JOIN documents USING (doc_id))', 'lang', 'n_chars', 'quality')})""",
    "auc_tiny_scores": f"""SELECT lang, n_pos, n_neg, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini
        FROM ({_auc('(SELECT lang, n_chars, quality FROM labels JOIN documents USING (doc_id) WHERE doc_id % 50 <> 0)', 'lang', 'n_chars', 'quality')})""",
    "batch_score": """SELECT Customer_ID, snapshot_date, 'prod_model' AS model_name, round(1 / (1 + exp(-(-0.4
          + 0.3 * coalesce(Age_Group, 0) - 0.2 * coalesce(Annual_Income_Group, 0) + 0.05 * coalesce(crs, 0)
          + 1.5 * coalesce(dti, 0) + 0.01 * coalesce(fe_1, 0) - 0.02 * coalesce(fe_2, 0)))), 6) AS model_predictions
        FROM store WHERE mob = 0 AND snapshot_date IN (DATE '2024-04-01', DATE '2024-01-01', DATE '2024-02-01')
          AND coalesce(Age_Group, Annual_Income_Group, crs, dti, fe_1, fe_2) IS NOT NULL""",
    "file_name_parts": r"""SELECT o_orderkey,
          CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
          CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'model_lr'
            WHEN o_orderkey % 3 = 1 THEN 'prod_predictions' ELSE 'odd name' END AS family
        FROM orders""",
    "feature_merge_fanout": """SELECT Customer_ID, snapshot_date, model_predictions, loan_id, label
        FROM (SELECT Customer_ID, snapshot_date, model_predictions FROM monthly_scores)
        FULL JOIN outcomes USING (Customer_ID, snapshot_date)""",
    "any_null_rows": """SELECT Customer_ID, snapshot_date FROM raw_financials
        WHERE Type_of_Loan IS NULL OR Annual_Income IS NULL""",
    "numeric_coercion": """SELECT Customer_ID, snapshot_date, try_cast(Annual_Income AS DOUBLE) AS Annual_Income,
        try_cast(Changed_Credit_Limit AS DOUBLE) AS Changed_Credit_Limit, try_cast(Monthly_Balance AS DOUBLE) AS Monthly_Balance
        FROM raw_financials""",
    "approx_quantiles": """SELECT c AS column_name, CAST(p AS DOUBLE) AS share, true AS is_near
        FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount')) a(c),
          (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) b(p) WHERE EXISTS (SELECT 1 FROM lineitem)""",
    "performance_history": f"SELECT * REPLACE ({_round('auc', 'logloss', 'accuracy', 'gini')}) FROM performance",
    "metrics_unpivot": " UNION ALL ".join(
        f"""SELECT model_name, period_month, period_tag, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value
        FROM performance"""
        for m in ("auc", "logloss", "accuracy", "gini", "n_rows")
    ),
    "psi_bin_edges": """SELECT feature, CAST(unnest(range(len(edges))) AS INTEGER) AS position,
        round(unnest(edges), 6) AS edge FROM line_edges""",
    "psi_bin_proportions": """SELECT feature, snapshot_date, n, CAST(bin AS INTEGER) AS position,
        round(proportion, 6) AS proportion FROM line_shares""",
    "psi_score_drift": f"SELECT * REPLACE ({_round('psi')}) FROM score_drift",
    "csi_feature_drift": f"SELECT * REPLACE ({_round('psi')}) FROM line_drift",
    "drift_severity": f"""SELECT * REPLACE ({_round('psi')}),
        CASE WHEN psi >= 0.25 THEN 'ALERT' WHEN psi >= 0.1 THEN 'WARN' ELSE 'OK' END AS severity FROM stability""",
    "drift_timeline": f"""SELECT * REPLACE ({_round('psi')}), CAST(period_month || '-01' AS DATE) AS month
        FROM stability WHERE model_name = 'prod_model'""",
    "stability_summary": """SELECT model_name, type, feature, round(max(psi), 6) AS max_psi, round(avg(psi), 6) AS mean_psi,
        count(DISTINCT period_month) AS n_months FROM stability GROUP BY 1, 2, 3""",
    "csi_topk_features": f"""SELECT * REPLACE ({_round('psi')}) FROM line_drift WHERE feature IN (
        SELECT feature FROM line_drift GROUP BY 1 ORDER BY max(psi) DESC, feature LIMIT 2)""",
    "retrain_decision": f"""
        SELECT model_name, snapshot_date, snapshot_date >= DATE '2023-06-01' AND len(reasons) > 0 AS retraining,
          CASE WHEN snapshot_date < DATE '2023-06-01'
            THEN 'Retraining not allowed. Either logical date < 2023-06-01 or dataset not found.'
            WHEN len(reasons) = 0 THEN {_CLOSED} ELSE array_to_string(reasons, '; ') END AS reason
        FROM (SELECT r.model_name, r.snapshot_date, {_REASONS} AS reasons
          FROM (SELECT DISTINCT model_name, snapshot_date FROM monthly_scores) r
          LEFT JOIN performance p ON p.model_name = r.model_name AND p.snapshot_date = r.snapshot_date
          LEFT JOIN (SELECT period_month, max(psi) FILTER (type = 'PSI') AS psi, max(psi) FILTER (type = 'CSI') AS csi
            FROM stability GROUP BY 1) d ON d.period_month = strftime(r.snapshot_date - to_months(1), '%Y-%m'))""",
    "history_upsert_keep_last": """
        SELECT model_name, type, snapshot_date, period_month, feature, n,
          round(round(psi, 6) + CASE WHEN period_month >= '1998-01' THEN 1 ELSE 0 END, 6) AS psi,
          CASE WHEN period_month >= '1998-01' THEN 2 ELSE 1 END AS ingest_seq FROM line_drift""",
    "topk_recent_per_group": """SELECT o_custkey, o_orderkey, CAST(r AS INTEGER) AS recency
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
        WHERE r <= 3""",
    "best_of_recent_per_group": """
        SELECT o_orderpriority, o_custkey, o_orderkey, selection_value
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY selection_value DESC, o_custkey, r) AS b
          FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 2 ELSE o_totalprice END AS selection_value,
              row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
            FROM orders) WHERE r <= 3 AND selection_value IS NOT NULL) WHERE b = 1""",
    "latest_per_key": """SELECT user_id, event_id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "carry_forward_unchanged": """
        SELECT user_id, event_id, event_type, is_new, first_value(event_id) OVER (PARTITION BY user_id, island
          ORDER BY ts, event_id) AS carried
        FROM (SELECT *, sum(CAST(is_new AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island
          FROM (SELECT *, coalesce(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), true) AS is_new
            FROM events))""",
    "csv_readback": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
          CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "snapshot_sink_readback": """
        SELECT o_orderkey, CASE WHEN m = DATE '1997-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
          m AS snapshot_date
        FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
        WHERE m BETWEEN DATE '1996-12-01' AND DATE '1998-03-01' AND m <> DATE '1997-02-01'""",
    "history_sink_readback": """
        SELECT o_custkey, period_month,
          CASE WHEN period_month >= '1998-01' AND o_custkey % 2 = 0 THEN -n ELSE n END AS n_orders
        FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS period_month, count(*) AS n FROM orders GROUP BY 1, 2)""",
    "sketch_profile": """
        SELECT c AS column_name, n, missing, true AS distinct_is_near, CAST(k AS BIGINT) AS near_quantiles
        FROM (VALUES ('l_quantity', 5), ('l_extendedprice', 5), ('l_discount', 5), ('l_returnflag', 0), ('l_comment_key', 0)) a(c, k),
          (SELECT count(*) AS n, CAST(0 AS BIGINT) AS missing FROM lineitem
            WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-07-01')""",
    "drift_from_counts": f"SELECT * REPLACE ({_round('psi')}) FROM line_drift",
}

# The matrix needs one extra block: capped rows without NULLs in long form.
_CTES["capped"] = _cap(
    "silver_financials",
    "Customer_ID, snapshot_date, " + ", ".join(c for c in _CORRELATED if c not in _CAPPED),
)
_CTES["tall"] = " UNION ALL ".join(
    f"SELECT Customer_ID, snapshot_date, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM capped WHERE "
    + " AND ".join(f"{o} IS NOT NULL" for o in _CORRELATED)
    for c in _CORRELATED
)


def oracle_sql() -> dict[str, str]:
    """Query name to SQL."""
    return {name: _sql(body) for name, body in _BODIES.items()}

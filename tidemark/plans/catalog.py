"""Registered queries: every operator over the driver's tables, or over sources derived from them.

Each query takes (spark, folder) and returns a lazy DataFrame. Doubles are rounded to six digits
so that another engine's summation order does not matter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import codes, schemas
from tidemark.functions import cleaning, dates, numeric
from tidemark.operators import (
    dataset,
    decision,
    drift,
    features,
    history,
    labels,
    linear_search,
    lookup,
    metrics,
    models,
    order_stats,
    profiling,
    quality,
    sketches,
    snapshots,
    tree_search,
    typing,
)
from tidemark.plans import fixtures as fx
from tidemark.plans import gold, silver
from tidemark.rules import LabelRule
from tidemark.session import scratch_folder, stored
from tidemark.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRAIN_DATE = dt.date(2024, 3, 1)
REFERENCE_MONTHS = [dt.date(2023, 1, 1), dt.date(2023, 2, 1)]
CSI_FEATURES = ["fe_1", "fe_2", "fe_3", "fe_4", "fe_5"]
PROFILE_TEXT = ["Customer_ID", "Name", "SSN", "Occupation"]
CORRELATED = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Outstanding_Debt",
    "Monthly_Balance",
]
CAPPED = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# --- shared inputs -------------------------------------------------------------


def _attributes(spark, d):
    return silver.silver_attributes(silver.validated_attributes(fx.raw_attributes(spark, d)))


def _typed_financials(spark, d):
    return typing.enforce_schema(
        silver.clean_financials(fx.raw_financials(spark, d)), schemas.FINANCIALS
    )


def _financials(spark, d):
    return silver.silver_financials(silver.validated_financials(fx.raw_financials(spark, d)))


def _clickstream(spark, d):
    return silver.silver_clickstream(fx.raw_clickstream(spark, d))


def _loans(spark, d):
    return silver.silver_loans(fx.raw_loans(spark, d))


def _gold_financials(spark, d):
    months = fx.raw_financials(spark, d).select("snapshot_date")
    return gold.gold_financials(_financials(spark, d), months)


def _store(spark, d):
    return gold.feature_store(
        gold.gold_attributes(_attributes(spark, d)),
        _gold_financials(spark, d),
        gold.gold_clickstream(_clickstream(spark, d)),
        gold.gold_loans(_loans(spark, d)),
        unique=True,
    )


def _surrogate(spark, d):
    loans = gold.gold_loans(_loans(spark, d))
    return labels.surrogate_label(gold.surrogate_source(_gold_financials(spark, d), loans, unique=True))


def _training(spark, d, first=None, last=None):
    """Month-0 rows of the store, stored once: the features and the surrogate label come from them."""
    start = gold.start_rows(
        gold.gold_attributes(_attributes(spark, d)),
        _gold_financials(spark, d),
        gold.gold_clickstream(_clickstream(spark, d)),
        gold.gold_loans(_loans(spark, d)),
    )
    if first is not None:
        start = snapshots.in_range(start, first, last)
    start = stored(start.select(*gold.KEYS, "mob", *codes.DEFAULT_FEATURES), "start")
    return dataset.training_set(
        start, labels.primary_label(_loans(spark, d)), labels.surrogate_label(start), codes.DEFAULT_FEATURES
    )


def _split(spark, d):
    """The training set of one train date, stored once before its four readers."""
    days = dates.split_dates(TRAIN_DATE)
    rows = _training(spark, d, days.train_start, days.oot_end)
    return dataset.split_train_test_oot(stored(rows, "training"), TRAIN_DATE)


def _scored(spark, d):
    return metrics.join_labels(fx.monthly_scores(spark, d), fx.outcomes(spark, d))


def _performance(spark, d):
    return metrics.performance_history(fx.monthly_scores(spark, d), fx.outcomes(spark, d), "PROD")


def _score_rows(spark, d):
    return order_stats.unpivot(fx.scores(spark, d), ["model_predictions"], ["snapshot_date"])


def _clickstream_rows(spark, d):
    return order_stats.unpivot(_clickstream(spark, d), CSI_FEATURES, ["snapshot_date"])


def _reference(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("snapshot_date").isin(*[F.lit(m) for m in REFERENCE_MONTHS]))


def _stability(spark, d):
    rows = _score_rows(spark, d).unionByName(_clickstream_rows(spark, d))
    kind = drift.kind_of("model_predictions")
    return drift.drift_history(rows, _reference(rows), "prod_model", kind)


def _monthly(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("snapshot_date", dates.month_start(F.col(column).cast("date")))


def _line_rows(lines: DataFrame) -> DataFrame:
    monthly = _monthly(lines, "l_shipdate").withColumn("high_tax", (F.col("l_tax") > 0.07).cast("int"))
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "high_tax"]
    return order_stats.unpivot(monthly, columns, ["snapshot_date"])


def _lineitem_rows(spark, d):
    return _line_rows(fx.table(spark, d, "lineitem"))


def _lineitem_reference(spark, d):
    """The first two months, as a date range on the scan."""
    lines = fx.table(spark, d, "lineitem")
    day = F.col("l_shipdate")
    return _line_rows(lines.where((day >= F.lit(dt.date(1996, 1, 1))) & (day < F.lit(dt.date(1996, 3, 1)))))


def _lineitem_drift(spark, d):
    return drift.drift_history(_lineitem_rows(spark, d), _lineitem_reference(spark, d), "lines", "CSI")


# --- scans and calendars --------------------------------------------------------


@query
def scan_project(spark, d):
    return fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("snapshot_date")
    )


@query
def snapshot_filter(spark, d):
    orders = fx.table(spark, d, "orders")
    return snapshots.in_month(orders, dt.date(1997, 3, 1), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def scan_snapshot_range(spark, d):
    orders = fx.table(spark, d, "orders")
    ranged = snapshots.in_range(orders, dt.date(1996, 1, 1), dt.date(1996, 6, 30), "o_orderdate")
    return ranged.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("snapshot_date"))


@query
def scan_timestamp_range(spark, d):
    days = dt.date(2024, 1, 5), dt.date(2024, 1, 9)
    return snapshots.in_range(fx.table(spark, d, "events"), *days, "ts").select("event_id", "user_id")


@query
def snapshot_range(spark, d):
    ranges = [
        snapshots.date_range(fx.table(spark, d, name), column).withColumn("source", F.lit(name))
        for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    return ranges[0].unionByName(ranges[1]).unionByName(ranges[2])


@query
def month_spine(spark, d):
    return snapshots.month_spine(snapshots.date_range(fx.table(spark, d, "orders"), "o_orderdate"))


@query
def snapshot_union(spark, d):
    return snapshots.union_months(
        [
            snapshots.distinct_months(fx.table(spark, d, "orders"), "o_orderdate"),
            snapshots.distinct_months(fx.table(spark, d, "lineitem"), "l_shipdate"),
            snapshots.distinct_months(fx.table(spark, d, "events"), "ts"),
        ]
    )


@query
def history_complete_guard(spark, d):
    months = fx.activity(spark, d).select("snapshot_date")
    return snapshots.complete_months(months, "snapshot_date", 3)


@query
def snapshot_completeness(spark, d):
    run = dt.date(2024, 1, 1)
    ready = snapshots.completeness(
        {"features": _clickstream(spark, d), "labels": _loans(spark, d)},
        run,
        n_months=3,
        n_recent=2,
        key="Customer_ID",
    )
    return snapshots.run_conditions(
        ready, run, train_on=run, retrain_from=run, infer_from=dt.date(2024, 4, 1), monitor_from=run
    )


@query
def dataset_readiness(spark, d):
    run = dt.date(2024, 3, 1)
    ready = snapshots.completeness(
        {"features": _clickstream(spark, d), "labels": labels.primary_label(_loans(spark, d))},
        run,
        n_months=14,
        n_recent=2,
        label_shift={"labels": 6},
    )
    return snapshots.run_conditions(
        ready, run, train_on=run, retrain_from=dt.date(2024, 5, 1), infer_from=run, monitor_from=run
    )


@query
def period_month(spark, d):
    day = F.col("snapshot_date")
    months = snapshots.distinct_months(fx.table(spark, d, "orders"), "o_orderdate")
    return months.select(
        day,
        dates.period_month(day).alias("period_month"),
        dates.performance_period(day).alias("performance_period"),
        F.get(dates.reference_months(day), F.lit(0)).alias("reference_month_1"),
        F.get(dates.reference_months(day), F.lit(1)).alias("reference_month_2"),
    )


# --- cleaning and typing -----------------------------------------------------------


@query
def cast_enforce(spark, d):
    raw = fx.raw_attributes(spark, d).withColumn("Age_text", F.col("Age"))
    cast = typing.enforce_schema(raw, schemas.ATTRIBUTES)
    return cast.select("Customer_ID", "Name", "SSN", "Age", "snapshot_date")


@query
def clickstream_typing(spark, d):
    return _clickstream(spark, d)


@query
def clean_underscore(spark, d):
    raw = fx.raw_financials(spark, d)
    stripped = [
        cleaning.strip_outer_underscores(F.col(c)).alias(c) for c in schemas.UNDERSCORED_FINANCIALS
    ]
    return raw.select("Customer_ID", "snapshot_date", *stripped)


@query
def clean_regex_default(spark, d):
    cleaned = silver.clean_attributes(fx.raw_attributes(spark, d))
    return cleaned.select("Customer_ID", "Name", "SSN", "Occupation", "Age")


@query
def clean_financial_defaults(spark, d):
    cleaned = silver.clean_financials(fx.raw_financials(spark, d))
    return cleaned.select(
        "Customer_ID", "snapshot_date", "Credit_Mix", "Changed_Credit_Limit", "Payment_Behaviour"
    )


@query
def mask_ssn(spark, d):
    cleaned = silver.clean_attributes(fx.raw_attributes(spark, d))
    return cleaned.select("Customer_ID", "Name", cleaning.mask_ssn(F.col("SSN")).alias("SSN"))


@query
def split_list_count(spark, d):
    return fx.raw_financials(spark, d).select(
        "Customer_ID",
        "snapshot_date",
        F.array_join(cleaning.split_list(F.col("Type_of_Loan")), "|").alias("parts"),
        cleaning.list_count(F.col("Type_of_Loan")).alias("n_parts"),
    )


@query
def reconcile_count(spark, d):
    count = cleaning.reconciled_count(F.col("Num_of_Loan"), F.col("Type_of_Loan"))
    return fx.raw_financials(spark, d).select(
        "Customer_ID",
        "snapshot_date",
        F.col("Num_of_Loan").alias("stated"),
        count.alias("Num_of_Loan"),
    )


@query
def parse_duration_months(spark, d):
    return fx.raw_financials(spark, d).select(
        "Customer_ID",
        "snapshot_date",
        "Credit_History_Age",
        cleaning.duration_months(F.col("Credit_History_Age")).alias("Credit_History_Months"),
    )


@query
def ratio_features(spark, d):
    rows = silver.enrich_financials(_typed_financials(spark, d)).select(
        "Customer_ID", "snapshot_date", "dti", "savings_rate", "Credit_Utilization_Ratio"
    )
    return rounded(rows, "dti", "savings_rate", "Credit_Utilization_Ratio")


# --- validation and silver -------------------------------------------------------------


@query
def duplicate_flag_window(spark, d):
    raw = silver.clean_attributes(fx.raw_attributes(spark, d)).select(
        "Customer_ID", "Name", "SSN", "snapshot_date"
    )
    flagged = quality.flag_repeated(raw, ["snapshot_date", "Customer_ID"], "duplicate_id")
    return quality.flag_repeated(
        flagged, ["snapshot_date", "SSN"], "duplicate_ssn", ignore=F.col("SSN") == codes.SSN_UNKNOWN
    )


@query
def quarantine_split(spark, d):
    both = silver.validated_attributes(fx.raw_attributes(spark, d))
    return both.select(
        "Customer_ID",
        "Name",
        "Age",
        "SSN",
        F.array_join("errors", "|").alias("error_text"),
        (F.size("errors") > 0).alias("quarantined"),
    )


@query
def quarantine_financials(spark, d):
    both = silver.validated_financials(fx.raw_financials(spark, d))
    return quality.quarantined_rows(both).select(
        "Customer_ID",
        "snapshot_date",
        "Delay_from_due_date",
        F.array_join("errors", "|").alias("error_text"),
    )


@query
def quarantine_error_counts(spark, d):
    attributes = silver.validated_attributes(fx.raw_attributes(spark, d))
    financials = silver.validated_financials(fx.raw_financials(spark, d))
    reports = [
        quality.error_counts(frame).withColumn("source", F.lit(name))
        for name, frame in (("fe_attributes", attributes), ("fe_financials", financials))
    ]
    return reports[0].unionByName(reports[1])


@query
def silver_attributes_clean(spark, d):
    return _attributes(spark, d)


@query
def silver_financials_clean(spark, d):
    return rounded(_financials(spark, d), "dti", "savings_rate", "Credit_Utilization_Ratio")


@query
def lms_mob_dpd(spark, d):
    return _loans(spark, d)


# --- lookups, bins and encodings ---------------------------------------------------------


@query
def code_table_join_left(spark, d):
    return silver.add_code_ids(silver.clean_financials(fx.raw_financials(spark, d))).select(
        "Customer_ID",
        "snapshot_date",
        "Payment_Behavior_ID",
        "Payment_of_Min_Amount_ID",
        "Credit_Mix_ID",
    )


@query
def bin_fixed_edges(spark, d):
    return fx.table(spark, d, "part").select(
        "p_partkey",
        numeric.fixed_bin(F.col("p_size").cast("double"), codes.AGE_CEILINGS).alias("size_group"),
        numeric.fixed_bin(F.col("p_retailprice") * 60, codes.INCOME_CEILINGS).alias("price_group"),
    )


@query
def bin_label_counts(spark, d):
    groups = _attributes(spark, d).groupBy("Age_Group").agg(F.count("*").alias("n"))
    names = lookup.code_table(spark, codes.AGE_LABELS, "Age_Group", "Age_Range").withColumn(
        "Age_Group", F.col("Age_Group").cast("int")
    )
    return lookup.label_lookup(groups, names, "Age_Group").orderBy("Age_Group")


@query
def one_hot_encode(spark, d):
    return gold.income_one_hot(_financials(spark, d))


@query
def count_encode_list(spark, d):
    return gold.loan_type_counts(_financials(spark, d))


@query
def list_normalize_counts(spark, d):
    names = lookup.code_table(spark, codes.LOAN_TYPE, "Loan_Type_ID", "Loan_Type_Name")
    return features.normalize_list(
        _financials(spark, d), "Type_of_Loan", names, "Loan_Type_Name", ["Customer_ID", "snapshot_date"]
    )


# --- gold ------------------------------------------------------------------------------


@query
def risk_score_rules(spark, d):
    return gold.add_scores(_financials(spark, d)).select(
        "Customer_ID", "snapshot_date", "crs", "crs_version"
    )


@query
def delinquency_score_log(spark, d):
    scored = gold.add_scores(silver.enrich_financials(_typed_financials(spark, d)))
    return rounded(
        scored.select("Customer_ID", "snapshot_date", "delinquency_score_log"), "delinquency_score_log"
    )


@query
def gold_financials(spark, d):
    return rounded(
        _gold_financials(spark, d),
        "delinquency_score_log",
        "dti",
        "savings_rate_avg_3m",
    )


@query
def rolling_avg_3m(spark, d):
    active = fx.activity(spark, d)
    months = active.select("snapshot_date")
    rolled = features.rolling_average(active, "total", "total_avg_3m", unique=True, months=months)
    rolled = rolled.select(*gold.KEYS, "total_avg_3m")
    return rolled.withColumn("total_avg_3m", F.round("total_avg_3m", 4))


@query
def clickstream_avg_3m(spark, d):
    clicks = _clickstream(spark, d)
    return rounded(gold.clickstream_average(clicks, clicks.select("snapshot_date")), "fe_1_avg_3m")


@query
def label_primary_dpd_mob(spark, d):
    return labels.primary_label(_loans(spark, d))


@query
def label_audit(spark, d):
    return (
        labels.primary_label(_loans(spark, d))
        .groupBy("snapshot_date")
        .agg(F.count("*").alias("n_loans"), F.count_if(F.col("label") == 1).alias("n_pos"))
    )


@query
def label_primary_with_crs(spark, d):
    scores = gold.add_scores(_financials(spark, d))
    return labels.primary_label(_loans(spark, d), LabelRule(mob=2, crs=5), scores)


@query
def label_surrogate_dsl(spark, d):
    return _surrogate(spark, d)


@query
def feature_merge_fanout(spark, d):
    """Several loans of a customer in a month keep a row each."""
    return features.merge_sources(
        {
            "scores": fx.monthly_scores(spark, d).drop("model_name"),
            "loans": fx.outcomes(spark, d),
        }
    )


@query
def feature_merge_outer(spark, d):
    return rounded(_store(spark, d), "delinquency_score_log", "dti", "savings_rate_avg_3m")


@query
def feature_select(spark, d):
    store = _store(spark, d)
    chosen = typing.pick_features(store, codes.FEATURE_SETS["FEATURES_1_1"])
    return rounded(
        store.select(*gold.KEYS, *chosen), "delinquency_score_log", "dti", "savings_rate_avg_3m"
    )


@query
def fill_null_numeric(spark, d):
    store = _store(spark, d)
    chosen = typing.pick_features(store, codes.FEATURE_SETS["FEATURES_0"])
    filled = typing.fill_nulls(store.select(*gold.KEYS, *chosen), chosen)
    return rounded(filled, "dti", "savings_rate_avg_3m")


@query
def dropna_all_features(spark, d):
    store = _store(spark, d).where("mob = 0").select(*gold.KEYS, "Age_Group", "crs", "dti")
    return rounded(typing.drop_if_all_null(store, ["Age_Group", "crs", "dti"]), "dti")


# --- training sets -------------------------------------------------------------------------


@query
def training_set_pit_join(spark, d):
    rows = _training(spark, d).select(
        *gold.KEYS,
        "label_snapshot_date",
        *codes.DEFAULT_FEATURES,
        "label",
        "delinquency_flag",
        "label_missing",
        "delinquency_missing",
    )
    return rounded(rows, "delinquency_score_log", "dti", "savings_rate_avg_3m")


@query
def train_test_oot_split(spark, d):
    return _split(spark, d).select(*gold.KEYS, "label", "split")


@query
def split_stats(spark, d):
    return dataset.split_stats(_split(spark, d))


TRAIN_DATES = [dates.shift_months(TRAIN_DATE, k) for k in range(-5, 7)]


@query
def split_many_dates(spark, d):
    """Rows per split and the cut-offs of twelve train dates, from one training set."""
    rows = stored(_training(spark, d).select(*gold.KEYS, "label"), "training")
    split, cuts = dataset.split_many(rows, TRAIN_DATES)
    sizes = split.groupBy("train_date", "label").agg(
        *[F.count_if(F.col("split") == part).alias(f"n_{part}") for part in ("train", "test", "oot")]
    )
    return sizes.join(cuts, ["train_date", "label"], "left")


@query
def train_lr(spark, d):
    """All draws and folds of the regression search: per problem and feature the moment that must equal
    the weighted sum of label times feature when the penalised gradient vanishes."""
    features, folds = codes.DEFAULT_FEATURES, models.FOLDS
    chosen = _split(spark, d).where(F.col("split") == "train")
    rows = models.training_rows("model_lr", chosen, features, gold.KEYS, folds)
    draws = models.draw_params(models.LR_SPACE, models.LR_DRAWS)
    problems = linear_search.fold_problems(draws, folds)
    scaled = linear_search.scaled(rows, features, linear_search.scaling(rows, features))
    search = linear_search.Search(scaled, len(features), problems)
    moments = search.moments(search.solve())
    table = [
        (i // folds, p.fold, p.C, "l1" if p.l1 else "l2", "balanced" if p.balanced else "none", name, float(m))
        for i, p in enumerate(problems)
        for name, m in zip([*features, "constant"], moments[i], strict=True)
    ]
    found = spark.createDataFrame(
        table, "draw int, fold int, C double, penalty string, class_weight string, feature string, moment double"
    )
    return found.withColumn("moment", F.round("moment", 3) + F.lit(0.0))


@query
def train_gbt_first_trees(spark, d):
    """The first tree of every draw and fold of the boosted search, and of every draw on all rows."""
    features, folds = codes.DEFAULT_FEATURES, models.FOLDS
    chosen = _split(spark, d).where(F.col("split") == "train")
    rows = models.training_rows("model_gbt", chosen, features, gold.KEYS, folds)
    ready, cuts = tree_search.prepared(rows, features)
    draws = [{**p, "n_estimators": 1} for p in models.draw_params(models.GBT_SPACE, models.GBT_DRAWS)]
    problems = tree_search.fold_problems(draws, folds)
    forest = tree_search.Search(ready, len(features), problems).fit()
    table = tree_search.tree_rows(problems, forest, 0, features, cuts)
    found = spark.createDataFrame(
        table, "draw int, fold int, node int, feature string, cut double, gain double, value double"
    )
    return rounded(found, "cut", "gain", "value")


@query
def standard_scale(spark, d):
    columns = ["fe_1", "fe_2", "fe_3", "fe_4", "fe_5", "Annual_Income_Group"]
    split = stored(_split(spark, d).select(*gold.KEYS, "split", *columns), "split")
    scaled = dataset.standard_scale(split, columns, F.col("split") == "train", [*gold.KEYS, "split"])
    return rounded(scaled, *columns)


# --- profiles ---------------------------------------------------------------------------


@query
def profile_missing(spark, d):
    profile = profiling.missing_profile(fx.raw_financials(spark, d), schemas.FINANCIALS.fieldNames())
    return rounded(profile, "missing_pct", "non_missing_pct")


@query
def profile_string(spark, d):
    profile = profiling.string_profile(fx.raw_attributes(spark, d), PROFILE_TEXT)
    return rounded(profile, "distinct_pct", "duplicate_pct")


@query
def duplicate_values(spark, d):
    return profiling.duplicate_values(fx.raw_attributes(spark, d), "SSN")


@query
def profile_numeric(spark, d):
    raw = fx.raw_financials(spark, d)
    columns = ["Annual_Income", "Delay_from_due_date", "Outstanding_Debt", "Changed_Credit_Limit"]
    return rounded(
        profiling.numeric_profile(raw, columns), "min_value", "max_value", "skewness", "kurtosis"
    )


@query
def profile_quantiles(spark, d):
    return profiling.quantile_profile(
        fx.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )


@query
def iqr_outliers(spark, d):
    found = profiling.iqr_outliers(
        fx.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"]
    )
    return rounded(found, "lower_bound", "upper_bound", "outlier_pct")


@query
def null_counts_per_column(spark, d):
    return profiling.null_counts(_training(spark, d).select(*codes.DEFAULT_FEATURES, "label"))


@query
def histogram(spark, d):
    found = profiling.histogram(_typed_financials(spark, d), ["Annual_Income", "Outstanding_Debt"])
    return rounded(found, "bin_start")


@query
def histogram_to_p95(spark, d):
    found = profiling.histogram(
        fx.table(spark, d, "orders"), ["o_totalprice"], upper_quantile=0.95
    )
    return rounded(found, "bin_start")


@query
def winsorize_cap(spark, d):
    capped = profiling.winsorize(_typed_financials(spark, d), CAPPED, 0.95)
    return capped.select("Customer_ID", "snapshot_date", *CAPPED)


@query
def correlation_matrix(spark, d):
    numbers = stored(_financials(spark, d).select(*CORRELATED), "numbers")
    capped = profiling.winsorize(numbers, CAPPED, 0.95)
    return rounded(profiling.correlation_pairs(capped, CORRELATED), "corr")


# --- metrics ---------------------------------------------------------------------------------


@query
def prediction_label_join(spark, d):
    return rounded(_scored(spark, d), "model_predictions")


@query
def score_stats(spark, d):
    found = metrics.score_stats(fx.scores(spark, d), ["snapshot_date"])
    return rounded(found, "score_mean", "score_std", "score_median")


@query
def classification_metrics(spark, d):
    found = metrics.classification_metrics(_scored(spark, d), ["snapshot_date"])
    return rounded(found, "prevalence", "accuracy", "logloss")


@query
def auc_gini(spark, d):
    labelled = fx.table(spark, d, "labels").join(
        fx.table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    )
    found = metrics.auc_gini(labelled, ["lang"], score="n_chars", label="quality")
    return rounded(found, "auc", "gini")


@query
def auc_tiny_scores(spark, d):
    """Saturated probabilities, and NaN scores, which count as missing."""
    labelled = fx.table(spark, d, "labels").join(
        fx.table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    )
    tiny = labelled.withColumn(
        "score", F.expr("case when doc_id % 50 = 0 then double('NaN') else n_chars * 1e-14D end")
    )
    return rounded(metrics.auc_gini(tiny, ["lang"], score="score", label="quality"), "auc", "gini")


@query
def performance_history(spark, d):
    return rounded(_performance(spark, d), "auc", "logloss", "accuracy", "gini")


@query
def metrics_unpivot(spark, d):
    tall = metrics.metric_timeline(_performance(spark, d), ["auc", "logloss", "accuracy", "gini", "n_rows"], "PROD")
    return rounded(tall, "value")


# --- drift --------------------------------------------------------------------------------


def _exploded(df: DataFrame, column: str, name: str, keep: Sequence[str]) -> DataFrame:
    cells = df.select(*keep, F.posexplode(column).alias("position", name))
    return cells.withColumn(name, F.round(name, 6))


@query
def psi_bin_edges(spark, d):
    edges = drift.bin_edges(_lineitem_reference(spark, d))
    return _exploded(edges, "edges", "edge", ["feature"])


@query
def psi_bin_proportions(spark, d):
    rows = _lineitem_rows(spark, d)
    edges = drift.bin_edges(_lineitem_reference(spark, d))
    shares = drift.bin_proportions(rows, edges, ["snapshot_date"])
    return _exploded(shares, "proportions", "proportion", ["feature", "snapshot_date", "n"])


@query
def psi_score_drift(spark, d):
    rows = _score_rows(spark, d)
    return rounded(drift.drift_history(rows, _reference(rows), "prod_model", "PSI"), "psi")


@query
def csi_feature_drift(spark, d):
    return rounded(_lineitem_drift(spark, d), "psi")


@query
def drift_severity(spark, d):
    return rounded(drift.with_severity(_stability(spark, d)), "psi")


@query
def drift_timeline(spark, d):
    return rounded(drift.drift_timeline(_stability(spark, d), "prod_model"), "psi")


@query
def stability_summary(spark, d):
    return rounded(drift.stability_summary(_stability(spark, d)), "max_psi", "mean_psi")


@query
def csi_topk_features(spark, d):
    return rounded(drift.top_drifting(_lineitem_drift(spark, d), 2), "psi")


@query
def retrain_decision(spark, d):
    runs = fx.monthly_scores(spark, d).select("model_name", "snapshot_date").distinct()
    return decision.retrain_decision(
        runs, _performance(spark, d), _stability(spark, d), retrain_from=dt.date(2023, 6, 1)
    )


# --- histories ----------------------------------------------------------------------------


@query
def history_upsert_keep_last(spark, d):
    first = rounded(_lineitem_drift(spark, d), "psi").withColumn("ingest_seq", F.lit(1))
    rerun = first.where(F.col("period_month") >= "1998-01").withColumns(
        {"psi": F.col("psi") + 1, "ingest_seq": F.lit(2)}
    )
    kept = history.upsert_keep_last(first, rerun, ["model_name", "type", "feature", "period_month"])
    return rounded(kept, "psi")


@query
def topk_recent_per_group(spark, d):
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return history.first_rows(
        fx.table(spark, d, "orders"), ["o_custkey"], newest, k=3, rank="recency"
    ).select("o_custkey", "o_orderkey", "recency")


@query
def best_of_recent_per_group(spark, d):
    priced = fx.table(spark, d, "orders").selectExpr(
        "o_orderpriority",
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "case when o_orderkey % 5 = 0 then null else o_totalprice end as metric",
        "o_totalprice / 2 as fallback",
    )
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    best = history.best_of_recent(
        priced, ["o_orderpriority"], ["o_custkey"], newest, "metric", "fallback"
    )
    return best.select("o_orderpriority", "o_custkey", "o_orderkey", "selection_value")


@query
def latest_per_key(spark, d):
    newest = [F.desc("ts"), F.desc("event_id")]
    return history.latest_per_key(fx.table(spark, d, "events"), ["user_id"], newest).select(
        "user_id", "event_id", "event_type", "value"
    )


@query
def carry_forward_unchanged(spark, d):
    carried = history.carry_forward(
        fx.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"),
        "user_id",
        ["ts", "event_id"],
        "event_type",
        F.col("event_id"),
        F.date_trunc("day", "ts"),
    )
    return carried.select("user_id", "event_id", "event_type", "is_new", "carried")


# --- models -------------------------------------------------------------------------------

# A given model: scoring is tested apart from training.
GIVEN_MODEL = models.LinearModel(
    ("Age_Group", "Annual_Income_Group", "crs", "dti", "fe_1", "fe_2"), (0.3, -0.2, 0.05, 1.5, 0.01, -0.02), -0.4
)


@query
def batch_score(spark, d):
    scored = models.batch_score(
        GIVEN_MODEL, _store(spark, d), dt.date(2024, 4, 1), [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    )
    return rounded(scored, "model_predictions")


DEPLOYMENTS = [(dt.date(2024, 1, 1), dt.date(2023, 12, 1)), (dt.date(2024, 3, 1), dt.date(2024, 2, 1))]
DEPLOYED_FEATURES = ["Age_Group", "crs", "dti", "fe_1"]


@query
def score_deployed(spark, d):
    """Three months under two deployments. The registry holds one model per month: standard scores of its
    month-0 customers, added up."""
    store = stored(_store(spark, d).where("mob = 0").select(*gold.KEYS, "mob", *DEPLOYED_FEATURES), "store")
    moments = order_stats.unpivot(store, DEPLOYED_FEATURES, ["snapshot_date"]).groupBy("snapshot_date", "feature").agg(
        F.avg("value").alias("mean"), F.nullif(F.stddev_pop("value"), F.lit(0.0)).alias("std")
    )
    name = F.concat(F.lit("model_lr_"), F.date_format("snapshot_date", "yyyy_MM_dd")).alias("model_name")
    weights = moments.select(name, "feature", (1 / F.col("std")).alias("weight"))
    constants = moments.groupBy("snapshot_date").agg(F.sum(-F.col("mean") / F.col("std")).alias("weight")).select(
        name, F.lit("constant").alias("feature"), "weight"
    )
    registry = weights.unionByName(constants)
    deployed = spark.createDataFrame(
        [(day, f"model_lr_{month:%Y_%m_%d}") for day, month in DEPLOYMENTS], "snapshot_date date, model_name string"
    )
    wanted = registry.join(F.broadcast(deployed.select("model_name").distinct()), "model_name", "left_semi")
    months = [dt.date(2024, k, 1) for k in (1, 2, 3)]
    return rounded(models.score_deployed(store, deployed, models.linear_models(wanted), months), "model_predictions")


@query
def file_name_parts(spark, d):
    names = fx.table(spark, d, "orders").selectExpr(
        "o_orderkey",
        """concat(case o_orderkey % 3 when 0 then 'model_lr' when 1 then 'prod_predictions' else 'odd name' end,
            case when o_orderkey % 7 = 0 then '' else date_format(o_orderdate, '_yyyy_MM_dd') end,
            case when o_orderkey % 2 = 0 then '.parquet' else '' end) as name""",
    )
    return names.select("o_orderkey", dates.name_date(F.col("name")).alias("day"), dates.name_family(F.col("name")).alias("family"))


@query
def any_null_rows(spark, d):
    raw = fx.raw_financials(spark, d)
    columns = ["Type_of_Loan", "Annual_Income"]
    return raw.where(quality.any_null(columns)).select("Customer_ID", "snapshot_date")


@query
def numeric_coercion(spark, d):
    columns = ["Annual_Income", "Changed_Credit_Limit", "Monthly_Balance"]
    return typing.to_numeric(fx.raw_financials(spark, d), columns).select("Customer_ID", "snapshot_date", *columns)


@query
def approx_quantiles(spark, d):
    """Whether the one-pass quantiles lie within a hundredth of their ranks."""
    columns, shares = ["l_quantity", "l_extendedprice", "l_discount"], [0.05, 0.25, 0.5, 0.75, 0.95]
    lines = fx.table(spark, d, "lineitem")
    found = order_stats.approx_quantiles(lines, columns, shares)
    cells = found.select(F.col("feature").alias("column_name"), F.posexplode("quantiles").alias("i", "q"))
    rows = order_stats.unpivot(lines, columns).withColumnRenamed("feature", "column_name")
    ranked = rows.join(F.broadcast(cells), "column_name").groupBy("column_name", "i").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("q")).alias("below"),
        F.count_if(F.col("value") <= F.col("q")).alias("up_to"),
    )
    share = F.get(F.array(*[F.lit(p) for p in shares]), F.col("i"))
    near = (F.col("below") <= (share + 0.01) * F.col("n") + 1) & (F.col("up_to") >= (share - 0.01) * F.col("n") - 1)
    return ranked.select("column_name", share.alias("share"), near.alias("is_near"))


# --- sinks read back, stored states ------------------------------------------------


@query
def csv_readback(spark, d):
    """Two deliveries of one folder: columns in another order, and one column missing."""
    folder = f"{scratch_folder(spark, 'deliveries')}/orders.csv"
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    files.write_csv(orders.where("o_orderkey % 2 = 0"), f"{folder}/one")
    files.write_csv(orders.where("o_orderkey % 2 = 1").select("o_totalprice", "o_custkey", "o_orderkey"), f"{folder}/two")
    text = files.read_table(spark, f"{folder}/*", orders.schema)
    return text.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query
def snapshot_sink_readback(spark, d):
    """Monthly orders written, then two months again: one with other rows, one that comes out empty."""
    folder = scratch_folder(spark, "orders")
    orders = _monthly(fx.table(spark, d, "orders"), "o_orderdate").select("o_orderkey", "o_totalprice", "snapshot_date")
    files.write_snapshots(orders, folder)
    again = [dt.date(1997, 1, 1), dt.date(1997, 2, 1)]
    january = snapshots.at_snapshot(orders, again[0]).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    files.write_snapshots(january, folder, again)
    return files.read_snapshots(spark, folder, dt.date(1996, 12, 1), dt.date(1998, 3, 1))


@query
def history_sink_readback(spark, d):
    """Order counts per customer and month, those of 1998 on delivered a second time with other values."""
    folder = scratch_folder(spark, "history")
    day = F.col("o_orderdate").cast("date")
    counts = fx.table(spark, d, "orders").groupBy("o_custkey", F.date_format(day, "yyyy-MM").alias("period_month")).agg(
        F.count("*").alias("n_orders")
    )
    files.upsert_history(counts, folder, ["o_custkey", "period_month"])
    later = counts.where("period_month >= '1998-01' and o_custkey % 2 = 0").withColumn("n_orders", -F.col("n_orders"))
    return files.upsert_history(later, folder, ["o_custkey", "period_month"])


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]
SKETCHED_TEXT = ["l_returnflag", "l_comment_key"]


@query
def sketch_profile(spark, d):
    """Profile of a year and a half from stored monthly sketches, held against the rows: whether each
    quantile lies within a hundredth of its rank and the distinct count within three percent."""
    folder, shares = scratch_folder(spark, "sketches"), [0.05, 0.25, 0.5, 0.75, 0.95]
    lines = _monthly(fx.table(spark, d, "lineitem"), "l_shipdate").withColumn(
        "l_comment_key", F.concat_ws("-", "l_partkey", "l_suppkey")
    )
    files.write_snapshots(sketches.sketch_months(lines, SKETCHED, SKETCHED_TEXT), folder)
    span = dt.date(1996, 1, 1), dt.date(1997, 6, 1)
    found = sketches.merged_profile(files.read_snapshots(spark, folder, *span), shares)

    rows = snapshots.in_range(lines, *span, "snapshot_date")
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in (*SKETCHED, *SKETCHED_TEXT)]).unpivot(
        [], [*SKETCHED, *SKETCHED_TEXT], "feature", "exact"
    )
    cells = found.where("quantiles is not null").select("feature", F.posexplode("quantiles").alias("i", "q"))
    share = F.get(F.array(*[F.lit(p) for p in shares]), F.col("i"))
    ranked = order_stats.unpivot(rows, SKETCHED).join(F.broadcast(cells), "feature").groupBy("feature", "i").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("q")).alias("below"),
        F.count_if(F.col("value") <= F.col("q")).alias("up_to"),
    )
    near = (F.col("below") <= (share + 0.01) * F.col("n") + 1) & (F.col("up_to") >= (share - 0.01) * F.col("n") - 1)
    ranks = ranked.groupBy("feature").agg(F.count_if(near).alias("near_quantiles"))
    return found.join(exact, "feature").join(ranks, "feature", "left").select(
        F.col("feature").alias("column_name"), "n", "missing",
        (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.03 * F.col("exact")).alias("distinct_is_near"),
        F.coalesce("near_quantiles", F.lit(0)).alias("near_quantiles"),
    )


@query
def drift_from_counts(spark, d):
    """Drift of the lines from stored bin counts, the later months added by a second run that reads
    only them; equal to the drift from all rows."""
    folder, border = scratch_folder(spark, "bins"), dt.date(1999, 1, 1)
    edges = stored(drift.bin_edges(_lineitem_reference(spark, d)), "edges")
    lines = fx.table(spark, d, "lineitem")
    for part in (lines.where(F.col("l_shipdate") < F.lit(border)), lines.where(F.col("l_shipdate") >= F.lit(border))):
        files.write_snapshots(drift.bin_counts(_line_rows(part), edges, ["snapshot_date"]), folder)
    base = files.read_snapshots(spark, folder, dt.date(1996, 1, 1), dt.date(1996, 2, 1))
    return rounded(drift.drift_of_counts(files.read_snapshots(spark, folder), base, "lines", "CSI"), "psi")

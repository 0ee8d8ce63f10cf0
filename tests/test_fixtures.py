"""Sources derived from few, large row groups are dealt over tasks before they multiply."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog, fixtures

SOURCES = [fixtures.raw_attributes, fixtures.raw_financials, fixtures.raw_clickstream, fixtures.raw_loans,
           fixtures.monthly_scores, fixtures.outcomes, fixtures.scores]


class Stored(Exception):
    """Carries the frame that a query stores before it goes on."""


@pytest.fixture(scope="module")
def one_file(spark, tmp_path_factory):
    """4,000 customers in one row group, two of them with one key and one without."""
    folder = str(tmp_path_factory.mktemp("customers"))
    keys = F.when(F.col("id") == 7, 8).when(F.col("id") != 9, F.col("id")).alias("c_custkey")
    rows = spark.range(0, 4000, 1, 1).select(
        keys, F.concat(F.lit("Customer#"), "id").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment")
    )
    rows.write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("source", SOURCES)
def test_dealt_sources_keep_their_rows_and_bound_a_task(spark, one_file, source, monkeypatch):
    as_read = source(spark, one_file)
    assert as_read.rdd.getNumPartitions() == 1  # few rows stay as they are read
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 1000)
    dealt = source(spark, one_file)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 1500
    assert dealt.exceptAll(as_read).isEmpty() and as_read.exceptAll(dealt).isEmpty()


@pytest.mark.parametrize("name", ["feature_select", "fill_null_numeric", "dropna_all_features", "label_surrogate_dsl", "score_deployed", "feature_merge_outer"])
def test_query_multiplies_no_rows_in_the_task_that_read_them(spark, one_file, name, monkeypatch):
    def seen(frame, *_):
        raise Stored(frame)

    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 1000)
    monkeypatch.setattr(catalog, "stored", seen)
    try:
        frame = catalog.QUERIES[name](spark, one_file)
    except Stored as stored:
        frame = stored.args[0]
    lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    multiplied = [k for k, line in enumerate(lines) if line[depth[k]:].startswith("Generate explode(sequence")]
    assert multiplied
    for k in multiplied:
        end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
        assert any(line[depth[j]:].startswith("Repartition") for j, line in enumerate(lines[k + 1 : end], k + 1))

from __future__ import annotations

import math
import re
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import edges
from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes: dict, weights=(5, 2, 1), share=Fraction(3, 2), most=2) -> dict:
    """Targets by resharing the excess round after round."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 10, "c": 7, "d": 0, None: 50}, {"x": 5}, {None: 0}, {"b": 1, "a": 10**9}, {str(i): i * i for i in range(40)}],
)
def test_targets_are_filled_like_rounds_of_resharing(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    for source, target in filled(sizes).items():
        assert got[source] == pytest.approx(float(target), rel=1e-12)


def check(rows):
    """Targets, epochs, and the miss of every source; rows are (source, size, taken, source_size, target)."""
    sources = {}
    for source, size, taken, source_size, target in rows:
        sources.setdefault(source, []).append((size, taken, source_size, target))
    targets = filled({s: sum(r[0] for r in rs) for s, rs in sources.items()})
    for source, found in sources.items():
        total = sum(r[0] for r in found)
        assert {r[2] for r in found} == {total}
        assert all(r[3] == pytest.approx(float(targets[source])) for r in found)
        assert abs(sum(r[1] for r in found) - targets[source]) <= max(r[0] for r in found) / 2 + 1e-6
        epochs = math.floor(targets[source] / total) if total else 0
        assert all(r[1] in (epochs * r[0], (epochs + 1) * r[0]) and r[1] <= 2 * r[0] for r in found)


def test_awkward_documents(spark):
    docs = edges.frame(spark)
    got = mixing.mix_documents(docs)
    assert edges.ids(got) == edges.ALL_IDS
    words = {}
    for r in edges.ROWS:
        words.setdefault(r[0], []).append(len(WORD.findall(r[1] or "")))
    found = {}
    for r in got.collect():
        found.setdefault(r["doc_id"], []).append(r["size"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in words.items()}
    assert mixing.mix_documents(edges.frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs.withColumns({"size": F.lit(1), "quality": F.lit(1.0), "draw": F.lit(0.5), "taken": F.lit(0)}))


def test_weights_odd_values_and_repeats(spark):
    nan = float("nan")
    rows = [("s", 7, q, d) for q in (None, 0.0, -1.0, nan, 1.0) for d in (None, 0.0, nan, 0.5)]
    rows += [("t", None, 1.0, 0.5), ("t", 3, 1.0, 0.5)] + [(None, 5, 1.0, 0.25)] * 3000
    got = mixing.mix(spark.createDataFrame(rows, "source string, size bigint, quality double, draw double"))
    check([(r["source"], r["size"] or 0, r["taken"], r["source_size"], r["target"]) for r in got.collect()])


def test_keys_decide_and_heavier_rows_are_taken_more_often(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit("a").alias("source"), F.lit(1).cast("bigint").alias("size"),
        F.when(F.col("id") % 2 == 0, 0.2).otherwise(0.8).alias("quality"),
        mixing.draw(F.col("id")).alias("draw"), "id",
    )
    got = mixing.mix(rows, weights=(1,), share=0.5).collect()
    keys = sorted((-math.log(r["draw"]) / r["quality"], r["id"]) for r in got)
    assert {r["id"] for r in got if r["taken"]} == {i for _, i in keys[: n // 2]}
    light = sum(r["taken"] for r in got if r["id"] % 2 == 0)
    assert 0.2 < light / (n / 2 - light) < 0.55  # between the ratio of weights and that of full urns


def test_documents_of_a_hot_source_reruns_and_layouts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    hot = docs.unionByName(docs.withColumns({"doc_id": F.col("doc_id") + 10**6, "source": F.lit("hot")}))
    first = mixing.mix_documents(hot)
    rows = first.collect()
    source = {r["doc_id"]: r["source"] for r in hot.select("doc_id", "source").collect()}
    check([(source[r["doc_id"]], r["size"], r["taken"], r["source_size"], r["target"]) for r in rows])
    again = mixing.mix_documents(hot.repartition(13, "text")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_twin(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({mixing.SQL})").fetchall()) == sorted(
        map(tuple, mixing.mix_documents(docs).select(columns).collect())
    )


def test_no_python_worker_takes_part(spark, data):
    plan = mixing.mix_documents(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

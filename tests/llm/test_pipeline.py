"""The five stages, each on its predecessor's result, and the registered queries."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm import edges
from tests.llm.test_jaccard import brute
from tests.llm.test_layout import _dedup
from tests.parity import connect, differences
from tidemark.llm import catalog, packing, quality_cnn, quality_rules


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory, data):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{data}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.where("n_chars <> char_length(text)").count() == 0


def test_rules_stage(stages):
    before, after = stages[0]
    kept = quality_rules.report(before).where("kept").select("doc_id")
    assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in kept.collect()}


def test_a_large_host_does_not_raise_the_line_limit(spark, data):
    """One host with a third of all rows: a line in 250 of its 6,000 texts (4 %) goes, one in 150 stays."""
    often, seldom = "a line that many texts of the host hold", "a line that fewer texts hold"
    rows = []
    for i in range(18_000):
        lines = [" ".join(f"w{(i * k + k) % 20011}" for k in range(7, 67)), f"only {i}"]
        if i % 3 == 0 and i < 720:
            lines.append(often)
        if 720 <= i < 750:
            lines += [often] * 8 if i % 3 == 0 else []
        if i % 3 == 0 and 3000 <= i < 3450:
            lines.append(seldom)
        rows.append((i, "\n".join(lines), "large" if i % 3 == 0 else f"small{i % 40}"))
    before = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality_rules_stage(spark, before, data).collect()}
    depleted = set(range(720, 750, 3))
    assert set(after) == set(range(18_000)) - depleted
    for i, text, _ in rows:
        if i not in depleted:
            assert after[i] == text.replace(f"\n{often}", "")


def test_classifier_stage(spark, stages, data):
    before, after = stages[1]
    scored = quality_cnn.report(before, spark.read.parquet(f"{data}/labels.parquet"))
    assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in scored.where("predicted = 1").collect()}


def test_line_stage(stages):
    before, after = stages[2]
    want = {r[0]: r[2:] for r in _dedup([tuple(r) for r in before.select("doc_id", "text").collect()])}
    left = {r["doc_id"] for r in after.collect()}
    assert left <= set(want) and all(want[i][0] > 0 for i in set(want) - left)


def test_near_duplicate_stage(stages):
    before, after = stages[3]
    groups = brute([tuple(r) for r in before.select("doc_id", "text").collect()])
    assert {r[0] for r in after.select("doc_id").collect()} == {c for _, n, c in groups if n} | {i for i, n, _ in groups if not n}


def test_packing_stage(stages):
    before, after = stages[4]
    assert after.columns == [f.split()[0] for f in packing.PACKED.split(", ")]
    assert after.select("doc_id").distinct().count() == before.count()


def test_run_equals_the_stages(spark, data, stages):
    last = [f for f in stages[-1][1].columns if f not in ("sequence_id", "offset")]
    assert Counter(corpus_pipeline.run(spark, data).select(last).collect()) == Counter(stages[-1][1].select(last).collect())


def test_awkward_documents_pass_all_stages(spark, data, tmp_path):
    docs = edges.frame(spark)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")


def test_empty_and_unlike_documents_pass_all_stages(spark, data, tmp_path):
    schema = spark.read.parquet(f"{data}/documents.parquet").schema
    for name, rows in {"none": [], **edges.UNLIKE}.items():
        (tmp_path / name).mkdir()
        table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{data}/labels.parquet").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for step, stage in corpus_pipeline.STAGES[2:]:
            stage(spark, docs, data).write.parquet(f"{tmp_path}/{name}/{step}")
            docs = spark.read.parquet(f"{tmp_path}/{name}/{step}")
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {i for i, _ in rows}
        run = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r["doc_id"] for r in run} <= {i for i, _ in rows}


def test_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(catalog.SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_equal_sql(spark, data, name):
    assert differences(catalog.QUERIES[name](spark, data), connect(data), catalog.SQL[name]) == []

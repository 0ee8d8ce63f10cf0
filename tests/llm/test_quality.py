"""Quality rules, the classifier and the licence scan."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import edges
from tests.parity import differences
from tidemark.llm import licences, quality_cnn, quality_rules
from tidemark.llm.common import text_bytes


def _compare(spark, table: pa.Table):
    con = duckdb.connect()
    con.register("documents", table)
    docs = spark.createDataFrame(table.to_pandas().astype(object).where(lambda x: x.notna(), None), "doc_id bigint, source string, text string")
    assert differences(quality_rules.report(docs), con, quality_rules.SQL) == []
    return docs


def _hosts():
    """Three hosts with boilerplate in one, copies that must not count, and documents of all kinds."""
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(800)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    rows = []
    for i in range(120):
        text = f"{prose(40)}\n{prose(30)}"
        if i < 60:
            text += "\n Share THIS page with friends and subscribe now "
        if i < 30:
            text = "share this page with friends and subscribe now\n" + "\n".join(["More  stories from our partners today"] * 15) + f"\n{prose(8)} {i}"
        rows.append(("a" if i < 100 else None, text))
    copied = f"{prose(60)}\ncopied everywhere"
    rows += [("b", copied)] * 40 + [("b", prose(70)) for _ in range(10)]
    rows += [("b", "spam and spam and spam " * 20), ("b", "####  $$ <a|b> & 100%\n" * 3 + prose(60)), (None, ""), ("c", "é è ü\té\n\né è ü\té")]
    return pa.table({"doc_id": list(range(len(rows))), "source": [r[0] for r in rows], "text": [r[1] for r in rows]})


def test_rules_equal_sql(spark):
    docs = _compare(spark, _hosts())
    rows = {r["doc_id"]: r for r in quality_rules.report(docs).collect()}
    assert all(r["boilerplate_words"] > 0 and not r["kept"] for i, r in rows.items() if i < 30)
    assert all(r["boilerplate_words"] == 8 and r["kept"] for i, r in rows.items() if 30 <= i < 60)
    assert all(r["kept"] and r["boilerplate_words"] == 0 for i, r in rows.items() if 120 <= i < 170)
    kept = quality_rules.apply_rules(docs).collect()
    assert {r["doc_id"] for r in kept} == {i for i, r in rows.items() if r["kept"]}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in kept:
        lines = before[r["doc_id"]].split("\n")
        want = [x for x in lines if " ".join(x.lower().split()) != "share this page with friends and subscribe now"]
        assert r["text"] == "\n".join(want)


def test_rules_on_the_table(spark, data):
    table = duckdb.sql(f"SELECT doc_id, source, text FROM '{data}/documents.parquet'").to_arrow_table()
    _compare(spark, table)


def test_regular_lines_are_not_equal(spark):
    a, b = edges.regular_words(2048)
    words = [" ".join(x) for x in edges.regular_words(2048)]
    texts = [f"{a}\n{b}", f"{words[0]}\n{words[1]}", f"{a}\n{a}"]
    _compare(spark, pa.table({"doc_id": [0, 1, 2], "source": ["s"] * 3, "text": texts}))
    rows = quality_rules.report(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id int, text string, source string"))
    assert {r["doc_id"]: r["n_dup_lines"] for r in rows.collect()} == {0: 0, 1: 0, 2: 1}


def test_line_limit_binds_in_a_large_host(spark):
    """A line in 201 of 6,000 texts of a host (3 %) is boilerplate, one in 200 is not."""
    rows = [(i, "h", f"line {i}\n" + ("often seen\n" if i < 201 else "") + ("less often seen" if i < 200 else "")) for i in range(6000)]
    table = pa.table({"doc_id": [r[0] for r in rows], "source": [r[1] for r in rows], "text": [r[2] for r in rows]})
    docs = _compare(spark, table)
    hits = {r["doc_id"]: r["boilerplate_words"] for r in quality_rules.report(docs).collect()}
    assert all(hits[i] == (2 if i < 201 else 0) for i in hits)


def test_rules_on_awkward_documents(spark):
    rows = quality_rules.report(edges.frame(spark))
    assert edges.ids(rows) == edges.ALL_IDS
    by = {r["doc_id"]: r for r in rows.collect()}
    assert by[3]["n_words"] == 0 and by[3]["base_failed"] and by[6]["kept"]
    assert by[9]["n_dup_lines"] == 49 and by[9]["n_repeat_words"] == 50 and not by[9]["kept"]
    assert quality_rules.apply_rules(edges.frame(spark)).columns == edges.frame(spark).columns
    assert quality_rules.report(edges.frame(spark, [])).collect() == []
    assert quality_rules.apply_rules(edges.frame(spark, [])).collect() == []


def test_chunks_cover_the_text():
    texts = ["", "x" * 1023, "y" * 1024, "z" * 1025, "".join(chr(33 + i % 90) for i in range(9999))]
    rows, first = quality_cnn.cut(*text_bytes(pa.array(texts, pa.large_string())))
    step = quality_cnn.CHUNK - quality_cnn.OVERLAP
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        whole = bytearray(quality_cnn.CHUNK + step * (b - a - 1))
        for k in range(a, b):
            whole[(k - a) * step : (k - a) * step + quality_cnn.CHUNK] = rows[k].tobytes()
        assert bytes(whole).rstrip(b"\0") == t.encode() and b > a


def test_gradients():
    rng = np.random.default_rng(0)
    net = quality_cnn.Network.start(1)
    for name in ("embed", "left", "right", "bias", "hidden", "shift", "out", "base"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    data = rng.integers(0, 256, (5, quality_cnn.CHUNK)).astype(np.uint8)
    first, labels, weights = np.array([0, 2, 5]), np.array([0.0, 1.0]), np.array([1.0, 2.0])

    def loss():
        p = net.scores(data, first)
        return float(-(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / 2)

    grads = quality_cnn._gradients(net, data, first, labels, weights)
    for part, grad in zip(net.parts(), grads, strict=True):
        for flat in np.argsort(-np.abs(grad).ravel())[:3]:
            at = np.unravel_index(flat, part.shape)
            keep, eps = part[at], 1e-3
            part[at] = keep + eps
            up = loss()
            part[at] = keep - eps
            down = loss()
            part[at] = keep
            assert abs((up - down) / (2 * eps) - grad[at]) < 0.05 * abs(grad[at]) + 1e-3


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    both = quality_cnn.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in both if r["quality"] == 1])
    bad = np.array([r["score"] for r in both if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.85
    assert np.mean(good >= quality_cnn.THRESHOLD) > 0.85
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in both)


def test_classifier_on_awkward_documents(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (6, 1), (9, 0), (9, 0)], "doc_id bigint, quality int")
    rows = quality_cnn.report(edges.frame(spark), labels).collect()
    assert len(rows) == len(edges.ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    again = quality_cnn.report(edges.frame(spark), labels).collect()
    assert Counter(tuple(r) for r in rows) == Counter(tuple(r) for r in again)
    good = quality_cnn.keep_good(edges.frame(spark), labels)
    assert good.columns == edges.frame(spark).columns
    assert good.count() == sum(r["predicted"] for r in rows)
    none = labels.where("false")
    assert len(quality_cnn.report(edges.frame(spark), none).collect()) == len(edges.ROWS)
    assert quality_cnn.report(edges.frame(spark, []), labels).collect() == []


def test_held_out_rows_are_never_learnt(spark):
    import zlib

    docs = spark.range(200).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    used = quality_cnn.training_rows(docs, labels, "doc_id", "text", "quality", 1000).collect()
    assert used and all(zlib.crc32(str(r["id"]).encode()) % 4 != 2 for r in used)
    assert len(quality_cnn.training_rows(docs, labels, "doc_id", "text", "quality", 10).collect()) == 20


def test_a_repeated_id_is_one_sample(spark):
    docs = spark.range(3000).selectExpr("if(id < 2900, 1, id) as doc_id", "concat('text ', id) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").distinct()
    used = quality_cnn.training_rows(docs, labels, "doc_id", "text", "quality", 1000).collect()
    assert 1 in {r["id"] for r in used} and len(used) == len({r["id"] for r in used})
    again = quality_cnn.training_rows(docs.orderBy(F.desc("text")), labels, "doc_id", "text", "quality", 1000).collect()
    assert {r["id"]: bytes(r["chunks"]) for r in used} == {r["id"]: bytes(r["chunks"]) for r in again}
    assert len(licences.sample_paragraphs(docs, "doc_id", "text")) == 101


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(8)
    words = ["the", "of", "and", "license", "public", "version", "copy", *(f"word{i}" for i in range(300))]
    return licences.train([" ".join(rng.choice(words, 25)) for _ in range(800)])


def test_licences(model):
    cases = {
        "Some prose here\nLicensed under the Apache License, Version 2.0.\nmore": "Apache-2.0",
        "released under the\nMIT license.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.\nAll rights reserved.": "All-Rights-Reserved,CC-BY-NC",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that\nthe following conditions are met:": "BSD",
        "The public version of the copy is under way, and the license of the hunter is in the house": "",
        "": "", "\n\n": "", "version license public the general": "",
    }
    found = licences.scan_texts(model, pa.array([*cases, None], pa.large_string()))
    assert found[1].to_pylist() == [*cases.values(), ""]


def test_dual_notices(model):
    """Two licences in one paragraph are both reported; one licence stays one."""
    cases = {
        "Released under the MIT License and licensed under the Apache License, Version 2.0": "Apache-2.0,MIT",
        "Licensed under the Apache License, Version 2.0 or, word4 word9, released under the MIT license": "Apache-2.0,MIT",
        **{t: family for family, ts in licences.TEMPLATES.items() for t in ts[:1]},
    }
    found = licences.scan_texts(model, pa.array(list(cases), pa.large_string()))
    assert found[1].to_pylist() == list(cases.values())


def test_licence_in_a_long_paragraph(model):
    text = " ".join(f"word{i % 290}" for i in range(5000))
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    found = licences.scan_texts(model, pa.array([text, f"{text} {notice} {text}"], pa.large_string()))
    assert found[1].to_pylist() == ["", "MIT"]


def test_licences_of_awkward_documents(spark):
    rows = licences.report(edges.frame(spark))
    assert edges.ids(rows) == edges.ALL_IDS
    assert {r["licences"] for r in rows.collect()} == {""}
    assert licences.report(edges.frame(spark, [])).collect() == []

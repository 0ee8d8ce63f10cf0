"""The shingle join against brute force on exact sets."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tests.llm import edges
from tidemark.llm import jaccard

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    w = _WORD.findall((text or "").encode().translate(_FOLD))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            owners[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in owners[x] if j > i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, s in enumerate(sets):
        groups[find(i) if s else -1 - i].append(i)
    result = []
    for members in groups.values():
        known = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(known) if known else None
        result += [(rows[i][0], len(sets[i]), least) for i in members]
    return Counter(result)


def _got(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return Counter(tuple(r) for r in jaccard.jaccard_components(df, **more).collect())


def test_awkward_documents(spark):
    rows = [(r[0], r[1]) for r in edges.ROWS]
    got = Counter(tuple(r) for r in jaccard.jaccard_components(edges.frame(spark)).collect())
    assert got == brute(rows)


def test_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert Counter(tuple(r) for r in jaccard.jaccard_components(docs).collect()) == brute(rows)


def test_empty(spark):
    none = edges.frame(spark, [])
    assert jaccard.jaccard_components(none).collect() == []
    assert jaccard.one_of_each(none).collect() == []


@pytest.mark.parametrize("name", edges.UNLIKE)
def test_nothing_shared(spark, name):
    rows = edges.UNLIKE[name]
    assert _got(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard.one_of_each(df).collect())) == rows


def test_last_group_shares_nothing(spark):
    """Copies put shingles into some of many groups, the others have none that two sets share."""
    rows = edges.UNLIKE["many"][:20] + [(500 + i, "only these five words " + "again " * i) for i in (1, 1, 2)]
    assert _got(spark, rows, parts=64) == brute(rows)


def test_regular_words_are_not_alike(spark):
    rows = list(enumerate(edges.regular_words(2048)))
    assert _got(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_copies_and_shared_passages(spark, seed):
    """Near copies at all distances, chains whose ends are not alike, passages in many documents."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = [rnd.choice(words) for _ in range(60)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 120))]
        if rnd.random() < 0.5:
            base = passage + base[: rnd.randint(0, 40)]
        for _ in range(rnd.randint(1, 12)):
            text = list(base)
            for _ in range(rnd.randint(0, 4)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append(" ".join(text))
            if rnd.random() < 0.3:
                base = text
            if rnd.random() < 0.2:
                rows.append(rows[-1])
    rows = [(i, t) for i, t in enumerate(rnd.sample(rows, len(rows)))]
    assert _got(spark, rows, parts=3) == brute(rows)


def test_one_of_each(spark):
    df = edges.frame(spark)
    got = jaccard.one_of_each(df)
    assert got.columns == df.columns
    want = brute([(r[0], r[1]) for r in edges.ROWS])
    groups = {c for _, n, c in want.elements() if n}
    single = sum(k for (_, n, _), k in want.items() if not n)
    assert got.count() == len(groups) + single
    assert {r["doc_id"] for r in got.where("doc_id in (1, 2, 10)").collect()} <= {1}


def test_linked_sets_share_enough_of_their_prefixes():
    rng = np.random.default_rng(4)
    frequency = rng.integers(1, 50, 400)
    sets = []
    for _ in range(40):
        base = rng.choice(400, rng.integers(5, 60), replace=False)
        for _ in range(3):
            keep = base[rng.random(len(base)) > 0.08]
            sets.append(np.unique(np.concatenate((keep, rng.choice(400, rng.integers(0, 3))))))
    chosen = []
    for s in sets:
        shared = s[frequency[s] > 1]
        if 100 * len(shared) >= 80 * len(s) and len(s):
            chosen.append((s, *jaccard.choose_prefix(len(s), shared, frequency[shared])))
    linked = 0
    for (a, pa_, ma), (b, pb, mb) in combinations(chosen, 2):
        both = np.intersect1d(a, b)
        both = both[frequency[both] > 1]
        if 100 * len(both) >= 80 * len(np.union1d(a, b)):
            linked += 1
            assert len(np.intersect1d(pa_, pb)) >= min(ma, mb)
    assert linked > 20 and len({m for _, _, m in chosen}) > 1

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm import edges
from tidemark.llm import alignment, catalog
from tidemark.llm.tokens import byte_to_char

A, B = catalog.vocabulary(catalog.BYTE_TOKENIZER), catalog.vocabulary(catalog.PIECE_MODEL)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

TEXTS = [
    "", " ", "  two  spaces ", "tab\tand\nfeed\r\n\n end\n", "x" * 5000, "=" * 3001 + " ab " + "-" * 77, " " * 999 + "a",
    "Ünïcode ñ 漢字漢字 🙂🙂 ελληνικά Ελλάς русский", "don't <|endoftext|> <s> </s> <unk> <0x41> 12345,678",
    "an ▁ underline", "null\x00byte", "é combining ﬁ ligature   nbsp 　 wide", "a b c a b c " * 50,
]


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by the libraries and a set of ends."""
    import sentencepiece

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: i for i, c in enumerate(byte_to_char())}
    bytes_a = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a, parts_b = [bytes_a[i] for i in ids_a], [bytes_b(i) for i in ids_b]
        if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            return []
        result, at = [], 0
        ends_a, ends_b = ends(parts_a), ends(parts_b)
        for cut in sorted(set(ends_a) & set(ends_b)):
            result.append((
                [i for i, e in zip(ids_a, ends_a, strict=True) if at < e <= cut],
                [i for i, e in zip(ids_b, ends_b, strict=True) if at < e <= cut],
            ) if len(ids_a) < 500 else None)
            at = cut
        if result and result[0] is None:  # the same for long texts, by places
            result, i, j = [], 0, 0
            for cut in sorted(set(ends_a) & set(ends_b)):
                k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
                result.append((ids_a[i:k], ids_b[j:m]))
                i, j = k, m
        return result

    return groups


def brute(rows, groups):
    found = [(doc_id, groups(text or "")) for doc_id, text in rows]
    per_doc = [Counter((x, y) for a, b in gs for x in a for y in b) for _, gs in found]
    count = Counter(pair for c in per_doc for pair in c)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    result = []
    for (doc_id, gs), links in zip(found, per_doc, strict=True):
        sign = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        result.append((
            doc_id, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(links.values()),
            sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()),
            hashlib.sha256(sign.encode()).hexdigest() if gs else "",
        ))
    return result


def _key(row):
    return [(x is not None, x) for x in row]


def test_awkward_texts_against_brute_force(spark, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(r[0], r[1]) for r in edges.ROWS]
    docs = edges.frame(spark, [edges._row(*r) for r in rows])
    got = [tuple(r) for r in alignment.report(docs.repartition(3), A, B).select(COLUMNS).collect()]
    assert sorted(got, key=_key) == sorted(brute(rows, plain), key=_key)
    assert alignment.report(edges.frame(spark, []), A, B).collect() == []


def test_documents_against_brute_force_in_small_blocks(spark, data, plain, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    expected = sorted(brute(rows, plain), key=_key)
    got = [tuple(r) for r in alignment.report(docs, A, B).select(COLUMNS).collect()]
    assert sorted(got, key=_key) == expected


def test_block_size_changes_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    size = len(alignment.pieces(B).token_bytes)
    tables = [
        sorted(map(tuple, alignment.pair_counts(alignment.blocks(docs, A, B, limit), size).collect()))
        for limit in (10_000, 1 << 30)
    ]
    assert tables[0] == tables[1] and tables[0]


def test_groups_give_the_texts_back(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    tool = alignment.aligner(A, B)
    texts = dict(map(tuple, docs.collect()))
    joined = defaultdict(list)
    for r in alignment.groups(docs, A, B).collect():
        joined[r["doc_id"]].append((r["n"], tool.a.decode(r["a_ids"]), tool.b.decode(r["b_ids"]), r["byte_end"]))
    for doc_id, parts in joined.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert all(a == b for _, a, b, _ in parts)
        assert b"".join(p[1] for p in parts).decode() == " " + texts[doc_id]
        assert [p[3] for p in parts] == np.cumsum([len(p[1]) for p in parts]).tolist()


def test_cuts_equal_the_common_ends():
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 400, 5000):
        for share in (0.01, 0.3, 0.9):
            a, b, text, base = [], [], [0], 0
            for _ in range(4):
                ends = range(base + 1, base + n + 1)
                a += [e for e in ends if rng.random() < share or e == base + n]
                b += [e for e in ends if rng.random() < share or e == base + n]
                text += [len(a), len(a)]  # an empty text after every other
                base += n
            got = alignment.shared_cuts(np.array(a), np.array(b), np.array(text))
            assert [a[i] for i in got] == sorted(set(a) & set(b))


def test_large_groups_are_reduced_to_distinct_ids(monkeypatch):
    tool = alignment.aligner(A, B)
    x = tool.align(TEXTS)
    expected = [v.tolist() for v in tool.links(x)]
    monkeypatch.setattr(alignment, "MANY_PAIRS", 0)
    assert [v.tolist() for v in tool.links(x)] == expected

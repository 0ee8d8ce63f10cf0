"""Byte-level BPE, token counts and packing against the libraries and plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import edges
from tidemark.llm import bpe, packing, token_counts
from tidemark.llm.tokens import byte_level, lower_words, read_ranks

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


def reference_sums(values):
    """Per occurring length: documents and tokens of at least that length, tokens when cut there."""
    v = np.asarray(values)
    return {int(x): (int((v >= x).sum()), int(v[v >= x].sum()), int(np.minimum(v, x).sum())) for x in set(v.tolist())}


def _random_texts(n):
    rnd = random.Random(3)
    parts = [*"ab THe  \n\n\t'sS1²½éßïİıΣσʼ́ \x1c漢🙂\r.,!?$<|", "<|endoftext|>", "    ", " \n", "don't ", "hello "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_libraries(library, word_library):
    texts = [*_random_texts(3000), "", "a" * 5000, " ", "\n", "x y"]
    for got, text in zip(byte_level(RANKS, PATTERN).encode_all(texts), texts, strict=True):
        assert got.tolist() == library.encode_ordinary(text)
    for got, text in zip(lower_words(WORDS).encode_all(texts), texts, strict=True):
        assert got.tolist() == word_library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1024, 4096])
def test_regular_words_keep_their_own_ids(spark, library, word_library, n):
    a, b = edges.regular_words(n)
    texts = [f"{a}\n{b}", f"{b} {a}", a, b]
    for vocabulary, plain in (
        (byte_level(RANKS, PATTERN), library.encode_ordinary),
        (lower_words(WORDS), lambda t: word_library.encode(t, add_special_tokens=False).ids),
    ):
        assert [x.tolist() for x in vocabulary.encode_all(texts)] == [plain(t) for t in texts]
        assert [vocabulary.encode(t).tolist() for t in texts] == [plain(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    for r in bpe.digests(bpe.round_trip(docs, RANKS, PATTERN)).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    lengths = Counter(len(library.encode_ordinary(t)) for t in texts)
    assert dict(map(tuple, token_counts.histogram(docs, RANKS, PATTERN).collect())) == lengths
    for r in packing.pack_documents(docs, WORDS).collect():
        assert r["doc_tokens"] == len(word_library.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1


def test_another_pattern_takes_the_plain_path(library):
    other = r"\S+|\s+"
    own = tiktoken.Encoding("x", pat_str=other, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    assert byte_level(RANKS, other).encode("some words, twice some").tolist() == own.encode_ordinary("some words, twice some")


def test_offsets_hold_every_byte_of_a_token():
    vocabulary = byte_level(RANKS, PATTERN)
    for text in _random_texts(200):
        ids = vocabulary.encode(text)
        starts, ends = vocabulary.offsets(text, ids)
        place = 0
        for token, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True):
            size = len(vocabulary.token_bytes[token])
            before = len(text[:a].encode())
            assert before <= place and place + size <= len(text[:b].encode())
            place += size


def test_encode_and_decode(spark, library):
    df = edges.frame(spark).select("doc_id", "text")
    rows = bpe.decode(bpe.encode(df, RANKS, PATTERN, offsets=True), RANKS, PATTERN).collect()
    assert len(rows) == len(edges.ROWS)
    for r in rows:
        text = r["text"] or ""
        assert list(r["tokens"]) == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
        assert len(r["token_start"]) == len(r["tokens"])
    split = next(r for r in rows if r["doc_id"] == 8)
    spans = Counter(zip(split["token_start"], split["token_end"], strict=True))
    assert max(spans.values()) > 1  # a character over several tokens
    with pytest.raises(ValueError, match="tokens"):
        bpe.encode(edges.frame(spark), RANKS, PATTERN)


def test_digests(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    both = docs.union(edges.frame(spark).select("doc_id", "text"))
    got = bpe.digests(bpe.round_trip(both, RANKS, PATTERN)).collect()
    want = []
    for r in both.collect():
        ids = library.encode_ordinary(r["text"] or "")
        line = " ".join(map(str, ids)).encode()
        split = sum(library.decode_single_token_bytes(i)[0] & 0xC0 == 0x80 for i in ids)  # begin inside a character
        want.append((r["doc_id"], len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest(), split))
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_counts(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    both = docs.union(edges.frame(spark).select("doc_id", "text"))
    lengths = np.array([len(library.encode_ordinary(r["text"] or "")) for r in both.collect()])
    sums = token_counts.suffix_sums(token_counts.histogram(both, RANKS, PATTERN))
    rows = {r["length"]: r for r in sums.collect()}
    assert set(rows) == set(lengths.tolist())
    for x, (docs_, tokens, cut) in reference_sums(lengths).items():
        r = rows[x]
        assert (r["docs_at_least"], r["tokens_at_least"], r["truncated_tokens"]) == (docs_, tokens, cut)
        assert r["docs_up_to"] == (lengths <= x).sum() and r["docs"] == (lengths == x).sum()
    limits = [0, 7, 512, 10**6]
    for r in token_counts.at_limits(sums, limits).collect():
        assert r["tokens_kept"] == np.minimum(lengths, r["limit"]).sum()
        assert r["docs_cut"] == (lengths > r["limit"]).sum()
        assert r["tokens_lost"] == np.maximum(lengths - r["limit"], 0).sum()
    for r in token_counts.quantiles(sums, [0.0, 0.5, 0.99, 1.0]).collect():
        assert r["length"] == np.quantile(lengths, r["share"], method="inverted_cdf")


def test_empty_tables(spark):
    none = edges.frame(spark, []).select("doc_id", "text")
    assert bpe.digests(bpe.round_trip(none, RANKS, PATTERN)).collect() == []
    assert token_counts.suffix_sums(token_counts.histogram(none, RANKS, PATTERN)).collect() == []
    assert packing.pack_documents(none, WORDS).collect() == []


def _check_packing(rows, texts, word_library, capacity):
    wanted = Counter()
    for doc_id, text in texts:
        ids = word_library.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        full = len(ids) - len(ids) % capacity
        edges_ = sorted({*range(0, full + 1, capacity), len(ids) - (len(ids) - full) % 1024, len(ids)})
        for a, b in zip(edges_[:-1], edges_[1:], strict=True):
            cut = np.array(ids[a:b], "<u4").tobytes()
            wanted[(doc_id, a, len(cut) // 4, zlib.crc32(cut), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, data, word_library):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    both = docs.union(edges.frame(spark).select("doc_id", "text"))
    texts = [(r["doc_id"], r["text"]) for r in both.collect()]
    rows = packing.pack_documents(both, WORDS).collect()
    count = _check_packing(rows, texts, word_library, packing.CAPACITY)
    tokens = sum(r["length"] for r in rows)
    assert count <= -(-tokens // packing.CAPACITY) * 1.03 + 1


def test_packing_in_many_groups(spark, word_library):
    cut = packing.pieces(edges.frame(spark).where("doc_id < 12"), WORDS, 64)
    rows = packing.pack(cut, 64, group=7).collect()
    texts = [(r[0], r[1]) for r in edges.ROWS if r[0] is not None]
    _check_packing(rows, texts, word_library, 64)


def test_costs_are_balanced_and_room_is_kept():
    sizes = np.random.default_rng(1).integers(1, 3000, 2000)
    lengths = np.array([b - a for size in sizes.tolist() for a, b in packing.cuts(size)])
    sequence = packing.balance(lengths)
    load = np.bincount(sequence, lengths)
    assert load.max() <= packing.CAPACITY and load.sum() / (len(load) * packing.CAPACITY) > 0.97
    cost = np.bincount(sequence, packing.costs(lengths))
    assert cost.std() / cost.mean() < 0.3
    assert packing.balance(np.full(10, 4000)).tolist() == list(range(10))


def test_copies_spread_over_groups(spark):
    rows = spark.range(500).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same words here").alias("text"))
    got = packing.pack(packing.pieces(rows, WORDS), group=100)
    assert got.count() == 500
    assert got.agg(F.count_distinct("sequence_id")).first()[0] >= 5

"""Cross-tokenizer alignment: token groups between shared cuts, and how often ids are linked in a corpus.

Both tokenizers split the same bytes. Byte offsets at which a token of either side ends are shared
cuts; between two of them lies a group. Cuts are found by divide and conquer: an interval looks for
a shared end near its middle, by bisection in the other side's ends, and is cut there; one without
an inner shared end is a leaf group. All intervals of one depth, of all texts of a few megabytes,
are worked on together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, require, staged, strings
from tidemark.llm.tokens import byte_level_file, pieces

# Text bytes per block: its documents' links are written, counted and valued together.
BLOCK_BYTES = 16 << 20
# A group of more pairs than this is first reduced to distinct ids.
MANY_PAIRS = 1 << 12


@dataclass
class Alignment:
    """Tokens of several texts on both sides and their groups.

    a, b: ids of all texts, one after the other; text_a, text_b: where each text's begin (one entry
    more than texts); cut_a, cut_b: where each group's begin (one entry more than groups); text_group:
    the place of every text's first group (one entry more than texts); end: byte offset in the text
    (with the space before it) at which each group ends.
    """

    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    text_group: np.ndarray
    end: np.ndarray


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for every i, lengths[i] of them."""
    after = np.cumsum(lengths)
    return np.repeat(starts - (after - lengths), lengths) + np.arange(int(after[-1]) if len(after) else 0)


def _near_middle(low: np.ndarray, high: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Per interval, the place of the shared end nearest to the middle of low..high (inclusive), or -1.

    The search widens in rings around the middle; in all it looks at every end of an interval once.
    """
    found = np.full(len(low), -1, np.int64)
    middle = (low + high) >> 1
    open_ = np.flatnonzero(low <= high)
    seen, radius = -1, 0
    while len(open_):
        lo, hi, mid = low[open_], high[open_], middle[open_]
        # both sides of the ring: seen < distance <= radius
        left, right = np.maximum(lo, mid - radius), np.minimum(hi, mid + radius)
        if seen < 0:
            start, length = left, right - left + 1
            owner = np.repeat(np.arange(len(open_)), length)
        else:
            start = np.stack((left, mid + seen + 1), 1).ravel()
            length = np.maximum(np.stack((mid - seen - left, right - mid - seen), 1).ravel(), 0)
            owner = np.repeat(np.arange(len(open_)).repeat(2), length)
        place = _places(start, length)
        at = ends_a[place]
        shared = ends_b[np.searchsorted(ends_b, at)] == at
        place, owner = place[shared], owner[shared]
        # nearest first, then one per interval
        order = np.lexsort((np.abs(place - mid[owner]), owner)) if radius else np.arange(len(place))
        place, owner = place[order], owner[order]
        first = np.ones(len(owner), bool)
        first[1:] = owner[1:] != owner[:-1]
        found[open_[owner[first]]] = place[first]
        rest = (found[open_] < 0) & ((lo < mid - radius) | (hi > mid + radius))
        open_ = open_[rest]
        seen, radius = radius, max(1, radius * 4)
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, text_a: np.ndarray) -> np.ndarray:
    """Places in `ends_a` of all ends that `ends_b` holds too, by divide and conquer per text.

    Both are strictly increasing, and the last end of every text is shared.
    """
    some = np.diff(text_a) > 0
    low, last = text_a[:-1][some], text_a[1:][some] - 1
    cuts = [last]
    high = last - 1  # inner ends of the interval: low..high
    while len(low):
        inner = low <= high
        low, high = low[inner], high[inner]
        at = _near_middle(low, high, ends_a, ends_b)
        cut = at >= 0
        low, high, at = low[cut], high[cut], at[cut]
        cuts.append(at)
        low, high = np.stack((low, at + 1), 1).ravel(), np.stack((at - 1, high), 1).ravel()
    return np.sort(np.concatenate(cuts))


class Aligner:
    """Two tokenizers of the same texts: a byte-level file and a sentencepiece model."""

    def __init__(self, byte_file: str, piece_model: str):
        self.a, self.b = byte_level_file(byte_file), pieces(piece_model)
        self.sizes = (len(self.a.token_bytes), len(self.b.token_bytes))
        self.digits = [_digits(n) for n in self.sizes]

    def align(self, texts: list[str]) -> Alignment:
        """Align space + text on both sides; an empty text, and one that either side does not give
        back byte by byte, has no tokens."""
        spaced = [" " + t if t else "" for t in texts]
        a = self.a.encode_all(spaced)
        b = self.b.encode_all(texts)
        none = np.zeros(0, np.uint32)
        for i, text in enumerate(spaced):
            if not text:
                a[i] = b[i] = none
                continue
            n = len(text.encode())
            same = self.a.token_sizes[a[i]].sum() == n and self.b.token_sizes[b[i]].sum() == n
            # equal lengths of other bytes can only come from characters that a side replaced
            if not same or (not text.isascii() and not self._kept(text, a[i], b[i])):
                a[i] = b[i] = none
        text_a, text_b = (np.concatenate(([0], np.cumsum([len(x) for x in side]))).astype(np.int64) for side in (a, b))
        ids_a, ids_b = (np.concatenate(side).astype(np.int64) if side else np.zeros(0, np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a.token_sizes[ids_a]), np.cumsum(self.b.token_sizes[ids_b])
        last = shared_cuts(ends_a, ends_b, text_a)
        begin = np.concatenate(([0], ends_a))[text_a[:-1]]
        text = np.searchsorted(text_a, last, side="right") - 1
        return Alignment(
            ids_a, ids_b, text_a, text_b,
            np.concatenate(([0], last + 1)),
            np.concatenate(([0], np.searchsorted(ends_b, ends_a[last]) + 1)),
            np.searchsorted(last + 1, text_a, side="right").astype(np.int64),
            ends_a[last] - begin[text],
        )

    def _kept(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        data = text.encode()
        return self.a.decode(a) == data and self.b.decode(b) == data

    def signatures(self, x: Alignment) -> list[str]:
        """Per text the lowercase hex SHA-256 of its groups as `a1,a2|b1;a3|b2`; '' without tokens."""
        n_a, n_b = np.diff(x.cut_a), np.diff(x.cut_b)
        table = np.zeros((len(x.a) + len(x.b), 6), np.uint8)
        at_a = np.arange(len(x.a)) + np.repeat(x.cut_b[:-1], n_a)
        at_b = np.arange(len(x.b)) + np.repeat(x.cut_a[1:], n_b)
        for at, ids, digits, cut, end in (
            (at_a, x.a, self.digits[0], x.cut_a, b"|"), (at_b, x.b, self.digits[1], x.cut_b, b";"),
        ):
            rows = digits[ids]
            rows[:, 5] = ord(",")
            rows[cut[1:] - 1, 5] = ord(end)
            table[at] = rows
        width = np.concatenate(([0], np.cumsum((table != 0).sum(1))))
        edge = width[x.text_a + x.text_b].tolist()
        data = memoryview(table[table != 0].tobytes())
        return [
            hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(edge[:-1], edge[1:], strict=True)
        ]

    def links(self, x: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times), sorted: how often tokens of an id pair share a group of a text.

        pair: id of A times the size of B's vocabulary, plus id of B. All pairs of occurrences count;
        a large group is reduced to its distinct ids first, whose products are all that is stored.
        """
        n_a, n_b = np.diff(x.cut_a), np.diff(x.cut_b)
        text = np.repeat(np.arange(len(x.text_a) - 1), np.diff(x.text_group))
        size = np.int64(self.sizes[1])
        small = n_a * n_b <= MANY_PAIRS
        one = small & (n_a == 1)
        keys = []
        g = np.flatnonzero(one)
        place = _places(x.cut_b[:-1][g], n_b[g])
        keys.append((np.repeat(text[g], n_b[g]), np.repeat(x.a[x.cut_a[:-1][g]], n_b[g]) * size + x.b[place]))
        g = np.flatnonzero(small & ~one)
        count = n_a[g] * n_b[g]
        k = _places(np.zeros(len(g), np.int64), count)
        wide = np.repeat(n_b[g], count)
        ia = np.repeat(x.cut_a[:-1][g], count) + k // wide
        ib = np.repeat(x.cut_b[:-1][g], count) + k % wide
        keys.append((np.repeat(text[g], count), x.a[ia] * size + x.b[ib]))
        bits = int(self.sizes[0] * self.sizes[1]).bit_length()
        key = np.sort(np.concatenate([(t << bits) | p for t, p in keys]))
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        key, times = key[start], np.diff(np.append(start, len(key)))
        if not small.all():
            more_key, more_times = [key], [times]
            for g in np.flatnonzero(~small).tolist():
                a, of_a = np.unique(x.a[x.cut_a[g] : x.cut_a[g + 1]], return_counts=True)
                b, of_b = np.unique(x.b[x.cut_b[g] : x.cut_b[g + 1]], return_counts=True)
                more_key.append(((np.int64(text[g]) << bits) | (a[:, None] * size + b)).ravel())
                more_times.append((of_a[:, None] * of_b).ravel())
            key, inverse = np.unique(np.concatenate(more_key), return_inverse=True)
            times = np.zeros(len(key), np.int64)
            np.add.at(times, inverse, np.concatenate(more_times))
        return key >> bits, key & ((1 << bits) - 1), times


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 to n - 1 as characters, in rows of five and an empty place for a separator."""
    if n > 100_000:
        raise ValueError("ids of more than five digits")
    text = np.char.mod("%d", np.arange(n)).astype("S6")
    return text.view(np.uint8).reshape(n, 6).copy()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_model: str) -> Aligner:
    key = (byte_file, piece_model)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def groups(docs: DataFrame, byte_file: str, piece_model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, a_ids, b_ids, byte_end) of every group of every whole text, n from 0 in each.

    byte_end counts the space before the text. Null and empty texts, and texts that a tokenizer does
    not give back, have no groups. Repeated rows give theirs again; other columns are not read.
    """
    require(docs, id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_file, piece_model)
        for batch in batches:
            for lo, hi in chunks(column(batch, text)):
                rows = batch.slice(lo, hi - lo)
                x = tool.align(strings(rows, text))
                of = np.repeat(np.arange(hi - lo), np.diff(x.text_group))
                n = np.arange(len(of)) - np.repeat(x.text_group[:-1], np.diff(x.text_group))
                lists = [
                    pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(ids.astype(np.int32)))
                    for cut, ids in ((x.cut_a, x.a), (x.cut_b, x.b))
                ]
                yield pa.RecordBatch.from_arrays(
                    [column(rows, id).take(pa.array(of)), pa.array(n), *lists, pa.array(x.end.astype(np.int64))],
                    names=[id, "n", "a_ids", "b_ids", "byte_end"],
                )

    kind = docs.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, n bigint, a_ids array<int>, b_ids array<int>, byte_end bigint"
    return docs.select(id, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


BLOCK = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, groups_sha256 array<string>, links array<bigint>, packed binary, "
    "pairs array<bigint>, docs array<bigint>"
)


class _Block:
    """Documents of a task, gathered up to a block's size."""

    def __init__(self, tool: Aligner):
        self.tool = tool
        self.size = 0
        self.columns: list[dict] = []
        self.pair: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: pa.Array, texts: list[str]) -> None:
        x = self.tool.align(texts)
        of, pair, times = self.tool.links(x)
        n_a, n_b = np.diff(x.cut_a), np.diff(x.cut_b)
        products = np.concatenate(([0], np.cumsum(n_a * n_b)))
        self.columns.append({
            "doc_id": ids,
            "n_a": np.diff(x.text_a), "n_b": np.diff(x.text_b), "n_groups": np.diff(x.text_group),
            "n_links": np.diff(products[x.text_group]),
            "groups_sha256": self.tool.signatures(x),
            "links": np.bincount(of, minlength=len(texts)),
        })
        self.pair.append(pair.astype(np.int64))
        self.times.append(times.astype(np.uint32))
        self.size += sum(len(t) for t in texts)

    def row(self, block: int) -> pa.RecordBatch:
        """One row: columns of the documents, the block's pairs with their documents, and every
        document's links as places among the pairs, in differences, and times."""
        pair = np.concatenate(self.pair)
        pairs, docs = np.unique(pair, return_counts=True)
        place = np.searchsorted(pairs, pair).astype(np.uint32)
        step = np.diff(place, prepend=np.uint32(0))  # modulo 2^32
        data = pa.compress(step.tobytes() + np.concatenate(self.times).tobytes(), codec="zstd", asbytes=True)
        columns = {k: pa.concat_arrays([pa.array(c[k]) for c in self.columns]) for k in self.columns[0]}
        columns |= {"packed": None, "pairs": pa.array(pairs), "docs": pa.array(docs.astype(np.int64))}
        arrays = [pa.array([block], pa.int64())]
        for name, values in columns.items():
            if name == "packed":
                arrays.append(pa.array([data], pa.binary()))
            else:
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        return pa.RecordBatch.from_arrays(arrays, names=["block", *columns])


def blocks(docs: DataFrame, byte_file: str, piece_model: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of about `limit` bytes of (doc_id, text) as in BLOCK; a longer text is a block of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_file, piece_model)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        block = _Block(tool)
        for batch in batches:
            for lo, hi in chunks(column(batch, "text")):
                rows = batch.slice(lo, hi - lo)
                texts = strings(rows, "text")
                if block.size and block.size + sum(len(t) for t in texts) > limit:
                    yield block.row(number)
                    number += 1
                    block = _Block(tool)
                block.add(column(rows, "doc_id"), texts)
        if block.columns:
            yield block.row(number)

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, BLOCK)


def _pairs(found: DataFrame) -> DataFrame:
    """(block, pos, pair, docs) of every block's pairs."""
    return found.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("pos", "p")).select(
        "block", "pos", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")
    )


def pair_counts(found: DataFrame, size: int) -> DataFrame:
    """(pair, a, count, best) of a corpus in blocks: documents that hold the pair linked, and whether
    no other pair of its A id is held by more. `size`: ids of B's vocabulary."""
    totals = _pairs(found).groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.expr(f"pair div {size}"))
    most = totals.groupBy("a").agg(F.max("count").alias("most"))
    return totals.join(most, "a").select("pair", "a", "count", (F.col("count") == F.col("most")).alias("best"))


REPORT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


def _value(block: pa.Table, values: pa.Table) -> pa.Table:
    """The documents of one block, with the corpus's counts of its pairs."""
    if not block.num_rows:
        return pa.schema(
            [(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in (c.split()[0] for c in REPORT.split(", "))]
        ).empty_table()
    lists = {
        n: block.column(n).combine_chunks().flatten()
        for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    }
    links = np.asarray(lists.pop("links"), np.int64)
    n = int(links.sum())
    data = pa.decompress(block.column("packed")[0].as_py(), 8 * n, codec="zstd", asbytes=True)
    place = np.cumsum(np.frombuffer(data, np.uint32, n), dtype=np.uint32).astype(np.int64)
    times = np.frombuffer(data, np.uint32, n, 4 * n).astype(np.int64)
    value = np.zeros(values.num_rows, np.int64)
    value[np.asarray(values.column("pos"), np.int64)] = np.asarray(values.column("value"), np.int64)
    value = value[place]
    edge = np.concatenate(([0], np.cumsum(links)))

    def per_document(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(x)))
        return sums[edge[1:]] - sums[edge[:-1]]

    lists["n_best"] = pa.array(per_document(times * (value & 1)))
    lists["count_sum"] = pa.array(per_document(times * (value >> 1)))
    names = [c.split()[0] for c in REPORT.split(", ")]
    return pa.table({n: lists[n] for n in names})


def report(docs: DataFrame, byte_file: str, piece_model: str) -> DataFrame:
    """Per document of (doc_id, text): tokens of both sides, groups, links and their corpus counts.

    Texts are encoded once, in blocks written to the shared folder. A block holds its documents'
    links as places among its own distinct pairs, so that only (block, pair) rows are shuffled to be
    counted and to get the corpus's counts back; a pair that every document holds has one row per
    block. Null, empty and lossy texts have zeros and ''; repeated rows are documents of their own.
    An empty table gives no rows. Other columns are not read.
    """
    require(docs, "doc_id", "text")
    size = len(pieces(piece_model).token_bytes)
    found = staged(blocks(docs, byte_file, piece_model))
    counts = pair_counts(found, size).select("pair", (2 * F.col("count") + F.col("best").cast("bigint")).alias("value"))
    values = _pairs(found).join(counts, "pair").select(F.col("block").alias("of"), "pos", "value")
    return found.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(_value, REPORT)

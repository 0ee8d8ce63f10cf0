"""Set-similarity join on word shingles with adaptive multi-match prefixes.

Documents with the same shingle set are one class. Shingles are ordered by document frequency, rare
ones first. Two sets of similarity t share at least o = ceil(t * n) shingles, n the size of either
set, and so share at least m shingles of their first n - o + m (their m-prefixes): the m-th common
shingle has o - m common ones after it. Each class chooses its own m by the estimated cost of its
candidates, and a pair is verified only after it shares the smaller m of the two.

Shingles that a single class has can never match; they come first in every prefix, so a class with
n - o + 1 or more of them has no partner at all and leaves after the frequency count.

Only components are wanted, so most pairs of a group of copies need no look: every set first meets
one set of each of its prefix shingles (a star per shingle), and what that links is one component.
Sets of different components that share a shingle follow: pair by pair where few sets have the
shingle, else in square blocks that compare all their sets at once and give a spanning forest of the
links found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, components, content_keys, require, set_hashes, shingle_hashes, staged, with_content

WIDTH = 5
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
# Text bytes per group of postings; the number of groups follows the input.
GROUP_BYTES = 12 << 20
# Shingles a map task gathers before it hands them on.
FLUSH = 3_000_000
# Sets of a shingle that are joined pair by pair; more are compared in blocks of at most so many sets
# and shared shingles a side.
FEW, BLOCK_SETS, BLOCK_SHINGLES = 32, 1024, 2_000_000
# Prefix matches tried at most, and the cost of a verification in units of one posting.
MOST_MATCHES, VERIFY_COST = 8, 20

BLOB = "part int, kind tinyint, data binary"
DOC_MAP, POSTINGS, SHARED = 0, 1, 2


def _required(n: np.ndarray) -> np.ndarray:
    """Least intersection with any linked set."""
    return -(-PERCENT * n // 100)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """Group of a 64-bit hash: equal ranges of its upper half."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(**arrays: np.ndarray) -> bytes:
    table = pa.table({k: pa.array(v) for k, v in arrays.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data).read_all()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(kind, pa.int8()), pa.array(data, pa.binary())],
        names=["part", "kind", "data"],
    )


def _by_part(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of an array sorted by part."""
    if not len(part):
        return
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for a, b in zip(edges, [*edges[1:], len(part)], strict=True):
        yield int(part[a]), slice(a, b)


def emit(parts: int, width: int):
    """Of a task's documents: the map (doc, set, size), and the shingles of each different set in
    sorted lists, one per group of shingle hashes. Sets seen before in the task are not sent again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            ids = np.concatenate([h[0] for h in held])
            sizes = np.concatenate([h[1] for h in held])
            values = np.concatenate([h[2] for h in held])
            order = np.argsort(values)
            values = values[order]
            owner = np.repeat(np.arange(len(ids)), sizes)[order]
            for part, at in _by_part(_part(values, parts)):
                own, place = np.unique(owner[at], return_inverse=True)
                used = np.uint16 if len(own) < 1 << 16 else np.uint32
                # gaps between sorted hashes have zero upper bytes, which compress away
                gaps = np.diff(values[at], prepend=np.uint64(0))
                data = _pack(gap=gaps, place=place.astype(used)), _pack(id=ids[own], n=sizes[own])
                head = len(data[1]).to_bytes(4, "little")
                yield _blobs([(part, POSTINGS, head + data[1] + data[0])])
            held, size = [], 0

        for batch in batches:
            for a, b in chunks(column(batch, "text")):
                rows = batch.slice(a, b - a)
                values, first = shingle_hashes(column(rows, "text"), width)
                keys, counts = set_hashes(values, first), np.diff(first)
                doc = column(rows, "doc_id")
                where = int(_part(mix_one(keys[:1]), parts)[0]) if len(keys) else 0
                yield _blobs([(where, DOC_MAP, _pack_docs(doc, keys, counts))])
                new = []
                for i, key in enumerate(keys.tolist()):
                    if counts[i] and key not in seen:
                        seen.add(key)
                        new.append(i)
                if new:
                    held.append((keys[new], counts[new], np.concatenate([values[first[i] : first[i + 1]] for i in new])))
                    size += int(counts[new].sum())
                    if size >= FLUSH:
                        yield from flush()
        if held:
            yield from flush()

    return run


def mix_one(keys: np.ndarray) -> np.ndarray:
    return keys * np.uint64(0x9E3779B97F4A7C15)


def _pack_docs(doc: pa.Array, keys: np.ndarray, counts: np.ndarray) -> bytes:
    table = pa.table({"doc_id": doc, "set_id": pa.array(keys.view(np.int64)), "n": pa.array(counts.astype(np.int64))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def count_shared(parts: int):
    """Of one group of shingle hashes: those that two or more sets have, with their frequency, sent
    on to the sets' own groups. The map of documents passes through."""

    def run(table: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        values, ids, sizes = [], [], []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True):
            if kind == DOC_MAP:
                rows.append((0, DOC_MAP, data))
                continue
            cut = 4 + int.from_bytes(data[:4], "little")
            sets, posts = _unpack(data[4:cut]), _unpack(data[cut:])
            values.append(np.cumsum(posts["gap"]))
            ids.append(sets["id"][posts["place"]])
            sizes.append(sets["n"][posts["place"]])
        if values:
            value, owner, size = np.concatenate(values), np.concatenate(ids), np.concatenate(sizes)
            order = np.lexsort((owner, value))
            value, owner, size = value[order], owner[order], size[order]
            keep = np.ones(len(value), bool)  # the same set may come from several tasks
            keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
            value, owner, size = value[keep], owner[keep], size[keep]
            begin = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            frequency = np.diff(np.append(begin, len(value)))
            of_row = np.repeat(frequency, frequency)
            shared = of_row > 1
            value, owner, size, of_row = value[shared], owner[shared], size[shared], of_row[shared]
            order = np.argsort(owner, kind="stable")
            value, owner, size, of_row = value[order], owner[order], size[order], of_row[order]
            for part, at in _by_part(_part(owner, parts)):
                own, first = np.unique(owner[at], return_index=True)
                counts = np.diff(np.append(first, at.stop - at.start))
                a = _pack(id=own, n=size[at][first], count=counts)
                b = _pack(value=value[at], frequency=of_row[at].astype(np.uint32))
                rows.append((part, SHARED, len(a).to_bytes(4, "little") + a + b))
        if not rows:
            return pa.table({"part": pa.array([], pa.int32()), "kind": pa.array([], pa.int8()), "data": pa.array([], pa.binary())})
        return pa.Table.from_batches([_blobs(rows)])

    return run


SETS = "set_id bigint, n bigint, shared array<bigint>, prefix array<bigint>, m int"


def choose_prefix(n: int, tokens: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, int]:
    """The shared part of a set's prefix and the matches it needs, by the least estimated cost.

    A prefix costs its postings; at most sum(postings) / m other sets can match m times, and each
    costs a verification.
    """
    order = np.lexsort((tokens, frequency))
    tokens, postings = tokens[order], np.cumsum(frequency[order])
    need = int(_required(np.int64(n)))
    base = n - need + 1 - (n - len(tokens))  # what unique shingles leave of the 1-prefix
    most = max(1, min(MOST_MATCHES, need))
    m = np.arange(1, most + 1)
    length = np.minimum(base + m - 1, len(tokens))
    cost = postings[length - 1] * (1 + VERIFY_COST / m)
    best = int(np.argmin(cost))
    return tokens[: length[best]], best + 1


def gather_sets(table: pa.Table) -> pa.Table:
    """Of one group of sets: those that could have a partner, with shared shingles and prefix."""
    ids, sizes, values, frequencies = [], [], [], []
    for data in table.column("data").to_pylist():
        cut = 4 + int.from_bytes(data[:4], "little")
        sets, posts = _unpack(data[4:cut]), _unpack(data[cut:])
        ids.append(np.repeat(sets["id"], sets["count"]))
        sizes.append(np.repeat(sets["n"], sets["count"]))
        values.append(posts["value"])
        frequencies.append(posts["frequency"])
    owner, size = np.concatenate(ids), np.concatenate(sizes)
    value, frequency = np.concatenate(values), np.concatenate(frequencies).astype(np.int64)
    order = np.lexsort((value, owner))
    owner, size, value, frequency = owner[order], size[order], value[order], frequency[order]
    begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    end = np.append(begin[1:], len(owner))
    rows = []
    for a, b in zip(begin, end, strict=True):
        n = int(size[a])
        if 100 * (b - a) >= PERCENT * n:  # else too few shingles are shared with anyone
            prefix, m = choose_prefix(n, value[a:b], frequency[a:b])
            rows.append((owner[a].view(np.int64), n, value[a:b].view(np.int64), prefix.view(np.int64), m))
    ids, n, shared, prefix, m = zip(*rows, strict=True) if rows else ([],) * 5
    return pa.table(
        {
            "set_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
            "shared": pa.array(shared, pa.list_(pa.int64())), "prefix": pa.array(prefix, pa.list_(pa.int64())),
            "m": pa.array(m, pa.int32()),
        }
    )


def unpack_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in column(batch, "data").to_pylist():
            yield from pa.ipc.open_stream(data)


def _possible(a: str, b: str):
    """Whether sizes alone allow a link: overlap is at most the smaller number of shared shingles."""
    most = F.least(F.col(f"s_{a}"), F.col(f"s_{b}"))
    return 100 * most >= PERCENT * (F.col(f"n_{a}") + F.col(f"n_{b}") - most)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) of set ids, those that link, by their whole shared shingles."""
    left = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .withColumn("both", both)
        .where(100 * F.col("both") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("both")))
        .select("a", "b")
    )


def _postings(sets: DataFrame) -> DataFrame:
    return sets.select("set_id", "n", F.size("shared").alias("s"), "m", F.explode("prefix").alias("token"))


def matched(pairs: DataFrame) -> DataFrame:
    """Pairs with as many shared prefix shingles as the smaller of the two demands."""
    return (
        pairs.groupBy("a", "b").agg(F.count("*").alias("matches"), F.first("need").alias("need"))
        .where("matches >= need").select("a", "b")
    )


def star_pairs(posts: DataFrame) -> DataFrame:
    """Every set with the first set of each of its prefix shingles: as many rows as postings."""
    least = posts.groupBy("token").agg(F.min(F.struct("set_id", "n", "s", "m")).alias("c"), F.count("*").alias("k"))
    return (
        posts.join(least.where("k > 1"), "token")
        .select(
            F.col("c.set_id").alias("a"), F.col("set_id").alias("b"), F.col("c.n").alias("n_a"), F.col("n").alias("n_b"),
            F.col("c.s").alias("s_a"), F.col("s").alias("s_b"), F.least("m", "c.m").alias("need"),
        )
        .where("a <> b").where(_possible("a", "b"))
    )


def cross_pairs(posts: DataFrame) -> DataFrame:
    """Pairs of sets of different components that share a prefix shingle of at most FEW sets.

    `posts` are those of shingles with several components. A pair that shares a shingle of more sets
    as well is also found in that one's blocks, so the matches counted here are complete for all others.
    """
    a = posts.select("token", *(F.col(c).alias(f"{c}_a") for c in ("set_id", "n", "s", "m", "component")))
    b = posts.select("token", *(F.col(c).alias(f"{c}_b") for c in ("set_id", "n", "s", "m", "component")))
    return (
        a.join(b, "token").where("set_id_a < set_id_b and component_a <> component_b").where(_possible("a", "b"))
        .select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b"), F.least("m_a", "m_b").alias("need"))
    )


def _lists(values: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of a list column."""
    flat = values.combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(flat))
    return np.repeat(np.arange(len(sizes)), sizes), np.asarray(flat.flatten())


def _common(row: np.ndarray, value: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of values that rows `left` and rows `right` share, as a matrix."""
    _, place, count = np.unique(value, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    row, place = row[twice], np.unique(place[twice], return_inverse=True)[1]
    result = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(place.max(initial=-1)) + 1, 2048):
        inside = (place >= begin) & (place < begin + 2048)
        held = np.zeros((max(left.max(initial=0), right.max(initial=0), row.max(initial=0)) + 1, 2048), np.float32)
        held[row[inside], place[inside] - begin] = 1
        result += held[left] @ held[right].T
    return result


def link_block(table: pa.Table) -> pa.Table:
    """A spanning forest of the links between two tiles of the sets that have one shingle.

    A pair counts in the block of the first crowded shingle that both prefixes have, when the two
    are not in one component, share as many prefix shingles as needed and could link by size.
    """
    token, i, j = (table.column(c)[0].as_py() for c in ("token", "i", "j"))
    ids, n, m, component, tile = (
        np.asarray(table.column(c)) for c in ("set_id", "n", "m", "component", "tile")
    )
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    row, crowded = _lists(table.column("crowded"))
    earlier = _common(row[crowded < token], crowded[crowded < token], left, right)
    matches = _common(*_lists(table.column("prefix")), left, right)
    s = np.asarray(pa.compute.list_value_length(table.column("shared").combine_chunks()))
    most = np.minimum(s[left][:, None], s[right][None, :])
    both = n[left][:, None] + n[right][None, :]
    wanted = (
        (earlier == 0) & (matches >= np.minimum(m[left][:, None], m[right][None, :]))
        & (component[left][:, None] != component[right][None, :]) & (100 * most >= PERCENT * (both - most))
    )
    if i == j:
        wanted = np.triu(wanted, 1)
    used = np.flatnonzero(wanted.any(axis=1))
    edges = []
    if len(used):
        shared = _common(*_lists(table.column("shared")), left[used], right)
        linked = wanted[used] & (100 * shared >= PERCENT * (both[used] - shared))
        root = np.arange(len(ids))
        for a, line in zip(left[used], linked, strict=True):
            partners = right[line]
            for r in np.unique(root[partners]):
                if r != root[a]:
                    edges.append((int(ids[a]), int(ids[partners[np.argmax(root[partners] == r)]])))
                    root[root == r] = root[a]
    x, y = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})


def block_links(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of sets of different components that share a shingle of more than FEW sets.

    A crowded shingle's sets are dealt into tiles by a hash, and every pair of tiles is a group of its
    own, so no task holds more than two tiles however many sets have the shingle.
    """
    tiles = F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("volume") / BLOCK_SHINGLES))
    crowded = posts.groupBy("set_id").agg(
        F.first("component").alias("component"), F.collect_list(F.struct("token", tiles.alias("tiles"))).alias("at")
    )
    rows = (
        crowded.join(sets.select("set_id", "n", "m", "prefix", "shared"), "set_id")
        .withColumn("crowded", F.col("at.token")).withColumn("at", F.explode("at"))
        .withColumn("token", F.col("at.token"))
        .withColumn("tile", F.pmod(F.xxhash64("set_id"), "at.tiles"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("at.tiles") - 1)))
        .select(
            "token", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile",
            "set_id", "n", "m", "component", "crowded", "prefix", "shared",
        )
    )
    return rows.groupBy("token", "i", "j").applyInArrow(link_block, "a bigint, b bigint")


def link_classes(docs: DataFrame, width: int = WIDTH, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set_id, n) of every document, and (id, component) of every set that has a partner."""
    if parts is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(4, -(-size // GROUP_BYTES))
    blobs = docs.mapInArrow(emit(parts, width), BLOB)
    counted = staged(blobs.groupBy("part").applyInArrow(count_shared(parts), BLOB))
    kind = docs.schema["doc_id"].dataType.simpleString()
    doc_map = counted.where(F.col("kind") == DOC_MAP).select("data").mapInArrow(
        unpack_docs, f"doc_id {kind}, set_id bigint, n bigint"
    )
    shared = counted.where(F.col("kind") == SHARED)
    sets = staged(shared.groupBy("part").applyInArrow(gather_sets, SETS))

    posts = _postings(sets)
    first = staged(verified(matched(star_pairs(posts)), sets))
    known = components(first)
    named = sets.join(known, sets["set_id"] == known["id"], "left").withColumn(
        "component", F.coalesce("component", "set_id")
    ).drop("id")
    posts = named.select("set_id", "n", F.size("shared").alias("s"), "m", "component", F.explode("prefix").alias("token"))
    # shingles of one component only have nothing left to find
    mixed = posts.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("k"), F.sum("s").alias("volume")
    ).where("lo <> hi").drop("lo", "hi")
    posts = staged(posts.join(mixed, "token"))
    few = verified(matched(cross_pairs(posts.where(F.col("k") <= FEW))), sets)
    many = block_links(posts.where(F.col("k") > FEW), sets)
    links = staged(few.unionByName(many))
    return doc_map, components(first.unionByName(links))


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are maximal runs without the bytes 0x20 and 0x09 to 0x0D, A-Z as a-z; the set holds the
    distinct five-word shingles of the whole text, or the whole sequence when there are fewer words.
    Null, empty and blank texts have an empty set and are linked with nothing. component_id is the
    least doc_id that links reach; repeated rows and ids each keep their row. Shingles and sets are
    compared by 64-bit hashes. Every pair of linked sets is either verified or known to be in one
    component already.
    """
    require(docs, id, text)
    slim = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    doc_map, linked = link_classes(slim, parts=parts)
    named = doc_map.join(linked, doc_map["set_id"] == linked["id"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "set_id").alias("component")
    )
    # copies are summed up before the shuffle; documents without words stand alone
    full = named.where("n_shingles > 0")
    # written first, so that the join below only moves its rows and a large component can be split
    least = staged(full.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return (
        full.join(least, "component").select("doc_id", "n_shingles", "component_id")
        .unionByName(named.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but one of each component: the least id stays, of equal ids the text
    of least hash, of rows equal in id and text any one. Documents without words all stay. All columns
    are kept. Rows are told apart by hashes of id and text, so no number must agree in two passes.
    """
    require(docs, id, text)
    keys = content_keys(docs)
    keyed = with_content(docs, keys, id, text)
    name = F.struct(F.col(id).alias("id"), *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)])
    doc_map, linked = link_classes(keyed.select(name.alias("doc_id"), F.col(text).cast("string").alias("text")))
    named = doc_map.join(linked, doc_map["set_id"] == linked["id"], "left").select(
        "doc_id", "n", F.coalesce("component", "set_id").alias("component")
    )
    best = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("doc_id"))
    rows = named.where("n > 0").groupBy("doc_id").agg(F.count("*").alias("rows"))
    one = best.select("doc_id").join(rows, "doc_id").select("doc_id.*", (F.col("rows") > 1).alias("repeated"))
    blank = named.where("n = 0").select("doc_id.*", F.lit(False).alias("repeated")).distinct()
    # written first, so that the joins below only move their rows
    stay = staged(one.unionByName(blank).select(*[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)], "repeated"))
    kept = keyed.join(stay.where("not repeated").drop("repeated"), keys, "left_semi")
    repeated = stay.where("repeated").drop("repeated")
    if not repeated.isEmpty():
        again = keyed.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.first(F.struct(*docs.columns)).alias("row"))
        kept = kept.drop(*keys).unionByName(again.select("row.*"))
    return kept.drop(*keys)

"""Quality classifier: a byte-level convolutional network, trained and applied with numpy.

A text's bytes are cut into overlapping chunks that cover all of it. In every chunk learned filters
slide over embedded bytes and keep their maximum; the chunks' maxima are combined into one
probability by their mean and their maximum over the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, fresh, require, text_bytes, widened

CHUNK, OVERLAP = 1024, 64
# Embedding size, half a filter's width in bytes (also its step), filters, units of the layer above.
EMBED, STRIDE, FILTERS, HIDDEN = 8, 4, 64, 16
THRESHOLD = 0.7
# Training sample: labelled documents of each class, and chunks of each, evenly spread over it.
TRAIN_ROWS, TRAIN_CHUNKS = 1536, 12
EPOCHS, BATCH, RATE, DECAY = 16, 64, 0.015, 1e-4
# Rows of a matrix product at a time.
BLOCK_CHUNKS = 256


@dataclass
class Network:
    """embed: 256 x EMBED; left, right: filter halves; bias; hidden, shift: a layer over each chunk's
    maxima; out, base: weights of the layer's mean and maximum over the document."""

    embed: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    base: np.ndarray

    @staticmethod
    def start(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        side = STRIDE * EMBED
        return Network(
            draw(256, EMBED, scale=0.5), draw(side, FILTERS, scale=(2 * side) ** -0.5),
            draw(side, FILTERS, scale=(2 * side) ** -0.5), np.zeros(FILTERS, np.float32),
            draw(FILTERS, HIDDEN, scale=FILTERS**-0.5), np.zeros(HIDDEN, np.float32),
            draw(2 * HIDDEN, scale=0.1), np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.left, self.right, self.bias, self.hidden, self.shift, self.out, self.base]

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every chunk (rows of CHUNK bytes)."""
        result = np.empty((len(data), FILTERS), np.float32)
        for a in range(0, len(data), BLOCK_CHUNKS):
            rows = data[a : a + BLOCK_CHUNKS]
            steps = self.embed[rows].reshape(len(rows), -1, STRIDE * EMBED)
            response = (steps @ self.left)[:, :-1] + (steps @ self.right)[:, 1:]
            result[a : a + BLOCK_CHUNKS] = response.max(axis=1)
        return np.maximum(result + self.bias, 0)

    def features(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean and maximum over the chunks of every document; every one has a chunk."""
        p = np.maximum(self.pooled(data) @ self.hidden + self.shift, 0)
        count = np.diff(first)[:, None]
        return np.hstack((np.add.reduceat(p, first[:-1]) / count, np.maximum.reduceat(p, first[:-1])))

    def scores(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        logit = self.features(data, first).astype(float) @ self.out.astype(float) + float(self.base[0])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, padded with zero bytes, and the place of each text's first.

    Chunks begin every CHUNK - OVERLAP bytes; an empty text has one chunk of zeros.
    """
    step = CHUNK - OVERLAP
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - OVERLAP) // step))
    first = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(sizes)), counts)
    begin = (np.arange(len(doc)) - first[doc]) * step
    padded = np.concatenate((data, np.zeros(CHUNK, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[offsets[doc] + begin].copy()
    left = sizes[doc] - begin
    for i in np.flatnonzero(left < CHUNK):
        rows[i, max(0, left[i]) :] = 0
    return rows, first


def train(data: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Network:
    """Weighted logistic loss by mini-batches and Adam; the same rows give the same network."""
    net = Network.start(seed)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    n, t = len(labels), 0
    weights = weights / weights.mean() if n else weights
    for epoch in range(EPOCHS if n else 0):
        order = rng.permutation(n)
        for a in range(0, n, BATCH):
            docs = np.sort(order[a : a + BATCH])
            counts = np.diff(first)[docs]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            begin = np.concatenate(([0], np.cumsum(counts)))
            grads = _gradients(net, data[rows], begin, labels[docs], weights[docs])
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for p, g, (m, v) in zip(net.parts(), grads, moments, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def _gradients(net: Network, data: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray):
    n, docs = len(data), len(labels)
    steps = net.embed[data].reshape(n, -1, STRIDE * EMBED)
    response = (steps @ net.left)[:, :-1] + (steps @ net.right)[:, 1:]
    best = response.argmax(axis=1)
    value = np.take_along_axis(response, best[:, None], 1)[:, 0] + net.bias
    p = np.maximum(value, 0)
    inner = p @ net.hidden + net.shift
    h = np.maximum(inner, 0)
    count = np.diff(first)
    doc = np.repeat(np.arange(docs), count)
    high = np.maximum.reduceat(h, first[:-1])
    feats = np.hstack((np.add.reduceat(h, first[:-1]) / count[:, None], high))
    logit = feats @ net.out + net.base[0]
    error = (weights * (1 / (1 + np.exp(-logit)) - labels) / docs).astype(np.float32)
    g_out, g_base = feats.T @ error, np.array([error.sum()], np.float32)
    to_mean = error[:, None] * net.out[None, :HIDDEN] / count[:, None]
    to_high = error[:, None] * net.out[None, HIDDEN:]
    top = h == high[doc]
    ties = np.add.reduceat(top.astype(np.float32), first[:-1])
    g_inner = ((to_mean[doc] + to_high[doc] * top / ties[doc]) * (inner > 0)).astype(np.float32)
    g_hidden, g_shift = p.T @ g_inner, g_inner.sum(axis=0)
    g = (g_inner @ net.hidden.T) * (value > 0)
    rows = np.repeat(np.arange(n), FILTERS)
    filters, at = np.tile(np.arange(FILTERS), n), best.ravel()
    flat = g.ravel().astype(np.float32)
    sparse = np.zeros((n * FILTERS, FILTERS), np.float32)
    sparse[np.arange(n * FILTERS), filters] = flat
    l_in, r_in = steps[rows, at], steps[rows, at + 1]
    g_left, g_right = l_in.T @ sparse, r_in.T @ sparse
    g_embed = np.zeros_like(net.embed)
    for back, offset in ((net.left, 0), (net.right, 1)):
        into = (flat[:, None] * back.T[filters]).reshape(-1, STRIDE, EMBED)
        bytes_ = data[rows[:, None], (at + offset)[:, None] * STRIDE + np.arange(STRIDE)]
        np.add.at(g_embed, bytes_.ravel(), into.reshape(-1, EMBED))
    return [g_embed, g_left, g_right, g.sum(axis=0).astype(np.float32), g_hidden, g_shift, g_out.astype(np.float32), g_base]


def held_out(id: str):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: int) -> DataFrame:
    """(label, weight, chunks) of at most `rows` labelled documents of each class that are not held
    out, the least by a hash of the id; weights restore the classes' shares. Each gives at most
    TRAIN_CHUNKS chunks, evenly spread over the whole text."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id)).select(
        F.col(id).alias("id"), F.col(label).cast("int").alias("label")
    )
    order = F.xxhash64(F.lit("sample"), F.col("id"))
    parts = [known.where(F.col("label") == k).orderBy(order, "id").limit(rows) for k in (0, 1)]
    shares = known.groupBy("label").agg(F.count("*").alias("all"))
    picked = parts[0].union(parts[1])
    sizes = picked.groupBy("label").agg(F.count("*").alias("picked"))
    weights = shares.join(sizes, "label").select("label", (F.col("all") / F.col("picked")).alias("weight"))
    chosen = F.broadcast(picked.join(F.broadcast(weights), "label"))  # at most 2 x rows ids
    texts = (
        docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(picked.select("id").distinct()), "id", "left_semi")
        .groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    found = texts.join(chosen, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(column(batch, "text")):
                part = batch.slice(a, b - a)
                rows, first = cut(*text_bytes(column(part, "text")))
                kept = []
                for x, y in zip(first[:-1], first[1:], strict=True):
                    places = np.unique(np.linspace(x, y - 1, min(TRAIN_CHUNKS, y - x)).round().astype(int))
                    kept.append(rows[places].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id"), column(part, "label"), column(part, "weight"), pa.array(kept, pa.binary())],
                    names=["id", "label", "weight", "chunks"],
                )

    kind = found.schema["id"].dataType.simpleString()
    return found.select("id", "label", "weight", "text").mapInArrow(
        run, f"id {kind}, label int, weight double, chunks binary"
    )


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Network:
    """Train on a bounded sample; what reaches the driver is at most 2 x rows x TRAIN_CHUNKS x CHUNK
    bytes. Without labelled rows the network stays as it starts. A repeated id gives one text;
    null texts count as empty."""
    require(docs, id, text)
    require(labels, id, label)
    sample = training_rows(docs, labels, id, text, label, rows).collect()
    sample.sort(key=lambda r: (r["id"], r["label"], r["chunks"]))
    data = np.frombuffer(b"".join(r["chunks"] for r in sample), np.uint8).reshape(-1, CHUNK)
    first = np.concatenate(([0], np.cumsum([len(r["chunks"]) // CHUNK for r in sample]))).astype(np.int64)
    target = np.array([r["label"] for r in sample], np.float32)
    return train(data, first, target, np.array([r["weight"] for r in sample], np.float32))


def score(docs: DataFrame, net: Network, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1 for every whole text; null and empty texts get that of a chunk
    of zeros. A text of any length is read in blocks; all columns stay."""
    require(docs, text)
    schema = widened(docs, f"`{name}` double")
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for a, b in chunks(column(batch, text)):
                part = batch.slice(a, b - a)
                values = network.scores(*cut(*text_bytes(column(part, text))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score THRESHOLD or more, columns as they were."""
    name = fresh(docs, "quality_score")
    return score(docs, fit(docs, labels), name=name).where(F.col(name) >= THRESHOLD).drop(name)

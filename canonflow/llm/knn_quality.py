"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are hashed byte trigrams of all its bytes, weighted by rarity, and a few binned
shape measures (repeated lines and word triples, capitals, symbols, digits, length). Truncated
singular vectors of a labelled sample's term matrix give the latent space. The sample's vectors
are broadcast; every document's exact cosines to all of them come from blocked matrix products,
and its nearest neighbours' labels are averaged, weighted by a power of the similarity.

At most SAMPLE labelled rows are learned from, those whose hashed doc_id is lowest: that bounds
what reaches the driver (8 KB a row) and what is broadcast. Terms' rarity is part of what is learned,
and comes from that sample too.

Defined cases: a null or empty text has shape terms only and is scored like any other; without
labelled rows every score is 0.5; a document labelled more than once has its lowest label;
repeated rows are scored each, and equal ones alike; of points with the same cosine at the last place
among the neighbours, those that come first in the sample vote; other columns are not read; an empty
table gives no rows. A very long text is held by one task with its words and one row of terms, some 75
bytes for each long word and 160 for each short one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .words import Words, slices, window_hashes

SAMPLE = 4000
TRIGRAMS = 1984
BINS = 8
SHAPES = 8
TERMS = TRIGRAMS + BINS * SHAPES
SHAPE_WEIGHT = 0.35
DIMENSIONS = 64
NEIGHBOURS = 25
POWER = 8
BLOCK = 256
#: Bytes of text taken at once.
BATCH_BYTES = 2 << 20
#: Marks counted as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>!{}=~^@_")] = True


def _repeated(values: np.ndarray) -> float:
    return 1 - len(np.unique(values)) / len(values) if len(values) else 0.0


def _shapes(data: bytes, words: np.ndarray, lengths: np.ndarray) -> list[float]:
    """Measures between 0 and 1."""
    b = np.frombuffer(data, np.uint8)
    n = max(1, len(b))
    lines = [hash(x) for x in data.split(b"\n") if x.strip()]
    return [
        min(1.0, np.log1p(len(words)) / 10), min(1.0, (lengths.mean() if len(lengths) else 0) / 16), _repeated(np.array(lines)) if lines else 0.0,
        _repeated(window_hashes(words, 3)), min(1.0, 3 * np.count_nonzero((b >= 65) & (b <= 90)) / n), min(1.0, 4 * np.count_nonzero(_SYMBOL[b]) / n),
        min(1.0, 4 * np.count_nonzero((b >= 48) & (b <= 57)) / n), _repeated(words),
    ]


def term_vectors(texts: list[bytes]) -> np.ndarray:
    """Raw term weights, one row per text: log counts of trigrams, then binned shapes."""
    w = Words(texts)
    hashes, lengths = w.hashes(), w.end - w.start
    out = np.zeros((len(texts), TERMS), np.float32)
    for k, data in enumerate(texts):
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        if len(b) >= 3:
            code = b[:-2] * np.uint32(65599) + b[1:-1] * np.uint32(257) + b[2:] * np.uint32(16777619)
            out[k, :TRIGRAMS] = np.log1p(np.bincount((code ^ (code >> np.uint32(15))) % np.uint32(TRIGRAMS), minlength=TRIGRAMS))
        a, z = w.first[k], w.first[k + 1]
        for s, x in enumerate(_shapes(data, hashes[a:z], lengths[a:z])):
            # linear interpolation between the two nearest bins, so near values stay near
            at = x * (BINS - 1)
            low = min(BINS - 2, int(at))
            base = TRIGRAMS + s * BINS + low
            out[k, base], out[k, base + 1] = 1 - (at - low), at - low
    return out


def _weighted(raw: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    x = raw.copy()
    x[:, :TRIGRAMS] *= rarity
    norm = np.linalg.norm(x[:, :TRIGRAMS], axis=1, keepdims=True)
    x[:, :TRIGRAMS] /= np.maximum(norm, 1e-9)
    x[:, TRIGRAMS:] *= SHAPE_WEIGHT
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Model:
    """Rarity of terms, the latent axes, and the sample's vectors and labels."""

    def __init__(self, raw: np.ndarray, labels: np.ndarray):
        self.rarity = np.log((1 + len(raw)) / (1 + (raw[:, :TRIGRAMS] > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
        x = _weighted(raw, self.rarity)
        self.axes = _axes(x, min(DIMENSIONS, len(x)))
        self.points = _unit(x @ self.axes)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def scores(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(raw), 0.5)
        k, out = min(NEIGHBOURS, len(self.labels)), np.empty(len(raw))
        at = _unit(_weighted(raw, self.rarity) @ self.axes)
        for a in range(0, len(raw), BLOCK):
            cos = at[a : a + BLOCK] @ self.points.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            last = np.take_along_axis(cos, near, axis=1).min(axis=1, keepdims=True)
            for row in np.flatnonzero((cos >= last).sum(axis=1) > k):  # several at the last place
                near[row] = np.argsort(-cos[row], kind="stable")[:k]
            weight = np.maximum(np.take_along_axis(cos, near, axis=1), 0.0).astype(np.float64) ** POWER
            vote = (weight * self.labels[near]).sum(axis=1)
            out[a : a + BLOCK] = np.clip((vote + 1e-6 * self.prior) / (weight.sum(axis=1) + 1e-6), 0.0, 1.0)
        return out


def _axes(x: np.ndarray, rank: int, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    if not len(x):
        return np.zeros((x.shape[1], 1), np.float32)
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(len(x), rank + 16))).astype(np.float32)
    for _ in range(rounds):
        q, _r = np.linalg.qr(x.T @ (x @ q))
    _u, _s, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T[:, :rank]).astype(np.float32)


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled rows outside the held-out fold."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in slices(batch, 1, BATCH_BYTES, 1024):
                rows = [x.tobytes() for x in term_vectors(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary()), batch.column(2).slice(a, b - a)], ["doc_id", "terms", "quality"])

    # SAMPLE rows of two numbers: the broadcast is bounded by that parameter.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).mapInArrow(run, f"doc_id {kind}, terms binary, quality int")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "terms").limit(SAMPLE).collect()
    raw = np.frombuffer(b"".join(r["terms"] for r in rows), np.float32).reshape(len(rows), TERMS)
    return Model(raw, np.array([r["quality"] for r in rows], np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in slices(batch, 1, BATCH_BYTES, 1024):
                found = shared.value.scores(term_vectors(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit circle make a whole signature: sigma scatters a document's
shingles once, and coordinate k is the least pi(sigma(s) + k), pi being the second permutation
shifted by k. Bands of coordinates are hashed; documents that share a band are candidates.

The threshold is given in percent, and `Fit` chooses the bands by it: so many bands of ROWS
coordinates that a pair at the threshold is missed with a probability of MISSED at most, which is
25 bands at 0.85, (1 - 0.85**5)**25 = 5e-7, and 37 at 0.80. Everything after banding is exact:

1. Documents with equal shingle sets form a class, which is one node from here on, with a number of
   its own. A doc_id only names a component in the end: several rows may have one doc_id and unlike
   texts, and each text's links count.
2. In each bucket, members are compared with its smallest and its largest member. Links found
   give components.
3. In buckets that still hold several components, every member is compared with those of other
   components, inside tasks: common shingles of all pairs of two blocks are counted by one matrix
   product. The component with the most members is dealt once for each block of the others, which
   mostly are few, and never meets itself. Only links leave a task, fewer than its components.

No step emits all pairs of a bucket, and no task holds more than two blocks of one. Work in step 3
grows with a bucket's members times those outside its largest component.

Defined cases: a null text, or one without words, has an empty set, is linked with nothing and is
kept; with fewer words than a shingle, the whole sequence is one shingle; rows that repeat a
doc_id and text share a verdict, and a doc_id with several texts may be in several components, that is,
texts link, not ids; a row with a null doc_id links like any other, but names a component only if no
row of it has a doc_id, and is kept only then; equal similarities need no order, as links are only present or absent; other columns,
whatever their names, pass through `near_dedup`; an empty table gives no rows. A very long text is
held by one task with its words and shingles, some 60 bytes for each word.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, table, written
from .components import components
from .words import Words, mix64, slices, window_hashes

WIDTH = 5
PERCENT = 85
ROWS = 5
MISSED = 5e-7
#: Rows and hashed shingles of a block of a bucket.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 2_000_000
#: Shingles, as columns of a matrix, counted at once.
COLUMNS = 4096
#: Bytes of text whose words are hashed at once.
BATCH_BYTES = 2 << 20


@dataclass(frozen=True)
class Fit:
    """Bands for a threshold in percent."""

    percent: int

    def __post_init__(self):
        if not 50 <= self.percent < 100:
            raise ValueError(f"a threshold of {self.percent} percent; 50 to 99 can be banded")

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISSED) / math.log1p(-((self.percent / 100) ** ROWS)))


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    windows = window_hashes(hashes, width)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(windows[a : b - width + 1]))
        elif b > a:  # the whole sequence, apart from every full shingle
            out.append(mix64(window_hashes(hashes[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit values, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """`count` coordinates (columns) of each set; a set without members has none and gets 0."""
    out = np.zeros((len(sets), count), np.uint32)
    full = [k for k, s in enumerate(sets) if len(s)]
    for at in range(0, len(full), 64):
        some = full[at : at + 64]
        sigma = _mix32((np.concatenate([sets[k] for k in some]) >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
        first = np.concatenate([[0], np.cumsum([len(sets[k]) for k in some])[:-1]])
        for shift in range(count):
            out[some, shift] = np.minimum.reduceat(_mix32(sigma + np.uint32(shift)), first)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(sig), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def sketches(docs: DataFrame, fit: Fit) -> DataFrame:
    """doc_id, n_shingles, set_key (null if empty), bands, text_key."""
    count = fit.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in slices(batch, 1, BATCH_BYTES):
                sets = shingle_sets(texts)
                keys = band_keys(signatures(sets, count * ROWS), count, ROWS).view(np.int64)
                set_key = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_key, pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())), batch.column(2).slice(a, b - a),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands", "text_key"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>, text_key long")


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_key, which tells rows that repeat a doc_id apart."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("text_key", F.xxhash64("text"))


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles (array of hashes) of the classes in `wanted` (node, rep, rep_key), each read
    from the row that stands for it, or one of the rows equal to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in slices(batch, 1, BATCH_BYTES):
                sets = [x.view(np.int64) for x in shingle_sets(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    mine = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key"))
    return _texts(docs).join(wanted, mine).select("node", "text").mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _linked(percent: int, n_both, n_a, n_b):
    return 100 * n_both >= percent * (n_a + n_b - n_both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(_linked(percent, both, F.size("sa"), F.size("sb"))).select("a", "b")


class _Forest:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x, y) -> None:
        self.up[self.find(x)] = self.find(y)


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many members each set of `left` (row) shares with each of `right` (column)."""
    both = np.zeros((len(left), len(right)))
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # a member of one set alone is in no intersection
    some = count[column] > 1
    row, column = row[some], number[column[some]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)  # counts up to COLUMNS are exact
        has[row[a:b], column[a:b] - first] = 1
        both += has[left] @ has[right].T
    return both


def _links_within(node: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect components inside one block of a bucket or between two."""
    sides = np.unique(side)
    left, right = (np.flatnonzero(side == sides[k]) for k in (0, -1))
    size = np.array([len(s) for s in sets], np.float64)
    both = _common(sets, left, right)
    whole = size[left][:, None] + size[right][None, :] - both
    i, j = np.nonzero((100 * both >= percent * whole) & (comp[left][:, None] != comp[right][None, :]))
    # One pair for each two components, then those that join two that weren't joined.
    names, number = np.unique(comp, return_inverse=True)
    _, pick = np.unique(number[left[i]] * len(names) + number[right[j]], return_index=True)
    forest, out = _Forest(), []
    for x, y in zip(left[i[pick]].tolist(), right[j[pick]].tolist(), strict=True):
        if forest.find(comp[x]) != forest.find(comp[y]):
            forest.join(comp[x], comp[y])
            out.append((node[x], node[y]))
    return out


def _links_of_buckets(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The same for each of the buckets in `rows`: key, node, component, side, shingles."""
    rows = rows.sort_values("key", kind="stable")
    key = rows["key"].to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    node, comp, side = (rows[c].to_numpy() for c in ("node", "component", "side"))
    sets = [np.frombuffer(s, np.int64) for s in rows["shingles"]]
    out: list[tuple[int, int]] = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out += _links_within(node[a:b], comp[a:b], side[a:b], sets[a:b], percent)
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _residual_links(members: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket. members: key, node."""
    named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = written(named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key"), "mixed")
    open_ = named.join(mixed, "key").join(reps.select("node", "n_shingles"), "node")
    open_ = written(open_, "open")
    # Blocks of the largest component, and of all others; a small bucket is one block of others.
    parts = open_.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    largest = F.max(F.struct("n", "component", "s"))
    keys = parts.groupBy("key").agg(largest.alias("big"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    blocks = lambda n, s: F.ceil(F.greatest(n / BLOCK_ROWS, s / BLOCK_SHINGLES)).cast("int")
    small = (F.col("n") <= BLOCK_ROWS) & (F.col("s") <= BLOCK_SHINGLES)
    keys = keys.select(
        "key", F.when(~small, F.col("big.component")).alias("largest"), F.when(small, 1).otherwise(blocks(F.col("n") - F.col("big.n"), F.col("s") - F.col("big.s"))).alias("others"),
        F.when(small, 0).otherwise(blocks(F.col("big.n"), F.col("big.s"))).alias("own"),
    )
    keys = written(keys, "blocks")
    hashed = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    is_big = F.coalesce(F.col("component") == F.col("largest"), F.lit(False))
    place = F.when(is_big, F.col("others") + hashed(F.col("own"))).otherwise(hashed(F.col("others")))
    meets = F.when(is_big, F.col("others")).otherwise(F.col("others") + F.col("own"))
    dealt = open_.join(keys, "key").withColumn("side", place).withColumn("with", F.explode(F.sequence(F.lit(0), meets - 1)))
    # Small buckets share a call, about as many as make a block.
    total = open_.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    calls = max(partitions(members.sparkSession), 2 * total[0] // BLOCK_ROWS, 2 * total[1] // BLOCK_SHINGLES)
    alone = F.col("largest").isNotNull()
    call = F.when(alone, F.col("key")).otherwise(F.pmod("key", F.lit(calls)))
    pair = F.least("side", "with").alias("p"), F.greatest("side", "with").alias("q")
    dealt = dealt.select(call.alias("call"), alone.alias("alone"), *pair, "side", "key", "node", "component").join(_as_bytes(sets), "node")
    return dealt.groupBy("call", "alone", "p", "q").applyInPandas(lambda rows: _links_of_buckets(rows, percent), "a long, b long")


def _as_bytes(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [x.values.to_numpy().tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["node", "shingles"])

    return sets.mapInArrow(run, "node long, shingles binary")


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`; pairs of a Jaccard
    similarity of `percent` or more are linked."""
    return _grouped(docs, percent).drop("text_key")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """The same with text_key, which tells rows that repeat a doc_id apart."""
    fit = Fit(percent)
    all_ = written(sketches(docs, fit), "sketches")
    # One row per distinct shingle set, pre-aggregated before the shuffle; its smallest doc_id, null
    # last. Numbered by where the row is written, so numbers are distinct, and fixed from then on.
    best = F.min(F.struct(F.isnull("doc_id"), "doc_id", "text_key", "bands", "n_shingles")).alias("best")
    reps = all_.where("set_key is not null").groupBy("set_key").agg(best).withColumn("node", F.monotonically_increasing_id())
    reps = written(reps.select("set_key", "node", F.col("best.doc_id").alias("rep"), F.col("best.text_key").alias("rep_key"), "best.bands", "best.n_shingles"), "classes")
    slots = reps.select(F.explode("bands").alias("key"), "node")
    # Written, so that the join has a plain exchange on either side: Spark can then split a huge
    # bucket's partition.
    buckets = written(slots.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi"), "buckets")
    members = written(slots.join(buckets, "key"), "members")
    pairs = members.select("node", F.explode(F.array("lo", "hi")).alias("b")).where("node != b").select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    wanted = members.select("node").distinct().join(reps.select("node", "rep", "rep_key"), "node")
    sets = written(_sets_of(docs, wanted), "sets")
    links = written(_verified(pairs, sets, percent), "links")
    labels = components(links)
    more = written(_residual_links(members.select("key", "node"), labels, reps, sets, percent), "more")
    if not more.isEmpty():
        labels = components(links.union(more))
    # A component is named by the smallest doc_id of its classes.
    linked = labels.join(reps.select("node", "set_key", "rep"), "node")
    names = written(linked.groupBy("component").agg(F.min("rep").alias("name")), "names")
    named = linked.join(names, "component").select("set_key", F.col("name").alias("component"))
    alone = reps.join(labels, "node", "left_anti").select("set_key", F.col("rep").alias("component"))
    found = all_.select("doc_id", "n_shingles", "set_key", "text_key").join(named.union(alone), "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each group, the smallest doc_id."""
    stay = _grouped(docs, percent).where("kept").select(F.col("doc_id").alias("__stay_id"), F.col("text_key").alias("__stay_key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(stay["__stay_id"]) & (F.xxhash64(docs["text"].cast("string")) == stay["__stay_key"])
    return docs.join(stay, same, "left_semi")


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))

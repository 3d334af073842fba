"""Best-fit packing of documents into sequences, online and in bounded space.

Documents become token ids and a closing id. Those longer than a sequence are cut into full
pieces, the first taking the remainder. Pieces arrive in hashed order at a fixed number of open
bins. A bitset has one bit per amount of free space that some open bin has: the lowest set bit at
or above a piece's length is the best fit. If none fits, a new bin opens; if all are in use, the
fullest closes first. Texts don't take part: only lengths are shuffled.

Each task packs `PIECES_PER_TASK` pieces or so; a task of that size leaves at most `OPEN_BINS`
bins that later pieces could have filled.

Instead of the hashed order, pieces may arrive in the order of a column, as the pipeline's do in
training order. Each task then packs one range of it, and sequence ids rise with the ranges, of
which there are `LEAST_RANGES` at least; inside a range, with the time a sequence is opened.

Defined cases: a null text counts as empty and makes the closing id alone; equal rows are packed
each for itself; of bins with equal free space, the one last opened or refilled is taken; other columns
are not read; an empty table gives no rows. A very long text is held whole by the task that encodes it,
with its ids, 4 bytes each and some 30 while they are made; only its pieces' lengths go on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty, written
from .tokens import encode, vocabulary_path

LENGTH = 2048
CLOSING_ID = 0
OPEN_BINS = 1024
PIECES_PER_TASK = 100_000
LEAST_RANGES = 16


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; the first may be shorter."""
    first = n % length or length
    return [(0, first), *((at, length) for at in range(first, n, length))]


def encoded_pieces(docs: DataFrame, path: str, length: int = LENGTH, order: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the column `order`, if given: one row per piece,
    without a shuffle."""
    orders = [order] if order else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py(), path), np.uint32(CLOSING_ID)).astype("<u4")
                for no, (at, n) in enumerate(cut(len(ids), length)):
                    row.append(k)
                    piece.append(no)
                    start.append(at)
                    size.append(n)
                    crc.append(zlib.crc32(ids[at : at + n].tobytes()))
            columns = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
            columns += [batch.column(2 + k).take(pa.array(row, pa.int32())) for k in range(len(orders))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", *orders])

    kind = lambda c: docs.schema[c].dataType.simpleString()
    kinds = ", ".join([f"doc_id {kind('doc_id')}, piece int, start long, length long, ids_crc32 long", *(f"{c} {kind(c)}" for c in orders)])
    return docs.select("doc_id", text_or_empty().alias("text"), *orders).mapInArrow(run, kinds)


class OpenBins:
    """A fixed number of open bins; `place` says which bin a piece goes to, and where in it."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        bin_ = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_

    def place(self, n: int) -> tuple[int, int]:
        """Bin and offset of a piece of n ids, n at most the length."""
        if fits := self.bits >> n:
            free = n + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            bin_, free, self.made = self.made, self.length, self.made + 1
        if left := free - n:  # a full bin closes
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.length - free


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK, order: str | None = None) -> DataFrame:
    """`pieces` with sequence_id and offset; they arrive in the order of a column, or hashed."""
    tasks = max(1, round(pieces.count() / per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, open_bins)
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(batch.schema.get_field_index("length")).to_numpy()
            placed = np.array([bins.place(n) for n in sizes.tolist()], np.int64)
            part = batch.column(batch.schema.get_field_index("part")).to_numpy()
            ids = part.astype(np.int64) << 40 | placed[:, 0]
            rows = batch.drop_columns(["part", "h"])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids), pa.array(placed[:, 1])], [*rows.schema.names, "sequence_id", "offset"])

    hashed = pieces.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32"))
    if order:
        # The ranges' bounds are drawn once a job. Ties of the order are split by the other keys.
        keys = [order, "doc_id", "piece", "h"]
        hashed = hashed.repartitionByRange(max(LEAST_RANGES, tasks), *keys)
    else:
        # `part` is a function of the row alone: a retried task gets the same rows and packs them alike.
        keys = ["h", "doc_id", "piece"]
        hashed = hashed.repartition(tasks, "h")
    dealt = hashed.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, order: str | None = None) -> DataFrame:
    """One row per piece of every row of `docs`: where its ids go."""
    return pack(written(encoded_pieces(docs, path or vocabulary_path(), length, order), "pieces"), length, order=order)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

"""Substring deduplication: words in 20-word windows that already started earlier are removed.

Every window of a document has a Rabin-Karp hash (sums modulo 2**64, and 16 bits of a second
polynomial), and a core: the least hash among the runs of `core_width` words in it. Equal windows
have equal cores, and neighbouring windows mostly share theirs, so there are six times fewer cores
than windows. Spark counts in two steps, and texts are shuffled once, by doc_id:

1. Documents' distinct cores are counted; those of one document alone can't be in a repeated
   window. A join tells every document which of its cores others have too.
2. Windows around those cores go out by hash, a row each, and an aggregation finds the smallest
   doc_id that has each. That document is told that it keeps the window.
3. A document's windows around shared cores that it doesn't keep, and those that started before
   in itself, are repeated. They merge into maximal intervals of words, and the rest of the text
   is joined.

Both aggregations combine before they shuffle, so a passage in every document is a row a task.
Cores are compared by as many bits as keep chance meetings rare: they only cost work, as windows
are told apart by 80 bits. Among n windows around shared cores, n**2 / 2**81 pairs are expected to
be mistaken for equal (4e-10 for the largest test table, 4 for ten trillion windows).

Defined cases: a null text has no words and an empty kept_text; texts shorter than a window are
kept; a null doc_id sorts below all others; rows that repeat a doc_id are documents of their own,
neither of which is earlier, so they don't remove each other's windows, and equal rows get equal
results; other columns are not read; an empty table gives no rows. Where ids repeat, lists of cores
and windows belong to a doc_id and text, so that each row gets its own, and rows that are equal share
theirs. A text is held whole by the task that cuts it, with about 17 bytes for each of its bytes where
words are long and 63 where they are single letters; `BATCH_BYTES` bounds how many shorter ones are
held at once, but one text always is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty, written
from .words import OTHER_BASE, Words, mix64, slices, window_hashes

WIDTH = 20
BATCH_BYTES = 2 << 20
#: Below all document numbers; stands for a null doc_id.
_NONE = np.iinfo(np.int64).min


def core_width(width: int) -> int:
    return max(1, 2 * width // 5)


def core_bits(size: int) -> int:
    """Bits of a core's key, for texts of `size` bytes: one pair in 128 or fewer meets by chance."""
    return min(63, max(16, (size // 32).bit_length() + 7))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, low = 1, x
    while 2 * span <= width:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    n = len(x) - width + 1
    return np.minimum(low[:n], low[width - span : width - span + n])


class Windows:
    """The windows of some texts: place of the first word, row, hash, tag, and key of the core."""

    def __init__(self, texts: list[bytes], width: int, bits: int):
        self.width, self.words = width, Words(texts)
        hashes, first = self.words.hashes(), self.words.first
        n = np.diff(first)
        count = max(0, len(hashes) - width + 1)
        # windows that lie in one text: all that start early enough before its end
        self.at = np.flatnonzero(np.arange(count) + width <= np.repeat(first[1:], n)[:count])
        self.row = np.repeat(np.arange(len(texts)), n)[self.at]
        self.cuts = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.hash = window_hashes(hashes, width)[self.at].view(np.int64)
        self.tag = (window_hashes(hashes, width, OTHER_BASE)[self.at] >> np.uint64(48)).astype(np.int32)
        if len(self.at):
            inner = core_width(width)
            least = _sliding_min(window_hashes(hashes, inner), width - inner + 1)[self.at]
            self.core = (mix64(least) >> np.uint64(64 - bits)).view(np.int64)
        else:
            self.core = np.empty(0, np.int64)

    def cores(self) -> tuple[np.ndarray, np.ndarray]:
        """row, core: the distinct cores of each row."""
        new = np.ones(len(self.at), bool)
        new[1:] = (self.core[1:] != self.core[:-1]) | (self.row[1:] != self.row[:-1])
        row, core = self.row[new], self.core[new]
        order = np.lexsort((core, row))
        row, core = row[order], core[order]
        new = np.ones(len(row), bool)
        new[1:] = (core[1:] != core[:-1]) | (row[1:] != row[:-1])
        return row[new], core[new]

    def among(self, values: np.ndarray, lists: list) -> np.ndarray:
        """Whether each window's value is in its row's list, which may be null."""
        out = np.zeros(len(self.at), bool)
        for k, some in enumerate(lists):
            a, b = self.cuts[k], self.cuts[k + 1]
            if a < b and some is not None and len(some):
                out[a:b] = np.isin(values[a:b], some)
        return out

    def again(self) -> np.ndarray:
        """Windows that started before in the same row."""
        order = np.lexsort((self.hash, self.row))  # stable: equal ones stay in order of start
        h, r = self.hash[order], self.row[order]
        out = np.zeros(len(order), bool)
        out[order[1:]] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
        return out

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """Which words the repeated windows cover."""
        step = np.zeros(len(self.words.start) + 1, np.int32)
        step[self.at[repeated]] += 1  # starts are distinct
        step[self.at[repeated] + self.width] -= 1
        return np.cumsum(step[:-1]) > 0

    def results(self, gone: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int]], str]]:
        """n_words, n_removed, spans of removed words, kept text of every row."""
        w, buf = self.words, self.words.buf.copy()
        buf[w.end] = 32  # the byte after a word, always a space of some kind
        step = np.zeros(len(buf) + 1, np.int8)
        step[w.start[~gone]] += 1
        step[w.end[~gone] + 1] -= 1
        keep = np.cumsum(step[:-1], dtype=np.int8) > 0
        text = buf[keep].tobytes()
        length = np.cumsum(np.concatenate([[0], np.where(gone, 0, w.end - w.start + 1)]))
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            spans: list[tuple[int, int]] = []
            n = int(np.count_nonzero(gone[a:b]))
            if n:
                part = np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)
                spans = list(zip(np.flatnonzero(part == 1).tolist(), np.flatnonzero(part == -1).tolist(), strict=True))
            yield int(b - a), n, spans, text[length[a] : max(length[a], length[b] - 1)].decode()


def _lists(batch: pa.RecordBatch, column: int, a: int, b: int) -> list:
    """Rows a to b of a column of lists as arrays, or None where null."""
    return [batch.column(column)[k].values.to_numpy() if batch.column(column)[k].is_valid else None for k in range(a, b)]


def _cores(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """core, doc, own: the distinct cores of each row of doc, own, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = (batch.column(k).to_numpy() for k in (0, 1))
            for a, _b, texts in slices(batch, 2, BATCH_BYTES):
                row, core = Windows(texts, width, bits).cores()
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(ids[a + row]), pa.array(own[a + row])], ["core", "doc", "own"])

    return docs.select("doc", "own", "text").mapInArrow(run, "core long, doc long, own long")


def _around(told: DataFrame, width: int, bits: int) -> DataFrame:
    """hash, tag, doc, own: the windows around shared cores. told: doc, own, text, cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = (batch.column(k).to_numpy() for k in (0, 1))
            for a, b, texts in slices(batch, 2, BATCH_BYTES):
                w = Windows(texts, width, bits)
                mine = w.among(w.core, _lists(batch, 3, a, b))
                row = a + w.row[mine]
                yield pa.RecordBatch.from_arrays([pa.array(w.hash[mine]), pa.array(w.tag[mine]), pa.array(ids[row]), pa.array(own[row])], ["hash", "tag", "doc", "own"])

    return told.select("doc", "own", "text", "cores").mapInArrow(run, "hash long, tag int, doc long, own long")


def _cut(told: DataFrame, width: int, bits: int) -> DataFrame:
    """The results. told: doc, text, cores, keeps (hashes of the windows that the row keeps)."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string()]
    names = ["doc_id", "n_words", "n_removed", "spans", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if x == _NONE else x for x in batch.column(0).to_pylist()]
            for a, b, texts in slices(batch, 1, BATCH_BYTES):
                w = Windows(texts, width, bits)
                shared = w.among(w.core, _lists(batch, 2, a, b))
                kept = w.among(w.hash, _lists(batch, 3, a, b))
                rows = list(w.results(w.removed(w.again() | (shared & ~kept))))
                cols = [ids[a:b], *zip(*rows, strict=True)]
                cols[3] = [[{"start": x, "end": y} for x, y in spans] for spans in cols[3]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
    return told.select("doc", "text", "cores", "keeps").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, spans (of removed words), kept_text of every row of `docs`."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NONE))).alias("doc"), text_or_empty().alias("text"))
    by_id = texts.groupBy("doc").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    size, most = by_id.agg(F.coalesce(F.sum("size"), F.lit(0)), F.max("n")).first()
    bits = core_bits(size)
    # A row is named by doc and own: 0, or a hash of its text where others have its doc_id.
    ids_repeat = (most or 0) > 1
    if ids_repeat:
        repeated = written(by_id.where("n > 1").select("doc", F.lit(True).alias("again")), "repeated")
        own = F.when(F.col("again"), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0))
        texts = texts.join(repeated, "doc", "left").select("doc", own.alias("own"), "text")
    else:
        texts = texts.select("doc", F.lit(0).cast("long").alias("own"), "text")
    row = ["doc", "own"] if ids_repeat else ["doc"]
    cores = _cores(texts, width, bits)
    # Written, so that the join has a plain exchange on either side: Spark can then split the rows
    # of a core that most documents have.
    shared = written(cores.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    # Never more than a row's words: rows of one name are equal, and a set takes what they share once.
    gathered = F.collect_set("core") if ids_repeat else F.collect_list("core")
    mine = cores.join(shared, "core").groupBy(*row).agg(gathered.alias("cores"))
    # The same join twice, with one exchange of the texts.
    told = texts.join(mine, row, "left")
    around = _around(told, width, bits)
    windows = around.groupBy("hash", "tag")
    if not ids_repeat:
        first = windows.agg(F.min("doc").alias("doc"))
    else:
        # Of a doc_id that comes in several rows, all rows that have its window keep it.
        first = written(windows.agg(F.min(F.struct(*row)).alias("first")).select("hash", "tag", "first.*"), "first")
        also = around.where("own != 0").join(first.where("own != 0").select("hash", "tag", "doc"), ["hash", "tag", "doc"])
        first = first.where("own = 0").select(*row, "hash").union(also.select(*row, "hash").distinct())
    keeps = first.groupBy(*row).agg(F.collect_list("hash").alias("keeps"))
    return _cut(told.join(keeps, row, "left"), width, bits)


def query(spark, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

"""Line deduplication: lines that many documents share stay in one of them.

1. Every text is split into lines, and each line is normalised to a key. Keys that are long enough
   become rows, one for each document and key, with a 128-bit hash of the key and the line's
   positions in the text. This table is written; it is far smaller than the texts.
2. Distinct documents are counted for each hash, (hash, document) pairs first, so that a line in
   every document is counted by many tasks. Hashes over the threshold keep their largest doc_id.
3. A join tells every other document which of its positions go. Positions are collected by
   document, never more than the text has lines, and joined to the texts, which are shuffled this
   once.
4. The text is split again and the lines that stay are put together in order.

Defined cases: a null text is an empty one, which has one empty line; rows that share a doc_id are
one document when documents are counted, and where that document is the one that keeps the line, all
of its rows do; equal rows get equal results; a null doc_id is one document that sorts below all
others; a line that occurs several times in the document that keeps it stays several times; lines
end at a newline only, so a carriage return before it belongs to the line, though not to its key;
other columns are not read; an empty table gives no rows. A text is held whole by the task that
splits it, with about 100 bytes for each of its lines besides.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

LEAST_DOCS = 3
LEAST_CHARS = 20
#: Fixed value: what is stripped off both ends of a line.
_ENDS = b" \t\n\x0b\x0c\r"
#: Below all document numbers; stands for a null doc_id.
_NONE = np.iinfo(np.int64).min


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The normalised line's hash, or None if it is too short to count."""
    key = line.strip(_ENDS).lower()  # bytes: only A-Z change
    if len(key) < least_chars or (len(key) < 4 * least_chars and len(key.decode()) < least_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _texts(docs: DataFrame) -> DataFrame:
    """doc, th, text: th tells rows of one doc_id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NONE))).alias("doc"), F.xxhash64(text_or_empty()).alias("th"), text_or_empty().cast("binary").alias("text"))


def _keyed_lines(texts: DataFrame, least_chars: int) -> DataFrame:
    """doc, th, key, places: a row for each key of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key, places = [], [], []
            for k, text in enumerate(batch.column(2)):
                found: dict[bytes, list[int]] = defaultdict(list)
                for at, line in enumerate(text.as_py().split(b"\n")):
                    if (h := line_key(line, least_chars)) is not None:
                        found[h].append(at)
                row += [k] * len(found)
                key += found.keys()
                places += found.values()
            own = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(key, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["doc", "th", "key", "places"])

    return texts.mapInArrow(run, "doc long, th long, key binary, places array<int>")


def _reassembled(told: DataFrame) -> DataFrame:
    """The results. told: doc, text, gone (lists of positions, or null)."""
    names = ["doc_id", "n_lines", "n_dropped", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if x == _NONE else x for x in batch.column(0).to_pylist()]
            n, dropped, kept = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2), strict=True):
                lines = text.as_py().split(b"\n")
                stays = np.ones(len(lines), bool)
                if gone.is_valid:
                    stays[gone.values.flatten().to_numpy()] = False
                n.append(len(lines))
                dropped.append(len(lines) - int(stays.sum()))
                kept.append(b"\n".join([line for line, stay in zip(lines, stays.tolist(), strict=True) if stay]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((ids, n, dropped, kept), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names)

    return told.select("doc", "text", "gone").mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_text string")


def drop_shared_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every row of `docs`."""
    texts = _texts(docs)
    lines = written(_keyed_lines(texts, least_chars), "lines")
    counts = lines.select("key", "doc").distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
    # Written, so that the join has a plain exchange on either side: Spark can then split the rows
    # of a line that most documents have.
    shared = written(counts.where(F.col("n") >= least_docs).select("key", "keeper"), "shared")
    gone = lines.join(shared, "key").where("doc != keeper").groupBy("doc", "th").agg(F.collect_set("places").alias("gone"))
    return _reassembled(texts.join(gone, ["doc", "th"], "left"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = drop_shared_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l),
f AS (SELECT line_key, max(doc_id) AS keeper FROM k WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS gone FROM k LEFT JOIN f ON k.line_key = f.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

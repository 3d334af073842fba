"""Exact deduplication with composable polynomial fingerprints.

A text's UTF-8 bytes are cut into fixed chunks. Each chunk hashes to sum(b[i] * B**(n-1-i))
modulo two 31-bit primes, and the chunks' hashes combine by H(xy) = H(x) * B**len(y) + H(y). A
text of up to `HUGE` bytes is hashed by the task that reads it, chunk after chunk. The chunks of a
longer one become rows, which many tasks hash at once; each is shifted by the length behind it, and
Spark sums them up: the result is the same.

Equal fingerprints only nominate: members of a group are compared chunk by chunk with the group's
representative, as rows of a join, so no task holds two whole texts or a whole group. Huge texts
are cut before that join's shuffle. Members that differ from their representative form groups of
their own, until none differs.

Defined cases: a null text counts as empty; empty texts are equal; a null doc_id sorts below all
others; rows that repeat the staying doc_id with the same text count as that row and stay with
it; other columns, whatever their names, pass through `dedup`; an empty table gives no rows. A very
long text is held whole only by the task that reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, table, text_or_empty, written

#: Two Mersenne-size primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 1 << 16
#: Bytes above which a text's chunks are hashed as rows.
HUGE = 4 << 20
SALT_ROWS = 256


class Fingerprint:
    """Chunk hashes and their combination; `bits` keeps only the low bits, to test collisions."""

    def __init__(self, chunk: int = CHUNK, bits: int = 31):
        self.chunk, self.mask = chunk, (1 << bits) - 1
        self.powers = []
        for p, b in zip(PRIMES, BASES, strict=True):
            pw, out = 1, np.empty(chunk, np.uint64)
            for i in range(chunk - 1, -1, -1):
                out[i] = pw
                pw = pw * b % p
            self.powers.append(out)

    def of_chunk(self, data: np.ndarray) -> tuple[int, int]:
        n = len(data)
        wide = data.astype(np.uint64)
        return tuple(int((wide * pw[self.chunk - n :]).sum() % np.uint64(p)) for p, pw in zip(PRIMES, self.powers, strict=True))

    @staticmethod
    def combine(left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
        return tuple((x * pow(b, right_len, p) + y) % p for x, y, p, b in zip(left, right, PRIMES, BASES, strict=True))

    def of(self, data: bytes) -> int:
        buf, out = np.frombuffer(data, np.uint8), (0, 0)
        for at in range(0, len(buf), self.chunk):
            part = buf[at : at + self.chunk]
            out = self.combine(out, self.of_chunk(part), len(part))
        return (out[0] & self.mask) << 31 | (out[1] & self.mask)


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def fingerprints(docs: DataFrame, bits: int = 31, chunk: int = CHUNK, huge: int = HUGE) -> DataFrame:
    """doc_id, fp, n_bytes, text_sha256 of every row. Texts of up to `huge` bytes need one pass
    without a shuffle; of longer ones, only chunks are shuffled."""
    names = ["doc_id", "fp", "n_bytes", "text_sha256", "no", "piece"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Fingerprint(chunk, bits)
        for batch in batches:
            texts, long, small = batch.column(1).cast(pa.large_binary()), [], []
            fp, size, sha = [], [], []
            for row, x in enumerate(texts):
                data = x.as_py()
                if len(data) > huge:
                    long.append(row)
                    continue
                small.append(row)
                fp.append(made.of(data))
                size.append(len(data))
                sha.append(hashlib.sha256(data).hexdigest())
            none = [None] * len(small)
            ids = batch.column(0).take(pa.array(small, pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, k) for x, k in zip((fp, size, sha, none, none), kinds, strict=True))], names)
            for row in long:
                data = texts[row].as_py()
                digest = hashlib.sha256(data).hexdigest()
                for at in range(0, len(data), chunk * 64):
                    cut = [data[k : k + chunk] for k in range(at, min(at + chunk * 64, len(data)), chunk)]
                    n, no = len(cut), list(range(at // chunk, at // chunk + len(cut)))
                    ids = batch.column(0).take(pa.array([row] * n, pa.int32()))
                    cols = ([None] * n, [len(data)] * n, [digest] * n, no, cut)
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names)

    kind = _kind(docs)
    found = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, fp long, n_bytes long, text_sha256 string, no long, piece binary")
    found = written(found, "prints")
    whole, cut = found.where("piece is null").select(*names[:4]), found.where("piece is not null")
    if cut.isEmpty():
        return whole
    return whole.union(_combined(cut, bits, chunk))


def _dealt(cut: DataFrame) -> DataFrame:
    """Chunks dealt one by one, so that those of one text go to many tasks."""
    return cut.repartition(partitions(cut.sparkSession), "doc_id", "text_sha256", "no")


def _combined(cut: DataFrame, bits: int, chunk: int) -> DataFrame:
    """The fingerprints of texts that come as rows of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Fingerprint(chunk, bits)
        for batch in batches:
            shifted = []
            for size, no, piece in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4)), strict=True):
                own = made.of_chunk(np.frombuffer(piece, np.uint8))
                shifted.append(made.combine(own, (0, 0), size - no * chunk - len(piece)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 2, 3)), *(pa.array(list(x), pa.int64()) for x in zip(*shifted, strict=True))], ["doc_id", "n_bytes", "text_sha256", "no", "x", "y"])

    hashed = _dealt(cut.select("doc_id", "n_bytes", "text_sha256", "no", "piece")).mapInArrow(run, f"doc_id {_kind(cut)}, n_bytes long, text_sha256 string, no long, x long, y long")
    # Rows that repeat a doc_id and text are told by their first chunks; each adds the same sum.
    copies = F.sum((F.col("no") == 0).cast("long"))
    low = lambda c, p: F.pmod(F.call_function("div", F.sum(c), copies), F.lit(p)).bitwiseAND(F.lit((1 << bits) - 1))
    sums = hashed.groupBy("doc_id", "n_bytes", "text_sha256").agg(
        (F.shiftleft(low("x", PRIMES[0]), 31).bitwiseOR(low("y", PRIMES[1]))).alias("fp"), copies.alias("copies")
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return sums.select("doc_id", "fp", "n_bytes", "text_sha256", each.alias("copy")).drop("copy")


def _pieces(rows: DataFrame, size: int) -> DataFrame:
    """The rows' texts as numbered pieces of `size` bytes; an empty text has one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column(0)[row].as_py().encode()
                for first in range(0, max(1, len(data)), size * 64):
                    cut = [data[at : at + size] for at in range(first, min(first + size * 64, max(1, len(data))), size)]
                    keep = pa.array([row] * len(cut), pa.int32())
                    rest = [batch.column(i).take(keep) for i in range(1, batch.num_columns)]
                    no = pa.array(range(first // size, first // size + len(cut)), pa.int64())
                    yield pa.RecordBatch.from_arrays([*rest, no, pa.array(cut, pa.binary())], [*names, "no", "piece"])

    names = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select("text", *names).mapInArrow(run, f"{kinds}, no long, piece binary")


def _verified(docs: DataFrame, members: DataFrame, size: int, huge: int) -> DataFrame:
    """Of `members` (doc_id, text_sha256, n_bytes, gid, is_rep, salts, n_rows), those that differ
    from their group's representative in some piece.

    The representative's pieces are repeated once per SALT_ROWS members, so a huge group of
    copies is compared by many tasks. Where several rows are the representative, one stands for all.
    """
    texts = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text")).withColumn("sha", F.sha2("text", 256))
    same_row = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))
    few = texts.where(F.octet_length("text") <= huge).join(members.where(F.col("n_bytes") <= huge), same_row)
    pieces = _pieces(few.drop("id", "sha", "n_bytes"), size)
    long = members.where(F.col("n_bytes") > huge)
    if not long.isEmpty():
        cut = _pieces(texts.where(F.octet_length("text") > huge), size)
        pieces = pieces.unionByName(cut.join(long, same_row).drop("id", "sha", "n_bytes"))
    own = F.pmod(F.xxhash64("doc_id", "text_sha256"), F.col("salts")).cast("int")
    theirs = pieces.where("not is_rep").select("doc_id", "text_sha256", "gid", own.alias("salt"), "no", "piece")
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    reps = pieces.where("is_rep")
    if not members.where("is_rep and n_rows > 1").isEmpty():
        reps = reps.where("n_rows = 1").union(reps.where("n_rows > 1").dropDuplicates(["gid", "no"]))
    reps = reps.select("gid", salt, "no", F.col("piece").alias("rep_piece"))
    same = theirs.join(reps, ["gid", "salt", "no"], "left")
    return same.where(~F.col("piece").eqNullSafe(F.col("rep_piece"))).select("doc_id", "text_sha256", "gid").distinct()


def exact_groups(docs: DataFrame, bits: int = 31, chunk: int = CHUNK, huge: int = HUGE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs`."""
    key = ["fp", "n_bytes", "cls"]
    prints = fingerprints(docs, bits, chunk, huge).withColumn("cls", F.lit(0))
    for level in range(1, 1 << 31):
        # Written, so that the joins below have a plain exchange on either side: Spark can then
        # split a huge group's partition.
        groups = written(prints.groupBy(*key).agg(F.max(F.struct("doc_id", "text_sha256")).alias("rep"), F.count("*").alias("group_size")), "groups")
        several = groups.where("group_size > 1 and n_bytes > 0").select(
            *key, "rep", F.concat_ws("/", *key).alias("gid"), F.ceil(F.col("group_size") / F.lit(SALT_ROWS)).cast("int").alias("salts")
        )
        is_rep = F.struct("doc_id", "text_sha256").eqNullSafe(F.col("rep")).alias("is_rep")
        members = prints.join(several, key).groupBy("doc_id", "text_sha256", "n_bytes", "gid", is_rep, "salts").agg(F.count("*").alias("n_rows"))
        differs = written(_verified(docs, members, chunk, huge), "differs")
        if differs.isEmpty():
            break
        # Not the representative's text after all: the next class of the same fingerprint.
        gid = F.concat_ws("/", *key).alias("gid")
        moved = prints.select("*", gid).join(
            differs.select(F.col("doc_id").alias("m_id"), F.col("text_sha256").alias("m_sha"), F.col("gid").alias("m_gid")),
            F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_sha256") == F.col("m_sha")) & (F.col("gid") == F.col("m_gid")),
            "left",
        )
        cls = F.when(F.col("m_gid").isNotNull(), F.lit(level)).otherwise(F.col("cls")).alias("cls")
        prints = written(moved.select("doc_id", "fp", "n_bytes", "text_sha256", cls), "classes")
    return prints.join(groups, key).select(
        "doc_id",
        F.col("rep.doc_id").alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("rep.doc_id")).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts, the largest doc_id."""
    stay = exact_groups(docs).where("kept").select(F.col("doc_id").alias("__stay_id"), F.col("text_sha256").alias("__stay_sha")).distinct()
    sha = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["__stay_id"]) & (sha == stay["__stay_sha"]), "left_semi")


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.t = g.t
"""

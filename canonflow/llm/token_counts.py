"""Exact token counts from a histogram of encoded lengths.

Tasks count lengths before the shuffle, so one row per length and task moves. Suffix sums over
the histogram answer totals, quantiles and truncated totals for every context limit.

Defined cases: a null text counts as empty and has length 0; repeated rows count each; other
columns are not read; there is nothing to tie, as equal lengths are one row; an empty table gives an
empty histogram, and answers of 0 or null. A very long text is encoded piece by piece (`tokens.PIECE`),
but its ids are held whole, four bytes each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty
from .tokens import encode, vocabulary_path


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """n_tokens, n_docs."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            seen.update(len(encode(x.as_py(), path)) for x in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["n_tokens", "n_docs"])

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(run, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length: documents and tokens of at least that length, the total if every document
    is cut to it, and the share of documents up to it. A histogram has a row per distinct length,
    so its running sums are taken in one task."""
    up = Window.orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("n_docs") * F.col("n_tokens")
    h = histogram.withColumns({
        "docs_at_least": F.sum("n_docs").over(up), "tokens_at_least": F.sum(tokens).over(up),
        "all_docs": F.sum("n_docs").over(whole), "total_tokens": F.sum(tokens).over(whole),
    })
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    share = (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")
    return h.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_total"), share.alias("share_up_to"), "total_tokens")


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """One row: the tokens left if every document is cut to each of the limits."""
    least = lambda n: F.coalesce(F.sum(F.col("n_docs") * F.least(F.col("n_tokens"), F.lit(n))), F.lit(0)).alias(f"at_{n}")
    return histogram.agg(*[least(n) for n in limits])


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share q of documents doesn't exceed."""
    return with_suffix_sums(histogram).where(F.col("share_up_to") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def query(spark, sf_dir: str) -> DataFrame:
    return with_suffix_sums(length_histogram(table(spark, sf_dir, "documents")))

"""The compiled transform on a stream: it keeps no state per record, so a stream of payload files
runs the same plan, and each micro-batch is upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.sink import merge
from ..plans.transform import Transform
from ..rulebook import Rulebook
from ..sources.landing import split_dsv


def stream_dsv(spark: SparkSession, pattern: str, book: Rulebook) -> DataFrame:
    """A stream of records from delimited payloads as they land."""
    lines = spark.readStream.option("lineSep", "\n").text(pattern)
    return split_dsv(lines, "value", [f["name"] for f in book.source.get("fields", [])], book.format.get("delimiter", ","))


def start_merge(records: DataFrame, book: Rulebook, checkpoint: str, provider: str = "delta", ingested_at: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Transforms a stream and upserts every micro-batch. The upsert is idempotent, so a batch
    that is run again after a failure changes nothing."""
    plan = Transform(book)

    def load(batch: DataFrame, _id: int) -> None:
        merge(plan.rows(batch, ingested_at=ingested_at), book, provider, count_table=False)

    writer = records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

"""Shared by the text operators: table access, written tables between jobs, fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch

#: Words are runs of characters other than six kinds of space.
WORD_SQL = r"[^\x20\x09-\x0D]+"
SPACE_SQL = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows read from a table in the shared folder: lineage ends there, and a lost
    executor costs only the tasks it was running."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def free(columns: list[str], name: str) -> str:
    """`name`, with underscores added until no column's name begins with it."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name

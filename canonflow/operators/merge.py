"""Typing, deduplication and upsert of staged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timestamps import event_date, instant
from ..rulebook import Rulebook, RulebookError

#: Canonical types, and families that are coded as text.
_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}
_CODED = ("enum:", "vocab:", "registry:")


def spark_type(name: str) -> T.DataType:
    if name.startswith(_CODED):
        return T.StringType()
    if name not in _TYPES:
        raise RulebookError(f"unknown canonical type {name!r}")
    return _TYPES[name]


def table_schema(book: Rulebook) -> T.StructType:
    """The fact table's columns, from the canonical schema, and event_date."""
    fields = book.canonical["entities"][book.target["table"]]["fields"]
    return T.StructType([*(T.StructField(f["name"], spark_type(f["type"])) for f in fields), T.StructField("event_date", T.DateType())])


def _typed(staged: DataFrame, field: T.StructField) -> Column:
    if field.name not in staged.columns:
        if field.name == "event_date" and "ts_utc" in staged.columns:
            return event_date(F.col("ts_utc").cast("string"))
        return F.lit(None).cast(field.dataType)
    c = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType) and isinstance(staged.schema[field.name].dataType, T.StringType):
        return instant(c)  # canonical text, in which a date may carry a Z
    if field.name == "event_date":
        return F.when(c.cast("string") != "unknown", c.cast("string").cast("date"))
    return c.cast(field.dataType)


def typed_projection(staged: DataFrame, schema: T.StructType) -> DataFrame:
    """Every column of `schema`, cast; what isn't staged is null."""
    return staged.select(*[_typed(staged, f).alias(f.name) for f in schema])


def keyed(rows: DataFrame, key: list[str]) -> DataFrame:
    """`rows`; a null in the key raises, since it would be inserted anew by every merge."""
    missing = F.raise_error(F.lit(f"null in the merge key {key}")).cast("boolean")
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return rows.where(F.when(whole, F.lit(True)).otherwise(missing))


def dedupe_latest(rows: DataFrame, key: list[str], newest: str = "ingested_at") -> DataFrame:
    """One row per key: the newest, ties broken by all other columns."""
    rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in key and c != newest]
    w = Window.partitionBy(*key).orderBy(F.col(newest).desc_nulls_last(), *rest)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert(target: DataFrame, staged: DataFrame, key: list[str]) -> DataFrame:
    """Staged rows, and target rows whose key isn't staged. Keys must be unique in `staged`."""
    return target.join(staged.select(*key), key, "left_anti").select(*target.columns).unionByName(staged.select(*target.columns))

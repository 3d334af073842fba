"""What consumers read: dimensions, serving views and snapshots, checks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import mean
from ..functions.timestamps import instant
from ..rulebook import Rulebook
from ..scratch import scratch
from .sink import create_schema, table_sql, told, upsert_table
from .transform import Transform


def dimension(spark: SparkSession, book: Rulebook, vocabulary: str, columns: list[dict]) -> DataFrame:
    """A vocabulary as rows in key order; `from: __key__` is the key, a missing attribute null.
    A rulebook's vocabulary is small: it comes from a file that people write."""
    terms = book.terms(vocabulary)
    text = lambda v: None if v is None else str(v)
    rows = [[key if c["from"] == "__key__" else text((terms[key] or {}).get(c["from"])) for c in columns] for key in sorted(terms)]
    fields = [T.StructField(c["name"], T.StringType(), True, {"comment": c["comment"]} if c.get("comment") else None) for c in columns]
    return spark.createDataFrame(rows, T.StructType(fields)).coalesce(1)


def publish_dimensions(spark: SparkSession, book: Rulebook, provider: str = "delta") -> list[str]:
    """Every reference dimension as a table, names sorted."""
    made = []
    for name, spec in sorted((book.target.get("reference_dimensions") or {}).items()):
        schema = spec.get("schema") or book.target["schema"]
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {book.schema_name(schema)}")
        full = f"{book.schema_name(schema)}.{name}"
        dimension(spark, book, spec["source_vocabulary"], spec["columns"]).write.mode("overwrite").format(provider).saveAsTable(full)
        made.append(full)
    return made


def described(fact: DataFrame, dim: DataFrame, on: str = "quantity") -> DataFrame:
    """The fact with its terms' attributes; terms without an entry keep nulls."""
    return fact.join(dim, on, "left")


#: What names a minute of a device.
MINUTE = ["source_vendor", "device_id", "minute"]


def _name(quantity: str, phase: str) -> str:
    return quantity if phase == "none" else f"{quantity}_{phase.lower()}"


def minute_wide(fact: DataFrame, pairs: list[tuple[str, str]], moment: str = "ts_utc", digits: int | None = None) -> DataFrame:
    """vendor, device, minute and the mean of each (quantity, phase), of rows that are ok. moment: the
    column with a row's instant; canonical text is parsed. digits: values are summed to so many
    places exactly, so that a mean doesn't depend on their order."""
    ts = instant(F.col(moment)) if isinstance(fact.schema[moment].dataType, T.StringType) else F.col(moment)
    test: Column = F.lit(False)
    for q, p in pairs:
        test = test | ((F.col("quantity") == q) & (F.col("phase") == p))

    value = lambda q, p: F.when((F.col("quantity") == q) & (F.col("phase") == p), F.col("value"))
    means = [mean([value(q, p)], digits).alias(_name(q, p)) for q, p in pairs]
    some = fact.where((F.col("quality") == "ok") & test).withColumn("minute", F.date_trunc("minute", ts))
    return some.groupBy(*MINUTE).agg(*means)


def minute_wide_of_records(plan: Transform, records: DataFrame, factors: DataFrame | None, pairs: list[tuple[str, str]], digits: int | None = None) -> DataFrame:
    """`minute_wide` of the rows that `plan` makes of raw records, from the pass that judges them.

    A record's cells are summed as the columns they are, so a group is looked up once for a record, not
    for each of its cells, and holds only pairs that the rulebook can give. Where a source's interval is
    a minute or more, sums before the shuffle would be as many as its records and outgrow a task's
    memory: such records are dealt by minute first and summed once. Those of shorter intervals are summed
    before the shuffle too."""
    d, values = plan.paired(records, pairs, factors)
    if not any(values.values()):
        raise ValueError(f"{plan.book.vendor} gives none of {pairs}")
    columns = {p: {f"__{k}_{n}": v for n, v in enumerate(values[p])} for k, p in enumerate(pairs)}
    d = d.select("source_vendor", "device_id", F.date_trunc("minute", "moment").alias("minute"), *[v.alias(name) for p in pairs for name, v in columns[p].items()])
    if (plan.book.interval_s or 0) >= 60:
        d = d.repartition("device_id", "minute")
    means = [(mean([F.col(c) for c in columns[p]], digits) if columns[p] else F.lit(None).cast("double")).alias(_name(*p)) for p in pairs]
    found = d.groupBy(*MINUTE).agg(*means)
    # A minute whose records have no such value goes now: testing each record would make its values twice.
    return found.where(reduce(or_, [F.col(_name(*p)).isNotNull() for p in pairs]))


def resolved(book: Rulebook, body: str) -> str:
    return body.replace("{canonical}", book.table_name()).strip()


def publish_serving(spark: SparkSession, book: Rulebook, bodies: dict[str, str], provider: str = "delta") -> list[str]:
    """Serving definitions, names sorted, as views or as snapshot tables as the target says."""
    mode, made = book.serving_mode(), []
    for name in sorted(bodies):
        full = book.serving_name(name)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {book.schema_name(book.target['serving_schema'])}")
        if mode == "view":
            spark.sql(f"CREATE OR REPLACE VIEW {full} AS {resolved(book, bodies[name])}")
        else:
            spark.sql(resolved(book, bodies[name])).write.mode("overwrite").format(provider).saveAsTable(full)
        made.append(full)
    return made


def reconciled(rows: DataFrame) -> DataFrame:
    """source_vendor, event_date, n."""
    return rows.groupBy("source_vendor", "event_date").agg(F.count("*").alias("n"))


def identity_collapse(rows: DataFrame) -> DataFrame:
    """n_rows, n_ids: fewer ids than rows means that the identity lacks a field.

    Ids are counted by a short hash first. An id whose hash no other row has is alone; only those
    whose hash comes again are compared in full, so full ids of unique rows aren't shuffled.
    """
    spark, id_, none = rows.sparkSession, F.col("measurement_id"), F.col("measurement_id").isNull()
    path = scratch(spark, "hashes")
    by_hash = rows.groupBy(F.xxhash64(id_).alias("h"), none.alias("none")).agg(F.count("*").alias("n"))
    # One pass leaves the totals and the hashes that come again.
    once, seen = F.col("n") == 1, Observation()
    totals = [F.sum("n").alias("n_rows"), F.count(F.when(once & ~F.col("none"), 1)).alias("alone")]
    by_hash.observe(seen, *totals).where(~once & ~F.col("none")).select("h").write.parquet(path)
    again = spark.read.schema("h long").parquet(path)
    found = told(seen, {"n_rows": 0, "alone": 0})
    total = [F.lit(found["n_rows"] or 0).cast("long").alias("n_rows"), (F.lit(found["alone"]) + F.col("n")).alias("n_ids")]
    if again.isEmpty():
        return spark.range(1).select(F.lit(0).cast("long").alias("n")).select(*total)
    return rows.select("measurement_id", F.xxhash64(id_).alias("h")).join(again, "h", "left_semi").agg(F.countDistinct("measurement_id").alias("n")).select(*total)


def minute_completeness(rows: DataFrame) -> DataFrame:
    """device_id, minutes_present, minutes_possible, percent: between a device's first and last
    minute.

    Minutes are bits: every 64 of them share a word, which tasks fill before they shuffle, so a
    device's words are sent, not its minutes.
    """
    minute = F.floor(F.unix_seconds(instant(F.col("ts_utc"))) / 60).cast("long")
    bits = rows.select("device_id", minute.alias("__m")).where("__m is not null").groupBy("device_id", F.floor(F.col("__m") / 64).alias("__w"))
    words = bits.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("__m", F.lit(64)).cast("int"))).alias("__b"), F.min("__m").alias("__lo"), F.max("__m").alias("__hi"))
    d = words.groupBy("device_id").agg(F.sum(F.bit_count("__b")).alias("minutes_present"), (F.max("__hi") - F.min("__lo") + 1).alias("minutes_possible"))
    return d.withColumn("percent", F.round(F.lit(100.0) * F.col("minutes_present") / F.col("minutes_possible"), 4))


def refresh_minutes(spark: SparkSession, fact: DataFrame, name: str, pairs: list[tuple[str, str]], since: str | None, newest: str = "ingested_at", digits: int | None = None) -> int:
    """Keeps a snapshot of `minute_wide` up to date and says how many minutes were made anew.

    Only minutes with a row whose `newest` is later than `since` are computed again, from all of their
    rows, and replace what the snapshot has of them; other partitions of the snapshot aren't touched.
    since: null makes all of them. A row that a load has moved to another minute has to be named in
    the old minute too, by a row there that is as new.
    """
    minute = F.date_trunc("minute", instant(F.col("ts_utc")) if isinstance(fact.schema["ts_utc"].dataType, T.StringType) else F.col("ts_utc"))
    dated = fact.withColumn("minute", minute)
    if since is not None:
        touched = dated.where(F.col(newest).cast("timestamp") > F.lit(since).cast("timestamp")).select(*MINUTE).distinct()
        path = scratch(spark, "minutes")
        touched.write.parquet(path)  # so that its size is known to the join, and it is found once
        touched = spark.read.schema(touched.schema).parquet(path)
        if touched.isEmpty():
            return 0
        span = touched.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi")).first()
        dated = dated.where(F.col("minute").between(F.lit(span["lo"]), F.lit(span["hi"]))).join(touched, MINUTE, "left_semi")
    wide = minute_wide(dated.drop("minute"), pairs, digits=digits).withColumn("event_date", F.to_date("minute"))
    book = Rulebook(vendor="", target={"schema": name.rsplit(".", 1)[0], "table": name.rsplit(".", 1)[1], "merge_key": MINUTE, "partition_by": ["event_date"], "key_fixes": ["event_date"]})
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide.schema)
    create_schema(spark, book)
    spark.sql(table_sql(name, columns, "parquet", ["event_date"], {}, MINUTE, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return upsert_table(wide, name, MINUTE, ["event_date"], ["event_date"])

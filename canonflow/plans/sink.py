"""Canonical parquet, the fact table, and the idempotent load of staged rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timestamps import event_date
from ..operators.merge import dedupe_latest, keyed, table_schema, typed_projection, upsert
from ..rulebook import Rulebook
from ..sources.landing import read_staged
from .transform import COUNTERS, Transform

PARTITIONS = ["source_vendor", "event_date", "run_scope"]
#: Providers whose tables take MERGE.
ROW_LEVEL = {"delta", "iceberg"}


#: How a null is named as a partition, and the characters that a partition's folder
#: shows in hexadecimal.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(k) for k in range(1, 32)}


def _folder(name: str, value: object) -> str:
    shown = _NULL_FOLDER if value is None or value == "" else "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))
    return f"{name}={shown}"


def told(seen: Observation, otherwise: dict) -> dict:
    """What a finished pass observed. A plan that Spark sees to be empty has no pass to observe."""
    try:
        return seen.get or otherwise
    except Exception as error:  # the class differs with the kind of session
        if "assertion failed" not in str(error):
            raise
        return otherwise


def write_canonical(rows: DataFrame, root: str, scope: str, spread: bool = True, moment: str | None = None) -> None:
    """Parquet partitioned by vendor, date and scope. Writing a scope again replaces what it had,
    other scopes stay. Nothing is written for no rows, and nothing is removed.

    The write itself tells which partitions it made. Those that the scope has besides belong to dates
    that it no longer has, and are overwritten with no rows. spread: deals rows by vendor and date,
    so that a partition has few files; without it, every task writes what it holds and there is no
    shuffle. moment: the column with a row's instant, which isn't written; else canonical text is
    parsed.
    """
    spark, made = rows.sparkSession, Observation()
    day = F.to_date(moment) if moment else event_date(F.col("ts_utc"))
    dated = rows.withColumn("event_date", day).withColumn("run_scope", F.lit(scope))
    dated = dated.drop(moment) if moment else dated
    watched = dated.observe(made, F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in PARTITIONS[:2]])).alias("parts"))
    watched = watched.hint("rebalance", *PARTITIONS[:2]) if spread else watched
    watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(root)
    parts = {tuple(p) for p in told(made, {"parts": []})["parts"]}
    if not parts:
        return
    kept = T.StructType([f for f in dated.schema if f.name not in PARTITIONS])
    as_text = T.StructType([*kept, *(T.StructField(c, T.StringType()) for c in PARTITIONS)])
    held = read_staged(spark, root, as_text).where(F.col("run_scope") == scope).select(*PARTITIONS[:2]).distinct()
    for old in {tuple(p) for p in held.collect()} - parts:  # as many as the scope has lost dates
        folder = "/".join(_folder(c, v) for c, v in zip(PARTITIONS, (*old, scope), strict=True))
        spark.createDataFrame([], kept).coalesce(1).write.mode("overwrite").parquet(f"{root}/{folder}")


def write_run(plan: Transform, records: DataFrame, root: str, scope: str, factors: DataFrame | None = None, ingested_at: str | None = None) -> dict[str, int]:
    """Writes a run's rows and gives its counters, both from one pass over the records. Raw records
    are dealt by date ahead of it, so that a date has few files; rows aren't dealt anew, so that the
    pass is the writing stage and counts each record once. If the timestamp field is absent, all
    dates are null and nothing is dealt."""
    counted = Observation()
    if plan.stamp_field in records.columns:
        records = records.withColumn("__day", plan.day()).hint("rebalance", "__day").drop("__day")
    rows = plan.rows(records, factors, ingested_at, moment="__instant", counted=counted)
    write_canonical(rows, root, scope, spread=False, moment="__instant")
    return told(counted, dict.fromkeys(COUNTERS, 0))


def read_canonical(spark: SparkSession, root: str) -> DataFrame:
    return read_staged(spark, root)


def create_schema(spark: SparkSession, book: Rulebook, schema: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {book.schema_name(schema)}")


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_sql(name: str, columns: str, provider: str, partition_by: list[str], properties: dict, bucket_by: list[str] | None = None, buckets: int = 0) -> str:
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if bucket_by and buckets:
        by += f" CLUSTERED BY ({', '.join(bucket_by)}) SORTED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS"
    props = f" TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in properties.items())})" if properties else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{by}{props}"


def _buckets(spark: SparkSession, book: Rulebook) -> int:
    return int(book.target.get("buckets", spark.conf.get("spark.sql.shuffle.partitions")))


def ensure_table(spark: SparkSession, book: Rulebook, provider: str = "delta") -> str:
    """The fact table, with columns, partitions and properties from the rulebook. A table whose
    provider has no MERGE is bucketed by the merge key, so that merging doesn't shuffle it;
    `target.buckets` says how many, by default as many as a shuffle has partitions."""
    create_schema(spark, book)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(book))
    bucketed = ([], 0) if provider in ROW_LEVEL else (book.target.get("merge_key", []), _buckets(spark, book))
    spark.sql(table_sql(book.table_name(), columns, provider, book.target.get("partition_by", []), book.target.get("table_properties") or {}, *bucketed))
    return book.table_name()


@dataclass(frozen=True)
class MergeReport:
    """Rows staged, rows merged, and the table's rows before and after, if they were counted."""

    staged: int
    merged: int
    before: int | None
    after: int | None


def prepared(staged: DataFrame, book: Rulebook) -> DataFrame:
    """Staged rows as the table takes them: typed, keyed, one per key."""
    key = book.target["merge_key"]
    return dedupe_latest(keyed(typed_projection(staged, table_schema(book)), key), key)


@dataclass(frozen=True)
class Touched:
    """What staged rows say about the target: their number, the least and the greatest value of each
    key column, and the partitions that they lie in."""

    rows: int
    bounds: dict[str, tuple]
    parts: list[dict] = field(default_factory=list)

    @classmethod
    def by(cls, rows: DataFrame, key: list[str], parts: list[str]) -> Touched:
        """One pass. The partitions of one load reach the driver, as they do in its catalog calls."""
        found = rows.agg(
            F.count(F.lit(1)).alias("n"), F.struct(*[F.struct(F.min(k).alias("lo"), F.max(k).alias("hi")).alias(k) for k in key]).alias("bounds"),
            F.collect_set(F.struct(*parts) if parts else F.lit(None)).alias("parts"),
        ).first()
        return cls(found["n"], {k: tuple(found["bounds"][k]) for k in key}, [p.asDict() for p in found["parts"]] if parts else [])

    def test(self, of, fixed: list[str]) -> Column:
        """A test that every row of the target with a staged key passes, and by which files are left
        out: keys lie within bounds, and partitions among the staged ones, where `fixed` names
        partition columns that a key fixes."""
        out = F.lit(True)
        for k, (lo, hi) in self.bounds.items():
            if lo is not None:
                out = out & of(k).between(F.lit(lo), F.lit(hi))
        for c in fixed:
            values = {p[c] for p in self.parts}
            some = of(c).isin(*[F.lit(v) for v in values if v is not None]) if values - {None} else F.lit(False)
            out = out & ((some | of(c).isNull()) if None in values else some)
        return out


def merge(staged: DataFrame, book: Rulebook, provider: str = "delta", count_table: bool = True) -> MergeReport:
    """Upserts staged rows and counts. `staged` is evaluated once: its rows are counted on their way
    into the merge. count_table: also counts the whole table before and after, which a stream of small
    batches shouldn't.

    Of the target, only files that can hold a staged key are read. `target.key_fixes` names partition
    columns that follow from the key, as the date does from an id over the timestamp: then other
    partitions aren't read at all.
    """
    spark, name, key = staged.sparkSession, book.table_name(), book.target["merge_key"]
    parts, fixed = book.target.get("partition_by", []), book.target.get("key_fixes", [])
    seen = Observation()
    rows = prepared(staged.observe(seen, F.count(F.lit(1)).alias("n")), book).persist()
    whole = lambda: spark.table(name).count() if count_table else None
    try:
        touched, before = Touched.by(rows, key, parts), whole()
        if touched.rows and provider in ROW_LEVEL:
            merge_rows(rows, name, key, touched, fixed)
        elif touched.rows:
            _rebuild(spark, rows, name, key, parts, touched, fixed)
        return MergeReport(told(seen, {"n": 0})["n"], touched.rows, before, whole())
    finally:
        rows.unpersist()


def upsert_table(rows: DataFrame, name: str, key: list[str], parts: list[str], fixed: list[str]) -> int:
    """Upserts rows, whose keys are distinct, into a table without MERGE, and counts them."""
    rows = rows.persist()
    try:
        if (touched := Touched.by(rows, key, parts)).rows:
            _rebuild(rows.sparkSession, rows, name, key, parts, touched, fixed)
        return touched.rows
    finally:
        rows.unpersist()


def merge_rows(rows: DataFrame, name: str, key: list[str], touched: Touched | None = None, fixed: list[str] | None = None) -> None:
    """The table's own MERGE: matching rows are replaced, others are inserted. touched: narrows the
    files that are searched for matches."""
    own = name.rsplit(".", 1)[-1]
    test = F.expr(" AND ".join(f"{own}.{k} = staged.{k}" for k in key))
    if touched is not None and fixed:
        test = test & touched.test(lambda c: F.col(f"{own}.{c}"), fixed)
    rows.alias("staged").mergeInto(name, test).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def _within(parts: list[dict]) -> Column:
    """Whether a row lies in one of these partitions; only they are listed and read."""
    out = F.lit(False)
    for p in parts:
        test = F.lit(True)
        for c, v in p.items():
            test = test & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        out = out | test
    return out


def changed_partitions(target: DataFrame, rows: DataFrame, key: list[str], parts: list[str], touched: Touched, fixed: list[str]) -> list[dict]:
    """The partitions that staged rows lie in, and those whose rows they replace."""
    if set(parts) <= set(fixed):
        return touched.parts
    replaced = target.where(touched.test(F.col, fixed)).join(rows.select(*key), key, "left_semi").select(*parts).distinct()
    return touched.parts + [p for p in (r.asDict() for r in replaced.collect()) if p not in touched.parts]


def _rebuild(spark: SparkSession, rows: DataFrame, name: str, key: list[str], parts: list[str], touched: Touched, fixed: list[str]) -> None:
    """Upsert for tables without MERGE. Changed partitions are written anew to a folder of their own,
    and only when all are there does the table switch over to them, so a load that fails leaves the
    old rows. What the table held before is emptied last. A table without partitions is swapped.

    The target is read where it may hold a staged key, and as it is bucketed by the key, it isn't
    shuffled.
    """
    target, load = spark.table(name), uuid.uuid4().hex
    if not parts:
        _swap(spark, upsert(target, rows, key).select(*target.columns), name, f"{name}_load_{load}")
        return
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    changed = changed_partitions(target, rows, key, parts, touched, fixed)
    new = upsert(target.where(_within(changed)), rows, key)
    folder, spool = f"{about['Location']}/_loads/{load}", f"{name}_load_{load}"
    writer = new.select(*target.columns).write.format("parquet").option("path", folder).partitionBy(*parts)
    if int(about.get("Num Buckets", 0)):
        writer = writer.bucketBy(int(about["Num Buckets"]), *key).sortBy(*key)
    writer.saveAsTable(spool)
    try:
        made = [r.asDict() for r in spark.table(spool).select(*parts).distinct().collect()]
    finally:
        spark.sql(f"DROP TABLE {spool}")  # its files stay, as it is no managed table
    none = spark.createDataFrame([], T.StructType([f for f in target.schema if f.name not in parts]))
    empty = lambda path: none.coalesce(1).write.mode("overwrite").parquet(path)
    gone = [p for p in changed if p not in made]  # all their keys moved
    places = [(p, f"{folder}/" + "/".join(_folder(c, p[c]) for c in parts)) for p in made]
    if gone:
        empty(f"{folder}/_none")
        places += [(p, f"{folder}/_none") for p in gone]
    old = _switch(spark, name, places)
    for p in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(p)})")
    for path in old:
        empty(path)


def _swap(spark: SparkSession, new: DataFrame, name: str, spool: str) -> None:
    """Gives a table without partitions other rows: they are written to a table like it, which then
    takes its name. If that fails, the old one has it."""
    spark.sql(f"CREATE TABLE {spool} LIKE {name}")
    try:
        told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if told:
            spark.sql(f"ALTER TABLE {spool} SET TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in told.items())})")
        new.write.insertInto(spool)
        spark.sql(f"ALTER TABLE {name} RENAME TO {spool}_old")
        try:
            spark.sql(f"ALTER TABLE {spool} RENAME TO {name}")
        except BaseException:
            spark.sql(f"ALTER TABLE {spool}_old RENAME TO {name}")
            raise
        spark.sql(f"DROP TABLE {spool}_old")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {spool}")


def _spec(part: dict) -> str:
    return ", ".join(f"{c} = {'NULL' if v is None else _quoted(v)}" for c, v in part.items())


def _place(spark: SparkSession, name: str, part: dict) -> str | None:
    """Where a partition's files lie, if the table has it."""
    try:
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({_spec(part)})").where("col_name = 'Location'").collect()
    except AnalysisException as error:
        if "PARTITION" not in (error.getCondition() or "").upper():
            raise
        return None
    return found[0]["data_type"]


def _switch(spark: SparkSession, name: str, places: list[tuple[dict, str]]) -> list[str]:
    """Makes the table's partitions lie in these places, all of them or none: what fails is undone.
    Returns where they lay."""
    before = [_place(spark, name, p) for p, _ in places]

    def put(part: dict, was: str | None, to: str | None) -> None:
        if to is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(part)})")
        elif was is None:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({_spec(part)}) LOCATION {_quoted(to)}")
        else:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(part)}) SET LOCATION {_quoted(to)}")

    done = 0
    try:
        for (part, to), was in zip(places, before, strict=True):
            done += 1
            put(part, was, to)
    except BaseException:
        for (part, to), was in list(zip(places, before, strict=True))[:done]:
            put(part, to, was)
        raise
    finally:
        spark.catalog.refreshTable(name)
    return [x for x in before if x is not None]


def merge_staging(spark: SparkSession, path: str, book: Rulebook, provider: str = "delta") -> MergeReport:
    """Loads a staged dataset; loading it again changes nothing."""
    return merge(read_staged(spark, path), book, provider)

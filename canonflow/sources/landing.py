"""The landing zone: partitions of payload snapshots beside their sidecars."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rulebook import Rulebook
from ..scratch import scratch
from .payloads import records

_SIDECAR, _UNFINISHED = ".meta.json", ".tmp"
#: Bytes of a payload from which JSON is read in ranges; below, one task parses one payload.
LARGE_JSON = 256 << 20


def latest_snapshots(files: DataFrame) -> DataFrame:
    """directory, path of the greatest (fetched_at, path) of each directory. A file without
    fetched_at counts as the oldest."""
    age = F.struct(F.coalesce("fetched_at", F.lit("")).alias("fetched_at"), "path")
    more = [F.max_by("length", age).alias("length")] if "length" in files.columns else []
    return files.groupBy("directory").agg(F.max_by("path", age).alias("path"), *more)


def partition_globs(root: str, layout: str, date: str, meter: str | None = None) -> str:
    """The directory of one date and meter, or the pattern for all meters."""
    return f"{root.rstrip('/')}/{layout.format(date=date, meter='*' if meter is None else meter)}"


def landed_files(spark: SparkSession, pattern: str) -> DataFrame | None:
    """directory, path, length, fetched_at of the payloads under `pattern`; None if nothing is there.
    Payloads are listed, not opened; sidecars are read. Paths are as a scan's `_metadata` has them."""
    try:
        listed = spark.read.format("binaryFile").load(f"{pattern}/*").select(F.col("_metadata.file_path").alias("path"), "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    name = F.col("path")
    stem = F.regexp_replace(name, r"(\.meta\.json|\.[^./]*)$", "")
    files = listed.select("path", "length", F.regexp_replace(name, "/[^/]*$", "").alias("directory"), stem.alias("stem"))
    payloads = files.where(~F.endswith("path", F.lit(_SIDECAR)) & ~F.endswith("path", F.lit(_UNFINISHED)))
    try:
        text = spark.read.option("wholetext", True).text(f"{pattern}/*{_SIDECAR}").select(F.col("_metadata.file_path").alias("m"), "value")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return payloads.select("directory", "path", "length", F.lit(None).cast("string").alias("fetched_at"))
    told = text.select(F.regexp_replace("m", r"\.meta\.json$", "").alias("s"), F.get_json_object("value", "$.fetched_at").alias("fetched_at"))
    return payloads.join(told, F.col("stem") == F.col("s"), "left").select("directory", "path", "length", "fetched_at")


@dataclass(frozen=True)
class Snapshot:
    """The newest payloads under a pattern: a table of their paths. A scan of all files is joined to
    it by each row's own file, so no name comes to the driver, and older payloads yield nothing."""

    pattern: str
    newest: DataFrame
    largest: int = 0

    @classmethod
    def of(cls, spark: SparkSession, pattern: str) -> Snapshot | None:
        """None if nothing has landed. The listing is written, so that its size is known to the join."""
        files = landed_files(spark, pattern)
        if files is None:
            return None
        path = scratch(spark, "newest")
        latest_snapshots(files).select(F.col("path").alias("__newest"), "length").write.parquet(path)
        newest = spark.read.schema("__newest string, length long").parquet(path)
        return cls(f"{pattern}/*", newest.select("__newest"), newest.agg(F.max("length")).first()[0] or 0)

    def only(self, rows: DataFrame) -> DataFrame:
        """The rows, which have a column __file, of the newest payloads."""
        return rows.join(self.newest, F.col("__file") == F.col("__newest"), "left_semi")


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _newest(of: list[str] | Snapshot, rows: DataFrame) -> DataFrame:
    return of.only(rows) if isinstance(of, Snapshot) else rows


def _paths(of: list[str] | Snapshot) -> list[str]:
    return [of.pattern] if isinstance(of, Snapshot) else of


def _not_json(text: Column) -> Column:
    return F.raise_error(F.concat(F.lit("not JSON: "), F.left(text, F.lit(80)))).cast("boolean")


def read_json_ranges(spark: SparkSession, of: list[str] | Snapshot, names: list[str]) -> DataFrame:
    """The same records of UTF-8 payloads, each read in ranges by several tasks."""
    file = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("range")
    text = _newest(of, spark.read.option("lineSep", "}").text(_paths(of)).select("value", *file))
    return records(text.withColumnRenamed("__file", "file"), names, _not_json)


def read_json(spark: SparkSession, of: list[str] | Snapshot, names: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Records of payloads that hold an array or one object, as texts. Another JSON value yields
    nothing; what isn't JSON raises, but not in payloads that a snapshot leaves out. Where a snapshot has
    a payload above LARGE_JSON, its payloads are read in ranges, by several tasks each."""
    schema = _strings(names).add("__corrupt", T.StringType())
    reader = spark.read.schema(schema).option("multiLine", True).option("encoding", encoding).option("columnNameOfCorruptRecord", "__corrupt")
    bad = F.col("__corrupt")
    scalar = F.trim(bad).rlike(r'^(null|true|false|-?\d[\d.eE+-]*|"([^"\\]|\\.)*")$')
    if isinstance(of, Snapshot) and of.largest > LARGE_JSON and encoding.upper().replace("-", "") == "UTF8":
        return read_json_ranges(spark, of, names)
    found = _newest(of, reader.json(_paths(of)).select("*", F.col("_metadata.file_path").alias("__file")))
    # Numbered behind the join and tested with the number, so that nothing raises below the join, where
    # older payloads still are.
    found = found.withColumn("__at", F.monotonically_increasing_id())
    good = F.when(bad.isNull(), F.col("__at") >= 0).when(scalar, F.lit(False)).otherwise(_not_json(bad))
    return found.where(good).select(*names)


def split_dsv(lines: DataFrame, line: str, names: list[str], delimiter: str = ",") -> DataFrame:
    """`lines` with the fields of each; lines that are empty or have another number of fields
    are left out. The delimiter is literal and nothing is quoted."""
    parts = F.split(F.regexp_replace(F.col(line), r"[\r\n]+$", ""), re.escape(delimiter), -1)
    d = lines.withColumn("__parts", parts).where((F.size("__parts") == len(names)) & (F.regexp_replace(F.col(line), r"[\r\n]+$", "") != ""))
    return d.select(*[c for c in lines.columns if c != line], *[F.get("__parts", F.lit(k)).alias(n) for k, n in enumerate(names)])


def read_dsv(spark: SparkSession, of: list[str] | Snapshot, names: list[str], delimiter: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Records of header-less delimited payloads; lines end at a newline only."""
    file = F.col("_metadata.file_path").alias("__file")
    if encoding.upper().replace("-", "") == "UTF8":
        lines = _newest(of, spark.read.option("lineSep", "\n").text(_paths(of)).select("value", file))
    else:  # another charset is decoded file by file
        content = _newest(of, spark.read.format("binaryFile").load(_paths(of)).select("content", file))
        lines = content.select(F.explode(F.split(F.decode("content", encoding), "\n")).alias("value"))
    return split_dsv(lines.select("value"), "value", names, delimiter)


def read_payloads(spark: SparkSession, of: list[str] | Snapshot | None, book: Rulebook) -> DataFrame:
    """Records of payloads in the rulebook's format, all fields as text."""
    kind, encoding = book.format.get("type", "json"), book.format.get("encoding", "UTF-8")
    declared = [f["name"] for f in book.source.get("fields", [])]
    if kind == "csv":
        return read_dsv(spark, of, declared, book.format.get("delimiter", ","), encoding) if of else spark.createDataFrame([], _strings(declared))
    names = book.raw_fields()
    return read_json(spark, of, names, encoding) if of else spark.createDataFrame([], _strings(names))


def read_records(spark: SparkSession, root: str, book: Rulebook, date: str, meter: str | None = None) -> DataFrame:
    """One date's records, of one meter or of all; an absent partition has none."""
    return read_payloads(spark, Snapshot.of(spark, partition_globs(root, book.source["access"]["layout"], date, meter)), book)


def factor_columns(devices: DataFrame, book: Rulebook) -> DataFrame:
    """meter, uk, ik from device records; a missing factor raises, the last of equal ids counts."""
    names = book.source.get("device_factors", {})

    def needed(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.raise_error(F.concat(F.lit(f"a device without {name}: "), F.coalesce("id", F.lit("None")))).cast("double"))

    rows = devices.select(F.coalesce(F.col("id").cast("string"), F.lit("None")).alias("meter"), needed(names.get("voltage_factor", "uk")).alias("uk"), needed(names.get("current_factor", "ik")).alias("ik"))
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    last = F.max_by(F.struct("uk", "ik"), F.col("__at"))
    return rows.groupBy("meter").agg(last.alias("f")).select("meter", "f.uk", "f.ik")


def read_device_factors(spark: SparkSession, root: str, book: Rulebook, date: str) -> DataFrame:
    """meter, uk, ik from the newest payload of the meters partition."""
    names = book.source.get("device_factors", {})
    fields = ["id", names.get("voltage_factor", "uk"), names.get("current_factor", "ik")]
    newest = Snapshot.of(spark, f"{root.rstrip('/')}/vendor={book.vendor}/source=meters/date={date}")
    devices = read_json(spark, newest, fields) if newest else spark.createDataFrame([], _strings(fields))
    return factor_columns(devices, book)


def read_staged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Staged parquet with its partition columns; a bare path is a local file."""
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(path)

"""JSON payloads that are too large for one task, read in ranges.

A payload's records are found without reading it in one piece. Its text is split behind every closing
brace, which Spark does range by range (an end-of-line mark of one's choice). For each fragment, quotes
and opening braces are counted twice, as if it began outside a string and as if it began inside. Sums
over ranges, then running sums inside each range, tell how every fragment really begins and how deep it
is. A record ends where the depth is back at 0; its fragments are joined and parsed.

Only sums of ranges are ordered by file. Fragments are written once, so that the passes over the
counts don't read texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import scratch

#: What stands before the first record, between two, and behind the last one.
_FIRST, _NEXT, _LAST = r"^\s*\[?\s*$", r"^\s*,\s*$", r"^\s*\]?\s*$"


def fragments(text: DataFrame) -> DataFrame:
    """file, range, id, value, quotes, opens_out, opens_in. text: file, range, value, the latter without
    its closing brace."""
    bare = F.regexp_replace("value", r"\\\\.", "")
    parts = F.split(bare, '"', -1)
    opens = lambda keep: F.aggregate(
        F.filter(parts, lambda _, k: F.pmod(k, F.lit(2)) == keep), F.lit(0), lambda n, x: n + F.char_length(x) - F.char_length(F.replace(x, F.lit("{"), F.lit("")))
    )
    return text.select("file", "range", F.monotonically_increasing_id().alias("id"), "value", (F.size(parts) - 1).alias("quotes"), opens(0).alias("opens_out"), opens(1).alias("opens_in"))


def _before(rows: DataFrame, count: str, name: str) -> DataFrame:
    """file, range, name: the sum of `count` over the ranges before."""
    sums = rows.groupBy("file", "range").agg(F.sum(count).alias("sum"))
    ahead = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "range", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias(name))


def _running(rows: DataFrame, count: str, name: str, own: bool) -> DataFrame:
    """The sum of `count` over the file up to a fragment, with or without its own."""
    inside = Window.partitionBy("file", "range").orderBy("id").rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    start = f"{name}_start"
    return rows.join(_before(rows, count, start), ["file", "range"]).withColumn(name, F.col(start) + F.coalesce(F.sum(count).over(inside), F.lit(0))).drop(start)


def records(text: DataFrame, names: list[str], raised) -> DataFrame:
    """Records of payloads that come as fragments (file, range, value), their fields as texts. raised:
    makes an expression that raises with a text."""
    spark, path = text.sparkSession, scratch(text.sparkSession, "fragments")
    fragments(text).write.parquet(path)
    held = spark.read.parquet(path)
    counts = _running(held.drop("value"), "quotes", "quoted", own=False)
    inside = counts["quoted"] % 2 == 1
    # A payload's last fragment has no closing brace; it lies in the last range.
    final = Window.partitionBy("file").orderBy(F.col("range").desc())
    lasts = counts.groupBy("file", "range").agg(F.max("id").alias("last")).withColumn("no", F.row_number().over(final)).where("no = 1").select("file", "range", F.col("last").alias("id"), F.lit(True).alias("last"))
    counts = counts.withColumn("opens", F.when(inside, F.col("opens_in")).otherwise(F.col("opens_out"))).withColumn("out", (F.col("quoted") + F.col("quotes")) % 2 == 0)
    counts = counts.join(lasts, ["file", "range", "id"], "left").withColumn("last", F.col("last").isNotNull())
    counts = counts.withColumn("step", F.col("opens") - F.when(F.col("out") & ~F.col("last"), 1).otherwise(0))
    deep = _running(counts.select("file", "range", "id", "step", "out", "last"), "step", "depth", own=True)
    ends = (F.col("depth") == 0) & F.col("out") & ~F.col("last")
    placed = _running(deep.withColumn("ends", ends.cast("long")), "ends", "record", own=False).select("file", "range", "id", "record", "depth", "out", "last")
    whole = held.select("file", "range", "id", "value").join(placed, ["file", "range", "id"])
    piece = F.struct("range", "id", F.concat("value", F.when(F.col("last"), "").otherwise("}")).alias("value"), "last", "depth", "out")
    rows = whole.groupBy("file", "record").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    rows = rows.select("file", "record", F.array_join(F.col("pieces.value"), "").alias("body"), F.element_at("pieces", -1).alias("end"))
    return _parsed(rows, names, raised)


def _parsed(rows: DataFrame, names: list[str], raised) -> DataFrame:
    """rows: file, record, body, end. The last one of a file has what follows its records."""
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("__corrupt", T.StringType())])
    lead = F.regexp_extract("body", r"^([^{]*)", 1)
    text = F.substring(F.col("body"), F.char_length(lead) + 1, F.char_length("body"))
    told = F.from_json(text, schema, {"columnNameOfCorruptRecord": "__corrupt"})
    last = F.col("end.last")
    alone = last & (F.col("record") == 0)  # no record at all: some other value, or nothing
    good: Column = (
        F.when(alone, F.try_parse_json(F.col("body")).isNotNull() & ~F.col("body").rlike(r"^\s*\[\s*[^\]\s]"))
        .when(last, F.col("body").rlike(_LAST) & (F.col("end.depth") == 0) & F.col("end.out"))
        .otherwise(F.when(F.col("record") == 0, lead.rlike(_FIRST)).otherwise(lead.rlike(_NEXT)) & F.col("__told.__corrupt").isNull())
    )
    # Brackets belong together: an array has both, one object none.
    opened = F.max(F.when(~last & (F.col("record") == 0), F.contains(lead, F.lit("["))))
    closed = F.max(F.when(last & ~alone, F.contains("body", F.lit("]"))))
    many = F.max(F.when(~last, F.col("record")))
    odd = rows.groupBy("file").agg(opened.alias("opened"), closed.alias("closed"), many.alias("many"))
    odd = odd.where((F.col("opened") != F.col("closed")) | (~F.col("opened") & (F.col("many") > 0))).select("file", F.lit(True).alias("odd"))
    found = rows.withColumn("__told", told).join(odd, "file", "left")
    test = F.when(good & F.col("odd").isNull(), ~last).otherwise(raised(F.col("body")))
    return found.where(test).select(*[F.col("__told")[n].alias(n) for n in names])

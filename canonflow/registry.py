"""Registered queries of the measurement engine and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as b
from .functions.numbers import exact_sum, number
from .functions.timestamps import event_date, utc_text
from .operators.cells import join_factors
from .operators.merge import dedupe_latest, keyed, table_schema, typed_projection, upsert
from .oracles import ORACLES  # noqa: F401  for the entry module
from .plans import publish
from .plans.sink import ensure_table, merge, prepared, read_canonical, write_canonical, write_run
from .plans.transform import COUNTERS, Transform
from .scratch import scratch
from .session import prepare
from .sources import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(prepare(spark), sf_dir)
    return f


def _wide(spark, d, book=b.WIDE, **more) -> DataFrame:
    return Transform(book).rows(b.wide_records(spark, d), b.device_factors(spark, d), b.STAMP, **more)


def _long(spark, d, book=b.LONG, **more) -> DataFrame:
    return Transform(book).rows(b.long_records(spark, d), None, b.STAMP, **more)


def _span(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


# long sources


@query
def long_lookup(spark, d):
    return _long(spark, d).drop("measurement_id")


@query
def long_unmapped(spark, d):
    return Transform(b.LONG).unmapped(b.long_records(spark, d))


@query
def long_aggregation_override(spark, d):
    return _long(spark, d).groupBy("quantity", "aggregation", "harmonic_order").agg(F.count("*").alias("n"))


@query
def measurement_id(spark, d):
    return _long(spark, d).select(F.col("source_row_id").cast("long").alias("event_id"), "measurement_id")


@query
def identity_collapse(spark, d):
    return publish.identity_collapse(_long(spark, d))


@query
def ingested_at_single(spark, d):
    return _long(spark, d).agg(F.countDistinct("ingested_at").alias("stamps"))


# timestamps


def _epoch(spark, d, kind: str) -> DataFrame:
    e = b.table(spark, d, "events")
    ticks = F.unix_millis(F.col("ts").cast("timestamp")) if kind == "epoch_ms" else F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(ticks.cast("string"))
    return e.select("event_id", utc_text(raw, kind).alias("ts_utc"))


@query
def ts_epoch_ms(spark, d):
    return _epoch(spark, d, "epoch_ms")


@query
def ts_epoch_s(spark, d):
    return _epoch(spark, d, "epoch_s")


def _iso(spark, d) -> DataFrame:
    key = F.col("l_orderkey")
    raw = F.when(key % 7 == 0, F.lit("yesterday")).when(key % 3 == 0, F.concat("ts", F.lit("-05:00"))).otherwise(F.col("ts"))
    text = F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    one = b.table(spark, d, "lineitem").withColumn("ts", text).withColumn("raw", raw)
    return one.select(F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"), utc_text(F.col("raw"), "iso8601").alias("ts_utc"))


@query
def ts_iso8601(spark, d):
    return _iso(spark, d)


@query
def fn_event_date(spark, d):
    return _iso(spark, d).select("id", event_date(F.col("ts_utc")).cast("string").alias("event_date"))


# values


def _values(spark, d, quantity: str, book=b.WIDE) -> DataFrame:
    return _wide(spark, d, book, quantities={quantity}).select(F.col("source_row_id").alias("id"), "value")


@query
def fn_none(spark, d):
    return _values(spark, d, "load")


@query
def fn_scale_by_factor(spark, d):
    return _values(spark, d, "pressure")


@query
def fn_scale_uk_ik(spark, d):
    columns = [c | {"args": {"factor_field": "uk_ik"}} if c["src"] == "price" else c for c in b.WIDE.mapping["columns"]]
    return _values(spark, d, "pressure", replace(b.WIDE, mapping=b.WIDE.mapping | {"columns": columns}))


@query
def fn_parse_decimal(spark, d):
    return _values(spark, d, "turbidity")


@query
def fn_device_id(spark, d):
    frame = Transform(b.WIDE).frame(b.wide_records(spark, d), b.device_factors(spark, d), keep=set())
    return frame.select("meter", F.col("__device").alias("device_id")).distinct()


@query
def join_device_factors(spark, d):
    joined = join_factors(b.wide_records(spark, d).select("meter"), b.device_factors(spark, d), "meter")
    return joined.groupBy("meter", F.col("__uk").alias("uk"), F.col("__ik").alias("ik")).agg(F.count("*").alias("n"))


# unpivot


@query
def wide_unpivot(spark, d):
    return _wide(spark, d).select(F.col("source_row_id").alias("id"), "quantity", "phase", "unit", "value")


@query
def wide_generated_harmonics(spark, d):
    return _wide(spark, d, b.with_generated(b.WIDE, columns=False)).select(F.col("source_row_id").alias("id"), "phase", "harmonic_order", "value")


@query
def wide_all_cells(spark, d):
    rows = _wide(spark, d, b.with_generated(b.WIDE, columns=True))
    total = exact_sum(F.col("value"), 4).cast("string").alias("total")
    return rows.groupBy("quantity", "phase", "harmonic_order").agg(F.count("*").alias("n"), total)


@query
def null_cell_skip(spark, d):
    return Transform(b.WIDE).stats(b.wide_records(spark, d), b.device_factors(spark, d)).select("cells_null_skipped")


# rules


def _ruled(*rules: dict) -> Query:
    return lambda spark, d: _wide(spark, d, b.with_rules(b.WIDE, *rules)).select(F.col("source_row_id").alias("id"), "quantity", "value", "quality")


def _rule(target: str, name: str, on_fail: str, kind: str = "range", **bounds) -> dict:
    return {target: name, "type": kind, "on_fail": on_fail, **bounds}


RULED = {
    "rule_record_not_null": [_rule("field", "disc", "reject_row", "not_null")],
    "rule_record_suspect": [_rule("field", "disc", "flag_suspect", "not_null")],
    "rule_record_range": [_rule("field", "q", "reject_row", min=2, max=48)],
    "rule_quantity_suspect": [_rule("quantity", "load", "flag_suspect", max=48)],
    "rule_quantity_drop": [_rule("quantity", "flow", "drop_row", max=0.09)],
    "rule_quantity_reject": [_rule("quantity", "pressure", "reject_row", max=8e8)],
    "rule_one_sided_range": [_rule("quantity", "load", "flag_suspect", min=10)],
    "rule_order": [
        _rule("quantity", "load", "flag_suspect", max=30), _rule("quantity", "load", "drop_row", "not_null"),
        _rule("quantity", "load", "drop_row", max=40), _rule("quantity", "load", "reject_row", max=48),
        _rule("quantity", "flow", "reject_row", max=0.09),
    ],
}
for _name, _rules in RULED.items():
    QUERIES[_name] = (lambda f: lambda spark, sf_dir: f(prepare(spark), sf_dir))(_ruled(*_rules))

#: Rules of every kind, whose order decides the counters.
MIXED = [
    _rule("field", "q", "reject_row", min=2), _rule("quantity", "load", "flag_suspect", max=45), _rule("quantity", "load", "drop_row", max=48),
    _rule("quantity", "pressure", "reject_row", max=8e8), _rule("quantity", "flow", "drop_row", max=0.09),
]


@query
def run_stats(spark, d):
    wide = Transform(b.with_rules(b.WIDE, *MIXED)).stats(b.wide_records(spark, d), b.device_factors(spark, d))
    long = Transform(b.LONG).stats(b.long_records(spark, d))
    return wide.withColumn("source_vendor", F.lit("demo_wide")).unionByName(long.withColumn("source_vendor", F.lit("demo_long")))


@query
def run_stats_written(spark, d):
    """The same counters from the passes that write the rows."""
    root = scratch(spark, "runs")
    wide = write_run(Transform(b.with_rules(b.WIDE, *MIXED)), b.wide_records(spark, d), root, "wide", b.device_factors(spark, d), b.STAMP)
    long = write_run(Transform(b.LONG), b.long_records(spark, d), root, "long", None, b.STAMP)
    rows = [(vendor, *(told[c] for c in COUNTERS)) for vendor, told in (("demo_wide", wide), ("demo_long", long))]
    return spark.createDataFrame(rows, "source_vendor string, " + ", ".join(f"{c} long" for c in COUNTERS))


@query
def run_stats_by_day(spark, d):
    day: list[Column] = [F.left("ts", F.lit(10)).alias("day")]
    return Transform(b.with_rules(b.WIDE, *MIXED)).stats(b.wide_records(spark, d), b.device_factors(spark, d), day)


@query
def reconcile_counts(spark, d):
    """Mapped records by vendor and date, the unmapped ones, and all."""
    dated = _long(spark, d).withColumn("event_date", event_date(F.col("ts_utc")).cast("string"))
    stats = Transform(b.LONG).stats(b.long_records(spark, d))
    rest = stats.select(F.lit("demo_long").alias("source_vendor"), F.inline(F.array(F.struct(F.lit("unmapped").alias("event_date"), F.col("records_unmapped").alias("n")), F.struct(F.lit("all").alias("event_date"), F.col("records_in").alias("n")))))
    return publish.reconciled(dated).unionByName(rest)


# sources


@query
def src_dsv(spark, d):
    names = [f["name"] for f in b.LONG.source["fields"]]
    return landing.split_dsv(b.dsv_lines(spark, d), "line", names, "\t").withColumn("value", number(F.col("value")))


def _json_payloads(spark, d) -> str:
    """Payloads of up to 5,000 records each, written as the landing zone holds them."""
    e = b.table(spark, d, "events")
    one = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(","), F.substring("props", 2, 1 << 30))
    payloads = e.groupBy((F.col("event_id") / 5000).cast("long").alias("part")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(one)), F.lit("]")).alias("value"))
    root = scratch(spark, "json")
    payloads.select("part", "value").write.partitionBy("part").text(root)
    return root


@query
def src_json(spark, d):
    found = landing.read_json(spark, [_json_payloads(spark, d)], ["id", "k"])
    return found.select(F.col("id").cast("long").alias("event_id"), "k")


@query
def src_json_ranges(spark, d):
    """The same by the reader of large payloads."""
    found = landing.read_json_ranges(spark, [_json_payloads(spark, d)], ["id", "k"])
    return found.select(F.col("id").cast("long").alias("event_id"), "k")


@query
def src_latest_snapshot(spark, d):
    o = b.table(spark, d, "orders")
    files = o.select(F.concat(F.lit("customer="), F.col("o_custkey")).alias("directory"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fetched_at"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"))
    return landing.latest_snapshots(files)


@query
def src_partition(spark, d):
    """Orders landed by month and meter, then one month of all meters read back."""
    o = b.table(spark, d, "orders")
    line = F.concat_ws("\t", "o_orderkey", "o_custkey", "o_totalprice").alias("value")
    landed = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("date"), F.left("o_orderpriority", F.lit(1)).alias("meter"), line)
    root = scratch(spark, "landing")
    landed.repartition("date", "meter").write.partitionBy("date", "meter").text(root)
    fields = ["o_orderkey", "o_custkey", "o_totalprice"]
    source = {"access": {"layout": "date={date}/meter={meter}"}, "format": {"type": "csv", "delimiter": "\t"}, "fields": [{"name": n} for n in fields]}
    found = landing.read_records(spark, root, replace(b.LONG, source=source), "1996-03")
    return found.select(*[F.col(n).cast("long").alias(n) for n in fields[:2]], number(F.col(fields[2])).alias(fields[2]))


@query
def src_device_factors(spark, d):
    s = b.table(spark, d, "supplier")
    book = replace(b.WIDE, source=b.WIDE.source | {"device_factors": {"voltage_factor": "s_acctbal", "current_factor": "s_nationkey"}})
    devices = s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("string"))
    return landing.factor_columns(devices, book)


# sinks


def _shown(rows: DataFrame) -> DataFrame:
    """Instants and dates as texts, so engines' types don't matter."""
    texts = {"ts_utc": "yyyy-MM-dd HH:mm:ss.SSSSSS", "ingested_at": "yyyy-MM-dd HH:mm:ss", "event_date": "yyyy-MM-dd"}
    return rows.withColumns({c: F.date_format(c, f) for c, f in texts.items() if c in rows.columns})


def _staged(spark, d) -> DataFrame:
    path = scratch(spark, "staged")
    b.staged_rows(spark, d).hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)
    return landing.read_staged(spark, path)


@query
def sink_staged_scan(spark, d):
    rows = _staged(spark, d)
    return rows.withColumn("event_date", F.date_format(F.col("event_date").cast("date"), "yyyy-MM-dd"))


@query
def sink_typed_projection(spark, d):
    return _shown(typed_projection(_staged(spark, d), table_schema(b.MERGE)))


def _typed(spark, d) -> DataFrame:
    return typed_projection(b.staged_rows(spark, d), table_schema(b.MERGE))


@query
def dedupe_latest_rows(spark, d):
    return _shown(dedupe_latest(keyed(_typed(spark, d), ["event_id"]), ["event_id"]))


QUERIES["dedupe_latest"] = QUERIES.pop("dedupe_latest_rows")


@query
def merge_upsert(spark, d):
    return _shown(upsert(b.merge_target(spark, d), prepared(b.staged_rows(spark, d), b.MERGE), ["event_id"]))


@query
def merge_twice_idempotent(spark, d):
    rows = prepared(b.staged_rows(spark, d), b.MERGE)
    return _shown(upsert(upsert(b.merge_target(spark, d), rows, ["event_id"]), rows, ["event_id"]))


@query
def merge_report(spark, d):
    staged, target = b.staged_rows(spark, d), b.merge_target(spark, d)
    rows = prepared(staged, b.MERGE)
    n = lambda f, name: f.agg(F.count("*").alias("n")).select(F.lit(name).alias("step"), "n")
    return n(staged, "staged").union(n(rows, "merged")).union(n(target, "before")).union(n(upsert(target, rows, ["event_id"]), "after"))


@query
def merge_table(spark, d):
    """A table that is loaded, and loaded again with what it has in part."""
    name = "fact_" + scratch(spark, "x")[-12:]
    book = replace(b.MERGE, target=b.MERGE.target | {"table": name}, canonical={"entities": {name: b.MERGE.canonical["entities"]["measurement"]}})
    ensure_table(spark, book, "parquet")
    for rows in (b.merge_target(spark, d), b.staged_rows(spark, d)):
        merge(rows, book, "parquet", count_table=False)
    return _kept(spark, name, _shown(spark.table(name)))


def _kept(spark, name: str, rows: DataFrame) -> DataFrame:
    """The rows, written; the catalog is left as it was."""
    path = scratch(spark, "kept")
    rows.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def _scoped(spark, d, scopes: list[str]) -> DataFrame:
    root = scratch(spark, "canonical")
    for scope in scopes:
        write_canonical(_long(spark, d), root, scope)
    return read_canonical(spark, root).groupBy("source_vendor", "run_scope").agg(F.count("*").alias("n"), F.countDistinct("measurement_id").alias("n_ids"))


@query
def sink_rerun_idempotent(spark, d):
    return _scoped(spark, d, ["site-1", "site-1"])


@query
def sink_scopes_coexist(spark, d):
    return _scoped(spark, d, ["site-1", "site-2"])


# publishing


def _dimension(spark) -> DataFrame:
    return publish.dimension(spark, b.LONG, "quantities", b.DIMENSION)


@query
def dim_publish(spark, d):
    """The published dimension, with the fact's rows of each term."""
    counts = _long(spark, d).groupBy("quantity").agg(F.count("*").alias("n"))
    return _dimension(spark).join(counts, "quantity", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query
def dim_join(spark, d):
    rows = publish.described(_long(spark, d), _dimension(spark))
    return rows.groupBy("quantity", "unit", "usual_unit", "rule_ref", "meaning").agg(F.count("*").alias("n"))


PAIRS = [("pressure", "inlet"), ("flow", "inlet"), ("volume_total", "none"), ("pressure_ripple", "inlet"), ("load", "none")]


def _both(spark, d, quantities: set[str] | None = None, **more) -> DataFrame:
    return _wide(spark, d, quantities=quantities, **more).unionByName(_long(spark, d, quantities=quantities, **more))


@query
def serving_minute_wide(spark, d):
    wide = publish.minute_wide_of_records(Transform(b.WIDE), b.wide_records(spark, d), b.device_factors(spark, d), PAIRS, digits=4)
    long = publish.minute_wide_of_records(Transform(b.LONG), b.long_records(spark, d), None, PAIRS, digits=4)
    return wide.unionByName(long).withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@query
def serving_snapshot(spark, d):
    """A snapshot table made from a serving definition over a written fact table."""
    name = "fact_" + scratch(spark, "x")[-12:]
    _long(spark, d).write.option("path", scratch(spark, name)).saveAsTable(name)
    book = replace(b.LONG, target={"schema": "default", "table": name, "serving_mode": "table", "serving_schema": "default"})
    body = "SELECT source_vendor, device_id, quantity, phase, left(ts_utc, 16) AS minute, CAST(sum(CAST(floor(value * 10000 + 0.5) AS DECIMAL(20, 0))) AS STRING) AS total, count(*) AS n FROM {canonical} WHERE quality = 'ok' GROUP BY ALL"
    made = publish.publish_serving(spark, book, {f"snapshot_{name}": body}, "parquet")[0]
    kept = scratch(spark, "snapshot")
    spark.table(made).write.parquet(kept)
    for table in (made, name):  # the catalog is left as it was
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(kept)


@query
def serving_refreshed(spark, d):
    """A snapshot made of three fifths of the readings, then brought up to date with the others."""
    name, row = "default.minutes_" + scratch(spark, "x")[-12:], F.col("source_row_id").cast("long") % 5
    stamps = ["2025-01-01T00:00:00Z", "2025-01-02T00:00:00Z"]
    fact = _long(spark, d).withColumn("ingested_at", F.when(row < 3, stamps[0]).otherwise(stamps[1]))
    publish.refresh_minutes(spark, fact.where(F.col("ingested_at") == stamps[0]), name, PAIRS[:4], None, digits=4)
    publish.refresh_minutes(spark, fact, name, PAIRS[:4], stamps[0], digits=4)
    return _kept(spark, name, spark.table(name).drop("event_date").withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm")))


@query
def minute_completeness(spark, d):
    return publish.minute_completeness(_long(spark, d))


@query
def union_vendors(spark, d):
    return _both(spark, d).groupBy("source_vendor").agg(F.count("*").alias("n"))


@query
def convergence(spark, d):
    rows = _both(spark, d, {"pressure"}).where("quantity = 'pressure' and phase = 'inlet'")
    return _span(rows, "source_vendor", "device_id")


assert len(COUNTERS) == 8

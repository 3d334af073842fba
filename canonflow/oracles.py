"""The measurement queries' results as DuckDB SQL."""

from __future__ import annotations

_L = """
l AS (SELECT event_id, event_type AS key, value, epoch_us(ts) // 1000 AS ms, ts FROM events),
m(key, quantity, phase, unit, harmonic_order, aggregation) AS (VALUES
  ('click', 'pressure', 'inlet', 'bar', NULL, 'instantaneous'), ('view', 'flow', 'inlet', 'l/s', NULL, 'instantaneous'),
  ('purchase', 'volume_total', 'none', 'm3', NULL, 'counter'), ('signup', 'pressure_ripple', 'inlet', 'bar', 3, 'instantaneous')),
lr AS (SELECT l.*, m.* EXCLUDE (key), strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S.%gZ') AS ts_utc FROM l JOIN m USING (key))
"""
_W = """
w AS (SELECT CAST(l_suppkey AS VARCHAR) AS meter, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ts,
  l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id, l_orderkey, l_shipdate,
  l_quantity AS q, l_extendedprice AS price, nullif(l_discount, 0) AS disc, l_tax AS tax FROM lineitem),
f AS (SELECT CAST(s_suppkey AS VARCHAR) AS meter, s_acctbal AS uk, CAST(s_nationkey AS DOUBLE) AS ik FROM supplier WHERE s_suppkey % 10 <> 0),
wf AS (SELECT row_number() OVER () AS rec, w.*, uk, ik FROM w LEFT JOIN f USING (meter)),
c AS (SELECT *, 0 AS ord, 'load' AS quantity, 'none' AS phase, 'pcs' AS unit, q AS value FROM wf
  UNION ALL SELECT *, 1, 'pressure', 'inlet', 'bar', price * uk FROM wf WHERE uk IS NOT NULL
  UNION ALL SELECT *, 2, 'flow', 'inlet', 'l/s', disc FROM wf WHERE disc IS NOT NULL
  UNION ALL SELECT *, 3, 'turbidity', 'none', 'ntu', tax FROM wf)
"""
_G = """
g AS (SELECT id, 'inlet' AS phase, 1 AS harmonic_order, q AS value FROM w UNION ALL SELECT id, 'outlet', 1, price FROM w
  UNION ALL SELECT id, 'inlet', 3, disc FROM w WHERE disc IS NOT NULL UNION ALL SELECT id, 'outlet', 3, tax FROM w)
"""
_M = """
t AS (SELECT event_id, ts AS ts_utc, event_type, value, CAST(NULL AS VARCHAR) AS location_id, '2025-01-01 00:00:00' AS ingested_at FROM events WHERE event_id % 5 < 3),
s AS (SELECT event_id, ts AS ts_utc, event_type, value * 2 AS value, CAST(NULL AS VARCHAR) AS location_id, '2025-01-02 00:00:00' AS ingested_at FROM events WHERE event_id % 5 >= 2
  UNION ALL SELECT event_id, ts, event_type, value * 3, NULL, '2025-01-03 00:00:00' FROM events WHERE event_id % 5 >= 2 AND event_id % 50 IN (2, 3, 4)),
d AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) = 1),
u AS (SELECT * FROM d UNION ALL SELECT * FROM t WHERE event_id NOT IN (SELECT event_id FROM d))
"""
_SHOWN = "event_id, strftime(ts_utc, '%Y-%m-%d %H:%M:%S.%f') AS ts_utc, event_type, value, location_id, ingested_at, strftime(ts_utc, '%Y-%m-%d') AS event_date"
_SPAN = "count(*) AS n, min(value) AS lowest, max(value) AS highest"


def _with(parts: str, select: str) -> str:
    return f"WITH {parts} {select}"


def _ruled(where: str = "true", quality: str = "'ok'", extra: str = "") -> str:
    return _with(_W + extra, f"SELECT id, quantity, value, {quality} AS quality FROM c WHERE {where}")


_ISO = """
i AS (SELECT id, CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN ts || '-05:00' ELSE ts || 'Z' END AS ts_utc,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN l_shipdate + INTERVAL 5 HOUR ELSE l_shipdate END AS moment FROM w)
"""
_JUDGED = """
j AS (SELECT *, price * uk > 8e8 AS bad FROM wf),
k AS (SELECT *, q < 2 AS out, q >= 2 AND coalesce(bad, false) AS poisoned, q >= 2 AND NOT coalesce(bad, false) AS whole FROM j)
"""
_COUNTS = """
  count(*) AS records_in, count(*) FILTER (out OR poisoned) AS records_rejected, 0 AS records_unmapped,
  CAST(coalesce(sum(CASE WHEN whole THEN (q <= 48)::INT + (uk IS NOT NULL)::INT + coalesce((disc <= 0.09)::INT, 0) + 1 END), 0) AS BIGINT) AS rows_emitted,
  count(*) FILTER (whole AND q > 45 AND q <= 48) AS rows_suspect,
  CAST(coalesce(sum(CASE WHEN NOT out THEN (q > 48)::INT + coalesce((disc > 0.09 AND whole)::INT, 0) END), 0) AS BIGINT) AS rows_dropped,
  count(*) FILTER (NOT out AND disc IS NULL) AS cells_null_skipped, count(*) FILTER (NOT out AND uk IS NULL) AS cells_factor_missing
"""

ORACLES = {
    "long_lookup": _with(_L, """SELECT 'demo_long' AS source_vendor, 'events' AS source_dataset, 'demo:site:device' AS device_id, ts_utc, quantity, phase, 'none' AS variant,
        harmonic_order, value, unit, aggregation, 1 AS interval_s, 'ok' AS quality, CAST(event_id AS VARCHAR) AS source_row_id, '1.0.0' AS schema_version,
        '2025-01-01T00:00:00+00:00' AS ingested_at, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS INT) AS ts_session_offset_s FROM lr"""),
    "long_unmapped": _with(_L, "SELECT key, count(*) AS n FROM l WHERE key NOT IN (SELECT key FROM m) GROUP BY key"),
    "long_aggregation_override": _with(_L, "SELECT quantity, aggregation, harmonic_order, count(*) AS n FROM lr GROUP BY ALL"),
    "measurement_id": _with(_L, """SELECT event_id, left(sha256('source_vendor=''demo_long''|quantity=''' || quantity || '''|ts_utc=''' || ts_utc || '''|source_row_id=''' || event_id || ''''), 32) AS measurement_id FROM lr"""),
    "identity_collapse": _with(_L, "SELECT count(*) AS n_rows, count(DISTINCT (quantity, ts_utc, event_id)) AS n_ids FROM lr"),
    "ingested_at_single": "SELECT CAST(count(*) > 0 AS BIGINT) AS stamps FROM events WHERE event_type <> 'error'",
    "ts_epoch_ms": _with(_L, "SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S.%gZ') END AS ts_utc FROM l"),
    "ts_epoch_s": _with(_L, "SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%SZ') END AS ts_utc FROM l"),
    "ts_iso8601": _with(_W + "," + _ISO, "SELECT id, ts_utc FROM i"),
    "fn_event_date": _with(_W + "," + _ISO, "SELECT id, strftime(moment, '%Y-%m-%d') AS event_date FROM i"),
    "fn_none": _with(_W, "SELECT id, q AS value FROM w"),
    "fn_scale_by_factor": _with(_W, "SELECT id, price * uk AS value FROM wf WHERE uk IS NOT NULL"),
    "fn_scale_uk_ik": _with(_W, "SELECT id, price * (uk * ik) AS value FROM wf WHERE uk IS NOT NULL"),
    "fn_parse_decimal": _with(_W, "SELECT id, tax AS value FROM w"),
    "fn_device_id": _with(_W, "SELECT DISTINCT meter, 'demo:meter:' || meter AS device_id FROM w"),
    "join_device_factors": _with(_W, "SELECT meter, uk, ik, count(*) AS n FROM wf GROUP BY ALL"),
    "wide_unpivot": _with(_W, "SELECT id, quantity, phase, unit, value FROM c"),
    "wide_generated_harmonics": _with(_W + "," + _G, "SELECT id, phase, harmonic_order, value FROM g"),
    "wide_all_cells": _with(_W + "," + _G, """SELECT quantity, phase, CAST(NULL AS INT) AS harmonic_order, count(*) AS n, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) AS VARCHAR) AS total FROM c GROUP BY ALL
        UNION ALL SELECT 'pressure_ripple', phase, harmonic_order, count(*), CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) AS VARCHAR) FROM g GROUP BY ALL"""),
    "null_cell_skip": _with(_W, "SELECT count(*) AS cells_null_skipped FROM w WHERE disc IS NULL"),
    "rule_record_not_null": _ruled("disc IS NOT NULL"),
    "rule_record_suspect": _ruled(quality="CASE WHEN disc IS NULL THEN 'suspect' ELSE 'ok' END"),
    "rule_record_range": _ruled("q BETWEEN 2 AND 48"),
    "rule_quantity_suspect": _ruled(quality="CASE WHEN quantity = 'load' AND value > 48 THEN 'suspect' ELSE 'ok' END"),
    "rule_quantity_drop": _ruled("NOT (quantity = 'flow' AND value > 0.09)"),
    "rule_quantity_reject": _ruled("coalesce(price * uk, 0) <= 8e8"),
    "rule_one_sided_range": _ruled(quality="CASE WHEN quantity = 'load' AND value < 10 THEN 'suspect' ELSE 'ok' END"),
    # values over 48 are dropped by the rule before the one that would reject
    "rule_order": _ruled("NOT (quantity = 'load' AND value > 40) AND coalesce(disc, 0) <= 0.09", "CASE WHEN quantity = 'load' AND value > 30 THEN 'suspect' ELSE 'ok' END"),
    "run_stats": _with(_W + "," + _JUDGED + "," + _L, f"""SELECT 'demo_wide' AS source_vendor, {_COUNTS} FROM k UNION ALL
        SELECT 'demo_long', count(*), 0, count(*) FILTER (key = 'error'), count(*) FILTER (key <> 'error'), 0, 0, 0, 0 FROM l"""),
    "run_stats_written": _with(_W + "," + _JUDGED + "," + _L, f"""SELECT 'demo_wide' AS source_vendor, {_COUNTS} FROM k UNION ALL
        SELECT 'demo_long', count(*), 0, count(*) FILTER (key = 'error'), count(*) FILTER (key <> 'error'), 0, 0, 0, 0 FROM l"""),
    "run_stats_by_day": _with(_W + "," + _JUDGED, f"SELECT left(ts, 10) AS day, {_COUNTS} FROM k GROUP BY day"),
    "reconcile_counts": _with(_L, """SELECT 'demo_long' AS source_vendor, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n FROM lr GROUP BY ALL
        UNION ALL SELECT 'demo_long', 'unmapped', count(*) FROM l WHERE key NOT IN (SELECT key FROM m) UNION ALL SELECT 'demo_long', 'all', count(*) FROM l"""),
    "src_dsv": _with(_L, """SELECT event_id, CASE WHEN event_id % 100 = 3 THEN '"' ELSE '' END || key AS key, value, CAST(ms AS VARCHAR) AS "timestamp" FROM l WHERE event_id % 100 NOT IN (0, 1)"""),
    "src_json": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "src_json_ranges": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "src_latest_snapshot": "SELECT 'customer=' || o_custkey AS directory, arg_max(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), strftime(o_orderdate, '%Y-%m-%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS path FROM orders GROUP BY o_custkey",
    "src_partition": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-03'",
    "src_device_factors": "SELECT CAST(s_suppkey AS VARCHAR) AS meter, s_acctbal AS uk, CAST(s_nationkey AS DOUBLE) AS ik FROM supplier",
    "sink_staged_scan": _with(_M, "SELECT event_id, strftime(ts_utc, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_utc, event_type, value, replace(ingested_at, ' ', 'T') || '+00:00' AS ingested_at, strftime(ts_utc, '%Y-%m-%d') AS event_date FROM s"),
    "sink_typed_projection": _with(_M, f"SELECT {_SHOWN} FROM s"),
    "dedupe_latest": _with(_M, f"SELECT {_SHOWN} FROM d"),
    "merge_upsert": _with(_M, f"SELECT {_SHOWN} FROM u"),
    "merge_table": _with(_M, f"SELECT {_SHOWN} FROM u"),
    "merge_twice_idempotent": _with(_M, f"SELECT {_SHOWN} FROM u"),
    "merge_report": _with(_M, "SELECT 'staged' AS step, count(*) AS n FROM s UNION ALL SELECT 'merged', count(*) FROM d UNION ALL SELECT 'before', count(*) FROM t UNION ALL SELECT 'after', count(*) FROM u"),
    "sink_rerun_idempotent": _with(_L, "SELECT 'demo_long' AS source_vendor, 'site-1' AS run_scope, count(*) AS n, count(*) AS n_ids FROM lr"),
    "sink_scopes_coexist": _with(_L, "SELECT 'demo_long' AS source_vendor, 'site-' || x AS run_scope, count(*) AS n, count(*) AS n_ids FROM lr, (VALUES (1), (2)) v(x) GROUP BY x"),
    "dim_publish": _with(_L, """SELECT v.*, (SELECT count(*) FROM lr WHERE lr.quantity = v.quantity) AS n FROM (VALUES ('flow', 'l/s', 'house rule 4', 'Litres through the valve'),
        ('volume_total', 'm3', NULL, 'What has passed, ever'), ('load', 'pcs', NULL, NULL), ('pressure', 'bar', 'house rule 4', 'Head at the gauge')) v(quantity, usual_unit, rule_ref, meaning)"""),
    "dim_join": _with(_L, """SELECT lr.quantity, unit, usual_unit, rule_ref, meaning, count(*) AS n FROM lr LEFT JOIN (VALUES ('flow', 'l/s', 'house rule 4', 'Litres through the valve'),
        ('volume_total', 'm3', NULL, 'What has passed, ever'), ('load', 'pcs', NULL, NULL), ('pressure', 'bar', 'house rule 4', 'Head at the gauge')) v(quantity, usual_unit, rule_ref, meaning) ON v.quantity = lr.quantity GROUP BY ALL"""),
    "serving_minute_wide": _with(_W + "," + _L, """SELECT source_vendor, device_id, minute, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = 'pressure') AS DOUBLE) / 10000 / count(*) FILTER (quantity = 'pressure') AS pressure_inlet, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = 'flow') AS DOUBLE) / 10000 / count(*) FILTER (quantity = 'flow') AS flow_inlet,
        CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = 'volume_total') AS DOUBLE) / 10000 / count(*) FILTER (quantity = 'volume_total') AS volume_total, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = 'pressure_ripple') AS DOUBLE) / 10000 / count(*) FILTER (quantity = 'pressure_ripple') AS pressure_ripple_inlet, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = 'load') AS DOUBLE) / 10000 / count(*) FILTER (quantity = 'load') AS load
        FROM (SELECT 'demo_wide' AS source_vendor, 'demo:meter:' || meter AS device_id, strftime(l_shipdate, '%Y-%m-%d %H:%M') AS minute, quantity, value FROM c WHERE quantity <> 'turbidity'
          UNION ALL SELECT 'demo_long', 'demo:site:device', strftime(ts, '%Y-%m-%d %H:%M'), quantity, value FROM lr) x GROUP BY source_vendor, device_id, minute"""),
    "serving_snapshot": _with(_L, "SELECT 'demo_long' AS source_vendor, 'demo:site:device' AS device_id, quantity, phase, left(ts_utc, 16) AS minute, CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) AS VARCHAR) AS total, count(*) AS n FROM lr GROUP BY ALL"),
    "serving_refreshed": _with(_L, "SELECT 'demo_long' AS source_vendor, 'demo:site:device' AS device_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, " + ", ".join(
        f"CAST(sum(CAST(floor(value * 10000 + 0.5) AS BIGINT)) FILTER (quantity = '{q}') AS DOUBLE) / 10000 / count(*) FILTER (quantity = '{q}') AS {n}"
        for q, n in (("pressure", "pressure_inlet"), ("flow", "flow_inlet"), ("volume_total", "volume_total"), ("pressure_ripple", "pressure_ripple_inlet"))) + " FROM lr GROUP BY ALL"),
    "minute_completeness": _with(_L, """SELECT 'demo:site:device' AS device_id, p AS minutes_present, q AS minutes_possible, round(100.0 * p / q, 4) AS percent
        FROM (SELECT count(DISTINCT date_trunc('minute', ts)) AS p, epoch_us(max(date_trunc('minute', ts)) ) // 60000000 - epoch_us(min(date_trunc('minute', ts))) // 60000000 + 1 AS q FROM lr) z"""),
    "union_vendors": _with(_W + "," + _L, "SELECT 'demo_wide' AS source_vendor, count(*) AS n FROM c UNION ALL SELECT 'demo_long', count(*) FROM lr"),
    "convergence": _with(_W + "," + _L, f"""SELECT source_vendor, device_id, {_SPAN} FROM (SELECT 'demo_wide' AS source_vendor, 'demo:meter:' || meter AS device_id, value FROM c WHERE quantity = 'pressure'
        UNION ALL SELECT 'demo_long', 'demo:site:device', value FROM lr WHERE quantity = 'pressure') x GROUP BY source_vendor, device_id"""),
}

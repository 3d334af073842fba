"""The rulebook compiled to one DataFrame plan: raw records to canonical rows and counts.

The plan has one stage: scan, broadcast lookup, projections, `inline`. Rules never need a shuffle,
since a record's cells stay together until they have been judged.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.identity import measurement_id
from ..functions.templates import filled
from ..functions.timestamps import utc_instant, utc_text
from ..operators.cells import Slot, is_number, join_factors, judged, long_cells, look_up, values_of, wide_cells
from ..operators.rules import any_of, record_fails
from ..rulebook import Rulebook

#: The canonical columns, in order.
COLUMNS = [
    "measurement_id", "source_vendor", "source_dataset", "device_id", "ts_utc", "quantity", "phase", "variant", "harmonic_order", "value", "unit",
    "aggregation", "interval_s", "quality", "source_row_id", "schema_version", "ingested_at", "location_id", "session_id", "ts_session_offset_s",
]
COUNTERS = ["records_in", "records_rejected", "records_unmapped", "rows_emitted", "rows_suspect", "rows_dropped", "cells_null_skipped", "cells_factor_missing"]
_INTS = {"harmonic_order"}


class Transform:
    """Plans for one rulebook. All checks run here, before any record is read."""

    def __init__(self, book: Rulebook):
        self.book = book.check()
        self.booleans = book.format.get("type", "json") == "json"
        self.on_record, _ = book.rules()
        self.stamp_field = self.book.record.get("timestamp_field", "timestamp")

    def frame(self, records: DataFrame, factors: DataFrame | None = None, keep: set[str] | None = None) -> DataFrame:
        """One row per record: identity columns, judged cells and counts. A record that a record
        rule discards has no cells."""
        return self._frame(records, factors, keep)[0]

    def _frame(self, records: DataFrame, factors: DataFrame | None, keep: set[str] | None) -> tuple[DataFrame, list[Slot]]:
        book, r = self.book, self.book.record
        absent = [name for name in book.raw_fields() if name not in records.columns]
        if absent:
            records = records.withColumns({name: F.lit(None).cast("string") for name in absent})
        fails = lambda x: record_fails(x, self.booleans, is_number(records, x.target))
        rejected = any_of([fails(x) for x in self.on_record if x.discards])
        suspect = any_of([fails(x) for x in self.on_record if not x.discards])
        meter, stamp = r.get("meter_field"), F.col(f"`{self.stamp_field}`")
        told = {"__rejected": rejected, "__suspect": suspect}
        if meter and factors is not None:
            records = join_factors(records, factors, meter)
        else:
            told |= {"__uk": F.lit(None).cast("double"), "__ik": F.lit(None).cast("double")}
        d = records.withColumns(told | {
            "__device": filled(book.device_template), "__ts": utc_text(stamp, book.datetime_format), "__moment": utc_instant(stamp, book.datetime_format),
            "__row_id": F.col(f"`{r.get('row_id_field', 'id')}`").cast("string"),
        })
        if book.shape == "long":
            d, slots = long_cells(look_up(d, book), book, self.booleans)
            unmapped = ~F.col("__rejected") & F.col("__key").isNull()
        else:
            d, slots = wide_cells(d, book, keep, self.booleans)
            unmapped = F.lit(False)
        return judged(d.withColumn("__unmapped", unmapped), slots), slots

    def day(self) -> Column:
        """The event date of a raw record's rows."""
        return F.to_date(utc_instant(F.col(f"`{self.stamp_field}`"), self.book.datetime_format))

    def rows(self, records: DataFrame, factors: DataFrame | None = None, ingested_at: str | None = None, quantities: set[str] | None = None, extra: tuple[str, ...] = (), moment: str | None = None, counted: Observation | None = None) -> DataFrame:
        """Canonical rows. ingested_at: the run's one stamp. quantities: builds only what they
        need. extra: raw fields carried along. moment: names a further column, the instant of ts_utc,
        which is read once a record. counted: takes the run's counters from the pass that makes the
        rows. They are summed for each task that ends, so that pass must be a job's last stage: there a
        task counts once, even if it is run again after its executor was lost."""
        book = self.book
        if counted is not None and quantities is not None:
            raise ValueError("counters are of all quantities")
        # Rejection by a value lies in the generator: as a filter it would be pushed below the
        # cells and have them computed twice. Rejection by a raw field is a plain filter.
        d = self.frame(records, factors, quantities)
        if counted is not None:
            d = d.observe(counted, *self.counters())
        d = d.where(~F.col("__rejected"))
        told = [F.col("__moment").alias(moment)] if moment else []
        # array_compact isn't compiled with its neighbours, so a record's columns are made once, ahead
        # of the generator; compiled together, they would be made anew for each of its cells.
        flat = d.select("__device", "__ts", "__row_id", *extra, *told, F.inline(F.array_compact("__cells")))
        extra = (*extra, *([moment] if moment else []))
        if quantities is not None:
            flat = flat.where(F.col("quantity").isin(*sorted(quantities)))
        stamp = ingested_at or datetime.now(UTC).isoformat()
        named = flat.select(
            F.lit(book.vendor).alias("source_vendor"), F.lit(book.mapping.get("source", "")).alias("source_dataset"), F.col("__device").alias("device_id"),
            F.col("__ts").alias("ts_utc"), "quantity", "phase", "variant", "harmonic_order", "value", "unit", "aggregation",
            F.lit(book.interval_s).cast("int").alias("interval_s"), F.when(F.col("suspect"), "suspect").otherwise("ok").alias("quality"),
            F.col("__row_id").alias("source_row_id"), F.lit(str(book.mapping.get("target_schema_version", "1.0.0"))).alias("schema_version"),
            F.lit(stamp).alias("ingested_at"), F.lit(None).cast("string").alias("location_id"), F.lit(None).cast("string").alias("session_id"),
            F.lit(None).cast("int").alias("ts_session_offset_s"), *extra,
        )
        key = measurement_id([(f, F.col(f), f not in _INTS) for f in book.identity])
        return named.withColumn("measurement_id", key).select(*COLUMNS, *extra)

    def paired(self, records: DataFrame, pairs: list[tuple[str, str]], factors: DataFrame | None = None) -> tuple[DataFrame, dict[tuple[str, str], list[Column]]]:
        """Records with source_vendor, device_id and moment, their cells not taken apart into rows,
        and for each (quantity, phase) the columns with its values that are ok. A record whose values
        are all null there has no such rows."""
        d, slots = self._frame(records, factors, {q for q, _ in pairs})
        named = d.where(~F.col("__rejected") & ~F.col("__unmapped")).withColumns({"source_vendor": F.lit(self.book.vendor), "device_id": F.col("__device"), "moment": F.col("__moment")})
        return named, {pair: values_of(slots, pair) for pair in pairs}

    def counters(self) -> list[Column]:
        """Sums over `frame` that give the run's counters."""
        live = ~F.col("__rejected")
        whole = live & F.col("__reject_at").isNull()
        total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
        of = lambda test, n: total(F.when(test, n).otherwise(0))
        one = F.lit(1)
        found = [
            F.count("*"), of(~whole, one), of(F.col("__unmapped"), one), of(whole, F.col("__n_kept")),
            of(whole, F.col("__n_doubtful")), of(live, F.col("__n_dropped")), of(live, F.col("__n_null")), of(live, F.col("__n_unscaled")),
        ]
        return [c.alias(name) for c, name in zip(found, COUNTERS, strict=True)]

    def stats(self, records: DataFrame, factors: DataFrame | None = None, by: list[Column] | None = None) -> DataFrame:
        """The run's counters: one row, or one per group of `by`; batches add up by sums."""
        return self.frame(records, factors).groupBy(*(by or [])).agg(*self.counters())

    def unmapped(self, records: DataFrame) -> DataFrame:
        """key, n of a long source's records that no entry gives a meaning."""
        d = self.frame(records).where("__unmapped")
        return d.groupBy(F.coalesce(F.col(f"`{self.book.record['key_field']}`").cast("string"), F.lit("None")).alias("key")).agg(F.count("*").alias("n"))

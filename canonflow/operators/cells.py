"""From a record to measurement cells: values and verdicts as plain columns, one set a cell.

Nothing here needs a lambda, so a scan, its lookups and the cells compile to one stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import factor, number
from ..rulebook import Cell, Entry, Rule, Rulebook
from .rules import outcome

#: Mapping tables up to this many keys are broadcast; their size is known before the plan is made.
BROADCAST_KEYS = 100_000
#: The type of a record's cells.
CELLS = "array<struct<quantity:string,phase:string,variant:string,harmonic_order:int,unit:string,value:double,aggregation:string,suspect:boolean>>"


@dataclass(frozen=True)
class Slot:
    """A cell that a record may hold: its value in column __v{n}, its rules, its other fields, and
    which quantities and phases these can name."""

    rules: list[Rule]
    fields: dict[str, Column]
    pairs: frozenset[tuple[str, str]]

    def can(self, on_fail: str) -> bool:
        return any(r.on_fail == on_fail for r in self.rules)


def join_factors(records: DataFrame, factors: DataFrame, meter_field: str) -> DataFrame:
    """Each record with its meter's uk and ik (as __uk, __ik), null where there are none. A meter
    that is named twice raises: `factor_columns` keeps one row of each. The factors' side is left to
    the planner, which knows its size."""
    known = F.struct(F.col("uk").cast("double").alias("uk"), F.col("ik").cast("double").alias("ik"))
    f = factors.groupBy(F.col("meter").cast("string").alias("__meter")).agg(F.count("*").alias("__n"), F.first(known).alias("__f"))
    twice = F.raise_error(F.concat(F.lit("factors given twice for meter "), F.col("__meter"))).cast("double")
    one = lambda c: F.when(F.col("__n") == 1, F.col(f"__f.{c}")).otherwise(twice).alias(f"__{c}")
    f = f.select("__meter", one("uk"), one("ik"))
    return records.join(f, F.coalesce(F.col(f"`{meter_field}`").cast("string"), F.lit("None")) == F.col("__meter"), "left")


def is_number(records: DataFrame, name: str) -> bool:
    return isinstance(records.schema[name].dataType, T.NumericType)


def _scaled(name: str, args: dict, v: Column) -> Column:
    return v * factor(args["factor_field"], F.col("__uk"), F.col("__ik")) if name == "scale_by_factor" else v


def wide_cells(records: DataFrame, book: Rulebook, keep: set[str] | None, booleans: bool) -> tuple[DataFrame, list[Slot]]:
    """`records` with values and counts, and their slots. keep: quantities wanted; others are built
    only if a rule of theirs can reject the record."""
    rules = book.rules()[1]
    cells = [c for c in book.cells() if keep is None or c.quantity in keep or any(r.on_fail == "reject_row" for r in rules.get(c.quantity, []))]
    raw = lambda c: F.col(f"`{c.source}`")
    # Texts with another separator are rewritten a step ahead: reading a number names its text often.
    texts = {}
    for k, c in enumerate(cells):
        if c.transform == "parse_decimal" and (mark := c.args.get("decimal_separator", ".")) != ".":
            texts[f"__t{k}"] = F.replace(raw(c).cast("string"), F.lit(mark), F.lit("."))
    d = records.withColumns(texts) if texts else records

    def value(k: int, c: Cell) -> Column:
        if f"__t{k}" in texts:
            return number(F.col(f"__t{k}"), booleans)
        return _scaled(c.transform, c.args, number(raw(c), booleans, c.transform != "parse_decimal" and is_number(records, c.source)))

    count = lambda tests: sum((t.cast("int") for t in tests), F.lit(0))
    d = d.withColumns({f"__v{k}": value(k, c) for k, c in enumerate(cells)} | {"__n_null": count([raw(c).isNull() for c in cells])}) if cells else d.withColumn("__n_null", F.lit(0))
    d = d.withColumn("__n_unscaled", count([raw(c).isNotNull() & F.col(f"__v{k}").isNull() for k, c in enumerate(cells) if c.transform == "scale_by_factor"]))
    lit = lambda v, kind="string": F.lit(v).cast(kind)
    return d, [Slot(rules.get(c.quantity, []), {
        "quantity": lit(c.quantity), "phase": lit(c.phase), "variant": lit(c.variant), "harmonic_order": lit(c.harmonic_order, "int"), "unit": lit(c.unit), "aggregation": lit(book.aggregation),
    }, frozenset({(c.quantity, c.phase)})) for c in cells]


def entries_frame(spark, entries: list[Entry]) -> DataFrame:
    schema = "__key string, __quantity string, __phase string, __variant string, __order int, __unit string, __aggregation string, __transform string, __separator string, __factor string"
    rows = [(e.key, e.quantity, e.phase, e.variant, e.harmonic_order, e.unit, e.aggregation, e.transform, e.args.get("decimal_separator", "."), e.args.get("factor_field")) for e in entries]
    frame = spark.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_KEYS else frame


def look_up(records: DataFrame, book: Rulebook) -> DataFrame:
    """Each record with the meaning of its key (columns __key and on), null if it has none."""
    key = F.coalesce(F.col(f"`{book.record['key_field']}`").cast("string"), F.lit("None"))
    return records.join(entries_frame(records.sparkSession, book.entries()), key == F.col("__key"), "left")


def long_cells(records: DataFrame, book: Rulebook, booleans: bool) -> tuple[DataFrame, list[Slot]]:
    """The same as wide_cells for records that `look_up` has given a meaning: one cell at most, with
    a slot for each quantity that has rules, of which a record fills one."""
    raw, rules, entries = F.col(f"`{book.record['value_field']}`"), book.rules()[1], book.entries()
    kinds, numeric, mapped = {e.transform for e in entries}, is_number(records, book.record["value_field"]), F.col("__key").isNotNull()
    if kinds == {"none"}:
        value = F.when(mapped, number(raw, booleans, numeric))
    else:
        text = F.when(F.col("__transform") == "parse_decimal", F.replace(raw.cast("string"), F.col("__separator"), F.lit("."))).otherwise(raw.cast("string"))
        records = records.withColumn("__t", F.when(mapped, text))
        value = number(F.col("__t"), booleans)
        for name in sorted({e.args["factor_field"] for e in entries if e.transform == "scale_by_factor"}):
            value = F.when(F.col("__factor") == name, value * factor(name, F.col("__uk"), F.col("__ik"))).otherwise(value)
    d = records.withColumn("__v", value)
    fields = {
        "quantity": F.col("__quantity"), "phase": F.col("__phase"), "variant": F.col("__variant"), "harmonic_order": F.col("__order"), "unit": F.col("__unit"),
        "aggregation": F.coalesce("__aggregation", F.lit(book.aggregation)),
    }
    # Rules go by quantity: the values of each have a slot, all others share the last.
    named = [q for q in rules if q in {e.quantity for e in entries}]
    of = {f"__v{k}": F.when(F.col("__quantity") == q, F.col("__v")) for k, q in enumerate(named)}
    of[f"__v{len(named)}"] = F.when(~F.col("__quantity").isin(*named), F.col("__v")) if named else F.col("__v")
    d = d.withColumns(of | {"__n_null": (mapped & raw.isNull()).cast("int"), "__n_unscaled": (mapped & raw.isNotNull() & F.col("__v").isNull()).cast("int")})
    pairs = lambda q: frozenset((e.quantity, e.phase) for e in entries if (e.quantity if e.quantity in named else "") == q)
    return d, [Slot(rules.get(q, []), fields, pairs(q)) for q in [*named, ""]]


def judged(valued: DataFrame, slots: list[Slot]) -> DataFrame:
    """Adds __cells (those that stay, nulls for others), __ok{n} (whether a slot's cell stays and is in
    no doubt) and, for the record's counters, __reject_at (the first slot whose rule rejects the
    record), __n_kept, __n_doubtful and __n_dropped."""
    v = [F.col(f"__v{k}") for k in range(len(slots))]
    told = {}
    for k, slot in enumerate(slots):
        suspect, out = outcome(slot.rules, v[k])
        told |= {f"__s{k}": suspect} if slot.can("flag_suspect") else {}
        told |= {f"__o{k}": F.when(v[k].isNotNull(), out)} if slot.can("drop_row") or slot.can("reject_row") else {}
    d = valued.withColumns(told) if told else valued
    stays = [F.col(f"__o{k}") == "keep" if f"__o{k}" in told else v[k].isNotNull() for k in range(len(slots))]
    doubt = [F.col("__suspect") | F.col(f"__s{k}") if f"__s{k}" in told else F.col("__suspect") for k in range(len(slots))]
    rejects = [F.when(F.col(f"__o{k}") == "reject", k) for k, slot in enumerate(slots) if slot.can("reject_row")]
    first = F.least(*rejects, F.lit(None).cast("int")) if rejects else F.lit(None).cast("int")
    d = d.withColumn("__reject_at", first)
    at, none = F.col("__reject_at"), F.lit(None).cast(CELLS[6:-1])
    count = lambda tests: sum((F.coalesce(t, F.lit(False)).cast("int") for t in tests), F.lit(0))

    def cell(k: int, slot: Slot) -> Column:
        f = slot.fields
        made = F.struct(*[f[n].alias(n) for n in ("quantity", "phase", "variant", "harmonic_order", "unit")], v[k].alias("value"), f["aggregation"].alias("aggregation"), doubt[k].alias("suspect"))
        return F.when(stays[k] & at.isNull() if rejects else stays[k], made).otherwise(none)

    # A reject ends the record's judging: drops after it don't count, those before it do.
    dropped = [(F.col(f"__o{k}") == "drop") & (at.isNull() | (F.lit(k) < at)) for k, slot in enumerate(slots) if slot.can("drop_row")]
    return d.withColumns({f"__ok{k}": stays[k] & ~doubt[k] & at.isNull() for k in range(len(slots))} | {
        "__cells": F.array(*[cell(k, slot) for k, slot in enumerate(slots)]).cast(CELLS), "__n_kept": count(stays),
        "__n_doubtful": count([s & x for s, x in zip(stays, doubt, strict=True)]), "__n_dropped": count(dropped),
    })


def values_of(slots: list[Slot], pair: tuple[str, str]) -> list[Column]:
    """Columns over a judged record with the values that it has of a (quantity, phase) and that are
    ok, null for others; no column if no slot can have any."""
    quantity, phase = pair
    found = [(k, slot) for k, slot in enumerate(slots) if pair in slot.pairs]
    return [F.when(F.col(f"__ok{k}") & (slot.fields["quantity"] == quantity) & (slot.fields["phase"] == phase), F.col(f"__v{k}")) for k, slot in found]


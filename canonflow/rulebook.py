"""The rulebook: plain data that says how a vendor's records become canonical rows.

Everything that the engine can't honour raises here, before a row is read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from string import Formatter
from typing import Any

#: The closed sets of names that a rulebook may use.
TRANSFORMS = {"none", "scale_by_factor", "parse_decimal"}
FACTORS = {"uk", "ik", "uk_ik"}
DATETIME_FORMATS = {"iso8601", "epoch_ms", "epoch_s"}
SOURCE_FORMATS = {"json", "csv"}
RULE_TYPES = {"not_null", "range"}
ON_FAIL = {"flag_suspect", "drop_row", "reject_row"}
SERVING_MODES = {"view", "table"}
#: The identity fields, in the order in which they are hashed by default.
IDENTITY = ("source_vendor", "device_id", "ts_utc", "quantity", "phase", "variant", "harmonic_order", "aggregation", "source_row_id")


class RulebookError(ValueError):
    """The rulebook asks for something that the engine doesn't do."""


@dataclass(frozen=True)
class Rule:
    """One validation rule; `target` is a raw field or a quantity."""

    target: str
    kind: str
    on_fail: str
    low: float | None = None
    high: float | None = None

    @property
    def discards(self) -> bool:
        return self.on_fail != "flag_suspect"


@dataclass(frozen=True)
class Cell:
    """One measurement that a wide record can hold."""

    source: str
    quantity: str
    phase: str
    unit: str
    variant: str = "none"
    harmonic_order: int | None = None
    transform: str = "none"
    args: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Entry:
    """The meaning of one key of a long source."""

    key: str
    quantity: str
    phase: str
    unit: str
    variant: str = "none"
    harmonic_order: int | None = None
    aggregation: str | None = None
    transform: str = "none"
    args: dict = field(default_factory=dict)


def _transform(entry: dict[str, Any]) -> tuple[str, dict]:
    name, args = entry.get("transform", "none"), entry.get("args") or {}
    if name not in TRANSFORMS:
        raise RulebookError(f"unknown transform {name!r}")
    if name == "scale_by_factor" and args.get("factor_field") not in FACTORS:
        raise RulebookError(f"scale_by_factor needs a factor_field of {sorted(FACTORS)}, not {args.get('factor_field')!r}")
    return name, args


@dataclass(frozen=True)
class Rulebook:
    """A vendor's documents, as plain data."""

    vendor: str
    source: dict[str, Any] = field(default_factory=dict)
    mapping: dict[str, Any] = field(default_factory=dict)
    validation: dict[str, Any] = field(default_factory=dict)
    target: dict[str, Any] = field(default_factory=dict)
    canonical: dict[str, Any] = field(default_factory=dict)
    vocabulary: dict[str, Any] = field(default_factory=dict)
    units: dict[str, Any] = field(default_factory=dict)

    @property
    def record(self) -> dict[str, Any]:
        return self.source.get("record", {})

    @property
    def shape(self) -> str:
        shape = self.source.get("shape", "wide")
        if shape not in ("wide", "long"):
            raise RulebookError(f"unknown shape {shape!r}")
        if shape == "long" and not (self.record.get("key_field") and self.record.get("value_field")):
            raise RulebookError("a long source needs record.key_field and record.value_field")
        return shape

    @property
    def format(self) -> dict[str, Any]:
        found = self.source.get("format", {})
        if (kind := found.get("type", "json")) not in SOURCE_FORMATS:
            raise RulebookError(f"unknown source format {kind!r}")
        if found.get("header"):
            raise RulebookError("delimited sources with a header line aren't supported: declare the fields")
        return found

    @property
    def datetime_format(self) -> str:
        if (kind := self.format.get("datetime_format", "iso8601")) not in DATETIME_FORMATS:
            raise RulebookError(f"unknown datetime_format {kind!r}")
        return kind

    @property
    def device_template(self) -> str:
        meter = self.record.get("meter_field")
        default = f"{self.vendor}:meter:{{{meter}}}" if meter else f"{self.vendor}:device"
        return self.record.get("device_id_template", default)

    @property
    def aggregation(self) -> str:
        return self.source.get("defaults", {}).get("aggregation", "instantaneous")

    @property
    def interval_s(self) -> int | None:
        return self.source.get("defaults", {}).get("interval_s")

    @property
    def identity(self) -> tuple[str, ...]:
        fields = tuple(self.target.get("measurement_id_from", IDENTITY))
        if unknown := [f for f in fields if f not in IDENTITY]:
            raise RulebookError(f"identity fields {unknown} are none of {IDENTITY}")
        return fields

    def cells(self) -> list[Cell]:
        """Mapped columns in order, then generated ones: orders times phases."""
        out = []
        for c in self.mapping.get("columns", []):
            name, args = _transform(c)
            out.append(Cell(c["src"], c["quantity"], c["phase"], c["unit"], c.get("variant", "none"), None, name, args))
        for g in self.mapping.get("generated", []):
            out += [Cell(g["pattern"].format(order=order, p=index), g["quantity"], phase, g["unit"], harmonic_order=int(order)) for order in g["order"] for index, phase in g["phase_map"].items()]
        return out

    def entries(self) -> list[Entry]:
        """Meanings by key; of entries with one key the last counts."""
        found = {}
        for r in self.mapping.get("rows", []):
            name, args = _transform(r)
            found[str(r["key"])] = Entry(str(r["key"]), r["quantity"], r["phase"], r["unit"], r.get("variant", "none"), r.get("harmonic_order"), r.get("aggregation"), name, args)
        return list(found.values())

    def rules(self) -> tuple[list[Rule], dict[str, list[Rule]]]:
        """Rules on raw fields, and rules by quantity, each in the order given."""
        on_record: list[Rule] = []
        on_quantity: dict[str, list[Rule]] = {}
        for r in (self.validation or {}).get("rules", []):
            if "entity" in r:
                if r["entity"] == "measurement" and r.get("field") == "value" and r["type"] == "not_null":
                    continue  # null values never become rows
                raise RulebookError(f"unsupported entity rule {r}")
            if r["type"] not in RULE_TYPES or r["on_fail"] not in ON_FAIL:
                raise RulebookError(f"unsupported rule {r}")
            target = r.get("quantity") if r.get("quantity") is not None else r.get("field")
            if target is None:
                raise RulebookError(f"a rule without field, quantity or entity: {r}")
            rule = Rule(target, r["type"], r["on_fail"], r.get("min"), r.get("max"))
            if r.get("quantity") is not None:
                on_quantity.setdefault(target, []).append(rule)
            else:
                on_record.append(rule)
        return on_record, on_quantity

    def check(self) -> Rulebook:
        """Everything that can be wrong raises."""
        _ = self.shape, self.datetime_format, self.identity
        self.cells(), self.entries(), self.rules()
        return self

    def raw_fields(self) -> list[str]:
        """The record fields that the plan reads, so that nothing else is parsed."""
        r = self.record
        found = [r.get("timestamp_field", "timestamp"), r.get("row_id_field", "id"), r.get("meter_field"), r.get("key_field"), r.get("value_field")]
        found += [name for _, name, _, _ in Formatter().parse(self.device_template) if name]
        found += [c.source for c in self.cells()] + [x.target for x in self.rules()[0]]
        return list(dict.fromkeys(f for f in found if f))

    # target

    def table_name(self) -> str:
        t = self.target
        return ".".join(t[k] for k in ("catalog", "schema", "table") if t.get(k))

    def schema_name(self, schema: str | None = None) -> str:
        return ".".join(x for x in (self.target.get("catalog"), schema or self.target["schema"]) if x)

    def serving_mode(self) -> str:
        if (mode := self.target.get("serving_mode", "view")) not in SERVING_MODES:
            raise RulebookError(f"unknown serving_mode {mode!r}")
        return mode

    def serving_name(self, name: str) -> str:
        if not self.target.get("serving_schema"):
            raise RulebookError("the target has no serving_schema")
        return f"{self.schema_name(self.target['serving_schema'])}.{name}"

    def terms(self, vocabulary: str) -> dict[str, Any]:
        """A published vocabulary."""
        if vocabulary == "quantities":
            return self.vocabulary.get("quantities", {})
        if vocabulary == "units":
            return self.units.get("units", {})
        raise RulebookError(f"unknown vocabulary {vocabulary!r}")

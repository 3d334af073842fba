"""Timestamps: the canonical text, and the instant and date it stands for.

The session's time zone must be UTC (session.prepare)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|z|[+-]\d{2}(?::?\d{2})?)?"
#: The ISO forms taken, with and without separators.
_EXTENDED = rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:.(\d{{2}})(?::(\d{{2}})(?::(\d{{2}})(?:[.,](\d+))?)?)?{_OFFSET})?$"
_BASIC = rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:.(\d{{2}})(?:(\d{{2}})(?:(\d{{2}})(?:[.,](\d+))?)?)?{_OFFSET})?$"
_FIRST_S, _LAST_S = -62_135_596_800, 253_402_300_799  # years 1 to 9999


_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"


#: How what an ISO text leaves out is filled in, one after the other: hour, minute, second, fraction
#: (of which microseconds are kept), offset and its minutes.
_FILLED = [
    (" :", " 00:"), ("::", ":00:"), (":\\.", ":00."), ("\\. ", ".0 "), (r"\.(\d{6})\d+", ".$1"), (" $", " Z"),
    (r" ([+-]\d{2})$", " $1:00"), (r" ([+-]\d{2})(\d{2})$", " $1:$2"), (r" (\S+)$", "$1"),
]


def iso_instant(text: Column) -> Column:
    """The instant of an ISO text, naive ones taken as UTC; null if it is none. The usual form is
    cast as it is; only other forms are rewritten, each step naming the one before once, so that the
    expression stays small."""
    groups = "$1-$2-$3 $4:$5:$6.$7 $8"
    usual = F.when(text.rlike(_EXTENDED), F.regexp_replace(text, _EXTENDED, groups)).when(text.rlike(_BASIC), F.regexp_replace(text, _BASIC, groups))
    stamp = F.upper(usual)
    for pattern, by in _FILLED:
        stamp = F.regexp_replace(stamp, pattern, by)
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp")).otherwise(stamp.try_cast("timestamp"))


def utc_text(raw: Column, kind: str) -> Column:
    """iso8601: the text, with Z if it names no offset. epoch_ms and epoch_s: exact text of the
    instant. Null if it can't be parsed; an epoch outside years 1 to 9999 raises."""
    text = raw.cast("string")
    if kind == "iso8601":
        # Only a text with a clock names an offset, at its end.
        named = (F.length(text) > 10) & F.right(text, F.lit(6)).rlike(r"(Z|z|[+-]\d{2}(:?\d{2})?)$")
        return F.when(iso_instant(text).isNotNull(), F.when(named, text).otherwise(F.concat(text, F.lit("Z"))))
    ticks = F.trim(text).try_cast("bigint")
    unit = 1000 if kind == "epoch_ms" else 1
    inside = (ticks >= _FIRST_S * unit) & (ticks < (_LAST_S + 1) * unit)
    if kind == "epoch_ms":
        shown = F.date_format(F.timestamp_millis(ticks), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    else:
        shown = F.date_format(F.timestamp_seconds(ticks), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    outside = F.raise_error(F.concat(F.lit("epoch out of range: "), text)).cast("string")
    return F.when(inside, shown).when(ticks.isNotNull(), outside)


def utc_instant(raw: Column, kind: str) -> Column:
    """The instant of what `utc_text` shows, from the raw value; null where it is null."""
    text = raw.cast("string")
    if kind == "iso8601":
        return iso_instant(text)
    ticks = F.trim(text).try_cast("bigint")
    return F.timestamp_millis(ticks) if kind == "epoch_ms" else F.timestamp_seconds(ticks)


def instant(ts_utc: Column) -> Column:
    """The instant of a canonical text. A date with Z glued on is midnight."""
    return iso_instant(F.when(F.length(ts_utc) <= 11, F.rtrim(ts_utc, F.lit("Z"))).otherwise(ts_utc))


def event_date(ts_utc: Column) -> Column:
    """The UTC date of the instant, null if unknown."""
    return F.to_date(instant(ts_utc))

"""Numbers from raw values."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what counts as a number. Narrower than a cast, which also takes 1.5d and 1.5f.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def number(raw: Column, booleans: bool = False, numeric: bool = False) -> Column:
    """A text or number as double; other text raises. booleans: true and false count as 1 and 0,
    for JSON sources, whose booleans arrive as text. numeric: the column's type is a number.

    A text that casts, ends in a digit and isn't hexadecimal needs no pattern."""
    if numeric:
        return raw.cast("double")
    text = raw.cast("string")
    cast = F.trim(text).try_cast("double")
    plain = F.right(text, F.lit(1)).between("0", "9") & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    bad = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    out = F.when(cast.isNotNull() & plain, cast).when(text.rlike(NUMBER), F.trim(text).cast("double")).when(text.isNotNull(), bad)
    if booleans:
        out = F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(out)
    return out


def factor(name: str, uk: Column, ik: Column) -> Column:
    """A device factor, null if a part of it is missing."""
    return {"uk": uk, "ik": ik, "uk_ik": uk * ik}[name]


def exact_sum(value: Column, digits: int) -> Column:
    """A sum in units of the last of so many places, which doesn't depend on the order of its terms."""
    return F.sum(F.floor(value * F.lit(10.0**digits) + F.lit(0.5)).cast("decimal(20,0)"))


def mean(values: list[Column], digits: int | None = None) -> Column:
    """The mean of a group's values that aren't null, of which a row may have several; null if there
    are none. digits: values are summed in units of that many places, as `exact_sum` does, but as two
    longs, the units' upper and lower 32 bits, which are shorter to keep and quicker to add than
    decimals. Exact for up to 2**31 values a group; more may raise, never wrap."""
    some = [v.isNotNull() for v in values]

    def total(terms: list[Column]) -> Column:
        return F.sum(terms[0] if len(terms) == 1 else reduce(add, [F.coalesce(t, F.lit(0)) for t in terms]))

    n = F.count(values[0]) if len(values) == 1 else total([t.cast("long") for t in some])
    n = F.nullif(n, F.lit(0))
    if digits is None:
        return total(values) / n
    units = [F.floor(v * F.lit(10.0**digits) + F.lit(0.5)) for v in values]
    high, low = total([F.shiftright(u, 32) for u in units]), total([u.bitwiseAND(F.lit(2**32 - 1)) for u in units])
    short = high.between(-(2**30), 2**30) & (low < F.lit(2**62))  # so the whole is a long
    long = high.cast("decimal(20,0)") * F.lit(Decimal(2**32)) + low.cast("decimal(20,0)")
    return F.when(short, (high * F.lit(2**32) + low).cast("double")).otherwise(long.cast("double")) / F.lit(10.0**digits) / n

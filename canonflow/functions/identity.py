"""Deterministic ids: a hash over named fields, each shown as a Python literal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: control and Latin-1 characters that a literal shows in hexadecimal.
_HIDDEN = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\xa0\\xad]"
#: Printable ASCII but for quotes and the backslash: a literal shows it as it is.
_PLAIN = r"^[ !#-&(-\[\]-~]*$"


def literal(text: Column) -> Column:
    """A text as Python shows it: single quotes unless it has only single ones inside; backslash,
    tab, newline, return and hidden characters escaped; null as None."""
    out = text
    for raw, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    shown_hex = lambda c: F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(F.ascii(c)), 2, "0")))
    one_by_one = F.transform(F.split(out, ""), lambda c: F.when(c.rlike(_HIDDEN), shown_hex(c)).otherwise(c))
    out = F.when(text.rlike(_HIDDEN), F.array_join(one_by_one, "")).otherwise(out)
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    shown = F.when(double, F.concat(F.lit('"'), out, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(out, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.coalesce(shown, F.lit("None"))


def measurement_id(fields: list[tuple[str, Column, bool]]) -> Column:
    """fields: name, value, whether it is a text. 32 hex digits. Texts that show as they are, as nearly
    all do, are told by one pattern over all of them."""
    texts = [value for _, value, is_text in fields if is_text]
    bare = lambda v: F.coalesce(v.cast("string"), F.lit("None"))
    quoted = lambda v: F.coalesce(F.concat(F.lit("'"), v, F.lit("'")), F.lit("None"))
    plain = F.concat_ws("|", *[F.concat(F.lit(f"{name}="), quoted(value) if is_text else bare(value)) for name, value, is_text in fields])
    # One rule for all fields, so that the expression stays small.
    told = F.array(*[F.struct(F.lit(f"{name}=").alias("name"), value.cast("string").alias("v"), F.lit(is_text).alias("is_text")) for name, value, is_text in fields])
    shown = F.array_join(F.transform(told, lambda f: F.concat(f["name"], F.when(f["is_text"], literal(f["v"])).otherwise(bare(f["v"])))), "|")
    return F.left(F.sha2(F.when(F.concat_ws("", *texts).rlike(_PLAIN), plain).otherwise(shown), 256), F.lit(32))

"""Text templates over a record's fields."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(template: str) -> Column:
    """`{field}` stands for the field's text, None if it is null."""
    parts: list[Column] = []
    for before, name, _spec, _conversion in Formatter().parse(template):
        if before:
            parts.append(F.lit(before))
        if name:
            parts.append(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")

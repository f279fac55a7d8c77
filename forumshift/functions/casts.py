"""Casts with the reference's NULL defaults.

Strictness is part of the expression: text that is no value raises whatever the session's ANSI
setting is, unless ``tolerant`` makes it NULL (which then takes the caller's default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _strict(text: Column, value: Column, kind: str, tolerant: bool) -> Column:
    if tolerant:
        return value
    failed = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    return F.when(text.isNotNull() & value.isNull(), failed).otherwise(value)


def to_smallint(text: Column, tolerant: bool = False) -> Column:
    """E11 ``cast(text as smallint)``.  T-SQL casts an empty or blank string to 0."""
    trimmed = F.trim(text)
    value = F.when(trimmed == F.lit(""), F.lit(0).cast("smallint")).otherwise(trimmed.try_cast("smallint"))
    return _strict(trimmed, value, "smallint", tolerant)


def to_date_strict(text: Column, tolerant: bool = False) -> Column:
    """E11 ``cast(text as date)`` accepting ``yyyy-mm-ddThh:mm:ss`` like the reference's default."""
    return _strict(text, text.try_cast("date"), "date", tolerant)

"""Strict casts and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed(value: Column | str, data_type: str, strict: bool = True) -> Column:
    """Strict cast (E2): a value that does not fit fails the job, or is NULL if not strict."""
    column = F.col(value) if isinstance(value, str) else value
    return column.cast(data_type) if strict else column.try_cast(data_type)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that answers NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("bigint"))


def change_pct(current: Column, previous: Column) -> Column:
    """Percentage change against ``previous``; NULL if either is missing or it is zero."""
    return F.lit(100).cast("decimal(4,1)") * (current - previous) / F.nullif(
        previous, F.lit(0).cast("decimal(28,2)")
    )

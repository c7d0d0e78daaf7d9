"""Safe casts: bad input becomes NULL instead of failing the job.

Spark 4 runs with ANSI semantics, where ``cast``/``to_date`` raise on bad
strings; the staged data is messy, so every conversion uses ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column

from dimforge.functions._util import as_col


def to_decimal(c, precision: int, scale: int) -> Column:
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def to_int(c) -> Column:
    return as_col(c).try_cast("int")


def to_string(c) -> Column:
    return as_col(c).cast("string")


def parse_date(c) -> Column:
    """Strings like ``'2010-10-01'`` or ``'2010-10-01 00:00:00.000'``,
    timestamps and dates -> date; anything unparsable -> NULL."""
    return as_col(c).try_cast("date")


def parse_timestamp(c) -> Column:
    """-> timestamp without time zone (the wall-clock value as written)."""
    return as_col(c).try_cast("timestamp_ntz")

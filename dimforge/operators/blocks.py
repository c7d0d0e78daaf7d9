"""Integer sets with 64 neighbouring values in a row, as the bits of a number.

``pack`` makes the rows, ``block`` and ``place`` say where a value is: it is
in the set where the row of its ``block`` has the bit of its ``place``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, MEMBERS = "__block", "__members"


def block(value: Column) -> Column:
    return F.shiftright(value, 6)


def place(value: Column) -> Column:
    return value.bitwiseAND(63).cast("int")


def has(members: str | Column, value: Column) -> Column:
    return F.getbit(members, place(value)) == 1


def pack(rows: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """The values of the last column of ``rows`` (but ``flags``; no NULLs) packed
    for each combination of the columns before it: these, ``BLOCK`` and
    ``MEMBERS``, or, of a table with boolean columns ``flags``, the members
    with each flag under its name."""
    *others, key = [c for c in rows.columns if c not in flags]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place(F.col(key)))
    bits = [F.bit_or(F.when(F.col(f), bit).otherwise(F.lit(0).cast("bigint"))).alias(f) for f in flags]
    return (rows.groupBy(*others, block(F.col(key)).alias(BLOCK)).agg(*(bits or [F.bit_or(bit).alias(MEMBERS)]))
            .sortWithinPartitions(BLOCK))

"""Frame-level null handling (use with ``DataFrame.transform``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def blank_to_null(df: DataFrame, *sentinels: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn sentinel strings into NULL in every string column (default
    sentinel: the empty string).  Non-string columns are untouched."""
    sentinels = sentinels or ("",)
    targets = set(columns if columns is not None else _string_columns(df))
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in targets:
            c = F.when(~c.isin(*sentinels), c)
        out.append(c.alias(name) if name in targets else c)
    return df.select(*out)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``coalesce(column, default)`` per column; the default is cast to the
    column's own type, so a decimal column stays decimal."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = set(defaults) - set(types)
    if missing:
        raise ValueError(f"fill_defaults: unknown columns {sorted(missing)}")
    return df.select(*[
        F.coalesce(F.col(n), F.lit(defaults[n]).cast(types[n])).alias(n) if n in defaults else F.col(n)
        for n in df.columns
    ])


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    cond = F.lit(True)
    for n in subset:
        cond = cond & F.col(n).isNotNull()
    return df.where(cond)

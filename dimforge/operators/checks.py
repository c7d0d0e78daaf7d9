"""Declared-constraint checks (NOT NULL, unique, length, numeric range, FK).

Every check returns rows ``(table_name, check_name, column_name,
violations)``; a clean table gives ``violations = 0``.  Checks over one
table are fused into a single aggregate pass where they can be.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators.refcheck import flag_matches, key_set, keep_missing

RESULT_COLUMNS = ["table_name", "check_name", "column_name", "violations"]


def _rows(df: DataFrame, table: str, check: str, exprs: Mapping[str, F.Column]) -> DataFrame:
    names = list(exprs)
    one = df.agg(*[e.cast("long").alias(f"v{i}") for i, e in enumerate(exprs.values())])
    per = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"v{i}").alias("violations"))
                              for i, n in enumerate(names)]))
    return one.select(per.alias("r")).select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                                             "r.column_name", F.coalesce("r.violations", F.lit(0)).alias("violations"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _rows(df, table, "not_null", {c: F.count_if(F.col(c).isNull()) for c in columns})


def max_length(df: DataFrame, table: str, bounds: Mapping[str, int]) -> DataFrame:
    return _rows(df, table, "max_length", {c: F.count_if(F.length(c) > n) for c, n in bounds.items()})


def numeric_fits(df: DataFrame, table: str, columns: Sequence[str], precision: int = 15,
                 scale: int = 2) -> DataFrame:
    t = f"decimal({precision},{scale})"
    return _rows(df, table, f"numeric({precision},{scale})",
                 {c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c in columns})


def unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Number of key values (NULL included) held by more than one row."""
    dup = df.groupBy(key).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"), F.lit(key).alias("column_name"),
        F.col("violations").cast("long").alias("violations"))


def foreign_key(df: DataFrame, table: str, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Rows with a non-NULL ``column`` value that ``ref[ref_column]`` lacks."""
    missing = keep_missing(df.where(F.col(column).isNotNull()).select(column), key_set(ref, ref_column), [column])
    return missing.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("foreign_key").alias("check_name"),
        F.lit(column).alias("column_name"), F.col("violations").cast("long").alias("violations"))


def foreign_keys(tables: Mapping[str, DataFrame], declared: Sequence[tuple[str, str, str, str]],
                 keys: Callable[[str, str], DataFrame]) -> DataFrame:
    """``foreign_key`` for all ``declared`` (table, column, referenced table,
    referenced column): a table is read once for all its references.
    ``keys(table, column)`` gives the distinct non-NULL keys of a referenced column."""
    parts = []
    for table in dict.fromkeys(t for t, _, _, _ in declared):
        refs = [(c, rt, rc) for t, c, rt, rc in declared if t == table]
        df = tables[table].select(*dict.fromkeys(c for c, _, _ in refs))
        for i, (c, rt, rc) in enumerate(refs):
            df = flag_matches(df, keys(rt, rc), [c], f"__known{i}")
        parts.append(_rows(df, table, "foreign_key", {
            c: F.count_if(F.col(c).isNotNull() & ~F.col(f"__known{i}")) for i, (c, _, _) in enumerate(refs)}))
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

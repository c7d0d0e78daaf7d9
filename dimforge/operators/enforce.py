"""Declared constraints enforced row by row.

``classify`` compiles a table's declared constraints into one array column:
the names of those a row breaks (empty: the row may be loaded).

* NOT NULL, text length and numeric range are expressions on the row; they
  cost one projection.
* A foreign key is a left join with the referenced key set (distinct, written).
* UNIQUE is checked against the target, then inside the batch.  A row loses
  when the target holds its value under another key, even if the same batch
  moves that key to another value: the outcome then depends on no order of
  rows.  Of the rows left, the one with the largest key keeps a value.  Only
  values held under several keys are joined back: one aggregate with
  map-side combine finds them, and a batch that has none pays for nothing else.

A row that breaks an earlier constraint holds no unique value.  NULL values
are never equal to each other and refer to nothing, as in SQL.  The primary
key itself is not checked here: ``operators.upsert.split_incoming`` rejects
NULL and repeated keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge import schemas as S
from dimforge.operators.refcheck import flag_matches, key_set, written

VIOLATIONS = "__violations"


@dataclass(frozen=True)
class Constraints:
    """What a table declares.  ``unique``: column tuples besides the primary
    key; ``foreign``: (column, referenced table, referenced column)."""

    not_null: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    numeric: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, str, str], ...] = ()


def declared(table: str, key: str, mode: str = "compat") -> Constraints:
    """The warehouse schema's constraints on ``table``.  With strict keys an
    entity is identified by type and id, so its uniqueness covers both."""
    unique = []
    for c in S.UNIQUE.get(table, []):
        entity_type = c.replace("_object_id", "_entity_type")
        if c != key:
            unique.append((entity_type, c) if mode == "strict" and entity_type != c else (c,))
    return Constraints(
        not_null=tuple(c for c in S.NOT_NULL.get(table, []) if c != key),
        max_length=S.MAX_LENGTH.get(table, {}),
        numeric={c: (15, 2) for c in S.NUMERIC_15_2.get(table, [])},
        unique=tuple(unique),
        foreign=tuple((c, rt, rc) for t, c, rt, rc in S.FOREIGN_KEYS if t == table))


def row_violations(c: Constraints, columns: list[str]) -> Column:
    """The constraints on single values that a row breaks, in declared order."""
    found = [F.when(F.col(x).isNull(), F.lit(f"{x} is NULL")) for x in c.not_null if x in columns]
    found += [F.when(F.length(x) > n, F.lit(f"{x} is longer than {n}")) for x, n in c.max_length.items() if x in columns]
    found += [F.when(F.col(x).isNotNull() & F.col(x).try_cast(f"decimal({p},{s})").isNull(), F.lit(f"{x} exceeds numeric({p},{s})"))
              for x, (p, s) in c.numeric.items() if x in columns]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _add(df: DataFrame, broken: Column, text: str) -> DataFrame:
    return df.withColumn(VIOLATIONS, F.when(broken, F.array_append(VIOLATIONS, F.lit(text))).otherwise(F.col(VIOLATIONS)))


def _same(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & (F.col(a) == F.col(b))
    return cond


def _unique(df: DataFrame, key: str, cols: tuple[str, ...], target: DataFrame | None) -> DataFrame:
    columns, name = df.columns, f"{', '.join(cols)} is not unique"
    tmp = [f"__u{i}" for i in range(len(cols))]

    def spans(d: DataFrame) -> DataFrame:
        """Smallest and largest key of every value."""
        whole = F.lit(True)
        for x in cols:
            whole = whole & F.col(x).isNotNull()
        return (d.where(whole).groupBy(*[F.col(x).alias(t) for x, t in zip(cols, tmp)])
                .agg(F.min(key).alias("__lo"), F.max(key).alias("__hi")))

    clean = F.size(VIOLATIONS) == 0
    if target is not None:
        df = _add(df.join(spans(target), _same(list(cols), tmp), "left"),
                  clean & F.coalesce((F.col(key) != F.col("__lo")) | (F.col(key) != F.col("__hi")), F.lit(False)),
                  f"{name} in the table").select(*columns)
    several = written(spans(df.where(clean)).where("__lo <> __hi"))
    if several.take(1):
        df = _add(df.join(several, _same(list(cols), tmp), "left"),
                  clean & F.coalesce(F.col(key) != F.col("__hi"), F.lit(False)), name).select(*columns)
    return df


def classify(incoming: DataFrame, c: Constraints, key: str, target: DataFrame | None = None,
             refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``incoming`` with the array column ``VIOLATIONS``.

    ``target``: the table as loaded so far; ``refs``: the referenced tables
    by name (a foreign key whose table is not given is not checked)."""
    df = incoming.withColumn(VIOLATIONS, row_violations(c, incoming.columns))
    for col, table, ref_col in c.foreign:
        if refs and table in refs and col in incoming.columns:
            flagged = flag_matches(df, key_set(refs[table], ref_col), [col], "__known")
            df = _add(flagged, F.col(col).isNotNull() & ~F.col("__known"), f"{col} is not in {table}.{ref_col}").drop("__known")
    for cols in c.unique:
        if set(cols) <= set(incoming.columns):
            there = target if target is not None and {key, *cols} <= set(target.columns) else None
            df = _unique(df, key, cols, there)
    return df


def split_violations(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be loaded, the others with a ``reason``)."""
    clean = F.size(VIOLATIONS) == 0
    return (classified.where(clean).drop(VIOLATIONS),
            classified.where(~clean).withColumn("reason", F.array_join(VIOLATIONS, "; ")).drop(VIOLATIONS))

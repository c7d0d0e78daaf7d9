"""Reference (foreign-key) checks that keep every rejected row.

A fact is *classified* once: each reference becomes a boolean flag from a
left join against the distinct, non-NULL key set of the referenced
dimension.  Because the key set is distinct the join never fans out, and
the valid and the quarantined rows are two filters of the same frame (so
they partition the input exactly; nothing is recomputed differently).

No broadcast is forced.  Key sets and lookup tables are written once to the
shared checkpoint folder and read back, so the planner knows their size (it
broadcasts one only below ``spark.sql.autoBroadcastJoinThreshold``) and, in
a sort-merge join, a plain shuffle lies under the sort on both sides: only
then can AQE split the partition of a hot fact key (an aggregate between
shuffle and sort would keep it whole).

Integer keys can be ``packed``: one row holds 64 neighbouring values as the bits
of a number.  Where ids lie close together, such a set is up to 64 times shorter, so the
planner broadcasts it for far larger dimensions and the fact is not shuffled;
where they are far apart, it has a row a key like the plain one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from dimforge.operators.blocks import BLOCK, MEMBERS, block, has, pack
from dimforge.operators.dedupe import distinct_keys, written


def key_set(dim: DataFrame, *cols: str | Column) -> DataFrame:
    """Distinct non-NULL key tuples of a dimension (a written table)."""
    return written(distinct_keys(dim, *cols))


def typed_key_set(**dims: tuple[DataFrame, str]) -> DataFrame:
    """Union of per-type key sets as ``(entity_type, object_id)``.

    ``typed_key_set(c=(company, "company_object_id"), p=(people, "people_object_id"))``
    """
    parts = [df.select(F.lit(t).alias("entity_type"), F.col(col).cast("int").alias("object_id"))
             for t, (df, col) in dims.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return written(distinct_keys(out, "entity_type", "object_id"))


def packed(keys: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """A set of non-NULL keys (a written table) with the values of its last key
    column packed (``operators.blocks``), or a table for ``lookup`` with its
    boolean columns ``flags``.  A set whose last key column is no integer is returned as it is."""
    key = [c for c in keys.columns if c not in flags][-1]
    return written(pack(keys, flags)) if isinstance(keys.schema[key].dataType, (IntegerType, LongType)) else keys


def flag_matches(fact: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Add boolean ``flag``: does ``fact[on]`` occur in ``keys`` (plain or ``packed``)?

    ``keys`` must have exactly ``len(on)`` key columns, matched by position.
    NULL fact keys never match.
    """
    on = list(on)
    if MEMBERS in keys.columns:
        if len(keys.columns) != len(on) + 1:
            raise ValueError("flag_matches: key set width does not match `on`")
        members = f"__{flag}"
        joined = _join_blocks(fact, keys.withColumnRenamed(MEMBERS, members), on)
        return joined.select(*[F.col(c) for c in fact.columns],
                             F.coalesce(has(members, F.col(on[-1])), F.lit(False)).alias(flag))
    if len(keys.columns) != len(on):
        raise ValueError("flag_matches: key set width does not match `on`")
    tmp = [f"__{flag}_k{i}" for i in range(len(on))]
    k = keys.select(*[F.col(c).alias(t) for c, t in zip(keys.columns, tmp)]).withColumn(f"__{flag}", F.lit(True))
    cond = None
    for fc, t in zip(on, tmp):
        e = F.col(fc) == F.col(t)
        cond = e if cond is None else cond & e
    joined = fact.join(k, cond, "left")
    return joined.select(*[F.col(c) for c in fact.columns],
                         F.coalesce(F.col(f"__{flag}"), F.lit(False)).alias(flag))


def _join_blocks(fact: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """``fact`` with the block of ``table`` that its key lies in."""
    tmp = [f"__b{i}" for i in range(len(on))]
    cond = block(F.col(on[-1])) == F.col(tmp[-1])
    for fc, t in zip(on[:-1], tmp):
        cond = cond & (F.col(fc) == F.col(t))
    return fact.join(table.withColumnsRenamed(dict(zip(table.columns, tmp))), cond, "left")


def lookup(fact: DataFrame, table: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join ``cols`` of ``table`` onto ``fact``; ``table`` must be unique
    on its first ``len(on)`` columns (matched by position), so there is no fan-out.
    The flags of a ``packed`` table are false, or NULL, where a key is not in it."""
    on = list(on)
    if BLOCK in table.columns:
        joined = _join_blocks(fact, table, on)
        return joined.select(*[F.col(c) for c in fact.columns], *[has(c, F.col(on[-1])).alias(c) for c in cols])
    tk = table.columns[:len(on)]
    tmp = [f"__lk{i}" for i in range(len(on))]
    t = table.select(*[F.col(c).alias(n) for c, n in zip(tk, tmp)], *cols)
    cond = None
    for fc, n in zip(on, tmp):
        e = F.col(fc) == F.col(n)
        cond = e if cond is None else cond & e
    return fact.join(t, cond, "left").drop(*tmp)


def keep_matching(fact: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose ``on`` tuple occurs in ``keys`` (left semi join, no fan-out)."""
    return _semi_anti(fact, keys, on, "left_semi")


def keep_matching_where(fact: DataFrame, dim: DataFrame, on: Sequence[str], dim_on: Sequence[str], where: Column | str) -> DataFrame:
    """Rows whose ``on`` tuple occurs in the rows of ``dim`` that satisfy ``where``.

    The dimension is joined as it is stored, with its filter, so that Spark
    can make a runtime Bloom filter of it (``session.runtime_filters``): fact rows without
    a match are dropped in the scan stage, before the shuffle.  For dimensions too
    large to broadcast."""
    keys = dim.where(F.expr(where) if isinstance(where, str) else where).select(*dim_on)
    return _semi_anti(fact, keys, on, "left_semi")


def keep_missing(fact: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose ``on`` tuple does not occur in ``keys`` (NULL keys included)."""
    return _semi_anti(fact, keys, on, "left_anti")


def _semi_anti(fact: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    on = list(on)
    tmp = [f"__k{i}" for i in range(len(on))]
    k = keys.select(*[F.col(c).alias(t) for c, t in zip(keys.columns, tmp)])
    cond = None
    for fc, t in zip(on, tmp):
        e = F.col(fc) == F.col(t)
        cond = e if cond is None else cond & e
    return fact.join(k, cond, how)


def split(classified: DataFrame, valid: Column | str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a classified frame."""
    v = F.expr(valid) if isinstance(valid, str) else valid
    return classified.where(v), classified.where(~v)


def quarantine(rejected: DataFrame, table_name: str, record_id: str,
               entity_type: str, object_id: str,
               extra_entity_type: str | None = None, extra_object_id: str | None = None,
               reason: Column | str | None = None) -> DataFrame:
    """Project rejected rows to the fixed quarantine layout (see
    ``dimforge.schemas.QUARANTINE``; ``logged_at`` is added by the sink)."""
    def s(name):
        return F.col(name).cast("string") if name else F.lit(None).cast("string")
    r = F.lit(reason) if isinstance(reason, str) else (reason if reason is not None else F.lit(None))
    return rejected.select(
        F.lit(table_name).alias("table_name"),
        s(record_id).alias("record_id"),
        s(entity_type).alias("entity_type"),
        s(object_id).alias("object_id"),
        s(extra_entity_type).alias("extra_entity_type_1"),
        s(extra_object_id).alias("extra_object_id_1"),
        r.cast("string").alias("reason"),
    )

"""Keyed upsert (merge) as one DataFrame plan.

``merge(target, incoming, key)``: incoming rows replace target rows with
the same key, new keys are inserted, other target rows are kept.
Semantics:

* an incoming NULL overwrites the old value;
* a column the incoming frame lacks keeps its old value on update and
  takes its default on insert (``defaults``: column -> Column, e.g.
  ``current_timestamp()`` for load-time stamps; otherwise NULL);
* ``incoming`` must be unique on ``key`` and have no NULL key: split it
  with ``split_incoming`` first (``sinks.tables.upsert`` always does).

A merge is a single full outer join on the key: one shuffle of each side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.operators.dedupe import keep_one, split_repeated


def merge(target: DataFrame, incoming: DataFrame, key: str,
          defaults: Mapping[str, Column] | None = None) -> DataFrame:
    defaults = dict(defaults or {})
    unknown = [c for c in incoming.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"merge: incoming has columns the target lacks: {unknown}")
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns])
    i = incoming.select(*[F.col(c).alias(f"i__{c}") for c in incoming.columns], F.lit(True).alias("i__present"))
    j = t.join(i, F.col(f"t__{key}") == F.col(f"i__{key}"), "full_outer")
    new = F.coalesce(F.col("i__present"), F.lit(False))
    cols = []
    for c in target.columns:
        if c in incoming.columns:
            v = F.when(new, F.col(f"i__{c}")).otherwise(F.col(f"t__{c}"))
        else:
            old = F.col(f"t__{c}")
            ins = defaults.get(c, F.lit(None))
            v = F.when(F.col(f"t__{key}").isNull() & new, ins.cast(target.schema[c].dataType)).otherwise(old)
        cols.append(v.alias(c))
    return j.select(*cols)


def split_incoming(incoming: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to merge, rejected rows with a ``reason``).

    The first part has one row per non-NULL key (``keep_one``: the largest
    row, so the survivor does not depend on partitioning).  The second has
    every other row: those with a NULL key, and the further rows of a key
    that occurs several times, copies included.  Keys are counted alone (one
    row per key and task leaves a task); only rows of repeated keys are
    grouped (``split_repeated``), and a batch without any is passed on as it is."""
    present = incoming.where(F.col(key).isNotNull())
    nulls = incoming.where(F.col(key).isNull()).withColumn("reason", F.lit("NULL key"))
    parts = split_repeated(present, key)
    if parts is None:
        return present, nulls
    several = parts[1]
    unique = parts[0].unionByName(keep_one(several, [key]))
    rest = [c for c in incoming.columns if c != key]
    whole = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    groups = several.groupBy(F.col(key).alias("__key")).agg(F.max(whole).alias("__survivor"))
    rows = several.groupBy(*incoming.columns).agg(F.count(F.lit(1)).alias("__copies"))
    losers = (rows.join(groups, F.col(key) == F.col("__key"))
              .withColumn("__copies", F.col("__copies") - F.when(whole.eqNullSafe(F.col("__survivor")), 1).otherwise(0))
              .where("__copies > 0")
              .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
              .select(*incoming.columns, F.lit("duplicate key").alias("reason")))
    return unique, nulls.unionByName(losers)

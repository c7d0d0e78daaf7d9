"""Deterministic keyed dedupe.

``keep_one`` keeps exactly one row per key.  The survivor is the row with
the largest ``prefer`` tuple (NULL counts as smallest), ties broken by the
remaining columns in frame order, so the result never depends on
partitioning or task order.

It is a ``groupBy(keys).agg(max(struct(...)))``: Spark runs a partial
aggregate before the shuffle, so a key that holds a large share of the
rows collapses to one row per input partition before anything moves —
unlike ``row_number()`` over a window, which would send the whole hot
group to one task.

Such an aggregate sorts every row before and after its shuffle (rows are no
fixed-width buffers).  Where a key is a record id that few rows share,
``keep_one_record`` counts the keys alone and hands only the rows of
repeated keys to ``keep_one``; all others stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.functions._util import as_col
from dimforge.operators.blocks import BLOCK, MEMBERS, block, has, pack
from dimforge.session import scratch_path


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, "keys", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence = ()) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [as_col(p).alias(f"__prefer{i}") for i, p in enumerate(prefer)]
    packed = F.struct(*order, *[F.col(c) for c in rest])
    return (df.groupBy(*keys)
              .agg(F.max(packed).alias("__row"))
              .select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in rest])
              .select(*df.columns))


def split_repeated(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame] | None:
    """(rows whose key no other row has, the rows of repeated keys), or None
    when no key is repeated.  ``df`` is read twice (once for its keys only), so it should be a scan.

    Keys are counted by their hash (a number, whatever the key is), and rows are
    told apart by it.  So a few rows of unique keys whose hash another key has
    are among the second: what is done with these must leave a unique key's row as it is.
    The hashes of repeated keys are written.  If they are too many to broadcast,
    eight bits for each, set at the hash, may do (an eighth of the other
    rows is then among the second); more than that are joined by shuffled hash tables, which
    hold hashes only and need no sort of the rows."""
    spark, hashed = df.sparkSession, F.xxhash64(key)
    counts = df.groupBy(hashed.alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = written(counts.where("__n > 1").select("__hash"))
    n = repeated.count()
    if not n:
        return None
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    same = hashed == F.col("__hash")
    if 8 * n > limit:
        if 1.6 * n <= limit:  # 8 bytes and a block number for every 64 bits
            bits = F.lit(8 * n).cast("bigint")
            repeated = written(pack(repeated.select(F.pmod("__hash", bits).alias("__slot"))))
            slot = F.pmod(hashed, bits)
            same = (block(slot) == F.col(BLOCK)) & has(MEMBERS, slot)
        else:
            repeated = repeated.hint("shuffle_hash")
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def keep_one_record(df: DataFrame, key: str, prefer: Sequence = ()) -> DataFrame:
    """``keep_one(df, [key], prefer)`` for a mostly unique key (``split_repeated``)."""
    parts = split_repeated(df, key)
    return df if parts is None else parts[0].unionByName(keep_one(parts[1], [key], prefer))


def distinct_keys(df: DataFrame, *cols: str | Column, drop_nulls: bool = True) -> DataFrame:
    """The distinct values of ``cols`` (NULL keys dropped by default, since
    they can never match an equi-join)."""
    out = df.select(*[as_col(c) for c in cols])
    if drop_nulls:
        cond = F.lit(True)
        for name in out.columns:
            cond = cond & F.col(name).isNotNull()
        out = out.where(cond)
    return out.distinct()

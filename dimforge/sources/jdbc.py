"""JDBC sources and the multi-relation extract.

A JDBC read without partition options runs as one task; pass a numeric
``partition_column`` with bounds to split it into ``num_partitions``
range queries.  Predicates given with ``where`` reach the database
(Catalyst pushes them into the generated SQL).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def list_tables(spark: SparkSession, url: str, schema: str = "public",
                properties: Mapping[str, str] | None = None) -> list[str]:
    """Table names of one schema (the catalog read is tiny; the filter is
    pushed to the database)."""
    cat = read_jdbc(spark, url, "information_schema.tables", properties)
    return [r.table_name for r in cat.where(F.col("table_schema") == schema).select("table_name").collect()]


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: Mapping[str, str] | None = None, batch_size: int = 10000) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def extract_all(names: Iterable[str], read: Callable[[str], DataFrame],
                on_error: Callable[[str, Exception], None] | None = None) -> dict[str, DataFrame]:
    """Read every named relation; one relation's failure is reported and
    skipped.  The schema is resolved here, so a missing table fails now and
    not later inside a transform."""
    out: dict[str, DataFrame] = {}
    for name in names:
        try:
            df = read(name)
            df.schema  # noqa: B018  (force analysis)
            out[name] = df
        except Exception as e:  # noqa: BLE001
            if on_error:
                on_error(name, e)
    return out

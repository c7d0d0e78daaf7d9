"""Relations found by listing a catalog instead of a fixed list of names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimforge.sources.jdbc import extract_all

OnError = Callable[[str, Exception], None]


def list_relations(spark: SparkSession, database: str, on_error: OnError | None = None) -> list[str]:
    """Names of the tables of ``database`` (views and temporary views are
    not relations of it).  A listing that fails is reported and gives none."""
    try:
        return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW")
    except Exception as e:  # noqa: BLE001
        if on_error:
            on_error(database, e)
        return []


def extract_catalog(spark: SparkSession, database: str, on_error: OnError | None = None) -> dict[str, DataFrame]:
    """Every relation of ``database`` by name; one that cannot be read is
    reported and left out."""
    return extract_all(list_relations(spark, database, on_error), lambda n: spark.read.table(f"`{database}`.`{n}`"), on_error)


def register(df: DataFrame, database: str, name: str, path: str | None = None) -> None:
    """Write ``df`` as a table of ``database`` (created if missing)."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    w = df.write.mode("overwrite").format("parquet")
    (w.option("path", path) if path else w).saveAsTable(f"`{database}`.`{name}`")

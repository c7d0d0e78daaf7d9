"""Queries of the load path: constraints at load, bucketed and partitioned
targets.  Batches are derived from whole base tables; shifted keys and
long, missing or repeated values plant what a load must reject."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators.enforce import VIOLATIONS, classify, declared
from dimforge.operators.refcheck import written
from dimforge.plans.catalog import Warehouse, query
from dimforge.session import scratch_path
from dimforge.sinks import tables as T
from dimforge.sinks.keyed import BucketedTable, PartitionedTable


def scratch(spark, *parts) -> str:
    return scratch_path(spark, "dimforge", *parts, uuid.uuid4().hex)


def _company(spark, d) -> DataFrame:
    path = scratch(spark, "company")
    T.write_table(Warehouse(spark, d).get("dim_company").valid, path)
    return spark.read.parquet(path)


def company_batch(company: DataFrame) -> DataFrame:
    """Every company; again under a shifted id with an overlong description;
    without its type; and with the same company id (its value moves to the largest key)."""
    def shifted(by: int, **cols) -> DataFrame:
        return company.withColumns({"company_id": F.col("company_id") + by, **cols})
    return (company.unionByName(shifted(10_000_000, description=F.repeat(F.lit("x"), 256)))
            .unionByName(shifted(20_000_000, company_entity_type=F.lit(None).cast("string")))
            .unionByName(shifted(30_000_000)))


@query("enforce_row_checks")
def q_enforce_row_checks(spark, d):
    """Every row of the batch with what it breaks (NULL: nothing)."""
    rows = classify(company_batch(_company(spark, d)), declared("dim_company", "company_id"), "company_id")
    return rows.select("company_id", F.when(F.size(VIOLATIONS) > 0, F.array_join(VIOLATIONS, "; ")).alias("broken"))


@query("enforce_foreign_key")
def q_enforce_foreign_key(spark, d):
    """IPOs whose company was not loaded, by the declared foreign key."""
    from dimforge.plans import warehouse as W
    wh = Warehouse(spark, d)
    rows = classify(W.ipo_prepared(wh.st["ipo"]), declared("fact_ipo", "ipo_id"), "ipo_id", refs={"dim_company": _company(spark, d)})
    return rows.select("ipo_id", F.when(F.size(VIOLATIONS) > 0, F.array_join(VIOLATIONS, "; ")).alias("broken"))


def _second_batch(company: DataFrame) -> DataFrame:
    """Renamed regions under the same keys, and the same companies under new keys."""
    new = company.withColumn("region", F.concat("region", F.lit("~")))
    return new.unionByName(new.withColumn("company_id", F.col("company_id") + 40_000_000))


@query("upsert_enforced")
def q_upsert_enforced(spark, d):
    """Two loads with constraints: the table after them."""
    path, rules = scratch(spark, "dim_company"), declared("dim_company", "company_id")
    company = _company(spark, d)
    T.upsert(company_batch(company), path, "company_id", constraints=rules)
    T.upsert(_second_batch(company.withColumn("company_id", F.col("company_id") + 30_000_000)), path, "company_id", constraints=rules)
    return T.read_table(spark, path)


@query("quarantine_enforced")
def q_quarantine_enforced(spark, d):
    """What those loads rejected, with key and reason."""
    path, bad, rules = scratch(spark, "dim_company"), scratch(spark, "rejected"), declared("dim_company", "company_id")
    company = _company(spark, d)
    T.upsert(company_batch(company), path, "company_id", None, bad, rules)
    T.upsert(_second_batch(company.withColumn("company_id", F.col("company_id") + 30_000_000)), path, "company_id", None, bad, rules)
    return spark.read.parquet(bad).select("record_id", "reason")


@query("warehouse_enforced_counts")
def q_warehouse_enforced_counts(spark, d):
    """The whole job with constraints, loaded twice."""
    from dimforge.plans.jobs import build_warehouse, stage_all, warehouse_table_counts
    root = scratch(spark, "warehouse_job")
    stage_all(spark, d, f"{root}/staging")
    for _ in range(2):
        build_warehouse(spark, f"{root}/staging", f"{root}/warehouse")
    return warehouse_table_counts(spark, f"{root}/warehouse")


# ------------------------------------------------------------------ K2 targets laid out by key
def _rounds(spark, d) -> DataFrame:
    path = scratch(spark, "rounds")
    T.write_table(Warehouse(spark, d).get("dim_funding_rounds").valid, path)
    return spark.read.parquet(path)


def _rounds_batch(rounds: DataFrame) -> DataFrame:
    """New amounts for the later half of the rounds, and as many new rounds."""
    half = rounds.agg(((F.min("funding_round_id") + F.max("funding_round_id")) / 2).cast("int").alias("half"))
    top = rounds.agg(F.max("funding_round_id").alias("top"))
    late = rounds.join(F.broadcast(half), F.col("funding_round_id") >= F.col("half")).drop("half")
    new = late.join(F.broadcast(top)).withColumn("funding_round_id", F.col("funding_round_id") + F.col("top")).drop("top")
    return late.unionByName(new).select("funding_round_id", "round_type",
                                        (F.col("raised_amount_usd") + 1).cast("decimal(15,2)").alias("raised_amount_usd"))


@query("upsert_bucketed")
def q_upsert_bucketed(spark, d):
    """Two loads into a bucketed target."""
    table, rounds = BucketedTable(spark, scratch(spark, "rounds_bucketed"), "funding_round_id", 16), _rounds(spark, d)
    table.upsert(rounds)
    table.upsert(_rounds_batch(rounds))
    return table.read()


@query("upsert_partitioned")
def q_upsert_partitioned(spark, d):
    """Two loads into ranges of the key: the table, and whether each row's
    file is one of the first load."""
    rounds = _rounds(spark, d)
    table = PartitionedTable(spark, scratch(spark, "rounds_parts"), "funding_round_id", width=1000)
    table.upsert(rounds)
    first = written(spark.read.parquet(table.path).select(F.input_file_name().alias("first_file")).distinct())
    table.upsert(_rounds_batch(rounds))
    rows = table.read().withColumn("file", F.input_file_name())
    return rows.join(first, F.col("file") == F.col("first_file"), "left") \
        .withColumn("kept_file", F.col("first_file").isNotNull()).drop("file", "first_file")

"""Driver contract, oracle agreement on the smallest data set, and the jobs."""

import collections
import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from dimforge.plans import jobs
from dimforge.plans.fixtures import BASE_TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "acquisition_id"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(v)
    return v


FAST = ["fact_acquisition", "dim_company", "dim_people", "fact_investments", "quarantine_relationship",
        "profile_company", "entity_id", "clean_text", "normalize_text", "dedupe_lineitem", "upsert_merge",
        "check_unique", "profile_samples"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement_small(spark, name):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sorder = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    a = collections.Counter(tuple(_norm(r[i]) for i in sorder) for r in df.collect())
    b = collections.Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    assert a == b


def test_pipeline_and_rerun(spark, scratch):
    first = jobs.run_all(spark, SF_SMALL, scratch)
    c1 = {r.table_name: r.n_rows for r in jobs.warehouse_table_counts(spark, f"{scratch}/warehouse").collect()}
    second = jobs.build_warehouse(spark, f"{scratch}/staging", f"{scratch}/warehouse")
    c2 = {r.table_name: r.n_rows for r in jobs.warehouse_table_counts(spark, f"{scratch}/warehouse").collect()}
    assert first == second and c1 == c2 and c1["dim_company"] > 0
    logs = spark.read.parquet(f"{scratch}/etl_logs")
    steps = {r.step for r in logs.select("step").distinct().collect()}
    assert {"Load Staging", "Profiling", "Load to DWH", "Validation"} <= steps
    q = spark.read.parquet(f"{scratch}/warehouse/quarantine/*")
    assert q.where("logged_at IS NULL").count() == 0 and q.count() > 0


def test_cli_stage_step(spark, scratch, capsys):
    from dimforge.__main__ import main
    assert main(["--data", SF_SMALL, "--root", scratch, "--steps", "stage"]) == 0
    out = capsys.readouterr().out.strip().splitlines()[-1]
    import json
    staged = json.loads(out)["staged_rows"]
    assert set(staged) == {"company", "people", "acquisition", "funding_rounds", "investments", "relationship",
                           "ipo", "funds", "milestones"} and staged["acquisition"] > 0


def test_bucketed_warehouse(spark, scratch):
    """The job on bucketed tables gives the same tables, and rejects the same rows."""
    jobs.stage_all(spark, SF_SMALL, f"{scratch}/staging")
    plain = jobs.build_warehouse(spark, f"{scratch}/staging", f"{scratch}/plain")
    for _ in range(2):
        assert jobs.build_warehouse(spark, f"{scratch}/staging", f"{scratch}/bucketed", buckets=4) == plain
    a, b = (sorted(map(tuple, jobs.warehouse_table_counts(spark, f"{scratch}/{x}").collect())) for x in ("plain", "bucketed"))
    assert a == b
    rejected = spark.read.parquet(f"{scratch}/plain/quarantine_keys/dim_company")
    assert {r.reason for r in rejected.collect()} == {"company_entity_type is NULL; company_object_id is NULL"}

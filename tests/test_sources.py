"""API source, catalog listing, malformed CSV lines, merged profiles, per-table documents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimforge.operators import profile_state
from dimforge.operators.profile import profile
from dimforge.operators.refcheck import keep_matching_where
from dimforge.session import runtime_filters
from dimforge.sinks import tables as T
from dimforge.sources.api import Failure, fetch, land, log_of, outcomes_of, parse_page, read_api, records_of
from dimforge.sources.catalog import extract_catalog, list_relations, register
from dimforge.sources.files import read_csv_checked


def answer(folder, name, body, status=200):
    raw = body.encode()
    with open(f"{folder}/{name}.http", "wb") as f:
        f.write(f"HTTP/1.1 {status} x\r\nContent-Length: {len(raw)}\r\n\r\n".encode() + raw)


@pytest.fixture()
def answers(scratch):
    answer(scratch, "2024-01-01_1", '[{"id": 1, "d": "2024-01-01", "t": "é"}, {"id": 2, "d": null}]')
    answer(scratch, "2024-01-01_2", '[{"id": 3, "more": 1}]')
    answer(scratch, "2024-01-01_3", "[]")
    answer(scratch, "2024-01-02_1", "[]")
    answer(scratch, "2024-01-03_1", '[{"id": 4}]')
    answer(scratch, "2024-01-03_2", "busy", 503)
    answer(scratch, "2024-01-04_1", "{}")
    answer(scratch, "2024-01-05_1", "no", 404)
    return f"landed:{scratch}/{{start}}_{{page}}.http"


def test_api_classes(spark, answers, scratch):
    raw = read_api(spark, answers, "2024-01-01", "2024-01-06", paged=True, retries=0)
    records, outcomes = land(raw, f"{scratch}/landed", "id long, d string, t string")
    assert sorted(map(tuple, records.collect())) == [(1, "2024-01-01", "é"), (2, None, None), (3, None, None), (4, None, None)]
    got = {r.window_start.day: (r.n_records, r.outcome, r.status) for r in outcomes.collect()}
    assert got == {1: (3, "ok", 200), 2: (0, "empty", 200), 3: (1, "bad_status", 503), 4: (0, "malformed", 200),
                   5: (0, "bad_status", 404), 6: (0, "transport_error", None)}
    log = {r.status.split(":")[0] for r in log_of(outcomes, "milestones").collect()}
    assert log == {"Success - 3 records", "Failed - empty 200", "Failed - bad_status 503", "Failed - malformed 200",
                   "Failed - bad_status 404", "Failed - transport_error"}


def test_api_filter_reaches_the_source(spark, answers):
    """Windows outside the filter are not requested: they have no partition."""
    raw = read_api(spark, answers, "2024-01-01", "2024-01-06", paged=True, retries=0)
    one = raw.where("window_start = DATE'2024-01-01'")
    assert raw.rdd.getNumPartitions() == 6 and one.rdd.getNumPartitions() == 1
    assert records_of(one, "id long").count() == 3
    some = raw.where("window_start > DATE'2024-01-01' AND window_end <= DATE'2024-01-03'")
    assert some.rdd.getNumPartitions() == 2 and {r.outcome for r in outcomes_of(some).collect()} == {"empty", "bad_status"}
    assert raw.where("window_start > DATE'2030-01-01'").count() == 0
    # other filters are Spark's
    assert raw.where("outcome = 'malformed'").count() == 1


def test_api_windows_and_next(spark, scratch):
    answer(scratch, "2024-01-01_1", '{"rows": {"x": [{"id": 1}]}, "next": "p2"}')
    answer(scratch, "2024-01-01_2", '{"rows": {"x": []}, "next": null}')
    answer(scratch, "2024-01-04_1", '{"rows": {"x": [{"id": 2}]}}')
    raw = read_api(spark, f"landed:{scratch}/{{start}}_{{page}}.http", "2024-01-01", "2024-01-05", window_days=3,
                   records="rows.x", next_field="next", retries=0)
    assert [(r.window_start, r.window_end, r.outcome, r.n_records) for r in outcomes_of(raw).orderBy("window_start").collect()] == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 3), "ok", 1), (dt.date(2024, 1, 4), dt.date(2024, 1, 5), "ok", 1)]


def test_fetch(scratch):
    with open(f"{scratch}/x.json", "w") as f:
        f.write("[1]")
    assert fetch(f"file://{scratch}/x.json") == (200, b"[1]")
    for url in (f"file://{scratch}/none.json", f"landed:{scratch}/none"):
        with pytest.raises(Failure) as e:
            fetch(url, retries=1, wait=0)
        assert e.value.outcome == "transport_error"
    assert parse_page(b'{"a": [1], "n": 1}', "a", "n") == ([1], True)
    for body in (b"", b"{}", b'{"a": 1}', b"\xff"):
        with pytest.raises(Failure):
            parse_page(body, "a", None)


def test_catalog(spark, scratch):
    seen = []
    assert list_relations(spark, "no_such_database", lambda n, e: seen.append(n)) == [] and seen == ["no_such_database"]
    assert extract_catalog(spark, "no_such_database") == {}
    db = "db_" + scratch.rpartition("-")[2].replace("_", "x").lower()
    for n in ("b", "a"):
        register(spark.range(3), db, n, f"{scratch}/{n}")
    spark.sql(f"CREATE VIEW `{db}`.v AS SELECT 1 AS x")
    spark.range(1).createOrReplaceTempView("not_a_relation")
    assert list_relations(spark, db) == ["a", "b"]
    assert {n: d.count() for n, d in extract_catalog(spark, db).items()} == {"a": 3, "b": 3}


def test_csv_checked(spark, scratch):
    lines = ["id,name,on,amount", '1,"a, ""b""",2024-01-02,1.50', "2,x,,", "3,short", "4,a,2024-01-02,1,more", "no,a,2024-01-02,1",
             "5,a,yesterday,1", '6,"quoted,comma",2024-01-02', "7,a,2024-01-02,1e9999x", "8,é,2024-02-30,1"]
    with open(f"{scratch}/f.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    rows, bad = read_csv_checked(spark, f"{scratch}/f.csv", "id int, name string, on date, amount decimal(9,2)")
    assert [(r.id, r.name) for r in rows.orderBy("id").collect()] == [(1, 'a, "b"'), (2, "x")]
    # the same lines are rows whatever columns a query needs
    assert rows.select("name").count() == 2 and rows.count() == 2
    got = {r.first_value: (r.reason, r.line) for r in bad.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "3": "too few columns: 2", "4": "too many columns: 5", "no": "id is no int", "5": "on is no date",
        "6": "too few columns: 3", "7": "amount is no decimal(9,2)", "8": "on is no date"}
    assert all(line in lines for _, line in got.values())
    with open(f"{scratch}/empty.csv", "w") as f:
        f.write("id,name\n")
    rows, bad = read_csv_checked(spark, f"{scratch}/empty.csv", "id int, name string")
    assert rows.count() == 0 and bad.count() == 0


def test_merged_profile(spark, scratch):
    """Batches profiled apart and merged give the profile of all rows."""
    df = spark.range(3000).select(
        F.col("id"), (F.col("id") % 10).cast("string").alias("s"), F.when(F.col("id") % 3 > 0, F.col("id") * 1.5).alias("x"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d"), F.array("id").alias("a"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit(None).cast("int").alias("n"))
    for batch, rows in (("1", df.where("id < 900")), ("2", df.where("id between 900 and 1999")), ("1", df.where("id < 1000")),
                        ("2", df.where("id between 1000 and 1999")), ("3", df.where("id >= 2000")), ("4", df.limit(0))):
        profile_state.store(rows, f"{scratch}/state", batch)
    got = {r.column_name: r.asDict() for r in profile_state.merged(spark, f"{scratch}/state", "t").collect()}
    want = {r.column_name: r.asDict() for r in profile(df, "t").collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert abs(g.pop("unique_count") - w.pop("unique_count")) <= 0.03 * 3000
        assert g == w, c
    # merging reads states only
    assert "Scan parquet" in profile_state.merged(spark, f"{scratch}/state", "t")._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(f"{scratch}/state").count() == 4


def test_profile_documents(spark, scratch):
    a = profile(spark.range(5).withColumn("s", F.lit("x")), "a", sample_k=2)
    b = profile(spark.range(3), "b", sample_k=2)
    T.write_profile_json(a.unionByName(b), f"{scratch}/docs", person="someone", per_table=True)
    docs = spark.read.json(f"{scratch}/docs")
    assert {(r.table, r.person_in_charge, r.profiling_result.n_rows) for r in docs.collect()} == {("a", "someone", 5), ("b", "someone", 3)}
    assert len(docs.inputFiles()) == 2
    got = {(r.table_name, r.column_name): (r.data_type, r.unique_count, r.sample_values) for r in T.read_profile_json(spark, f"{scratch}/docs").collect()}
    assert got == {("a", "id"): ("bigint", 5, ["0", "1"]), ("a", "s"): ("string", 1, ["x"]), ("b", "id"): ("bigint", 3, ["0", "1"])}


def test_runtime_filter_in_plan(spark, scratch):
    """Too large to broadcast: fact rows meet a Bloom filter before the shuffle."""
    spark.range(20000).select("id", (F.col("id") % 50).alias("kind")).write.parquet(f"{scratch}/dim")
    spark.range(100000).select((F.col("id") * 3).alias("k"), F.lit("payload").alias("p")).write.parquet(f"{scratch}/fact")
    fact, dim = spark.read.parquet(f"{scratch}/fact"), spark.read.parquet(f"{scratch}/dim")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with runtime_filters(spark, fact_at_least="0", keys_at_most="1GB"):
            out = keep_matching_where(fact, dim, ["k"], ["id"], "kind = 3")
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            assert "might_contain" in plan and "bloom_filter_agg" in plan
            n = out.count()
        out = keep_matching_where(fact, dim, ["k"], ["id"], "kind = 3")
        assert "might_contain" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert n == out.count() == len([i for i in range(3, 20000, 50) if i % 3 == 0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stage_csv_and_api_jobs(spark, scratch):
    """Rows, bad rows and every window's outcome reach the staging folder and the run log."""
    from dimforge.plans import jobs
    with open(f"{scratch}/people.csv", "w") as f:
        f.write("people_id,object_id,first_name,last_name,birthplace,affiliation_name\n1,p:1,A,B,C,D\n2,p:2,A\n")
    root, log = f"{scratch}/staging", f"{scratch}/log"
    assert jobs.stage_csv(spark, "people", f"{scratch}/people.csv", root, log) == {"rows": 1, "bad_rows": 1}
    assert spark.read.parquet(f"{root}/people").first().object_id == "p:1"
    assert spark.read.parquet(f"{root}/bad_rows/people").first().reason == "too few columns: 3"
    answer(scratch, "2024-01-01_1", '[{"milestone_id": 5, "object_id": "c:1"}]')
    got = jobs.stage_api(spark, "milestones", f"landed:{scratch}/{{start}}_{{page}}.http", "2024-01-01", "2024-01-02", root, log, retries=0)
    assert got == {"ok": 1, "transport_error": 1}
    assert [(r.milestone_id, r.object_id) for r in spark.read.parquet(f"{root}/milestones").collect()] == [(5, "c:1")]
    status = {(r.source, r.status.split(":")[0]) for r in spark.read.parquet(log).collect()}
    assert status == {("CSV", "Success - 1 bad lines"), ("API", "Success - 1 records"), ("API", "Failed - transport_error")}
    with pytest.raises(RuntimeError):
        jobs.stage_api(spark, "milestones", f"landed:{scratch}/none_{{start}}_{{page}}", "2024-01-01", "2024-01-02", root, retries=0)
    with pytest.raises(Exception):
        jobs.stage_csv(spark, "people", f"{scratch}/no_such_file.csv", root, log)
    assert spark.read.parquet(log).where("status like 'Failed: %'").count() == 1


def test_staging_through_a_database(spark, scratch):
    from conftest import SF_SMALL
    from dimforge.plans import jobs
    db = "stage_" + scratch.rpartition("-")[2].replace("_", "x").lower()
    counts = jobs.stage_all(spark, SF_SMALL, f"{scratch}/staging", database=db)
    staged = jobs.read_staged(spark, f"{scratch}/staging", database=db)
    assert set(staged) == set(jobs.STAGED_NAMES) and {n: d.count() for n, d in staged.items()} == counts


def test_busy_days_have_more_pages(spark, scratch, monkeypatch):
    """Milestone answers: a page's size does not grow with its day."""
    import glob
    import json

    from dimforge.plans import source_queries as Q
    rows = [(i, "c:1", "2024-01-01" if i < 300 else "2024-01-02") for i in range(320)]
    m = spark.createDataFrame(rows, "milestone_id long, object_id string, milestone_at string")
    monkeypatch.setattr(Q, "fixture", lambda *_: m)
    monkeypatch.setattr(Q, "PAGE_ROWS", 10)
    monkeypatch.setattr(Q, "scratch", lambda *_: f"{scratch}/answers")
    assert Q._milestone_answers(spark, None).startswith(f"landed:{scratch}/answers/")
    sizes = [len(json.loads(open(f, "rb").read().split(b"\r\n\r\n")[1])["data"]["items"]) for f in glob.glob(f"{scratch}/answers/2024-*.http")]
    assert sum(sizes) == 320 and max(sizes) < 40 and len(sizes) == 31 + 5
    assert Q.PAGE_BATCH * Q.PAGE_ROWS <= 16_000 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(Q.PAGE_BATCH)


def test_answers_are_handed_over_in_small_batches(spark, scratch, monkeypatch):
    """A worker holds a few pages, not those of a whole partition."""
    from dimforge.plans import source_queries as Q
    sizes = []

    class Frames:
        def __init__(self, df):
            self.df, self.sparkSession = df, df.sparkSession

        def mapInPandas(self, run, schema):
            sizes.append(self.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
            return self.df.mapInPandas(run, schema)

    df = spark.range(40).selectExpr("'2024-01-01' AS day", "int(id) AS page", "200 AS status", "'[]' AS body").coalesce(1)
    Q.write_answers(Frames(df), f"{scratch}/a")
    assert sizes == [str(Q.PAGE_BATCH)]
    import os
    assert len(os.listdir(f"{scratch}/a")) == 40

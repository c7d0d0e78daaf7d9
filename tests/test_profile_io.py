"""Profiling against brute force; sources and sinks round trips; versioned upsert."""

import json
import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimforge.operators.profile import profile, samples
from dimforge.plans import jobs
from dimforge.plans.fixtures import fixture
from dimforge.schemas import staged_schema
from dimforge.sinks import tables as T
from dimforge.sources.files import read_csv, read_json_records
from dimforge.sources.jdbc import extract_all


def test_profile_brute_force(spark):
    df = fixture(spark, SF_SMALL, "funding_rounds")
    prof = {r.column_name: r for r in profile(df, "fr", sample_k=5).collect()}
    pdf = df.toPandas()
    n = len(pdf)
    for c in df.columns:
        col = pdf[c]
        nulls = int(col.isna().sum())
        uniq = col.dropna().nunique() + (1 if nulls else 0)
        r = prof[c]
        assert r.n_rows == n and r.null_count == nulls and r.unique_count == uniq, c
        assert r.percentage_missing_value == round(nulls * 100 / n + 1e-9, 2), c
        nonnull = col.dropna()
        if len(nonnull):
            first = df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).limit(5)
            assert r.sample_values == [x[0] for x in first.select(F.col(c).cast("string")).collect()], c


def test_profile_empty_and_maps(spark):
    df = spark.createDataFrame([], "a int, m map<string,int>")
    rows = profile(df, "e").collect()
    assert [(r.n_rows, r.null_count, r.unique_count, r.percentage_missing_value) for r in rows] == [(0, 0, 0, 0.0)] * 2
    df2 = spark.createDataFrame([(1, {"x": 1}), (1, {"x": 1}), (None, None)], "a int, m map<string,int>")
    p = {r.column_name: r for r in profile(df2, "m").collect()}
    assert p["a"].unique_count == 2 and p["m"].unique_count == 2 and p["m"].min_value is None
    assert p["a"].percentage_missing_value == 33.33


def test_samples_long_format(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, None), (10, "c")], "n int, s string")
    got = [(r.column_name, r.sample_rank, r.sample_value) for r in samples(df, "t", k=2).orderBy("column_name", "sample_rank").collect()]
    assert got == [("n", 1, "1"), ("n", 2, "2"), ("s", 1, "a"), ("s", 2, "b")]


def test_csv_quotes_and_newlines(spark, scratch):
    path = os.path.join(scratch, "x.csv")
    with open(path, "w") as f:
        f.write('id,name\n1,"DJ ""Mix"""\n2,"two\nlines"\n3,\n')
    rows = read_csv(spark, path, multiline=True).orderBy("id").collect()
    assert [r.name for r in rows] == ['DJ "Mix"', "two\nlines", None]


def test_json_records_date_range(spark, scratch):
    m = fixture(spark, SF_SMALL, "milestones")
    m.write.json(os.path.join(scratch, "j"))
    from dimforge.schemas import staged_schema
    r = read_json_records(spark, os.path.join(scratch, "j"), staged_schema("milestones"), "milestone_at",
                          "2024-01-08", "2024-01-21")
    want = m.where(F.col("milestone_at").cast("date").between("2024-01-08", "2024-01-21"))
    assert r.count() == want.count() > 0


def test_extract_all_skips_failures(spark, scratch):
    spark.range(3).write.parquet(os.path.join(scratch, "a"))
    errors = []
    got = extract_all(["a", "missing"], lambda n: spark.read.parquet(os.path.join(scratch, n)),
                      lambda n, e: errors.append(n))
    assert list(got) == ["a"] and errors == ["missing"]


def test_versioned_upsert(spark, scratch):
    path = os.path.join(scratch, "t")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    T.upsert(a, path, "k")
    T.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), path, "k")
    assert sorted(map(tuple, T.read_table(spark, path).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    # an uncommitted version folder is ignored by readers
    os.makedirs(os.path.join(path, "v=99"))
    assert T.committed_versions(spark, path) == [1, 2]
    assert T.read_table(spark, path).count() == 3
    # the same upsert twice gives the same table
    T.upsert(spark.createDataFrame([(3, "c")], "k int, v string"), path, "k")
    assert sorted(map(tuple, T.read_table(spark, path).collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_defaults_on_insert(spark, scratch):
    path = os.path.join(scratch, "p")
    T.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), path, "k",
             {"created_at": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")})
    T.upsert(spark.createDataFrame([(1, "A"), (2, "b")], "k int, v string"), path, "k",
             {"created_at": F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")})
    got = {r.k: (r.v, str(r.created_at)) for r in T.read_table(spark, path).collect()}
    assert got == {1: ("A", "2020-01-01 00:00:00"), 2: ("b", "2021-01-01 00:00:00")}


def test_run_log_and_profile_json(spark, scratch):
    T.append_log(spark, os.path.join(scratch, "log"), [{"step": "Extract", "status": "Success", "table_name": "x"}])
    assert spark.read.parquet(os.path.join(scratch, "log")).first().step == "Extract"
    df = fixture(spark, SF_SMALL, "funds")
    T.write_profile_json(profile(df, "funds", sample_k=5), os.path.join(scratch, "json"))
    line = [f for f in os.listdir(os.path.join(scratch, "json")) if f.endswith(".json")][0]
    doc = json.loads(open(os.path.join(scratch, "json", line)).readline())
    rep = doc["profiling_result"]["report"]
    assert doc["profiling_result"]["n_cols"] == len(df.columns) and set(rep) == set(df.columns)
    assert len(rep["fund_id"]["sample_values"]) == 5


def test_profile_approx_close_to_exact(spark):
    df = fixture(spark, SF_SMALL, "relationship")
    exact = {r.column_name: r for r in profile(df, "r").collect()}
    approx = {r.column_name: r for r in profile(df, "r", exact=False).collect()}
    for c, e in exact.items():
        a = approx[c]
        assert (a.n_rows, a.null_count, a.min_value, a.max_value) == (e.n_rows, e.null_count, e.min_value, e.max_value)
        assert abs(a.unique_count - e.unique_count) <= max(2, 0.1 * e.unique_count), c


def test_upsert_dedupes_incoming(spark, scratch):
    path = os.path.join(scratch, "d")
    T.upsert(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), path, "k")
    got = sorted(map(tuple, T.read_table(spark, path).collect()))
    assert got == [(1, "b"), (2, "c")]


def test_upsert_rerun_with_bad_keys(spark, scratch):
    path, q = os.path.join(scratch, "r"), os.path.join(scratch, "q")
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k int, v string")
    for n in range(1, 4):
        T.upsert(batch, path, "k", quarantine_path=q)
        assert sorted(map(tuple, T.read_table(spark, path).collect())) == [(1, "b"), (2, "c")]
        assert spark.read.parquet(q).count() == 2 * n
    assert {r.reason for r in spark.read.parquet(q).collect()} == {"NULL key", "duplicate key"}


def test_uncommitted_version_is_not_read(spark, scratch):
    path = os.path.join(scratch, "u")
    spark.range(3).write.parquet(f"{path}/v=1")
    os.remove(f"{path}/v=1/_SUCCESS")
    with pytest.raises(FileNotFoundError):
        T.read_table(spark, path)


def test_profile_orders_few_values(spark, monkeypatch):
    """Extremes and the smallest values are exact wherever they stand, whatever the bounds; no text is sorted for them."""
    from dimforge.operators import profile as P
    monkeypatch.setattr(P, "BOUND_ROWS", 10)
    rows = [(1000 - i, f"k{1000 - i:04d}", None if i < 20 else f"t{i % 7}", -0.0 if i % 2 else 0.0, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "n int, s string, late string, z double, nothing string")
    p = {r.column_name: r for r in profile(df, "t", sample_k=3).collect()}
    assert p["n"].sample_values == ["1", "2", "3"] and (p["n"].min_value, p["n"].max_value) == ("1", "1000")
    assert p["s"].sample_values == ["k0001", "k0002", "k0003"] and p["s"].max_value == "k1000" and p["s"].unique_count == 1000
    assert p["late"].sample_values == ["t0", "t1", "t2"] and (p["late"].null_count, p["late"].unique_count) == (20, 8)
    assert p["z"].unique_count == 1 and p["z"].min_value == "0.0"
    assert p["nothing"].sample_values is None and p["nothing"].unique_count == 1 and p["nothing"].max_value is None
    text = profile(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "ObjectHashAggregate" in text


# -- the profile job tells a failure from a result
def _stage_own_rows(spark, root, *names):
    for n in names:
        T.write_table(spark.createDataFrame([], staged_schema(n)), f"{root}/{n}")


def test_profile_all_fails_for_a_relation_not_profiled(spark, scratch, monkeypatch):
    """profile_documents: the others are profiled and logged, but their documents are not the whole report."""
    _stage_own_rows(spark, f"{scratch}/staging", *jobs.STAGED_NAMES)
    real = jobs.profile
    monkeypatch.setattr(jobs, "profile", lambda df, name, **k: 1 // 0 if name == "funds" else real(df, name, **k))
    with pytest.raises(RuntimeError, match="profiling failed for funds: .*division"):
        jobs.profile_all(spark, f"{scratch}/staging", f"{scratch}/out", f"{scratch}/log")
    assert sorted(os.listdir(f"{scratch}/out/profile")) == sorted(set(jobs.STAGED_NAMES) - {"funds"})
    assert not os.path.exists(f"{scratch}/out/json") and not os.path.exists(f"{scratch}/out/documents")
    status = {r.table_name: r.status for r in spark.read.parquet(f"{scratch}/log").collect()}
    assert set(status) == set(jobs.STAGED_NAMES) and status.pop("funds").startswith("Failed") and set(status.values()) == {"Success"}
    # the run that ends gives them all
    monkeypatch.undo()
    whole = jobs.profile_all(spark, f"{scratch}/staging", f"{scratch}/out")
    read = T.read_profile_json(spark, f"{scratch}/out/documents")
    for got in (whole, read):
        assert {r.table_name for r in got.select("table_name").distinct().collect()} == set(jobs.STAGED_NAMES)


def test_profile_all_fails_for_a_relation_not_staged(spark, scratch):
    """profile_job: a profile of eight relations is not the profile of the staged nine."""
    _stage_own_rows(spark, f"{scratch}/staging", *(n for n in jobs.STAGED_NAMES if n != "people"))
    with pytest.raises(RuntimeError, match="profiling failed for people"):
        jobs.profile_all(spark, f"{scratch}/staging", f"{scratch}/out", f"{scratch}/log", exact=False)
    steps = {(r.step, r.table_name) for r in spark.read.parquet(f"{scratch}/log").where("status LIKE 'Failed%'").collect()}
    assert steps == {("Extract", "people")}


def test_profile_all_fails_for_a_broken_file(spark, scratch):
    """profile_json: the documents of an earlier run are not replaced by a part of them."""
    _stage_own_rows(spark, f"{scratch}/staging", *jobs.STAGED_NAMES)
    jobs.profile_all(spark, f"{scratch}/staging", f"{scratch}/out", exact=False)
    before = sorted(os.listdir(f"{scratch}/out/json"))
    for f in os.listdir(f"{scratch}/staging/ipo"):
        if f.endswith(".parquet"):
            with open(f"{scratch}/staging/ipo/{f}", "wb") as out:
                out.write(b"no parquet")
            if os.path.exists(f"{scratch}/staging/ipo/.{f}.crc"):
                os.remove(f"{scratch}/staging/ipo/.{f}.crc")
    with pytest.raises(RuntimeError, match="profiling failed for ipo"):
        jobs.profile_all(spark, f"{scratch}/staging", f"{scratch}/out", exact=False)
    assert sorted(os.listdir(f"{scratch}/out/json")) == before
    assert spark.read.json(f"{scratch}/out/json").select("profiling_result.table_name").distinct().count() == 9

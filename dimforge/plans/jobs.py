"""The three batch jobs: stage, profile, build the warehouse.

* ``stage_all``       base tables -> nine staged relations (Parquet, overwrite)
* ``profile_all``     staged relations -> profile table (+ samples) and one
                      JSON document per table
* ``build_warehouse`` staged relations -> five dimensions and four facts,
                      each merged into its versioned table on its key;
                      rejected rows appended to the quarantine table.

Every job writes one run-log row per step (in one append at the end).

Robustness and cost:

* Dimensions are written first and everything downstream reads the
  *written* dimensions: the lineage is cut (a lost executor never
  recomputes a dimension inside a fact's plan), and the planner sees the
  real size of each key set, so a key set is broadcast only when its
  measured files are under the broadcast threshold.
* A checked table is classified once and that result is written to a work
  folder; the valid rows (merged into the warehouse table) and the
  quarantined rows are two filters of the written result, so the joins and
  dedupes are not run twice and the two outputs always partition the input.
* Work folders belong to one run and warehouse tables get a new version per
  load, so a run that dies changes no table that readers see; re-running it
  gives the same tables.  Staging is overwritten in place (stage again after
  a failure), and log and quarantine rows are appended by every run.
* Rows whose key is NULL or repeated, and rows that break a declared constraint,
  are never merged; they go to ``quarantine_keys/<table>`` with the reason.
* Independent writes are submitted concurrently (Spark runs jobs from
  several threads of one application side by side), so small tables do
  not leave cores idle.
* Row counts for the log come from ``DataFrame.observe`` on the write
  itself — no extra counting jobs.
* Concurrent jobs never append to the same folder (the file committer's
  temporary area is per folder): quarantine rows go to one folder per
  table, ``quarantine/<table>``; read them all with ``quarantine/*``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.enforce import declared
from dimforge.operators.profile import profile
from dimforge.plans import warehouse as W
from dimforge.plans.fixtures import STAGED, staged
from dimforge.schemas import DEFAULT_NOW, staged_schema
from dimforge.sinks import tables as T
from dimforge.sinks.keyed import BucketedTable
from dimforge.sources.api import land, log_of, read_api
from dimforge.sources.catalog import extract_catalog, register
from dimforge.sources.files import read_csv_checked
from dimforge.sources.jdbc import extract_all

STAGED_NAMES = tuple(STAGED)
# load order: referenced tables before the tables that reference them
WAREHOUSE_ORDER = ("dim_company", "dim_people", "dim_funding_rounds", "dim_milestones", "fact_acquisition",
                   "fact_relationship", "fact_ipo", "fact_investments", "dim_funds")
PARALLEL_WRITES = 8


def _observed_write(df: DataFrame, write: Callable[[DataFrame], object], name: str) -> tuple[object, int]:
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    out = write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return out, int(obs.get.get("rows", 0))


def _run_parallel(fns: list[Callable[[], object]], workers: int = PARALLEL_WRITES) -> list[object]:
    if len(fns) <= 1 or workers <= 1:
        return [f() for f in fns]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(f) for f in fns]
        return [f.result() for f in futures]


# ------------------------------------------------------------------ T10 staging
def stage_all(spark: SparkSession, data_dir: str, staging_root: str, log_path: str | None = None,
              database: str | None = None) -> dict[str, int]:
    """Write the staged relations; with ``database`` they are tables of it (their files stay under the root)."""
    counts: dict[str, int] = {}
    failed: dict[str, str] = {}
    with T.RunLog(spark, log_path) as log:
        def one(name: str, df: DataFrame):
            path = f"{staging_root.rstrip('/')}/{name}"
            try:
                _, counts[name] = _observed_write(
                    df, lambda d: register(d, database, name, path) if database else T.write_table(d, path), f"stage_{name}")
                log.add(step="Load Staging", status="Success", source="Staging", table_name=name)
            except Exception as e:  # noqa: BLE001  (one table's failure does not stop the others)
                log.add(step="Load Staging", status=f"Failed: {e}", source="Staging", table_name=name)
                failed[name] = str(e)
        _run_parallel([lambda n=n, d=d: one(n, d) for n, d in staged(spark, data_dir).items()])
    if failed:   # the others are staged and logged
        raise RuntimeError(f"staging failed for {', '.join(sorted(failed))}: {failed}")
    return counts


def stage_csv(spark: SparkSession, name: str, path: str, staging_root: str, log_path: str | None = None,
              header: bool = True, multiline: bool = False) -> dict[str, int]:
    """Stage a CSV with the declared layout of relation ``name``; lines that are
    no rows go to ``<root>/bad_rows/<name>`` with their reason, and are counted in the log."""
    root = staging_root.rstrip("/")
    with T.RunLog(spark, log_path) as log:
        try:
            rows, bad = read_csv_checked(spark, path, staged_schema(name), header, multiline)
            _, n = _observed_write(rows, lambda d: T.write_table(d, f"{root}/{name}"), f"stage_{name}")
            _, n_bad = _observed_write(bad, lambda d: T.write_table(d, f"{root}/bad_rows/{name}"), f"bad_{name}")
        except Exception as e:
            log.add(step="Load Staging", status=f"Failed: {e}", source="CSV", table_name=name)
            raise
        log.add(step="Load Staging", status="Success" if not n_bad else f"Success - {n_bad} bad lines", source="CSV", table_name=name)
    return {"rows": n, "bad_rows": n_bad}


def stage_api(spark: SparkSession, name: str, endpoint: str, start: str, end: str, staging_root: str,
              log_path: str | None = None, **request) -> dict[str, int]:
    """Stage the records of an API for a range of dates (``sources.api``); the
    answers are kept in ``<root>/answers/<name>``.  Returns the windows by
    outcome; every window has a row in the log.  No window with an answer is an error."""
    root = staging_root.rstrip("/")
    records, outcomes = land(read_api(spark, endpoint, start, end, **request), f"{root}/answers/{name}", staged_schema(name))
    T.write_table(records, f"{root}/{name}")
    if log_path:
        log_of(outcomes, name).write.mode("append").parquet(log_path)
    counts = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    if not set(counts) & {"ok", "empty"}:
        raise RuntimeError(f"no answer for {name} from {start} to {end}: {counts}")
    return counts


def read_staged(spark: SparkSession, staging_root: str, log: T.RunLog | None = None,
                database: str | None = None) -> dict[str, DataFrame]:
    """The staged relations: those that ``database`` lists, or else the known names under the root."""
    def on_error(name, e):
        if log:
            log.add(step="Extract", status=f"Failed: {e}", source="staging", table_name=name)
    if database:
        return extract_catalog(spark, database, on_error)
    return extract_all(STAGED_NAMES, lambda n: T.read_parquet_checked(spark, f"{staging_root.rstrip('/')}/{n}"),
                       on_error)


# ------------------------------------------------------------------ T11 profiling
def profile_all(spark: SparkSession, staging_root: str, out_dir: str, log_path: str | None = None,
                person: str = "", sample_k: int = 5, exact: bool = True) -> DataFrame:
    """Profile every staged relation (one job per relation, submitted
    concurrently); each profile table (with ``sample_values``) is written
    once under ``out_dir/profile/<relation>``, the JSON documents are built
    from the written tables, and the written profile is returned.  A relation
    that cannot be read or profiled does not stop the others, whose profile
    tables are written and logged; then the job fails with the names of all
    such relations, and no document of a part of them is written.
    ``exact=False`` trades exact distinct counts (and samples) for one
    aggregate pass without a value shuffle (HyperLogLog counts)."""
    out = out_dir.rstrip("/")
    with T.RunLog(spark, log_path) as log:
        tables = read_staged(spark, staging_root, log)
        failed = {n: "not read" for n in STAGED_NAMES if n not in tables}   # why is in the log

        def one(name: str, df: DataFrame) -> None:
            try:   # one row per column: tiny, one file
                p = profile(df, name, exact=exact, sample_k=sample_k if exact else 0, stored=True)
                T.write_table(p.coalesce(1), f"{out}/profile/{name}")
                log.add(step="Profiling", status="Success", source="from Staging", table_name=name)
            except Exception as e:  # noqa: BLE001  (one relation's failure does not stop the others)
                log.add(step="Profiling", status=f"Failed: {e}", source="from Staging",
                        table_name=name)
                failed[name] = str(e)

        _run_parallel([lambda n=n, d=d: one(n, d) for n, d in tables.items()])
        if failed:   # the others are profiled and logged
            raise RuntimeError(f"profiling failed for {', '.join(sorted(failed))}: {failed}")
        prof = spark.read.parquet(*[f"{out}/profile/{n}" for n in tables])
        T.write_profile_json(prof, f"{out}/json", person=person)
        T.write_profile_json(prof, f"{out}/documents", person=person, per_table=True)
    return prof


# ------------------------------------------------------------------ T12 warehouse
def build_warehouse(spark: SparkSession, staging_root: str, warehouse_root: str, mode: str = "compat",
                    log_path: str | None = None, enforce: bool = True, buckets: int | None = None) -> dict[str, int]:
    """Build and merge all nine warehouse tables; returns the rows merged per
    table plus ``quarantine_<table>`` counts.

    ``enforce``: rows that break a constraint the schema declares (NOT NULL,
    length, numeric range, uniqueness in the batch and against the table) go to ``quarantine_keys/<table>``
    with the names of those they break, before the merge.  The declared foreign keys
    are what the transforms check, against the same loaded tables.

    ``buckets``: the tables are bucketed by their keys (``sinks.keyed``), so a
    load shuffles the incoming rows only."""
    root = warehouse_root.rstrip("/")
    run_id = uuid.uuid4().hex
    counts: dict[str, int] = {}
    with T.RunLog(spark, log_path) as log:
        st = read_staged(spark, staging_root, log)

        def load(t: str, make: Callable[[], W.Built]) -> DataFrame:
            path = f"{root}/{t}"
            work = f"{root}/_work/{run_id}/{t}"
            try:
                built = make()   # finds repeated ids
                _, n = _observed_write(built.classified, lambda d: T.write_table(d, work), f"c_{t}")   # classify once
            except Exception as e:  # noqa: BLE001
                log.add(step="Transform", status=f"Failed - {e}", source="staging", table_name=t)
                raise
            log.add(step="Transform", status=f"Success - {n} rows", source="staging", table_name=t)
            classified = spark.read.parquet(work)
            try:
                valid = built.to_valid(classified)
                defaults = {c: F.current_timestamp().cast("timestamp_ntz") for c in ("created_at", "updated_at")
                            if t in DEFAULT_NOW and c not in valid.columns}
                rules = replace(declared(t, built.key, mode), foreign=()) if enforce else None
                merged = Observation(f"{t}_{uuid.uuid4().hex[:8]}")
                rejected = f"{root}/quarantine_keys/{t}"
                if buckets:
                    BucketedTable(spark, path, built.key, buckets).upsert(valid, defaults, rejected, rules, counted=merged)
                else:
                    T.upsert(valid, path, built.key, defaults, rejected, rules, counted=merged)
                counts[t] = int(merged.get.get("rows", 0))
                log.add(step="Load to DWH", status="Success", source="transformed data", table_name=t)
            except Exception as e:  # noqa: BLE001
                log.add(step="Load to DWH", status=f"Failed - {e}", source="transformed data", table_name=t)
                try:   # the rows as classified: what failed may be the projection itself
                    T.dead_letter(classified, f"{root}/dead_letter/{t}", str(e))
                except Exception as second:  # noqa: BLE001
                    raise second from e
                raise
            if built.to_quarantine is not None:
                _, q = _observed_write(built.to_quarantine(classified),
                                       lambda d: T.append_quarantine(d, f"{root}/quarantine/{t}"), f"q_{t}")
                counts[f"quarantine_{t}"] = q
                log.add(step="Validation", status=f"{q} rows quarantined", source="staging", table_name=t)
            return BucketedTable(spark, path, built.key, buckets).read() if buckets else T.read_table(spark, path)

        company, people = _run_parallel([
            lambda: load("dim_company", lambda: W.transform_company(st["company"], mode=mode)),
            lambda: load("dim_people", lambda: W.transform_people(st["people"], mode=mode)),
            lambda: load("dim_funds", lambda: W.transform_funds(st["funds"], mode=mode))])[:2]

        keys = W.Keys(company, people, mode)   # written once for all checks of this load

        def rounds_then_investments() -> None:   # investments reference the written rounds
            rounds = load("dim_funding_rounds", lambda: W.transform_funding_rounds(
                st["funding_rounds"], company, people, mode=mode, keys=keys))
            load("fact_investments", lambda: W.transform_investments(
                st["investments"], company, people, rounds, mode=mode, keys=keys))

        _run_parallel([
            rounds_then_investments,
            lambda: load("dim_milestones", lambda: W.transform_milestones(st["milestones"], company, mode=mode, keys=keys)),
            lambda: load("fact_acquisition", lambda: W.transform_acquisition(st["acquisition"], company, mode=mode, keys=keys)),
            lambda: load("fact_relationship", lambda: W.transform_relationship(st["relationship"], company, people, mode=mode, keys=keys)),
            lambda: load("fact_ipo", lambda: W.transform_ipo(st["ipo"], company, mode=mode, keys=keys))])
    return counts


def warehouse_table_counts(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """Current row count of each warehouse table (newest version)."""
    out = None
    for t in WAREHOUSE_ORDER:
        part = T.read_table(spark, f"{warehouse_root.rstrip('/')}/{t}").agg(
            F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def run_all(spark: SparkSession, data_dir: str, root: str, mode: str = "compat") -> dict[str, int]:
    """stage -> profile -> warehouse under one root folder."""
    root = root.rstrip("/")
    log = f"{root}/etl_logs"
    stage_all(spark, data_dir, f"{root}/staging", log)
    profile_all(spark, f"{root}/staging", f"{root}/data_profiling", log)
    return build_warehouse(spark, f"{root}/staging", f"{root}/warehouse", mode, log)

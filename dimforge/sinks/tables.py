"""Writers: plain tables, versioned tables with keyed upsert, run log,
quarantine, dead letter, and profile JSON.

Versioned tables
----------------
A table at ``path`` is a set of version folders ``path/v=<n>``.  A write
goes to a new version folder and is visible once Spark's commit marker
(``_SUCCESS``) is there; readers take the newest committed version.  A job
that dies mid-write leaves an uncommitted folder that nobody reads, and
re-running it is safe.  An upsert never reads and overwrites the same
folder in one plan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.enforce import Constraints, classify, split_violations
from dimforge.operators.refcheck import quarantine
from dimforge.operators.upsert import merge, split_incoming


# ------------------------------------------------------------------ file system (Hadoop API)
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def read_parquet_checked(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet`` that fails with a plain ``FileNotFoundError``
    (no query is analysed) when the folder does not exist."""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            try:
                n = int(name[2:])
            except ValueError:
                continue
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(n)
    return sorted(out)


def _next_version(spark: SparkSession, path: str) -> int:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return 1
    seen = [0]
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v="):
            try:
                seen.append(int(name[2:]))
            except ValueError:
                pass
    return max(seen) + 1


# ------------------------------------------------------------------ K1 plain and versioned tables
def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Newest committed version of a versioned table, or the plain table at
    ``path``.  A folder that has version folders but no committed one is an
    error: its files belong to writes that did not end."""
    vs = committed_versions(spark, path)
    if vs:
        return spark.read.format(fmt).load(f"{path.rstrip('/')}/v={vs[-1]}")
    if _next_version(spark, path) > 1:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.format(fmt).load(path)


def write_version(df: DataFrame, path: str) -> str:
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/v={_next_version(spark, path)}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(target)
    return target


# ------------------------------------------------------------------ K2 keyed upsert
def accepted(incoming: DataFrame, table: str, key: str, quarantine_path: str | None = None,
             constraints: Constraints | None = None, target: DataFrame | None = None,
             refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of a batch that may be merged: those that keep the declared
    ``constraints`` (``operators.enforce``), one per non-NULL key
    (``operators.upsert.split_incoming``).  All others are appended to
    ``quarantine_path`` with their key and reason."""
    if key not in incoming.columns:
        raise ValueError(f"upsert: key column {key!r} is missing from the input")
    rejected = []
    if constraints is not None:
        incoming, broken = split_violations(classify(incoming, constraints, key, target, refs))
        rejected.append(broken)
    unique, repeated = split_incoming(incoming, key)
    if quarantine_path:
        out = [quarantine(r, table, key, None, None, reason=F.col("reason")) for r in [*rejected, repeated]]
        append_quarantine(out[0] if len(out) == 1 else out[0].unionByName(out[1]), quarantine_path)
    return unique


def with_defaults(new: DataFrame, defaults: Mapping[str, Column] | None) -> DataFrame:
    """The first rows of a table: columns they lack take their default."""
    for c, v in (defaults or {}).items():
        if c not in new.columns:
            new = new.withColumn(c, v)
    return new


def upsert(incoming: DataFrame, path: str, key: str,
           defaults: Mapping[str, Column] | None = None, quarantine_path: str | None = None,
           constraints: Constraints | None = None, refs: Mapping[str, DataFrame] | None = None,
           counted: Observation | None = None) -> str:
    """Merge ``incoming`` into the versioned table at ``path`` on ``key``;
    returns the new version's folder.

    Only the ``accepted`` rows are merged, so re-running the same batch gives
    the same table.  ``counted`` gets their number (``rows``) from the write itself."""
    spark = incoming.sparkSession
    target = read_table(spark, path) if committed_versions(spark, path) else None
    unique = accepted(incoming, path.rstrip("/").rpartition("/")[2], key, quarantine_path, constraints, target, refs)
    if counted is not None:
        unique = unique.observe(counted, F.count(F.lit(1)).alias("rows"))
    merged = with_defaults(unique, defaults) if target is None else merge(target, unique, key, defaults)
    return write_version(merged, path)


# ------------------------------------------------------------------ K4 run log
def log_rows(spark: SparkSession, entries: Sequence[Mapping[str, object]]) -> DataFrame:
    """Run-log rows as a literal relation (built in the JVM; no Python data path)."""
    now = _dt.datetime.now().replace(microsecond=0)

    def lit_s(v):
        return F.lit(None if v is None else str(v)).cast("string")

    rows = [F.struct(lit_s(e.get("step")).alias("step"), lit_s(e.get("status")).alias("status"),
                     lit_s(e.get("source")).alias("source"), lit_s(e.get("table_name")).alias("table_name"),
                     F.lit(e.get("etl_date") or now).cast("timestamp").alias("etl_date"))
            for e in entries]
    return spark.range(1).select(F.inline(F.array(*rows)))


def append_log(spark: SparkSession, path: str, entries: Sequence[Mapping[str, object]]) -> None:
    """Append run-log rows; a failure to log never fails the job."""
    if not entries:
        return
    try:
        log_rows(spark, entries).coalesce(1).write.mode("append").parquet(path)
    except Exception as e:  # noqa: BLE001
        print(f"run log not written: {e}")


class RunLog:
    """Collects run-log entries of one job and appends them in one write
    (at ``flush``, or when the ``with`` block ends, also on failure)."""

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path, self.entries = spark, path, []

    def add(self, **entry) -> None:
        entry.setdefault("etl_date", _dt.datetime.now().replace(microsecond=0))
        self.entries.append(entry)

    def flush(self) -> None:
        if self.path and self.entries:
            append_log(self.spark, self.path, self.entries)
        self.entries = []

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.flush()
        return False


# ------------------------------------------------------------------ K5 quarantine, K3 dead letter
def append_quarantine(rejected: DataFrame, path: str) -> None:
    """Append quarantine rows (layout of ``refcheck.quarantine``) with ``logged_at``."""
    rejected.withColumn("logged_at", F.current_timestamp()).write.mode("append").option("compression", "zstd").parquet(path)


def dead_letter(df: DataFrame, path: str, error: str) -> None:
    """Keep the rows of a failed load with the error text and time."""
    (df.withColumn("error_message", F.lit(error)).withColumn("etl_date", F.current_timestamp())
       .write.mode("append").parquet(path))


# ------------------------------------------------------------------ K6 profile JSON
def profile_document(profile: DataFrame, person: str, fmt: str) -> DataFrame:
    """One document per table: a header plus ``report``, a map from column
    name to its statistics (``profile`` as made by ``operators.profile.profile``
    with ``sample_k``; the per-table group holds one row per column)."""
    samples = F.col("sample_values") if "sample_values" in profile.columns else F.lit(None).cast("array<string>")
    stats = F.struct("data_type", samples.alias("sample_values"), "unique_count",
                     samples.alias("unique_value"), "null_count", "percentage_missing_value",
                     F.col("min_value"), F.col("max_value"), "percentage_valid_date")
    doc = (profile.groupBy("table_name", "n_rows", "n_cols")
           .agg(F.sort_array(F.collect_list(F.struct("ordinal", "column_name", stats.alias("stats"))))
                .alias("cols"))
           .withColumn("report", F.map_from_entries(
               F.transform("cols", lambda e: F.struct(e["column_name"], e["stats"])))))
    return doc.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.lit(person).alias("person_in_charge"),
        F.struct("table_name", F.lit(fmt).alias("format_file"), "n_rows", "n_cols", "report")
         .alias("profiling_result"))


def write_profile_json(profile: DataFrame, path: str, person: str = "", fmt: str = "from Staging",
                       per_table: bool = False) -> None:
    """One JSON line per profiled table under ``path``; ``per_table`` gives
    each table its own document, ``path/table=<name>/part-*.json``."""
    docs = profile_document(profile, person, fmt)
    if per_table:
        docs = docs.withColumn("table", F.col("profiling_result.table_name"))
        docs.repartition("table").write.mode("overwrite").partitionBy("table").json(path)
    else:
        docs.coalesce(1).write.mode("overwrite").json(path)


#: Layout of the documents, for reading them back.
PROFILE_DOCUMENT_DDL = (
    "created_at string, person_in_charge string, profiling_result struct<table_name: string, format_file: string, n_rows: bigint, "
    "n_cols: int, report: map<string, struct<data_type: string, sample_values: array<string>, unique_count: bigint, "
    "unique_value: array<string>, null_count: bigint, percentage_missing_value: double, min_value: string, max_value: string, "
    "percentage_valid_date: double>>>, `table` string")


def read_profile_json(spark: SparkSession, path: str) -> DataFrame:
    """The documents under ``path`` as one row per table and column."""
    docs = spark.read.schema(PROFILE_DOCUMENT_DDL).json(path).select("profiling_result.*")
    return docs.select("table_name", "format_file", "n_rows", "n_cols", F.explode("report").alias("column_name", "s")) \
        .select("table_name", "format_file", "n_rows", "n_cols", "column_name", "s.*")

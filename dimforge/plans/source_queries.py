"""Queries of sources and profiles: API answers, catalog listing, malformed
CSV lines, merged profiles, per-table documents, runtime filters."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge import schemas as S
from dimforge.operators import profile_state
from dimforge.operators.profile import profile
from dimforge.operators.refcheck import keep_matching_where, written
from dimforge.plans import warehouse as W
from dimforge.plans.catalog import query
from dimforge.plans.fixtures import fixture, register_base_tables, staged
from dimforge.plans.load_queries import scratch
from dimforge.session import runtime_filters
from dimforge.sinks import tables as T
from dimforge.sources.api import land, outcomes_of, read_api
from dimforge.sources.catalog import extract_catalog, register
from dimforge.sources.files import read_csv_checked

PAGES = 4
PAGE_ROWS = 1000  # about as many records a page where a day has more than fit on these
PAGE_BATCH = 16  # pages handed to a Python worker at a time


# ------------------------------------------------------------------ S6 API
def write_answers(answers: DataFrame, folder: str) -> str:
    """Raw HTTP answers (day, page, status, body) as files of a shared folder."""
    folder = folder.removeprefix("file://").removeprefix("file:")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for frame in frames:
            for r in frame.itertuples():
                body = r.body.encode()
                head = f"HTTP/1.1 {r.status} -\r\nContent-Type: application/json\r\nContent-Length: {len(body)}\r\n\r\n"
                with open(f"{folder}/{r.day}_{r.page}.http", "wb") as f:
                    f.write(head.encode() + body)
            yield pd.DataFrame({"n": [len(frame)]})

    size, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", answers.sparkSession.conf
    before = conf.get(size, None)
    conf.set(size, PAGE_BATCH)   # a row is a whole page: the default would hand over a partition at once
    try:
        answers.mapInPandas(run, "n long").agg(F.sum("n")).collect()
    finally:
        conf.unset(size) if before is None else conf.set(size, before)
    return f"landed:{folder}/{{start}}_{{page}}.http"


def _milestone_answers(spark, d) -> str:
    """All milestones as paged daily answers; before them a day that answers
    503, one with a broken body, one without records and one that is missing."""
    m = fixture(spark, d, "milestones").withColumn("day", F.col("milestone_at"))
    # a busier day has more pages, not longer ones
    days = written(m.groupBy("day").agg(F.greatest(F.lit(PAGES), F.ceil(F.count(F.lit(1)) / PAGE_ROWS).cast("int")).alias("n_pages")))
    body = F.to_json(F.struct(*[c for c in m.columns if c != "day"]))
    pages = m.join(F.broadcast(days), "day").groupBy("day", (F.pmod(F.xxhash64("milestone_id"), "n_pages") + 1).cast("int").alias("page")).agg(
        F.concat(F.lit('{"data": {"items": ['), F.array_join(F.collect_list(body), ","), F.lit("]}}")).alias("body"))
    # a page may have no milestone by hash: every day has all its pages, and an empty one after them
    every = days.select("day", F.explode(F.sequence(F.lit(1), F.col("n_pages") + 1)).alias("page"))
    none = F.lit('{"data": {"items": []}}')
    answers = every.join(pages, ["day", "page"], "left").select(
        "day", "page", F.lit(200).alias("status"), F.coalesce("body", none).alias("body"))
    odd = spark.sql("""SELECT * FROM VALUES ('2023-12-28', 1, 503, 'busy'), ('2023-12-29', 1, 200, '{"data": '),
                       ('2023-12-30', 1, 200, '{"data": {"items": []}}') AS t(day, page, status, body)""")
    return write_answers(answers.unionByName(odd), scratch(spark, "answers"))


@query("src_api")
def q_src_api(spark, d):
    """Typed records of the windows that a filter asks for."""
    answers = read_api(spark, _milestone_answers(spark, d), "2023-12-28", "2024-02-15", paged=True, records="data.items", retries=0)
    asked = answers.where("window_start >= DATE'2024-01-08' AND window_end <= DATE'2024-01-21'")
    return land(asked, scratch(spark, "landed"), S.staged_schema("milestones"))[0]


@query("src_api_outcomes")
def q_src_api_outcomes(spark, d):
    """Outcome and records of every window."""
    answers = read_api(spark, _milestone_answers(spark, d), "2023-12-28", "2024-01-21", paged=True, records="data.items", retries=0)
    return outcomes_of(written(answers)).select("window_start", "n_records", "outcome", "status")


# ------------------------------------------------------------------ S3/S5 catalog
@query("src_catalog")
def q_src_catalog(spark, d):
    """The staged relations found by listing a database, with their rows."""
    root = scratch(spark, "catalog")
    database = "stage_" + root.rpartition("/")[2]
    for name, df in staged(spark, d).items():
        register(df, database, name, f"{root}/{name}")
    out = None
    for name, df in extract_catalog(spark, database).items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ S1 malformed lines
def _acquisition_lines(spark, d) -> str:
    """Every acquisition as a line, as a line with a column too many, as one
    with its first column only, and with an id that is no number."""
    path = scratch(spark, "lines")
    f = fixture(spark, d, "acquisition")
    line = F.to_csv(F.struct(*f.columns), {"escape": '"'})
    f.select(F.explode(F.array(line, F.concat(line, F.lit(",more")), F.col("acquisition_id").cast("string"),
                               F.concat(F.lit("x"), line)))).write.text(path)
    return path


@query("src_csv_rows")
def q_src_csv_rows(spark, d):
    return read_csv_checked(spark, _acquisition_lines(spark, d), S.staged_schema("acquisition"), header=False)[0] \
        .select("acquisition_id", "acquiring_object_id", "acquired_object_id", "price_amount", "acquired_at")


@query("src_csv_bad_rows")
def q_src_csv_bad_rows(spark, d):
    bad = read_csv_checked(spark, _acquisition_lines(spark, d), S.staged_schema("acquisition"), header=False)[1]
    return bad.select("first_value", "reason")


# ------------------------------------------------------------------ A3/A6 merged profiles
@query("profile_merged")
def q_profile_merged(spark, d):
    """Line items profiled in two batches (one of them twice) and merged;
    the estimated distinct counts against the exact ones."""
    register_base_tables(spark, d, ("lineitem",))
    items, path = spark.table("lineitem"), scratch(spark, "profile_state")
    open_items = F.coalesce(F.col("l_linestatus") == "O", F.lit(False))
    for batch, rows in (("closed", items.where(~open_items)), ("open", items.where(open_items)), ("closed", items.where(~open_items))):
        profile_state.store(rows, path, batch)
    exact = profile(items, "lineitem", stored=True).select("column_name", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.lit(1), 0.03 * F.col("exact"))
    return profile_state.merged(spark, path, "lineitem").join(F.broadcast(exact), "column_name") \
        .withColumn("distinct_close", near).drop("unique_count", "exact")


# ------------------------------------------------------------------ K6 one document per table
@query("profile_documents")
def q_profile_documents(spark, d):
    """The whole report of every staged relation, read back from its own document."""
    from dimforge.plans.jobs import profile_all, stage_all
    root = scratch(spark, "documents_job")
    stage_all(spark, d, f"{root}/staging")
    profile_all(spark, f"{root}/staging", f"{root}/data_profiling")
    return T.read_profile_json(spark, f"{root}/data_profiling/documents").select(
        "table_name", "n_rows", "n_cols", "column_name", "data_type", "unique_count", "null_count", "percentage_missing_value",
        "min_value", "max_value", "percentage_valid_date")


# ------------------------------------------------------------------ J1 runtime filter
@query("fk_runtime_filter")
def q_fk_runtime_filter(spark, d):
    """Investments whose funding round was raised in other than US dollars, by a runtime filter."""
    path, facts = scratch(spark, "rounds"), scratch(spark, "investments")
    T.write_table(W._rounds_clean(fixture(spark, d, "funding_rounds")), path)
    T.write_table(W.investments_prepared(written(fixture(spark, d, "investments"))), facts)
    with runtime_filters(spark, fact_at_least="0", keys_at_most="1GB"):
        return written(keep_matching_where(spark.read.parquet(facts), spark.read.parquet(path), ["funding_round_id"],
                                           ["funding_round_id"], "raised_currency <> 'USD'"))

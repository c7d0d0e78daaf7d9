"""A paged JSON API as a Spark data source.

One partition is one date window of the request range, so windows are
fetched in parallel and a lost executor repeats its windows only.  A filter on
``window_start`` or ``window_end`` is pushed into the source: windows outside
it are never requested.  A task holds one page at a time.

``endpoint`` is a URL with ``{start}``, ``{end}`` and ``{page}``.  Besides the
schemes that Python's ``urllib`` opens (http, https, file) it may be
``landed:/folder/...``: stored raw HTTP responses (status line, headers, body)
in a folder that all executors share, for replays and tests.

Every record is a row with its JSON text; what goes wrong is a row too, in
classes of its own:

* ``transport_error``: no answer (unknown host, refused, timeout, missing file);
* ``bad_status``: an answer other than 2xx, with its status;
* ``malformed``: a body that is not the expected JSON;
* ``empty``: an answer without any record in the whole window.

Transport errors and 5xx answers are tried ``retries`` times more.  Pages read
before a failure keep their records; the window then has both.

``land`` stores the answers once and splits them into typed records and
one outcome per window, so no request is made twice.
"""

from __future__ import annotations

import datetime as dt
import http.client
import io
import json
import sys
import time
import urllib.error
import urllib.request
import urllib.response
from collections.abc import Iterator
from types import SimpleNamespace

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

SCHEMA = "window_start date, window_end date, page int, outcome string, status int, detail string, record string"
DAY = dt.timedelta(days=1)


class _Landed(urllib.request.BaseHandler):
    def landed_open(self, req):
        try:
            with open(req.full_url.split(":", 1)[1], "rb") as f:
                raw = f.read()
        except OSError as e:
            raise urllib.error.URLError(e) from e
        answer = http.client.HTTPResponse(SimpleNamespace(makefile=lambda *_: io.BytesIO(raw)))
        answer.begin()
        return urllib.response.addinfourl(answer, answer.headers, req.full_url, answer.status)


class Failure(Exception):
    """A request that gave no records: its class, the status if any, and what was said."""

    def __init__(self, outcome: str, detail: object, status: int | None = None):
        super().__init__(f"{outcome}: {detail}")
        self.outcome, self.detail, self.status = outcome, str(detail)[:500], status


def fetch(url: str, timeout: float = 30, retries: int = 2, wait: float = 0.5) -> tuple[int, bytes]:
    """(status, body) of one request."""
    opener = urllib.request.build_opener(_Landed)
    for left in range(retries, -1, -1):
        try:
            with opener.open(url, timeout=timeout) as answer:
                status, body = answer.status or 200, answer.read()
            failure = None if 200 <= status < 300 else Failure("bad_status", body[:200].decode("utf-8", "replace"), status)
        except urllib.error.HTTPError as e:
            failure = Failure("bad_status", e.reason, e.code)
        except (OSError, http.client.HTTPException) as e:  # URLError and timeouts are OSErrors
            failure = Failure("transport_error", getattr(e, "reason", e))
        if failure is None:
            return status, body
        if not left or failure.outcome == "bad_status" and failure.status < 500:
            raise failure
        time.sleep(wait)
    raise AssertionError("not reached")


def parse_page(body: bytes, records: str | None, next_field: str | None) -> tuple[list, bool | None]:
    """(records, whether more pages follow, if the answer says so)."""
    try:
        answer = json.loads(body)
        found = answer
        for name in records.split(".") if records else ():
            found = found[name]
        if not isinstance(found, list):
            raise ValueError("the records are not a list")
        return found, bool(answer.get(next_field)) if next_field and isinstance(answer, dict) else None
    except (ValueError, KeyError, TypeError) as e:
        raise Failure("malformed", repr(e)) from e


class Window(InputPartition):
    def __init__(self, start: dt.date, end: dt.date):
        super().__init__((start, end))


def _date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


class ApiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.endpoint = options["endpoint"]
        self.first, self.last = _date(options["start"]), _date(options["end"])
        self.days = int(options.get("window_days", 1))
        self.paged = str(options.get("paged", "false")).lower() == "true"
        self.records, self.next_field = options.get("records") or None, options.get("next_field") or None
        self.timeout, self.retries = float(options.get("timeout", 30)), int(options.get("retries", 2))
        if self.days < 1:
            raise ValueError("window_days must be 1 or more")
        self.bounds: list[tuple[str, str, dt.date]] = []

    def pushFilters(self, filters: list[Filter]):
        ops = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in ops and f.attribute in (("window_start",), ("window_end",)) and f.value is not None:
                self.bounds.append((f.attribute[0], ops[type(f)], _date(f.value)))
            else:
                yield f

    def _asked(self, start: dt.date, end: dt.date) -> bool:
        for name, op, value in self.bounds:
            x = start if name == "window_start" else end
            if not {"=": x == value, ">": x > value, ">=": x >= value, "<": x < value, "<=": x <= value}[op]:
                return False
        return True

    def partitions(self) -> list[Window]:
        out, at = [], self.first
        while at <= self.last:
            end = min(at + DAY * (self.days - 1), self.last)
            if self._asked(at, end):
                out.append(Window(at, end))
            at = end + DAY
        # a scan needs a partition; one that asks for nothing gives nothing
        return out or [Window(None, None)]

    def read(self, partition: Window) -> Iterator[tuple]:
        start, end = partition.value
        if start is None:
            return
        page, total, more = 0, 0, True
        while more:
            page += 1
            status = None
            try:
                status, body = fetch(self.endpoint.format(start=start, end=end, page=page), self.timeout, self.retries)
                found, says_more = parse_page(body, self.records, self.next_field)
            except Failure as f:
                yield start, end, page, f.outcome, f.status or status, f.detail, None
                return
            for r in found:
                yield start, end, page, "ok", status, None, json.dumps(r, ensure_ascii=False)
            total += len(found)
            more = self.paged and bool(found) if says_more is None else says_more
        if not total:
            yield start, end, page, "empty", status, "no records", None


class ApiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ApiReader:
        return ApiReader(dict(self.options))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy


def read_api(spark: SparkSession, endpoint: str, start: str, end: str, window_days: int = 1, paged: bool = False,
             records: str | None = None, next_field: str | None = None, timeout: float = 30, retries: int = 2) -> DataFrame:
    """Raw answers (columns of ``SCHEMA``): a row per record or failure."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ApiSource)
    options = {"endpoint": endpoint, "start": start, "end": end, "window_days": window_days, "paged": str(paged).lower(),
               "records": records or "", "next_field": next_field or "", "timeout": timeout, "retries": retries}
    return spark.read.format("json_api").options(**{k: str(v) for k, v in options.items()}).load()


def records_of(answers: DataFrame, schema: StructType | str) -> DataFrame:
    """The records with their declared types."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return answers.where("outcome = 'ok'").select(F.from_json("record", ddl).alias("r")).select("r.*")


def outcomes_of(answers: DataFrame) -> DataFrame:
    """One row per window: its records, its outcome (a failure stands above
    ``ok``), the status and what was said."""
    failed = F.col("outcome") != "ok"
    return answers.groupBy("window_start", "window_end").agg(
        F.count_if(~failed).alias("n_records"), F.coalesce(F.max(F.when(failed, F.col("outcome"))), F.lit("ok")).alias("outcome"),
        F.coalesce(F.max(F.when(failed, F.col("status"))), F.max("status")).alias("status"),
        F.max(F.when(failed, F.col("detail"))).alias("detail"))


def land(answers: DataFrame, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Request once: the answers are written to ``path``, then (typed records, outcomes)."""
    answers.write.mode("overwrite").parquet(path)
    stored = answers.sparkSession.read.schema(answers.schema).parquet(path)
    return records_of(stored, schema), outcomes_of(stored)


def log_of(outcomes: DataFrame, table_name: str) -> DataFrame:
    """Run-log rows: one per window, failures with their class."""
    status = F.when(F.col("outcome") == "ok", F.concat(F.lit("Success - "), "n_records", F.lit(" records"))).otherwise(
        F.concat(F.lit("Failed - "), "outcome", F.coalesce(F.concat(F.lit(" "), "status"), F.lit("")), F.lit(": "), F.coalesce("detail", F.lit(""))))
    return outcomes.select(F.lit("Extract").alias("step"), status.alias("status"), F.lit("API").alias("source"),
                           F.lit(table_name).alias("table_name"), F.current_timestamp().alias("etl_date"))

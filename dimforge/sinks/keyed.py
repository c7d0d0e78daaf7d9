"""Targets laid out by their key, so that a merge moves or writes less.

``BucketedTable``: every version is bucketed and sorted by the key (Spark's
``bucketBy``).  A merge then shuffles the incoming rows only, into the
buckets of the target; each task reads one bucket and writes one file of the next version.

``PartitionedTable``: partitioned by a hash or a range of the key.  A merge
reads the partitions that the batch touches (partition pruning) and replaces
exactly these; the files of all others stay as they are.  Ranges suit keys that grow with time, where a batch
touches few partitions; with hashes a small batch does.

Versions of a bucketed table are visible once committed, as in
``sinks.tables``.  The partitioned table has one version.  Its merged
partitions are first written beside it (``<table>.merge``) and then moved over
the old ones, folder by folder, so each file is written once and nothing is
read and replaced by one job: lost executors change nothing, and a driver that
dies while partitions are replaced leaves those not yet moved committed;
``finish`` (the next ``upsert`` begins with it) moves them.  Readers in
between may see some partitions new and others missing or old; where
they must not, use the versioned tables.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.enforce import Constraints
from dimforge.operators.upsert import merge
from dimforge.sinks import tables as T


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = T._fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = T._fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


class _Keyed:
    """A folder with its layout beside the data; another layout is an error."""

    def __init__(self, spark: SparkSession, path: str, **layout):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout
        self.key = layout["key"]
        self.name = self.path.rpartition("/")[2]
        text = _read_text(spark, f"{self.path}/_layout")
        if text is not None and json.loads(text) != layout:
            raise ValueError(f"{self.path} has the layout {text}, not {json.dumps(layout)}")
        self._new = text is None

    def _remember_layout(self) -> None:
        if self._new:
            _write_text(self.spark, f"{self.path}/_layout", json.dumps(self.layout))
            self._new = False

    def _accept(self, incoming: DataFrame, target: DataFrame | None, quarantine_path, constraints, refs, counted) -> DataFrame:
        rows = T.accepted(incoming, self.name, self.key, quarantine_path, constraints, target, refs)
        return rows.observe(counted, F.count(F.lit(1)).alias("rows")) if counted is not None else rows


class BucketedTable(_Keyed):
    """A versioned table in ``buckets`` hash buckets of ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int):
        super().__init__(spark, path, key=key, buckets=buckets)
        self.buckets = buckets

    def _catalog_name(self, version: int) -> str:
        return f"dimforge_{zlib.crc32(self.path.encode()):08x}_v{version}"

    def read(self) -> DataFrame:
        """The newest committed version, known to Spark as bucketed (a session
        that has not seen it yet registers its folder)."""
        versions = T.committed_versions(self.spark, self.path)
        if not versions:
            raise FileNotFoundError(f"no committed version at {self.path}")
        name, folder = self._catalog_name(versions[-1]), f"{self.path}/v={versions[-1]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(folder).schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def merged(self, accepted: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
        """The next version's rows; the target is read bucket by bucket."""
        return merge(self.read(), accepted, self.key, defaults)

    def upsert(self, incoming: DataFrame, defaults: Mapping[str, Column] | None = None, quarantine_path: str | None = None,
               constraints: Constraints | None = None, refs: Mapping[str, DataFrame] | None = None,
               counted: Observation | None = None) -> str:
        there = bool(T.committed_versions(self.spark, self.path))
        rows = self._accept(incoming, self.read() if there else None, quarantine_path, constraints, refs, counted)
        out = self.merged(rows, defaults) if there else \
            T.with_defaults(rows, defaults).repartition(self.buckets, self.key)
        self._remember_layout()  # before any row
        version = T._next_version(self.spark, self.path)
        folder = f"{self.path}/v={version}"
        (out.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", folder).saveAsTable(self._catalog_name(version)))
        return folder


PART = "key_part"
MOVES = 16  # folders moved side by side
RUNS = 64  # more runs of neighbouring partitions than this are listed one by one


def _among(parts: Sequence[int]) -> str:
    """The partition filter for the (sorted) numbers ``parts``; neighbours are one range."""
    runs: list[list[int]] = []
    for n in parts:
        if runs and n == runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    if len(runs) > RUNS:
        return f"{PART} IN ({', '.join(map(str, parts))})"
    return " OR ".join(f"{PART} BETWEEN {lo} AND {hi}" for lo, hi in runs)


class PartitionedTable(_Keyed):
    """A table in partitions of ``key``: ``parts`` hashes, or ranges of ``width`` of an integer key."""

    def __init__(self, spark: SparkSession, path: str, key: str, parts: int | None = None, width: int | None = None):
        if (parts is None) == (width is None):
            raise ValueError("PartitionedTable: give either parts or width")
        super().__init__(spark, path, key=key, parts=parts, width=width)
        self.merge_path = f"{self.path}.merge"
        k = F.col(key)
        self.part = F.pmod(F.xxhash64(k), F.lit(parts)).cast("int") if parts else F.floor(k / F.lit(width)).cast("int")

    def _read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._read().drop(PART)

    def _has_rows(self) -> bool:
        fs, p, _ = T._fs(self.spark, self.path)
        return fs.exists(p) and any(st.getPath().getName().startswith(f"{PART}=") for st in fs.listStatus(p))

    def touched(self, accepted: DataFrame) -> list[int]:
        """The partitions a batch belongs to (numbers of partitions, not rows)."""
        return sorted(r[0] for r in accepted.select(self.part.alias(PART)).distinct().collect())

    def upsert(self, incoming: DataFrame, defaults: Mapping[str, Column] | None = None, quarantine_path: str | None = None,
               constraints: Constraints | None = None, refs: Mapping[str, DataFrame] | None = None,
               counted: Observation | None = None) -> list[int]:
        """Merge ``incoming``; returns the partitions that were rewritten."""
        self._remember_layout()  # before any row
        self.finish()
        there = self._has_rows()
        target = self.read() if there and constraints is not None else None  # what is unique is checked against it
        rows = self._accept(incoming, target, quarantine_path, constraints, refs, counted)
        parts = self.touched(rows)
        if not parts:  # nothing to merge
            return parts
        rows = rows.withColumn(PART, self.part)
        if there:
            out = merge(self._read().where(_among(parts)), rows, self.key, defaults)
        else:
            out = T.with_defaults(rows, defaults)
        # rebalance: the files of a partition follow its size, small ones are not scattered
        # the files count only once all are there (_SUCCESS), so tasks may move their own into place
        (out.hint("rebalance", F.col(PART)).write.mode("overwrite").partitionBy(PART)
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.merge_path))
        self.finish()
        return parts

    def finish(self) -> bool:
        """Moves the partitions that a merge has written over the old ones; whether there were any."""
        fs, p, jvm = T._fs(self.spark, self.merge_path)
        path = jvm.org.apache.hadoop.fs.Path
        done = fs.exists(path(p, "_SUCCESS"))

        def move(name: str) -> None:
            old = path(self.path, name)
            fs.delete(old, True)
            if not fs.rename(path(p, name), old):
                raise OSError(f"{self.merge_path}/{name} could not be moved to {self.path}")

        if done:
            names = [n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(f"{PART}=")]
            with ThreadPoolExecutor(MOVES) as pool:
                list(pool.map(move, names))
        fs.delete(p, True)
        return done

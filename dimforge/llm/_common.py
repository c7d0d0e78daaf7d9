"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.session import ensure_checkpoint_dir

#: Words are maximal runs of characters other than space, tab, LF, VT, FF, CR.
WORD_SEPARATOR = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of rows that reach a Python function at once, and rows that the widening functions return at once.
BATCH_BYTES = 4 << 20
PIECE = 1 << 15


def bounded_batches(spark: SparkSession) -> None:
    """Rows reach Python functions in batches of about ``BATCH_BYTES``.

    Spark's own bound is 64 MB a batch, which each running task holds several
    times: as Arrow buffers and as bytes for the pipe in the executor, as
    batch, objects and results in the Python worker, which keeps its peak while it lives.  A
    bound that the session already has stays.  The setting outlives the
    call, since the frames of an operator run after it has returned."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if size not in spark.conf.getAll:
        spark.conf.set(size, BATCH_BYTES)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def words_of(col: Column | str) -> Column:
    """Array of the words of a text column (native)."""
    return F.filter(F.split(text_or_empty(col), WORD_SEPARATOR), lambda w: w != "")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    A written table cuts the lineage: a lost executor costs at most the
    tasks since the last table.  ``drop`` deletes a table that no later step
    reads and lets Spark's cleaner remove the shuffles that led to it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = f"{self.root}/{tag}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        del df
        self.release()
        return out

    def release(self) -> None:
        """Let the cleaner drop shuffle files of frames that are gone."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tags: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for tag in tags:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{tag}")
            path.getFileSystem(conf).delete(path, True)
        self.release()

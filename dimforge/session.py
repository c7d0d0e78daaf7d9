"""Session helpers.

Library code never creates or stops a session; it takes the caller's.
``get_session`` is for tests, the bench and the command-line jobs only.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the warehouse plans rely on.  AQE re-plans joins at run time
# (broadcast only when the measured side is under the threshold, otherwise
# sort-merge) and splits skewed partitions of a join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "dimforge",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def runtime_filters(spark: SparkSession, fact_at_least: str = "10GB", keys_at_most: str = "1GB"):
    """Actions inside run with Spark's runtime Bloom filters on joins.

    Where a join shuffles both sides, the fact is at least ``fact_at_least``
    in size and the (filtered) key side at most ``keys_at_most``, Spark builds a Bloom
    filter of the keys first and drops fact rows without a match before they
    are shuffled.  Key sides below the broadcast threshold need none of this."""
    names = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": fact_at_least,
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": keys_at_most,
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint dir.  Only a local master gets a scratch folder
    of its own when the setting is absent (local runs and tests); on a
    cluster the executors could not see it, so the setting must name shared
    storage and its absence is an error."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(
            f"spark.checkpoint.dir is not set (master {master}): name a folder "
            "that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="dimforge-ckpt-", dir=os.environ.get("DIMFORGE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])

"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_ZONE = "Asia/Shanghai"

# Only settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Changelog checkpoints: a commit uploads the changes, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A compressed topic isn't split, so files of small size are put together to a task's share: ten
    # times as much text as this, which must fit the task's sorts.
    "spark.sql.files.maxPartitionBytes": "16m",
    # State of wide rows is most of a stream's disk: pack it well, locally and in the checkpoint.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # Without a count of its rows a store writes a row without looking for it first.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Shuffle files of a query that has ended go at once, also those of each micro-batch.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession, zone: str = DEFAULT_ZONE) -> SparkSession:
    """Apply the engine's settings and its one explicit time zone to a session."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "tillstream", zone: str = DEFAULT_ZONE, master: str | None = None,
          conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate(), zone)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in spark.checkpoint.dir.

    A local folder is used only where that setting is absent and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillstream-")
    return f"{base.rstrip('/')}/tillstream/{name}-{uuid.uuid4().hex[:12]}"

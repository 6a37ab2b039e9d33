"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on; safe to put on a session someone else made.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings the speed depends on; used when we make the session.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A page far behind the first is sorted by the executors, not gathered by the driver.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    "spark.ui.enabled": "false",
}

# State of the streaming jobs: on disk, saved as changes and not as whole copies per batch.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per partition of a join instead of four: a quarter of the files of each batch.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the results depend on (UTC days, last value wins for a repeated field)."""
    return _set(spark, REQUIRED)


def keep_state_on_disk(spark: SparkSession) -> SparkSession:
    """Join and dedup state can outgrow the heap of the executors."""
    return _set(spark, STATE)


def _set(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_tasks(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))


def build_session(app: str = "tallyflow", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **STATE, **REQUIRED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and written tables, under ``spark.checkpoint.dir``.

    Every executor must reach it, so a local folder is made only where the setting is unset
    and the session is a local one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix=f"{name}-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")

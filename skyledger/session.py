"""Session defaults and the shared work folder.

Every setting here is a runtime SQL setting, so ``prepare`` works on a session somebody else has built.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# All timestamps are UTC; the adaptive settings let Spark split hot keys and merge tiny partitions at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot key may cost one more exchange; one straggler with a third of the rows costs far more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings for long-running streams: state lives off-heap and is uploaded as change logs.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app_name: str, master: str | None = None):
    """A ``SparkSession.builder`` with the defaults of this package."""
    made = SparkSession.builder.appName(app_name)
    if master:
        made = made.master(master)
    for key, value in {**RUNTIME_CONF, **STREAM_CONF}.items():
        made = made.config(key, value)
    return made


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below a folder that driver and executors share.

    That is the folder named by ``spark.checkpoint.dir``. Where it is unset, the warehouse folder of the session takes its place,
    unless that lies on one machine while the session runs on several: other executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if warehouse.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share; the warehouse lies on one machine")
        base = f"{warehouse}/_work"
    return f"{base.rstrip('/')}/skyledger/{name}-{uuid.uuid4().hex}"

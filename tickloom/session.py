"""Session settings and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tickloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are designed for; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        # Integer sums raise on overflow instead of wrapping round.
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A table is broadcast by its measured size, never by the estimate that is scaled from its files.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local path would
    be lost with its machine.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session set-up and the few places where a plan depends on cluster settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of one key that a single window task may hold before its history is split.
ROWS_PER_TASK = 10_000_000
# Rows a slice of such a history is meant to hold.
ROWS_PER_SLICE = 4_000_000

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def open_session(app: str = "tidelog", **conf: str) -> SparkSession:
    """Build (or get) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidelog-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Every later pass then sees the same rows without computing them again, reads
    only the columns it needs, and survives lost executors.
    """
    place = shared_folder(df.sparkSession, "pinned")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)

"""Session settings shared by tests, the bench and interactive use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What the operators rely on. Everything else is the cluster's business.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # longer generated methods are not compiled by the JVM and run several times slower
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # keep session state of a hot key small: merge sessions map-side before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventrill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in REQUIRED_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made elsewhere."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset a
    local session gets a temporary one; a cluster session is refused, because a
    folder on one machine is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventrill-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/eventrill/{purpose}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``max_rows`` rows, else as it is.

    For dimension tables made by a query: Spark cannot tell their size when it plans, and
    would shuffle the big side by a key with few, heavy values. A larger table is joined by
    a shuffle, where the adaptive join splits heavy keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there.

    Used for intermediates that several passes read. A lost executor costs the
    re-read of a file, not the recomputation of what led to it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session settings for tests, the bench and local runs. On a cluster the session is given."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# What jobs want of a session: the first is needed, the others make them fast.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Distinct lists per session: hash this many sessions before falling back to a sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    # Open windows and blocks of streams, off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Call sites of every column in error messages; costs more than planning itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config(map=JOB_CONF)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folder: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as the cluster names it. Only a local session
    without one gets a temporary folder, the same one every time."""
    global _local_folder
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="clickloom-")
    return _local_folder

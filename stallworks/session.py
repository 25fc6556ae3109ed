"""Session settings and the shared working folder.

Nothing here fixes a parallelism: tasks are cut by size, so their number follows the
input, and AQE coalesces or splits partitions at run time.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: Runtime SQL settings every plan of this package is written for.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A skewed side is split even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Rows that lie together by one key of a join stay where they are for the others.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # More input makes more tasks, not larger ones: small splits of a file, and enough
    # shuffle partitions that AQE joins them up to a size instead of running out of them.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}

#: Settings a session must be opened with. Recording the call site of every column
#: expression makes wide plans slow to build.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests, comparisons and benchmarks. No web page is served."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stallworks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RECOMMENDED, **STATIC}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings above on a session that is already open."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and scratch output.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go
    without, and then gets a temporary folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stallworks-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"

"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Broadcasts are left to AQE, which decides on measured
# sizes; skew joins are split even where that costs one more shuffle. Shuffles begin
# with many partitions, so that none is sorted by way of the disk, and AQE joins them:
# 200 are the most that map tasks write straight to files (spark.shuffle.sort.bypassMergeThreshold);
# with more, each first gathers and sorts all its rows, and spills them. What map tasks
# still sort, for the latest row of a key, is bounded by the part of a file they read: at most
# 32 MB, and down to 4 (spark.sql.files.openCostInBytes) as long as that gives no more than a
# thousand parts, because 32 MB of a narrow file are millions of rows, more than a task sorts in memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.files.minPartitionNum": "1000",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Static settings, which only a new session can take. Call-site capture costs
# several driver round trips per column expression.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g",
                  name: str = "strataline") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    A cluster names a shared one in ``spark.checkpoint.dir``. Only a local
    master, where every task shares the machine, falls back to a fresh folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="strataline-checkpoint-")
    context.setCheckpointDir(shared)
    return shared


def materialise(df: DataFrame) -> DataFrame:
    """Compute once what several branches of a plan read, and cut its lineage.

    Parquet in the shared folder: it survives lost executors, which a cached or
    locally checkpointed frame does not, and later reads prune columns and push
    filters down.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/layer-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

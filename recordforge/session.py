"""Session helpers.

Library code never creates a session; it reads settings from the one it is given.  The
builder below is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a cluster job should run with.  AQE re-plans at runtime: it coalesces small
# shuffle partitions, turns a sort-merge join into a broadcast join once the real size of
# one side is known to be under the threshold, and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only on measured sizes: static planning would trust file-size estimates,
    # which miss row growth from explode/joins; AQE decides from the materialised stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # The JVM does not JIT-compile methods over 8000 bytecodes; a whole-stage method between
    # that and Spark's default limit (65535) runs interpreted, several times slower.  With the
    # limit at 8000 such stages use per-operator generated code, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def sized_conf(input_bytes: int, shuffle_ratio: float = 1.0, cores: int | None = None) -> dict[str, str]:
    """Settings sized to the input: each shuffle partition near 256 MB so it fits in executor memory.

    ``shuffle_ratio`` is the expected shuffle bytes per input byte (after pruning and partial
    aggregation; the staging distincts shuffle about what they read).  AQE starts from this
    many partitions and coalesces small ones, so over-estimating costs little, while too few
    partitions make each task spill.  The count is at least ``2 * cores`` so every core works.
    """
    shuffle_bytes = max(1, int(input_bytes * shuffle_ratio))
    parts = max(-(-shuffle_bytes // TARGET_PARTITION_BYTES), 2 * (cores or 1), 8)
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "recordforge") -> SparkSession:
    """A local session for tests and the bench (UI off, checkpoint dir in a fresh scratch dir)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RF_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; a cluster session
    without it is an error.  Only a local session (tests) without it gets a fresh scratch
    folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a shared folder for checkpoints "
                         "(a machine-local folder is not reachable from other executors)")
    path = tempfile.mkdtemp(prefix="rf-ckpt-", dir=os.environ.get("RF_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path

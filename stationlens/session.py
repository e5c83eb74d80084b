"""Session defaults shared by the library, the tests and the bench.

Only runtime SQL confs are touched by ``configure`` so it is safe to call on a
session somebody else built (the driver's, a cluster notebook's).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime confs every operator relies on.
#  * ANSI on: bad casts must go through try_cast / try_divide explicitly.
#  * UTC: wall-clock timestamps round-trip through LTZ parsing unchanged.
#  * AQE: runtime broadcast conversion (checked by actual shuffle size), partition
#    coalescing and skew-join splitting.
# Static confs: only settable when the session is built (``get_spark``). Python
# call-site capture for every Column (error context) costs more than the query plans
# themselves on deep pipelines.
STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs to any session (the driver's, a notebook's). A conf the
    session does not allow to change at runtime is left as it is."""
    for key, value in RUNTIME_CONF.items():
        try:
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)
        except Exception:  # static or locked conf: keep the session's value
            pass
    return spark


def get_spark(app: str = "stationlens", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. On a cluster use the session the platform provides and
    call :func:`configure` on it instead."""
    master = master or os.environ.get("STATIONLENS_MASTER", "local[8]")
    cores = 8
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = int(master[6:-1])
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STATIONLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**STATIC_CONF, **RUNTIME_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the platform (a shared filesystem every
    executor and the driver see); an unset value is an error there. Only in local
    mode (tests) is a fresh scratch folder created and registered when it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return conf
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared "
                           "folder every executor can reach; a machine-local folder is not used")
    local = tempfile.mkdtemp(prefix="stationlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scale_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 << 20,
               max_split_bytes: int = 512 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run, from the size of the largest input.

    * shuffle partitions: enough that each holds ~``target_partition_bytes`` of the
      largest shuffle (taken as the input size -- the daily aggregate shuffles at most
      that), never fewer than 2x the cores; AQE then coalesces small ones;
    * file splits: ``max_split_bytes`` per scan task, so a 100 TB scan is ~200k tasks;
    * skew join: a partition 5x the median and above 256 MB is split.
    Apply with ``for k, v in scale_conf(...).items(): spark.conf.set(k, v)``.
    """
    parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }

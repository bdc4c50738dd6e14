"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library assumes.  Shuffle partition count is
# left to the caller / cluster (AQE coalesces small partitions at runtime).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Sizing for a job reading ``input_bytes`` on ``total_cores`` cores.

    * scan splits of ``target_partition_mb`` (100 TB -> ~400k scan tasks);
    * initial shuffle partitions so that a shuffle of the whole input lands at
      about ``target_partition_mb`` per partition (at least 2 per core); AQE
      coalesces them down for smaller shuffles and splits skewed ones;
    * a partition is "skewed" at 4x the target (and 256 MB minimum);
    * broadcast threshold equal to the library's checked bound (64 MB).
    """
    target = target_partition_mb * MB
    shuffle = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(max(4 * target, 256 * MB)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
    }


def get_session(master: str | None = None, app: str = "tripmart",
                shuffle_partitions: int | None = None, input_bytes: int | None = None,
                total_cores: int | None = None, **extra: str) -> SparkSession:
    """Return (or create) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher provides it.
    With ``input_bytes`` and ``total_cores`` the sizing of :func:`scale_conf`
    is applied (an explicit ``shuffle_partitions`` still wins).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if input_bytes is not None and total_cores:
        for k, v in scale_conf(input_bytes, total_cores).items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``DataFrame.checkpoint`` and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; it is only invented
    here (under the system temp dir) when the session runs in local mode,
    as in tests.  A cluster session without the setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or None
    if d is None:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

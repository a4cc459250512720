"""SparkSession construction with the settings every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Joins whose smaller side is below this size (bytes, measured by the
# optimizer from statistics and re-measured by AQE after each shuffle)
# are broadcast; above it Spark falls back to a sort-merge join.
BROADCAST_THRESHOLD = str(32 * 1024 * 1024)


MB = 1024 * 1024
# Target bytes per task for scans and shuffle reads: large enough to keep
# task overhead low, small enough to sort/aggregate without heavy spilling.
TARGET_PARTITION_BYTES = 256 * MB


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of fact data on
    ``total_cores`` executor cores.

    * shuffle partitions ~ input / 256 MB (at least 2 per core), so a
      full-table shuffle stays near 256 MB per reducer; AQE then coalesces
      small ones toward the same advisory size;
    * scans split files at 256 MB;
    * a shuffle partition counts as skewed at 5x the median and > 1 GB, and
      AQE splits it (joins) instead of leaving one straggler.

    100 TB gives about 400,000 shuffle partitions (a fiscal year shuffles ~1/8
    of that); 4 MB on 8 cores gives 16.
    """
    parts = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
    }


def get_session(
    app: str = "salescope",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Return (or create) a session configured for the salescope operators.

    ``master`` and ``shuffle_partitions`` are only set when given, so that on a
    cluster the submitter's settings win.  With ``input_bytes`` and
    ``total_cores`` the partition sizes come from :func:`scale_settings`.
    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and turns joins into broadcasts once the real size of a side
    is known.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": BROADCAST_THRESHOLD,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_THRESHOLD,
        "spark.sql.sources.bucketing.enabled": "true",
        # facts bucketed by (customer, product) join on (customer, date, product) without a shuffle
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    if input_bytes and total_cores:
        conf.update(scale_settings(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, registered with the
    session.

    On a cluster that setting names shared storage (HDFS, object store) and
    must be there: without it this raises rather than use a folder of one
    machine.  Only a local session without it (tests) gets a scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="salescope-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder

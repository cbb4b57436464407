"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from measured
# shuffle sizes (broadcast only what it has measured to be small,
# split skewed partitions) and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of intermediates are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "accrualkit",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input_bytes / 128 MB (AQE coalesces
    downwards from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage-cutting writes.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only when neither is set — local tests — do we
    create one, and only for a local master: on a cluster a machine-local
    folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, the server owns it
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc and not sc.master.startswith("local") and current.startswith("file:"):
            warnings.warn(f"{current} must be mounted on every machine of the cluster", stacklevel=2)
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="accrualkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", "connect")

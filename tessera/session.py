"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every tessera job relies on.  AQE re-plans joins at runtime (it is the
# size check behind every broadcast we do not hint ourselves), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files of earlier rounds once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with tessera's defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized so that a partition stays well under
    executor memory (roughly input bytes / 128 MB for the widest shuffle).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is always honoured.  Only when it is unset *and* Spark runs in local mode
    (tests, laptops) do we create a scratch folder of our own.  On a cluster
    without the setting we refuse, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative tessera operators need a "
            "shared checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()

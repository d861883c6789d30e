"""Spark session helpers: session defaults, the shared checkpoint folder and
size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Largest dimension we are willing to ship to every executor.
BROADCAST_MAX_ROWS = 1_000_000


def build_session(
    master: str = "local[8]",
    app_name: str = "ledgerscope",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session
    the platform hands out and call :func:`checkpoint_dir` on it."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session. Only a local-mode session without that setting (tests)
    gets a private folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss"
        )
    local = tempfile.mkdtemp(prefix="ledgerscope-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder next to the checkpoints, for tables a job writes and reads
    back (lineage cuts, materialized layers)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the shared folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` only after counting that it has at most
    ``max_rows`` rows; otherwise leave the choice (shuffle join, or AQE's
    own size-based switch) to Spark. Meant for dimensions that are cheap
    to count (written or checkpointed tables, literal lookups). A frame
    already measured by :func:`measured` is not counted again."""
    n = getattr(df, "_ls_rows", None)
    if n is None:
        n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def measured(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Count a small, materialized frame once and remember the bound."""
    df._ls_rows = df.limit(max_rows + 1).count()  # noqa: SLF001 - our own tag
    return df

"""Session helpers: configuration, table loading, shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; all are plain Spark SQL configs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts are decided on measured sizes only: the static planner's
    # estimates for exploded / aggregated text data are guesses (it once chose
    # to broadcast per-document word counts), so static auto-broadcast is off
    # and AQE turns a sort-merge join into a broadcast join only when the
    # materialised side is below the adaptive threshold. Explicit broadcast()
    # hints remain for sides with a proven bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quire",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` is only set when given, so on a cluster the launcher's master
    wins. Shuffle partitions default to 2x the local cores for local masters
    and are left to the cluster's setting otherwise (AQE coalesces them).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[len("local["):-1] if "[" in master else "1"
        n = (os.cpu_count() or 8) if cores in ("*", "") else int(cores)
        shuffle_partitions = max(2 * n, 8)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster ``spark.checkpoint.dir`` must name a folder that every machine
    sees; it is used as is. A scratch folder of this machine is only made for a
    local master (tests), where driver and executors are one process; any other
    master without the setting is an error, because executors could not read
    back each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set (master {master}); name a shared folder")
        d = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder, used by no other call or run."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``documents``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

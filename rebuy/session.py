"""Session helpers.

Library code never creates a session; jobs, tests and the bench do. The
folder for checkpoints and stage tables is the one the cluster names: the
directory set on the context, else ``spark.checkpoint.dir``. Only a local
master, whose tasks share one machine, may fall back to a temporary folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
}

_LOCAL_FALLBACK: str | None = None


def local_session(cores: int | str = "*", app: str = "rebuy", **conf: str) -> SparkSession:
    """A local-mode session for tests and the bench (not used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_single_machine(master: str) -> bool:
    """``local`` and ``local[...]`` run every task in this process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    In this order: the directory already set on the context (Spark appends a
    folder of its own to it), ``spark.checkpoint.dir``, and, on a local master
    only, a fresh temporary folder. On any other master an unset directory is
    an error, because executors could not see each other's stage files.
    """
    global _LOCAL_FALLBACK
    named = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context here
        if not named:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return named
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not is_single_machine(sc.master):
        raise RuntimeError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_FALLBACK is None:
        _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="rebuy-ckpt-")
    sc.setCheckpointDir(_LOCAL_FALLBACK)
    return _LOCAL_FALLBACK


def application_id(spark: SparkSession) -> str:
    """The running application's id (also without a local SparkContext)."""
    app = spark.conf.get("spark.app.id", None)
    if app:
        return app
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return "app"

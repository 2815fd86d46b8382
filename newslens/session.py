"""SparkSession helpers.

Library code never creates a session on its own; callers pass one in.  These
helpers exist for tests, the bench and command-line use.  Cluster deployments
keep their own settings: ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the session and only falls back to a fresh local folder when it is unset
(local test runs).
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness or scale.  ANSI stays on (Spark 4
# default); every expression in the library is written to be ANSI-safe.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "newslens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("NEWSLENS_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) when the
    cluster names one; otherwise, as in local tests, creates a fresh folder and
    registers it on the session so later calls agree.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        # Unset only in local runs and tests: a fresh folder per session.
        configured = tempfile.mkdtemp(prefix="newslens-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path under the checkpoint folder for one written table."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Let the driver give back what finished jobs have left: plans, broadcasts, shuffles.

    Spark drops a job's shuffle files and broadcasts once the driver's JVM has found its
    plan to be garbage, and the JVM looks for garbage only when its heap is full.  A job
    of many steps would so hold the whole heap, and all its shuffle files, whatever is
    still in use.  Takes a fraction of a second; call it between steps, not in them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def below_checkpoints(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` lies in the folder for checkpoints, which all nodes share."""
    sc = spark.sparkContext

    def qualified(folder: str) -> str:
        at = sc._jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(at).toString()

    folders = (sc.getCheckpointDir(), sc.getConf().get("spark.checkpoint.dir", None),
               spark.conf.get("spark.checkpoint.dir", None))
    return any(qualified(path).startswith(qualified(f).rstrip("/") + "/") for f in folders if f)

"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "pricelens") -> SparkSession:
    """A session tuned for this library: AQE on, UI off, UTC, Arrow for small pulls.

    On a cluster pass ``master=None`` and let spark-submit decide; shuffle partitions
    should then be sized so one partition is ~128-256 MB of shuffle data.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PRICELENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def reach_package(spark: SparkSession) -> None:
    """Let Python workers that are started from now on import this package from where the
    driver has it, as with PYTHONPATH; where it is installed, this changes nothing."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests) is a private folder
    created, and removed when the process ends; a cluster without the setting is an error.
    """
    reach_package(spark)
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to storage that all executors share")
    local = tempfile.mkdtemp(prefix="pricelens-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def checkpointed(df):
    """Reliable checkpoint of ``df`` into the shared checkpoint folder (the folder is
    taken from ``spark.checkpoint.dir``; a private one is made only when that is unset)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

"""Spark session construction and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every flowlake job relies on. Time zone is pinned so DATE(ts)
# and day arithmetic never depend on the machine running the driver.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "flowlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with flowlake's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """This package's folder in the cluster's shared checkpoint folder.

    It comes from ``spark.checkpoint.dir`` (or a checkpoint dir set on
    the context) and keeps its scheme. Only a ``local[...]`` master may go
    without one: driver and tasks then share the machine, and a private
    temporary folder is registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="flowlake-ckpt-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/flowlake"


def workspace_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{name or 'work'}/{uuid.uuid4().hex}"

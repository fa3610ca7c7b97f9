"""Session construction and shared scratch locations.

Every job here is a plain DataFrame program; the session only sets the knobs
that matter for it: adaptive execution (runtime partition coalescing, skew-join
splitting, runtime broadcast conversion), a UTC session clock, and no UI.

Scratch data (round-trip fixtures, staged outputs, lineage cuts) always lives
under the cluster's shared checkpoint folder (``spark.checkpoint.dir``). Only
when the session has none, as in local tests, do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "terrace",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide scratch folder: ``spark.checkpoint.dir`` if the
    session names one, otherwise the context's checkpoint dir; if neither is
    set (local runs and tests) a fresh local folder is created and registered
    as the checkpoint dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="terrace-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared root (not created here;
    the first Spark write creates it)."""
    return f"{shared_root(spark)}/terrace/{name}-{uuid.uuid4().hex[:12]}"

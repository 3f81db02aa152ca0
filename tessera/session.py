"""Spark session and shared working locations.

Everything that must outlive a task (lineage cuts, intermediate tables,
stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. We only set our own value when the session has
none, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Session settings we rely on for correct results (not tuning).
REQUIRED_CONF = {
    # Parquet timestamps here are NTZ; watermarks and unix_timestamp need a
    # fixed zone so results do not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
}

# Used only where a session is built on a local master and the key is not set.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "tessera", **conf: str) -> SparkSession:
    """Return the active session, or build one. What spark-submit or
    spark-defaults set is never overridden; a master and the local defaults are
    only filled in where none is configured."""
    active = SparkSession.getActiveSession()
    if active is None:
        given = SparkConf()
        builder = SparkSession.builder.appName(app)
        if master or not given.contains("spark.master"):
            builder = builder.master(master or os.environ.get("TESSERA_MASTER", "local[8]"))
        if (master or given.get("spark.master", "local")).startswith("local"):
            for k, v in LOCAL_CONF.items():
                if not given.contains(k):
                    builder = builder.config(k, v)
        for k, v in {**REQUIRED_CONF, **conf}.items():
            builder = builder.config(k, v)
        active = builder.getOrCreate()
    else:
        for k, v in conf.items():
            active.conf.set(k, v)
    return configure(active)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job outputs.

    Reads ``spark.checkpoint.dir`` from the session. Only on a local master, when
    it is unset (tests), do we choose a folder ourselves and register it, so that
    ``df.checkpoint()`` works; on a cluster a local folder would be a different
    one on each machine, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for one job run."""
    return f"{shared_root(spark)}/work/{name}/{uuid.uuid4().hex}"

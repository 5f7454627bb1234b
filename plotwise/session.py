"""Session construction and the shared scratch location.

Scratch data (checkpoints, stage tables written by sink operators, iterative
job state) always lives under the cluster's ``spark.checkpoint.dir`` so it
survives the loss of an executor. Only when that setting is absent (local
tests) do we pick a private directory ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "plotwise", extra: dict | None = None) -> SparkSession:
    """Local/test session with AQE on; a cluster passes its own builder."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # a machine-local folder would lose data with its machine: fine for one process, an error on a cluster
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="plotwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path that stays the same from session to session, in the folder that spark.checkpoint.dir
    names (without it, this session's own folder): what is written there outlives a lost run."""
    own = ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return os.path.join(configured or own, "plotwise", name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "plotwise", f"{name}-{uuid.uuid4().hex[:12]}")

"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# SQL settings the jobs are designed for. Timestamps in the inputs are zone-less, so
# the session zone is pinned to UTC and date_trunc results are cast back to NTZ.
# Each one is applied only when the cluster (spark-defaults / spark-submit) has not
# set the key itself.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast conversion: only when the shuffled side really is small.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Context settings for sessions this module creates (no web UI).
CORE_DEFAULTS = {"spark.ui.enabled": "false"}


def build_session(master: str | None = None, app: str = "tessera", conf: dict | None = None) -> SparkSession:
    """Return a session with the job defaults.

    Explicit ``conf`` entries always apply; the defaults above fill only keys the
    cluster configuration leaves unset, so cluster settings win over them.
    """
    conf = dict(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**CORE_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for k, v in SQL_DEFAULTS.items():
        if k not in conf and not cluster.contains(k):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local session, whose executor is the
    driver, gets a folder of its own when it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = os.path.join(os.environ.get("TMPDIR", "/tmp"), "tessera-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the shared checkpoint folder (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tessera/{purpose}-{uuid.uuid4().hex}"

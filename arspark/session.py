"""SparkSession construction and session-level settings."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults applied only where the cluster has not set a value already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Partitions that shuffles start with, before AQE puts small ones together.
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Shuffle files go when the query that wrote them ends, not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries that run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "arspark", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use the cluster's builder and call
    :func:`ensure_checkpoint_dir` instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "8g")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's value always wins; a scratch folder is created only when the
    setting is absent and the master is local (tests). Elsewhere a machine-local
    folder would be lost with its machine, so a missing setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="arspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder (never machine-local
    on a cluster, because ``spark.checkpoint.dir`` points to shared storage)."""
    return os.path.join(ensure_checkpoint_dir(spark), name)

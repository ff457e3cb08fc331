"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Shuffle partition counts are left to
# the cluster: adaptive execution coalesces small partitions and splits big ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "branchlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def _checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it then gets one fresh
    temporary folder per application.
    """
    base = _checkpoint_dir(spark)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="branchlens-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/branchlens/{name}-{uuid.uuid4().hex}"

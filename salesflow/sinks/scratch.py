"""A fresh shared folder for intermediate output."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local session without one gets a temporary folder."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="salesflow-"))
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that nobody used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

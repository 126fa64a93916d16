"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tierflow", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution and UTC; `master` only for local runs and tests."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Wide projections make many column calls; skip the call-site lookup of each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only a local-mode session may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tierflow-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_root(spark)}/tierflow/{name}-{uuid.uuid4().hex}"


def join_path(root: str, *parts: str) -> str:
    """Join path pieces of a local or remote (scheme://) location."""
    tail = [p.strip("/") for p in parts if p.strip("/")]
    return "/".join([root.rstrip("/"), *tail])


def local_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))

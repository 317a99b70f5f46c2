"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times, adaptive execution and skew-join splitting on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would not survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="tradewind-")
    return _fallback[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tradewind/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"

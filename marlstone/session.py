"""Session factory: UTC, ANSI, adaptive execution; everything else is left to the deployment."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "marlstone", master: str | None = None, **conf: str) -> SparkSession:
    """The session. The process time zone is set before the JVM starts, so that both sides mean UTC."""
    os.environ.setdefault("TZ", "UTC")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

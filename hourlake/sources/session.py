"""Spark sessions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_session(name: str = "hourlake", master: str | None = None, **options: str) -> SparkSession:
    """A session in UTC. Nothing here depends on ANSI mode being off; adaptive execution stays on."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}
    for key, value in (fixed | options).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

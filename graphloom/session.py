"""Session defaults for the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "graphloom", **settings: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; ``settings`` override, underscores standing for dots."""
    b = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for k, v in (defaults | {k.replace("_", "."): v for k, v in settings.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()

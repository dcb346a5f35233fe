"""Session defaults: UTC, adaptive execution, ANSI on; shuffle partitions follow the cores."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "gatecount", cores: int | None = None, **conf: str) -> SparkSession:
    """A session; ``cores`` runs locally, without it the cluster's own master is used."""
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(2 * cores)).config("spark.ui.enabled", "false")
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

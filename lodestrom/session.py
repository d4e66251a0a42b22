"""Session factory. Every setting an operator relies on is set here and nowhere else."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "lodestrom", master: str | None = None, cores: int = 8, **extra: str) -> SparkSession:
    """A session with UTC instants, ANSI arithmetic and adaptive execution.

    ``cores`` sizes the shuffles of a local run; on a cluster leave ``master`` unset and pass
    ``spark.sql.shuffle.partitions`` through ``extra`` (AQE coalesces what is too many).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "furrow", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with adaptive execution on.

    The number of shuffle partitions is left to adaptive execution: it starts from the cluster's setting, merges small
    partitions and splits skewed ones. ``conf`` takes further settings, with ``__`` for the dots.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

"""A SparkSession with the settings these jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE sizes the reduce side, splits skewed join partitions and turns a
    # join into a broadcast only when the measured size is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(app_name: str = "cohortlink", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session; ``extra`` maps ``spark_sql_x``-style names to values.

    ``spark.checkpoint.dir`` is left to the cluster: set it there to a shared
    folder, see ``plans.stages``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()

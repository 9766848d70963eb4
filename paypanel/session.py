"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # dates and month arithmetic must not depend on the machine
    "spark.sql.session.timeZone": "UTC",
    # rewrite only the periods present in the written frame
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # runtime re-planning: join strategy from measured sizes, skew splits
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a side measured below this size at run time is broadcast, above it is not
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "paypanel", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings above; ``conf`` overrides use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

"""Session defaults. On a cluster, pass no master and let spark-submit supply it."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Trip times carry no zone, so the session zone must not shift them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def open_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build or reuse a session; ``conf`` keys use ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

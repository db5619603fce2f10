"""Session defaults shared by tests, bench and jobs that start their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "weirflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Time zone UTC keeps zoned timestamps stable.  Adaptive execution picks the
    partition count, turns joins into broadcasts once a side's real size is
    known and splits skewed join partitions.  The join rules never hint a
    broadcast: ``autoBroadcastJoinThreshold`` is the size check.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # a call site per Column call costs more than planning a wide report
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

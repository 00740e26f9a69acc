"""Session settings the operators were measured with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8,000 bytes of code. A rule list fused into one
    # method exceeds that and would be interpreted; above the limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Long expressions are built from many small columns; recording the call site of each
    # costs more than building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app_name: str = "padron", **settings: str) -> SparkSession.Builder:
    out = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        out = out.config(key, value)
    return out


def apply(spark: SparkSession) -> SparkSession:
    """Give a running session those of the settings it can still change."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark

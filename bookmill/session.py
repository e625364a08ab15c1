"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Defaults that hold where the caller sets nothing: adaptive plans, skewed joins split, last key wins in maps.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "bookmill", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=CONF | conf).getOrCreate()

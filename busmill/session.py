"""The Spark session that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(name: str = "busmill", **more: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | more).getOrCreate()

"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, app: str = "lodestrata", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster the master and sizes come from spark-submit."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    b = b.master(master) if master else b
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()

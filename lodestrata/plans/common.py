"""Registering queries with their SQL."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        """Register a function (t, spark) -> DataFrame, where t(name) reads a table, under its own name."""

        def add(f):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

            run.__name__, run.__doc__ = f.__name__, f.__doc__
            self.queries[f.__name__] = run
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder's path for a query that writes: below the shared folder of the session, which only local mode may lack."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that the executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lodestrata-")
    return f"{at.rstrip('/')}/plans/{name}-{uuid.uuid4().hex}"

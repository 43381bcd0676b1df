"""Shared scratch tables: where lineage is cut, and where twice-used intermediates live.

Every table goes below the folder named in ``spark.checkpoint.dir``, which all
executors and the driver share, so a lost executor costs a re-read and never
the data. Only where that setting is absent (tests, notebooks in local mode)
a temporary folder is made and the setting is filled in; on a cluster its absence
is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
#: Rows of a call's table for which a stage that follows a shuffle gets a task of its own.
TASK_ROWS = 8192


def folder(spark: SparkSession) -> str:
    """The shared folder of this session."""
    at = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"{KEY} names no folder that the executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lodestrata-")
        spark.conf.set(KEY, at)
    return at.rstrip("/")


class Scratch:
    """The scratch tables of one operator call, in a folder of their own.

    An operator returns a plan that reads them, so it can't delete them itself:
    ``close`` them, or all that were made since a ``mark``, once what the plan
    gives has been written.
    """

    _made: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{folder(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self.tasks = 0
        Scratch._made.append(self)

    @staticmethod
    def mark() -> int:
        return len(Scratch._made)

    @staticmethod
    def close_since(mark: int) -> None:
        while len(Scratch._made) > mark:
            Scratch._made[-1].close()

    def close(self) -> None:
        """Delete all tables of this call."""
        self._delete(self.root)
        if self in Scratch._made:
            Scratch._made.remove(self)

    def _delete(self, path: str) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def sized(self, rows: int) -> None:
        """From now on what is put and ``near`` has a task for each ``TASK_ROWS`` of ``rows``, two a core at least, and never more than it has anyway.

        A session's number of shuffle partitions fits its largest table; on small
        ones most of a stage's time would go into starting its tasks.
        """
        self.tasks = max(2 * self.spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))

    def near(self, df: DataFrame) -> DataFrame:
        """The rows of a shuffle in as many tasks as ``sized`` says: whole partitions are joined, none is moved."""
        return df.coalesce(self.tasks) if self.tasks else df

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: no lineage, no kept partitioning.

        Reading back also lets adaptive execution put its own exchange under a
        later join, which it can then split where a key is hot.
        """
        self._n += 1
        at = f"{self.root}/{self._n:03d}-{name}"
        self.near(df).write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._scratch = at
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for df in frames:
            self._delete(df._scratch)

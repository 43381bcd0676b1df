"""Windows, deduplication and upserts that run on streams and on tables alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _late(df: DataFrame, at: str, delay: str) -> DataFrame:
    return df.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay) if df.isStreaming else df


def tumbling(df: DataFrame, width: str, at: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total) by window; late rows beyond ``delay`` drop out of a stream."""
    by = _late(df, at, delay).groupBy(F.window(at, width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return by.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(df: DataFrame, width: str, slide: str, at: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """(start, event_type, n) by overlapping windows."""
    by = _late(df, at, delay).groupBy(F.window(at, width, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return by.select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(df: DataFrame, gap: str, key: str = "user_id", at: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """(key, start, last, n) of runs without a pause of ``gap``."""
    by = _late(df, at, delay).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.max(at).alias("last"), F.count("*").alias("n"))
    return by.select(key, F.col("w.start").alias("start"), "last", "n")


def firsts(df: DataFrame) -> DataFrame:
    """(user_id, event_type, first_event, n)."""
    return df.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"))


def deduplicated(df: DataFrame, keys: list[str], at: str = "ts", delay: str = "1 hour") -> DataFrame:
    """One row for each key within the watermark; over a table, one for each key."""
    return _late(df, at, delay).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def latest(df: DataFrame) -> DataFrame:
    """(id, seq, event_type, value): the last event of each user."""
    return df.groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("seq"), F.max_by("event_type", "event_id").alias("event_type"), F.max_by("value", "event_id").alias("value"))


def failure_states(df: DataFrame, threshold: int = 3) -> DataFrame:
    """W07 on a stream: (user_id, event_id, failures, state) in order of event_id within a batch; df(user_id, event_id, failed)."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, seen = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values("event_id")
        out = []
        for event, failed in zip(rows["event_id"].tolist(), rows["failed"].tolist(), strict=True):
            before = n
            n = n + 1 if failed else 0
            if not failed:
                name = "recovered" if before >= threshold else "healthy"
            elif not seen:
                name = "first_failure"
            else:
                name = "still_failing" if before >= threshold else "newly_failing" if n >= threshold else "first_failure"
            seen = 1
            out.append((key[0], event, n, name))
        state.update((n, seen))
        yield pd.DataFrame(out, columns=["user_id", "event_id", "failures", "state"])

    return df.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_id long, failures int, state string", "n int, seen int", "append", "NoTimeout")


def upsert_available(spark: SparkSession, incoming: str, schema, target: str, checkpoint: str, key: str, seq: str) -> int:
    """All files that have come since the checkpoint, merged into ``target`` (the greatest ``seq`` of a key stays); returns the batches run.

    A batch is written as its own version beside the target, and the pointer
    moves last, so that a batch that is run again after a failure gives the same.
    """
    from ..sources.sink import put_once, read_text, swap_pointer

    def merge(batch: DataFrame, epoch: int) -> None:
        at = read_text(spark, f"{target}/_latest")
        if at is not None and int(at) >= epoch:
            return
        rows = batch if at is None else batch.unionByName(spark.read.parquet(f"{target}/v{at}"))
        cols = [c for c in rows.columns if c != key]
        best = rows.groupBy(key).agg(F.max_by(F.struct(*cols), seq).alias("r")).select(key, "r.*").select(*rows.columns)
        best.write.mode("overwrite").parquet(f"{target}/v{epoch}")
        if at is None:
            put_once(spark, f"{target}/_latest", str(epoch))
        elif not swap_pointer(spark, f"{target}/_latest", at, str(epoch)):
            raise RuntimeError("another writer moved the pointer")

    q = spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(q.recentProgress)

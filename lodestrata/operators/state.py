"""State between runs: cursors, stamps, decisions. Small values decide on the driver; tables stay tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cursor_decision(records: int, now: str | None, then: str | None, has_updates: bool = True) -> tuple[str, str | None]:
    """(kind, token): a cursor moves only on records; updates without records are an anomaly, and hold it."""
    if not has_updates:
        return "no_updates_hold", now
    if records == 0:
        return "anomaly_zero_fetch_hold", now
    return "advance", then


def merge_decision(pointer: dict | None, run_id: str, first_run_done: bool, previous_filled: bool) -> str:
    """What a cumulative merge has to do."""
    if not pointer:
        return "sentinel_present_pointer_missing" if first_run_done else "first_run_skip"
    if not pointer.get("run_id"):
        return "pointer_missing_run_id"
    if pointer["run_id"] == run_id:
        return "same_run_skip"
    return "merge" if previous_filled else "empty_buffer_abort"


def failure_runs(df: DataFrame, entity: str, order: str, failed: str, threshold: int = 3) -> DataFrame:
    """Each event's ``state`` by the run of failures that it stands in: healthy, first_failure, newly_failing, still_failing or recovered.

    Gaps and islands: the number of passes so far names the island, and the
    place in it is the run's length.
    """
    w = Window.partitionBy(entity).orderBy(order)
    island = df.withColumn("_i", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w))
    n = F.count_if(F.col(failed)).over(Window.partitionBy(entity, "_i").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    got = island.withColumn("consecutive_failures", F.when(F.col(failed), n).otherwise(0))
    before = F.coalesce(F.lag("consecutive_failures").over(w), F.lit(0))
    state = (
        F.when(~F.col(failed), F.when(before >= threshold, "recovered").otherwise("healthy"))
        .when(F.lag(order).over(w).isNull(), "first_failure")
        .when(before >= threshold, "still_failing")
        .when(F.col("consecutive_failures") >= threshold, "newly_failing")
        .otherwise("first_failure")
    )
    return got.withColumn("state", state).drop("_i")


@dataclass
class Drained:
    chunks: int
    processed: int
    stop_reason: str


def drain(backlog: int, step: Callable[[int], float], chunk: int, budget_ms: float, cold_ms: float, most: int | None = None, alpha: float = 0.7, premium: float = 1.3, cold_pad: float = 1.1) -> Drained:
    """Chunks while the next one, projected from a moving mean, fits in the budget. ``step`` takes a chunk's size and returns its milliseconds."""
    if chunk <= 0 or budget_ms <= 0 or cold_ms <= 0 or most is not None and most < 0:
        raise ValueError("drain: bad parameters")
    chunks, done, spent, mean = 0, 0, 0.0, 0.0
    while True:
        if done >= backlog:
            return Drained(chunks, done, "backlog_exhausted")
        if most is not None and done >= most:
            return Drained(chunks, done, "record_cap")
        if spent + (mean * premium if chunks else cold_ms * cold_pad) > budget_ms:
            return Drained(chunks, done, "time_budget")
        n = min(chunk, backlog - done, most - done if most is not None else chunk)
        took = step(n)
        mean = took if mean == 0 else mean * (1 - alpha) + took * alpha
        chunks, done, spent = chunks + 1, done + n, spent + took


def due(df: DataFrame, stamps: DataFrame, key: str, now, days: float) -> DataFrame:
    """Rows without a fresh stamp; stamps(key, stamp timestamp)."""
    latest = stamps.groupBy(F.col(key).alias("_k")).agg(F.max("stamp").alias("_s"))
    out = df.join(latest, df[key] == latest["_k"], "left")
    fresh = (F.unix_micros(now) - F.unix_micros("_s")) / 86_400_000_000.0 < days
    return out.where(~F.coalesce(fresh, F.lit(False))).drop("_k", "_s")


def frozen(before: str | None, after: str | None, eligible: int, processed: int) -> bool:
    """A stage with work to do whose cursor and count didn't move."""
    return eligible > 0 and processed == 0 and before == after


def to_enrich(df: DataFrame, version: str, current: int, attempts: str, most: int = 3) -> DataFrame:
    """Rows of an older version that haven't failed ``most`` times."""
    return df.where((F.coalesce(version, F.lit(0)) < current) & (F.coalesce(attempts, F.lit(0)) < most))


def without_misses(df: DataFrame, misses: DataFrame, key: str) -> DataFrame:
    """Rows that aren't known to have no answer."""
    return df.join(misses.select(key).distinct(), key, "left_anti")


def prunable(snapshots: list[str], active: str, keep: int) -> list[str]:
    """All but the ``keep`` newest and the active one."""
    newest = set(sorted(snapshots, reverse=True)[:keep])
    return sorted(s for s in snapshots if s not in newest and s != active)


class Breaker:
    """Open for good after ``most`` failures in a row."""

    def __init__(self, most: int = 3):
        self.most, self.run, self.open = most, 0, False

    def record(self, ok: bool) -> bool:
        self.run = 0 if ok else self.run + 1
        self.open |= self.run >= self.most
        return self.open


class TokenBucket:
    """``rate`` tokens a second, at most ``burst`` saved; ``wait`` says how long a taker has to."""

    def __init__(self, rate: float, burst: int = 1):
        self.rate, self.burst, self.tokens, self.at = rate, burst, float(burst), 0.0

    def wait(self, now: float) -> float:
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at, self.tokens = now, self.tokens - 1
        return max(0.0, -self.tokens / self.rate)


CHUNK = 5000


def next_cursors(before: DataFrame, runs: DataFrame, now, chunk: int | None = None) -> DataFrame:
    """Each source's cursor after a run: where it goes on, how many cycles are complete, what the run did.

    before(source, cursor_id, chunk_size, cycles_completed), runs(source,
    next_cursor_id, wrapped, processed, eligible). A chunk size that isn't given
    stays as it was. Sources without a run keep their cursor.
    """
    old = before.select("source", F.col("cursor_id").alias("_c"), F.col("chunk_size").alias("_s"), F.col("cycles_completed").alias("_n"))
    j = old.join(runs, "source", "full_outer")
    ran = F.col("processed").isNotNull()
    return j.select(
        "source", F.when(ran, F.col("next_cursor_id")).otherwise(F.col("_c")).alias("cursor_id"), F.coalesce(F.lit(chunk).cast("int"), "_s", F.lit(CHUNK)).alias("chunk_size") if chunk else F.coalesce("_s", F.lit(CHUNK)).alias("chunk_size"),
        F.coalesce("processed", F.lit(0)).alias("processed_in_run"), (F.coalesce("_n", F.lit(0)) + F.when(F.col("wrapped"), 1).otherwise(0)).alias("cycles_completed"), F.when(ran, now).alias("last_run"), F.col("eligible").alias("total_eligible_at_last_run"),
    )


def snapshot_id(date: str, run_id: str, attempt: str = "1") -> str:
    """A snapshot's id, its own for each attempt of a run."""
    return f"{date}/{run_id}-{attempt if attempt.isdigit() else '1'}"


def object_prefix(snapshot: str) -> str:
    """Where a snapshot's files are; ends with a slash."""
    return f"snapshots/{snapshot}/"


def shard_key(prefix: Column, family: str, bucket: Column, shard: Column) -> Column:
    """The key of a shard; of a bucket's manifest where ``shard`` is null."""
    at = F.concat(prefix, F.lit(f"{family}/bucket-"), F.lpad(bucket.cast("string"), 4, "0"))
    return F.coalesce(F.concat(at, F.lit("/shard-"), F.lpad(shard.cast("string"), 3, "0"), F.lit(".bin")), F.concat(at, F.lit("/manifest.json")))


def sealed(manifest: DataFrame, required: list[str]) -> str:
    """X11: the seal of a candidate: a hash over its tables, rows and bytes in order. A required table that is missing or empty raises."""
    rows = {r["table"]: (r["records"], r["bytes"]) for r in manifest.select("table", "records", "bytes").collect()}
    if bad := sorted(t for t in required if not rows.get(t, (0, 0))[0]):
        raise ValueError(f"required tables missing or empty: {bad}")
    return hashlib.sha256(json.dumps(sorted((t, *v) for t, v in rows.items())).encode()).hexdigest()


def validate(manifest: DataFrame, seal: str, required: list[str]) -> None:
    """X11: raises unless the tables as they are now give the seal."""
    if sealed(manifest, required) != seal:
        raise ValueError("the candidate isn't what was sealed")

"""Stable ids: classify against a crosswalk, number what is new, append to the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ident import sid


def classify(df: DataFrame, space: str, kind: str, anchor: Column, crosswalk: DataFrame, fallback: Column | None = None) -> DataFrame:
    """With sid_s and ``stamp``: already, cross_pollinated (known by the fallback anchor), unstamped, or unstampable.

    anchor: struct(payload, version) or null. crosswalk(sid_s, sid_c).
    """
    make = lambda a: F.when(a["payload"].isNotNull(), sid(space, kind, a["version"], a["payload"]))
    own = df.withColumn("sid_s", make(anchor)).withColumn("_alt", make(fallback) if fallback is not None else F.lit(None).cast("string"))
    known = crosswalk.groupBy("sid_s").agg(F.min("sid_c").alias("_c"))
    j = own.join(known, "sid_s", "left").join(known.select(F.col("sid_s").alias("_a"), F.col("_c").alias("_ac")), F.col("_alt") == F.col("_a"), "left")
    stamp = F.when(F.col("_c").isNotNull(), "already").when(F.col("sid_s").isNotNull() & F.col("_ac").isNotNull(), "cross_pollinated").when(F.col("sid_s").isNull(), "unstampable").otherwise("unstamped")
    return j.withColumn("stamp", stamp).withColumn("sid_c", F.coalesce("_c", F.when(F.col("stamp") == "cross_pollinated", F.col("_ac")))).drop("_alt", "_c", "_a", "_ac")


def number(new: DataFrame, order: str, start: int, space: str, kind: str, parts: int = 64) -> DataFrame:
    """Counters from ``start`` without a gap, in the order of a unique column.

    Rows are range-partitioned and numbered within partitions; the partitions'
    sizes give their starts, so that no task sees all rows. Spark samples the
    ranges anew each time a plan is run, so the ranges whose rows were counted
    are read once, here, and rows are dealt by them and not by a second sample.
    """
    dealt = new.select(order).repartitionByRange(parts, order).withColumn("_p", F.spark_partition_id())
    # One row for each partition; a null stands before all others, in the first.
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"), F.min(order).alias("_lo")).orderBy("_p").collect()
    lows = [F.lit(r["_lo"]).cast(new.schema[order].dataType) for r in sizes[1:]]
    starts = [start + sum(r["_n"] for r in sizes[:i]) for i in range(max(len(sizes), 1))]
    part = F.size(F.filter(F.array(*lows), lambda x: x <= F.col(order))) if lows else F.lit(0)
    out = new.withColumn("_p", part).withColumn("_at", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), F.col("_p") + 1)
    return out.withColumn("counter_value", F.col("_at") - 1 + first).withColumn("sid_c", sid(space, kind, F.col("counter_value"))).drop("_p", "_at")


def ledger_entries(numbered: DataFrame, kind: str, version: str, payload: str, at: Column) -> DataFrame:
    """Crosswalk rows of newly numbered ones, with their shard."""
    return numbered.select("sid_s", "sid_c", F.lit(kind).alias("entity_class"), F.lit(version).alias("canonicalization_version"), F.col(payload).cast("string").alias("canonical_identity_payload"), "counter_value", at.alias("issuance_at"), F.substring("sid_s", 1, 2).alias("shard"))


def append(crosswalk: DataFrame, entries: DataFrame) -> DataFrame:
    """The crosswalk with entries whose sid_s it doesn't have."""
    return crosswalk.unionByName(entries.join(crosswalk.select("sid_s"), "sid_s", "left_anti").select(*crosswalk.columns))

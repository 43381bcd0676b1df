"""Merges of a current table over a previous one, and of deltas over a base.

A column can't be absent from one row only, so absent and null are the same
here, and a null never overwrites: values are filled, not replaced, unless an
operator says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import ranked_by


def cumulative(prev: DataFrame, cur: DataFrame, key: str) -> DataFrame:
    """Current rows replace previous ones of equal key; ``origin`` says kept, replaced or from_current.

    Keys are unique in each table. Rows of a null key have nothing to merge
    with: they are all kept, with origin no_key (G12).
    """
    names = prev.columns
    p, c = prev.where(F.col(key).isNotNull()), cur.where(F.col(key).isNotNull())
    p, c = (d.select(F.col(key).alias(f"{side}k"), F.struct(*names).alias(side)) for d, side in ((p, "p"), (c, "c")))
    j = p.join(c, p["pk"] == c["ck"], "full_outer")
    origin = F.when(F.col("ck").isNull(), "kept").when(F.col("pk").isNull(), "from_current").otherwise("replaced")
    merged = j.select(*[F.when(F.col("ck").isNotNull(), F.col(f"c.{n}")).otherwise(F.col(f"p.{n}")).alias(n) for n in names], origin.alias("origin"))
    loose = prev.where(F.col(key).isNull()).unionByName(cur.select(*names).where(F.col(key).isNull())).withColumn("origin", F.lit("no_key"))
    return merged.unionByName(loose)


def filled(cur: Column, prev: Column, kind: T.DataType) -> Column:
    """Current unless it is null, an empty string or an empty list; struct by field."""
    if isinstance(kind, T.StructType):
        both = F.struct(*[filled(cur[f.name], prev[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(cur.isNull(), prev).when(prev.isNull(), cur).otherwise(both)
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(cur) > 0, cur).otherwise(F.coalesce(prev, cur))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.nullif(cur, F.lit("")), prev, cur)
    return F.coalesce(cur, prev)


def union_first_seen(*arrays: Column, kind: str = "string") -> Column:
    """Distinct items in order of first appearance; a null list is empty."""
    return F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast(f"array<{kind}>")) for a in arrays]))


def union_by(prev: Column, cur: Column, name: str) -> Column:
    """Existing items, then only those whose ``name`` isn't among them."""
    known = F.transform(prev, lambda x: x[name])
    return F.when(prev.isNull(), cur).when(cur.isNull(), prev).otherwise(F.concat(prev, F.filter(cur, lambda x: ~F.array_contains(known, x[name]))))


def deep(prev: DataFrame, cur: DataFrame, key: str, unions: tuple[str, ...] = ()) -> DataFrame:
    """Field by field, current where it has something; list columns in ``unions`` are united."""
    kinds = {f.name: f.dataType for f in prev.schema.fields}
    p, c = prev.alias("p"), cur.alias("c")
    j = p.join(c, F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    one = lambda n: union_first_seen(F.col(f"p.{n}"), F.col(f"c.{n}"), kind=kinds[n].elementType.simpleString()) if n in unions else filled(F.col(f"c.{n}"), F.col(f"p.{n}"), kinds[n])
    return j.select(*[(F.coalesce(f"c.{key}", f"p.{key}") if n == key else one(n)).alias(n) for n in prev.columns])


def fold_deltas(base: DataFrame, deltas: DataFrame, key: str, rank: str, unions: tuple[str, ...] = ()) -> DataFrame:
    """Each field's last value that isn't null, deltas in order of ``rank`` after the base. One shuffle for any number of deltas.

    List columns in ``unions`` (of provenance, say) are united in that order
    instead. Deltas of a null key are skipped; base rows of a null key have
    nothing to merge with, and are all kept (G12).
    """
    names = [n for n in base.columns if n != key]
    keyed = F.col(key).isNotNull()
    both = base.where(keyed).withColumn(rank, F.lit(None).cast(deltas.schema[rank].dataType)).unionByName(deltas.where(keyed).select(*base.columns, rank))
    # Nulls first: the base stands before every delta.
    order = F.struct(F.col(rank).isNotNull().alias("d"), F.col(rank).alias("r"))

    def one(n: str) -> Column:
        if n not in unions:
            return F.max_by(n, F.when(F.col(n).isNotNull(), order)).alias(n)
        lists = F.array_sort(F.collect_list(F.when(F.col(n).isNotNull(), F.struct(order.alias("o"), F.col(n).alias("v")))))
        return F.array_distinct(F.flatten(F.transform(lists, lambda x: x["v"]))).alias(n)

    folded = both.groupBy(key).agg(*[one(n) for n in names]).select(*base.columns)
    return folded.unionByName(base.where(~keyed))


def shallow(prev: DataFrame, cur: DataFrame, key: str, given: str) -> DataFrame:
    """Current records over previous ones, field by field, where ``given`` lists the fields that the current record has: one that it has as null overwrites."""
    names = [n for n in prev.columns if n != key]
    j = prev.alias("p").join(cur.alias("c"), F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    has = lambda n: F.coalesce(F.array_contains(f"c.{given}", n), F.lit(False))
    return j.select(F.coalesce(f"c.{key}", f"p.{key}").alias(key), *[F.when(has(n), F.col(f"c.{n}")).otherwise(F.col(f"p.{n}")).alias(n) for n in names])


def retry_queue(queue: DataFrame, failures: DataFrame, successes: DataFrame, now: Column, most: int = 10) -> DataFrame:
    """What succeeded goes, what failed again counts up, new failures come in with 0, what has ``most`` retries goes.

    queue(id, first_failed_at, last_attempt_at, retries, last_error), failures(id, error), successes(id); ids unique in each.
    """
    open_ = queue.join(successes.select("id"), "id", "left_anti")
    f = failures.select(F.col("id").alias("fid"), F.substring("error", 1, 200).alias("error"))
    j = open_.join(f, open_["id"] == f["fid"], "full_outer")
    again, known = F.col("fid").isNotNull(), F.col("id").isNotNull()
    out = j.select(
        F.coalesce("id", "fid").alias("id"),
        F.coalesce("first_failed_at", now).alias("first_failed_at"),
        F.when(again, now).otherwise(F.col("last_attempt_at")).alias("last_attempt_at"),
        F.when(again & known, F.col("retries") + 1).when(again, 0).otherwise(F.col("retries")).alias("retries"),
        F.when(again, F.col("error")).otherwise(F.col("last_error")).alias("last_error"),
    )
    return out.where(F.col("retries") < most)


def stamps(*tables: DataFrame) -> DataFrame:
    """The latest stamp of each id."""
    return reduce(DataFrame.unionByName, tables).groupBy("id").agg(F.max("stamp").alias("stamp"))


def runs(tables: DataFrame, key: str, run: str) -> DataFrame:
    """Of many runs' rows the latest run's for each key; null keys are all kept."""
    keyed = ranked_by(tables.where(F.col(key).isNotNull()), [key], [F.col(run).desc()])
    return keyed.unionByName(tables.where(F.col(key).isNull()))


def link_key(a: Column, b: Column) -> Column:
    """A::b, null if either is missing."""
    return F.concat(F.nullif(a.cast("string"), F.lit("")), F.lit("::"), F.nullif(b.cast("string"), F.lit("")))


def bootstrap_flag(ids: Column, kind: T.StructType) -> Column:
    """unichem_matched set where a source list and an identifier say so; other fields as they are."""
    due = F.array_contains(ids["sources"], "unichem") & ids["unii"].isNotNull()
    return F.when(F.coalesce(due, F.lit(False)), ids.withField("unichem_matched", F.lit(True))).otherwise(ids)

"""One row for each key, by a stated policy and an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which has to be total. Plans with a WindowGroupLimit before the shuffle."""
    at = "_rank"
    while at in df.columns:
        at += "_"
    return df.withColumn(at, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(at) == 1).drop(at)


def first_by(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The first row of each key in the order of ``seq``."""
    return ranked_by(df, keys, [F.col(c).asc_nulls_first() for c in seq])


def last_by(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The last row of each key in the order of ``seq``."""
    return ranked_by(df, keys, [F.col(c).desc_nulls_last() for c in seq])


def min_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The least value of each key, and how many other values stood against it."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value), (F.count_distinct(value) - 1).alias("collisions"))


def preferred(df: DataFrame, keys: list[str], name: str, rank: Column, seq: str) -> DataFrame:
    """Each key's name of lowest rank (the first of equals) and its other distinct names in order."""
    best = F.min_by(name, F.struct(rank, F.col(seq)))
    names = F.array_sort(F.collect_set(name))
    return df.groupBy(*keys).agg(best.alias("preferred"), names.alias("_names")).withColumn("synonyms", F.array_remove("_names", F.col("preferred"))).drop("_names")

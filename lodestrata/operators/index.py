"""Indexes as normalised tables, and their physical layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ident import bucket
from ..functions.text import search_tokens
from .paging import pages


def inverted(df: DataFrame, id_col: str, text: Column, unique: bool = True) -> DataFrame:
    """(token, id), one row for each distinct token of a row's text; ``unique``: no id stands twice, so nothing has to be shuffled."""
    out = df.select(F.explode(search_tokens(text)).alias("token"), F.col(id_col).alias("id"))
    return out if unique else out.distinct()


def entries(df: DataFrame, id_col: str, names: Column, long_name: Column, extra: Column, width: int = 120) -> DataFrame:
    """(id, name, snippet): what a hit shows; the first name, else the long one, and a line of the formula and up to three other names."""
    first = F.nullif(F.get(names, 0), F.lit(""))
    others = F.when(F.size(names) > 1, F.concat(F.lit("aka: "), F.array_join(F.slice(names, 2, 3), ", ")))
    snippet = F.concat_ws(" \u2014 ", F.nullif(extra, F.lit("")), others)
    return df.select(F.col(id_col).alias("id"), F.substring(F.coalesce(first, F.nullif(long_name, F.lit(""))), 1, width).alias("name"), F.substring(snippet, 1, width).alias("snippet"))


def locators(df: DataFrame, key: str, kind, rows_per_shard: int) -> DataFrame:
    """(key, shard, place, content_hash): where each canonical record stands in shards of ``rows_per_shard`` by key, and its hash.

    Numbered by key within range partitions, whose bounds ``number`` reads once, so that no task sorts all rows.
    """
    from ..functions.ident import content_hash
    from .stamp import number

    placed = number(df.withColumn("content_hash", content_hash(F.struct(*df.columns), kind)), key, 0, "x", "x", parts=16)
    at = F.col("counter_value")
    return placed.select(key, F.floor(at / rows_per_shard).cast("int").alias("shard"), (at % rows_per_shard).cast("int").alias("place"), "content_hash")


def postings(index: DataFrame) -> DataFrame:
    """(token, doc_freq, first_id, last_id); the ids themselves stay rows, since a common token has as many as there are documents."""
    return index.groupBy("token").agg(F.count("*").alias("doc_freq"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def inverse_pivot(edges: DataFrame, key: str, through: str, passes: dict[str, DataFrame]) -> DataFrame:
    """Per key the ordered distinct ids of each pass, reached through the edge table (key, through).

    passes: name -> table (through, id).
    """
    pairs = edges.select(key, through).where(F.col(key).isNotNull() & F.col(through).isNotNull()).distinct()
    out = pairs.groupBy(key).agg(F.array_sort(F.collect_set(through)).alias(f"{through}s"))
    for name, table in passes.items():
        got = pairs.join(table.select(through, F.col("id")).distinct(), through).select(key, "id").distinct()
        out = out.join(got.groupBy(key).agg(F.array_sort(F.collect_set("id")).alias(name)), key, "left")
    empty = {n: F.coalesce(n, F.array().cast(out.schema[n].dataType)) for n in passes}
    return out.withColumns(empty)


def reached(edges: DataFrame, key: str, through: str, table: DataFrame) -> DataFrame:
    """Distinct (key, id) of table(through, id) reached through the edges; ids stay rows, since a common key reaches very many."""
    pairs = edges.select(key, through).where(F.col(key).isNotNull() & F.col(through).isNotNull()).distinct()
    return pairs.join(table.select(through, "id"), through).select(key, "id").distinct()


def xrefs(df: DataFrame, number: str, kinds: dict[str, Column]) -> DataFrame:
    """(kind, id, least number, collisions): all kinds unpivoted in one pass, nulls and empties left out."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("id")) for k, c in kinds.items()])).alias("e")
    got = df.select(F.col(number).alias("_n"), each).where(F.length("e.id") > 0)
    return got.groupBy("e.kind", "e.id").agg(F.min("_n").alias(number), (F.count_distinct("_n") - 1).alias("collisions"))


def bucketed(df: DataFrame, key: str, buckets: int = 1024) -> DataFrame:
    """With the key's FNV bucket."""
    return df.withColumn("bucket", bucket(F.col(key).cast("string"), buckets))


def posting_pages(df: DataFrame, key: str, order: list[str], size: int = 512, flat: int = 64) -> DataFrame:
    """Per key its rows, pages, and whether it needs a directory of pages (more than ``flat``)."""
    paged = pages(df, key, order, size)
    return paged.groupBy(key).agg(F.count("*").alias("n"), (F.max("page") + 1).alias("pages")).withColumn("two_level", F.col("pages") > flat)


def sublists(df: DataFrame, key: str, levels: dict[str, list[str]], size: int) -> DataFrame:
    """(key, level, pages): how many pages a key has if its rows are parted by each level's columns."""
    out = None
    for name, parts in levels.items():
        by = df.groupBy(key, *parts).agg(F.ceil(F.count("*") / size).alias("p")).groupBy(key).agg(F.sum("p").alias("pages")).withColumn("level", F.lit(name))
        out = by if out is None else out.unionByName(by)
    return out


def axis(df: DataFrame, key: Column, fields: list[str], order: str) -> DataFrame:
    """Rows projected to an axis; rows without a key drop out; with their order in the axis key."""
    return df.select(key.alias("axis_key"), *fields).where("axis_key is not null").withColumn("order_key", F.col(order))


def verified(pages: DataFrame, body: str, digest: str) -> DataFrame:
    """Pages whose body hashes to its digest; another raises when it is read."""
    good = F.sha2(F.col(body).cast("binary"), 256) == F.col(digest)
    return pages.withColumn(body, F.when(good, F.col(body)).otherwise(F.raise_error(F.concat(F.lit("hash mismatch of "), F.coalesce(digest, F.lit("null"))))))


def two_tier(current: DataFrame, archive: DataFrame, key: str) -> DataFrame:
    """Rows of the current table, and archived rows of keys that it lacks."""
    return current.withColumn("tier", F.lit(1)).unionByName(archive.join(current.select(key), key, "left_anti").select(*archive.columns).withColumn("tier", F.lit(2)))

"""Physical layout: posting pages, sublists, sizes, sealed pages, wide conversions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, index, paging
from .common import Registry

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql


@register("SELECT l_suppkey, count(*) AS n, ((count(*) + 7) // 8)::INT AS pages, (count(*) + 7) // 8 > 64 AS two_level FROM lineitem GROUP BY 1")
def posting_pages(t, spark):
    """Pages of each key, and whether it needs a directory."""
    return index.posting_pages(t("lineitem"), "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"], 8, 64)


@register("""
WITH a AS (SELECT l_suppkey, ceil(count(*) / 16.0)::BIGINT AS p FROM lineitem GROUP BY 1), b AS (SELECT l_suppkey, ceil(count(*) / 16.0)::BIGINT AS p FROM lineitem GROUP BY l_suppkey, l_returnflag), c AS (SELECT l_suppkey, ceil(count(*) / 16.0)::BIGINT AS p FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus)
SELECT l_suppkey, 'P0' AS level, sum(p)::BIGINT AS pages FROM a GROUP BY 1 UNION ALL SELECT l_suppkey, 'P1', sum(p)::BIGINT FROM b GROUP BY 1 UNION ALL SELECT l_suppkey, 'P2', sum(p)::BIGINT FROM c GROUP BY 1
""")
def partitioned_sublists(t, spark):
    """Pages if a key's rows are parted by nothing, one column or two."""
    return index.sublists(t("lineitem"), "l_suppkey", {"P0": [], "P1": ["l_returnflag"], "P2": ["l_returnflag", "l_linestatus"]}, 16)


@register("SELECT sum(n)::BIGINT AS edges, count(*) AS keys, ceil(sum(n) / 512.0)::BIGINT AS packed_pages, ceil(max(n) / 512.0)::BIGINT AS largest_pages FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def index_size(t, spark):
    """Edges, keys and pages of an index."""
    return aggregate.index_size(t("lineitem"), "l_suppkey", 512)


@register("SELECT p_brand AS axis_key, count(*) AS n, min(p_partkey) AS first, max(p_partkey) AS last FROM part WHERE p_size % 10 > 0 GROUP BY 1")
def axis_projection(t, spark):
    """Rows projected to an axis; rows without a key drop out."""
    got = index.axis(t("part"), F.when(F.col("p_size") % 10 > 0, F.col("p_brand")), ["p_partkey", "p_name"], "p_partkey")
    return got.groupBy("axis_key").agg(F.count("*").alias("n"), F.min("order_key").alias("first"), F.max("order_key").alias("last"))


@register("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END::INT AS tier FROM part")
def two_tier_lookup(t, spark):
    """The current table, then archived rows of keys that it lacks."""
    p = t("part").select("p_partkey", "p_name")
    return index.two_tier(p.where("p_partkey % 3 = 0"), p, "p_partkey").select("p_partkey", "tier")


@register("""
WITH RECURSIVE r AS (SELECT lang, doc_id, strlen(to_json(documents)::VARCHAR)::INT AS bytes, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents),
f AS (SELECT lang, doc_id, bytes, n, 0 AS page, 1 AS held, bytes AS total FROM r WHERE n = 1
  UNION ALL SELECT r.lang, r.doc_id, r.bytes, r.n, CASE WHEN held + 1 > 64 OR total + r.bytes > 65536 THEN page + 1 ELSE page END, CASE WHEN held + 1 > 64 OR total + r.bytes > 65536 THEN 1 ELSE held + 1 END, CASE WHEN held + 1 > 64 OR total + r.bytes > 65536 THEN r.bytes ELSE total + r.bytes END
  FROM f JOIN r ON r.lang IS NOT DISTINCT FROM f.lang AND r.n = f.n + 1)
SELECT lang, doc_id, bytes, page::INT AS page FROM f
""")
def size_sealed_pages(t, spark):
    """Pages that end by rows or bytes, whichever comes first. Where a page ends depends on all before it in its key."""
    return paging.sealed_pages(t("documents"), "lang", ["doc_id"], 64, 65536)


@register("SELECT p_partkey, sha256(p_name) AS digest, p_name AS body FROM part")
def verified_pages(t, spark):
    """Pages whose body hashes to their digest; another would raise."""
    p = t("part").select("p_partkey", F.sha2(F.col("p_name").cast("binary"), 256).alias("digest"), F.col("p_name").alias("body"))
    return index.verified(p, "body", "digest")


@register("SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS most, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2")
def pruned_scan(t, spark):
    """Five of eleven columns and a filter that both reach the scan."""
    li = t("lineitem").where(F.col("l_shipdate") <= F.lit("2000-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"), F.sum("l_quantity").cast("long").alias("quantity"))

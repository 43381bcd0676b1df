"""Dedup, merge, identifier and stamping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ident, text
from ..operators import dedup, index, merge, paging, stamp
from .common import Registry

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql

_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@register(f"SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(_ORDER)}) AS n FROM lineitem) WHERE n = 1")
def first_wins(t, spark):
    """The first row of each key in a stated order."""
    return dedup.first_by(t("lineitem"), ["l_partkey"], _ORDER).select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")


@register(f"SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(c + ' DESC' for c in _ORDER)}) AS n FROM lineitem) WHERE n = 1")
def last_wins(t, spark):
    """The last row of each key."""
    return dedup.last_by(t("lineitem"), ["l_partkey"], _ORDER).select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")


@register("SELECT p_name, min(p_partkey) AS p_partkey, count(DISTINCT p_partkey) - 1 AS collisions FROM part GROUP BY p_name")
def min_key(t, spark):
    """1.4: the least value of each key, and how many stood against it."""
    return dedup.min_key(t("part"), ["p_name"], "p_partkey")


@register("SELECT text_md5, doc_id FROM (SELECT md5(text) AS text_md5, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY CASE lang WHEN 'en' THEN 0 ELSE 1 END, doc_id) AS n FROM documents) WHERE n = 1")
def ranked_dedup(t, spark):
    """1.4: tier before id."""
    d = t("documents").select(F.md5(F.col("text").cast("binary")).alias("text_md5"), "doc_id", "lang")
    return dedup.ranked_by(d, ["text_md5"], [F.when(F.col("lang") == "en", 0).otherwise(1), F.col("doc_id")]).select("text_md5", "doc_id")


@register("""
SELECT p_brand, arg_min(p_name, (p_size, p_partkey)) AS preferred, array_to_string(list_filter(list_sort(list(DISTINCT p_name)), lambda x: x <> arg_min(p_name, (p_size, p_partkey))), ',') AS synonyms FROM part GROUP BY p_brand
""")
def concept_rollup(t, spark):
    """The name of lowest rank, and the other names in order."""
    return dedup.preferred(t("part"), ["p_brand"], "p_name", F.col("p_size"), "p_partkey").withColumn("synonyms", F.array_join("synonyms", ","))


@register("""
WITH p AS (SELECT event_id % 3000 AS k, max(value) AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 3000 > 50 GROUP BY 1), c AS (SELECT event_id % 3000 AS k, max(value) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'view' GROUP BY 1)
SELECT coalesce(c.k, p.k) AS k, CASE WHEN c.k IS NOT NULL THEN c.v ELSE p.v END AS v, CASE WHEN c.k IS NULL THEN 'kept' WHEN p.k IS NULL THEN 'from_current' ELSE 'replaced' END AS origin FROM p FULL JOIN c ON p.k = c.k
UNION ALL SELECT NULL, 1.0, 'no_key' UNION ALL SELECT NULL, 1.0, 'no_key'
""")
def cumulative_merge(t, spark):
    """Current over previous by key; rows without a key are all kept."""
    e = t("events").withColumn("k", F.col("event_id") % 3000)
    loose = spark.range(1).select(F.lit(None).cast("long").alias("k"), F.lit(1.0).alias("v"))
    prev = e.where("ts < timestamp '2024-01-15' and k > 50").groupBy("k").agg(F.max("value").alias("v")).union(loose)
    cur = e.where("ts >= timestamp '2024-01-15' and event_type <> 'view'").groupBy("k").agg(F.max("value").alias("v")).union(loose)
    return merge.cumulative(prev, cur, "k")


@register("""
WITH p AS (SELECT user_id AS k, max(CASE WHEN event_type = 'error' THEN value END) AS a, max(CASE WHEN user_id % 2 = 0 THEN event_type ELSE '' END) AS b, list_sort(list(DISTINCT event_type) FILTER (WHERE value > 60)) AS s FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
c AS (SELECT user_id AS k, max(CASE WHEN value > 150 THEN value END) AS a, min(CASE WHEN user_id % 3 = 0 THEN event_type ELSE '' END) AS b, list_sort(list(DISTINCT event_type) FILTER (WHERE value > 90)) AS s FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1),
m AS (SELECT coalesce(c.k, p.k) AS k, coalesce(c.a, p.a) AS a, coalesce(nullif(c.b, ''), p.b, c.b) AS b, list_sort(list_distinct(list_concat(coalesce(p.s, []), coalesce(c.s, [])))) AS s FROM p FULL JOIN c ON p.k = c.k)
SELECT k, a, b, array_to_string(s, ',') AS s FROM m
""")
def deep_merge(t, spark):
    """Fields filled, not replaced; lists united."""
    e = t("events").withColumnRenamed("user_id", "k")
    prev = e.where("ts < timestamp '2024-01-10'").groupBy("k").agg(F.max(F.expr("case when event_type = 'error' then value end")).alias("a"), F.max(F.expr("case when k % 2 = 0 then event_type else '' end")).alias("b"), F.array_sort(F.collect_set(F.expr("case when value > 60 then event_type end"))).alias("s"))
    cur = e.where("ts >= timestamp '2024-01-10'").groupBy("k").agg(F.max(F.expr("case when value > 150 then value end")).alias("a"), F.min(F.expr("case when k % 3 = 0 then event_type else '' end")).alias("b"), F.array_sort(F.collect_set(F.expr("case when value > 90 then event_type end"))).alias("s"))
    return merge.deep(prev, cur, "k", ("s",)).withColumn("s", F.array_join(F.array_sort("s"), ","))


@register("""
WITH b AS (SELECT CASE WHEN c_custkey % 50 > 0 THEN c_custkey END AS k, c_mktsegment AS seg, c_acctbal AS bal, 'base' AS src FROM customer),
d AS (SELECT CASE WHEN event_id % 9 > 0 THEN user_id END AS k, CASE WHEN event_type = 'signup' THEN event_type END AS seg, CASE WHEN event_type = 'purchase' THEN value END AS bal, event_type AS src, event_id AS r FROM events),
u AS (SELECT k, seg, bal, src, -1 AS r FROM b WHERE k IS NOT NULL UNION ALL SELECT * FROM d WHERE k IS NOT NULL)
SELECT k, arg_max(seg, r) FILTER (WHERE seg IS NOT NULL) AS seg, arg_max(bal, r) FILTER (WHERE bal IS NOT NULL) AS bal, array_to_string(list_sort(list(DISTINCT src)), ',') AS sources FROM u GROUP BY k UNION ALL SELECT k, seg, bal, src FROM b WHERE k IS NULL
""")
def delta_fold(t, spark):
    """Each field's last value that isn't null, over a base and deltas in order; provenance united; base rows without a key all kept, such deltas skipped."""
    base = t("customer").select(F.when(F.col("c_custkey") % 50 > 0, F.col("c_custkey")).alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"), F.array(F.lit("base")).alias("sources"))
    deltas = t("events").select(F.when(F.col("event_id") % 9 > 0, F.col("user_id")).alias("k"), F.expr("case when event_type = 'signup' then event_type end").alias("seg"), F.expr("case when event_type = 'purchase' then value end").alias("bal"), F.array("event_type").alias("sources"), F.col("event_id").alias("r"))
    return merge.fold_deltas(base, deltas, "k", "r", ("sources",)).withColumn("sources", F.array_join(F.array_sort("sources"), ","))


@register("""
WITH p AS (SELECT user_id AS k, max(value) AS a, max(event_type) AS b FROM events WHERE event_type <> 'view' GROUP BY 1), c AS (SELECT user_id AS k, CASE WHEN max(value) > 200 THEN max(value) END AS a, min(event_type) AS b FROM events WHERE event_id % 3 = 0 GROUP BY 1)
SELECT coalesce(c.k, p.k) AS k, CASE WHEN c.k IS NOT NULL THEN c.a ELSE p.a END AS a, CASE WHEN c.k % 2 = 0 THEN c.b ELSE p.b END AS b FROM p FULL JOIN c ON p.k = c.k
""")
def shallow_merge(t, spark):
    """A current record's fields over the previous one's, nulls that it has too."""
    e = t("events").withColumnRenamed("user_id", "k")
    prev = e.where("event_type <> 'view'").groupBy("k").agg(F.max("value").alias("a"), F.max("event_type").alias("b"))
    cur = e.where("event_id % 3 = 0").groupBy("k").agg(F.expr("case when max(value) > 200 then max(value) end").alias("a"), F.min("event_type").alias("b"))
    return merge.shallow(prev, cur.withColumn("given", F.when(F.col("k") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))), "k", "given")


@register("""
WITH q AS (SELECT user_id AS id, min(ts) AS f, max(ts) AS l, (count(*) % 12)::INT AS r, 'old' AS e FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1),
f AS (SELECT user_id AS id, max(event_type) AS e FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-29' GROUP BY 1), s AS (SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'purchase' AND value > 200),
j AS (SELECT coalesce(q.id, f.id) AS id, CASE WHEN f.id IS NOT NULL AND q.id IS NOT NULL THEN q.r + 1 WHEN f.id IS NOT NULL THEN 0 ELSE q.r END::INT AS retries, CASE WHEN f.id IS NOT NULL THEN f.e ELSE q.e END AS last_error, coalesce(q.f, TIMESTAMP '2024-02-01') AS first_failed_at FROM (SELECT * FROM q WHERE id NOT IN (SELECT id FROM s)) q FULL JOIN f ON q.id = f.id)
SELECT id, retries, last_error, first_failed_at FROM j WHERE retries < 10
""")
def retry_queue_merge(t, spark):
    """Successes leave the queue, failures count up, exhausted entries go."""
    e = t("events")
    queue = e.where("event_type = 'error' and ts < timestamp '2024-01-15'").groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("first_failed_at"), F.max("ts").alias("last_attempt_at"), (F.count("*") % 12).cast("int").alias("retries")).withColumn("last_error", F.lit("old"))
    failed = e.where("event_type = 'error' and ts >= timestamp '2024-01-29'").groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("error"))
    good = e.where("event_type = 'purchase' and value > 200").select(F.col("user_id").alias("id")).distinct()
    now = F.lit("2024-02-01 00:00:00").cast(e.schema["ts"].dataType)
    return merge.retry_queue(queue, failed, good, now).select("id", "retries", "last_error", "first_failed_at")


@register("SELECT id, max(stamp) AS stamp FROM (SELECT user_id AS id, ts AS stamp FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, ts FROM events WHERE event_type = 'click') GROUP BY id")
def stamp_merge(t, spark):
    """The latest stamp of each id over several maps."""
    e = t("events").select(F.col("user_id").alias("id"), F.col("ts").alias("stamp"), "event_type")
    return merge.stamps(e.where("event_type = 'view'").drop("event_type"), e.where("event_type = 'click'").drop("event_type"))


@register("""
WITH u AS (SELECT 'brand' AS kind, p_brand AS id, p_partkey AS n FROM part UNION ALL SELECT 'name', p_name, p_partkey FROM part UNION ALL SELECT 'type', p_type, p_partkey FROM part WHERE p_size > 10)
SELECT kind, id, min(n) AS p_partkey, count(DISTINCT n) - 1 AS collisions FROM u GROUP BY kind, id
""")
def xref_index(t, spark):
    """Identifiers of several kinds to the least number, with collisions."""
    return index.xrefs(t("part"), "p_partkey", {"brand": F.col("p_brand"), "name": F.col("p_name"), "type": F.when(F.col("p_size") > 10, F.col("p_type"))})


_K = "cast(c_custkey AS {})"
_RAW = f"""CASE c_custkey % 20 WHEN 0 THEN 'CID:' || {_K} WHEN 1 THEN ' chembl' || {_K} || ' ' WHEN 2 THEN 'UNII:abcdefgh' || lpad({_K}, 2, '0') WHEN 3 THEN 'db' || lpad({_K}, 5, '0') WHEN 4 THEN 'RXCUI:' || {_K} WHEN 5 THEN c_name
  WHEN 6 THEN 'lode::compound::CID:' || {_K} WHEN 7 THEN {_K} WHEN 8 THEN 'bsynrymutxbxsq-uhfffaoysa-' || substr(c_mktsegment, 1, 1) WHEN 9 THEN 'chebi:' || {_K} WHEN 10 THEN 'KEGG:d' || lpad({_K}, 5, '0') WHEN 11 THEN 'D' || lpad({_K}, 5, '0') WHEN 12 THEN 'DB' || {_K}
  WHEN 13 THEN 'UNII:' || {_K} WHEN 14 THEN 'CHEMBL' WHEN 15 THEN 'RXCUI: ' || {_K} WHEN 16 THEN '' WHEN 17 THEN 'CID:-' || {_K} WHEN 18 THEN 'x::compound::cid:' || {_K} END"""
# The chain of shapes as SQL has it: full matches, in order, whatever the case.
_SHAPES = (
    ("pubchem_cid", "(?:[a-z]+::compound::CID:|CID:)?([0-9]+)", "{}"), ("chembl_id", "(CHEMBL[0-9]+)", "upper({})"), ("inchi_key", "([A-Z]{{14}}-[A-Z]{{10}}-[A-Z])", "upper({})"), ("unii", "UNII:([A-Z0-9]{{10}})", "upper({})"),
    ("drugbank_id", "(DB[0-9]{{5}})", "upper({})"), ("chebi_id", "CHEBI:([0-9]+)", "'CHEBI:' || {}"), ("kegg_drug_id", "(?:KEGG:)?(D[0-9]{{5}})", "upper({})"), ("rxcui", "RXCUI:([0-9]+)", "{}"),
)
_chain = lambda value: " ".join(f"WHEN regexp_full_match(x, '(?i){p.format()}') THEN {value(k, p.format(), f)}" for k, p, f in _SHAPES)


@register(f"""
WITH q AS (SELECT c_custkey, trim({_RAW.format(*["VARCHAR"] * 30)}) AS x FROM customer)
SELECT c_custkey, CASE {_chain(lambda k, p, f: f"'{k}'")} END AS kind, CASE {_chain(lambda k, p, f: f.format(f"regexp_extract(x, '(?i)^{p}$', 1)"))} END AS normalized FROM q
""")
def resolve_identifier(t, spark):
    """Identifiers of all eight kinds, and of none, by an ordered chain of shapes."""
    got = t("customer").select("c_custkey", text.identifier(F.expr(_RAW.format(*["STRING"] * 30))).alias("i"))
    return got.select("c_custkey", "i.kind", "i.normalized")


_NUMBER = f"""CASE c_custkey % 9 WHEN 0 THEN 'lode%3A%3Acompound%3A%3ACID%3A' || {_K} WHEN 1 THEN 'cid:' || {_K} WHEN 2 THEN {_K} || 'x' WHEN 3 THEN ' ' || {_K} WHEN 4 THEN '0' WHEN 5 THEN '1' || lpad({_K}, 10, '0') WHEN 6 THEN 'CID%3A' || {_K}
  WHEN 7 THEN 'lode::compound::CID:' || {_K} ELSE '99999999999999' END"""


@register(f"""
WITH q AS (SELECT c_custkey, regexp_extract(trim(replace({_NUMBER.format(*["VARCHAR"] * 9)}, '%3A', ':')), '(?i)^(?:[a-z]+::compound::CID:|CID:)?([0-9]{{1,11}})$', 1) AS x FROM customer)
SELECT c_custkey, CASE WHEN x <> '' AND x::BIGINT BETWEEN 1 AND 10000000000 THEN x::BIGINT END AS number FROM q
""")
def compound_numbers(t, spark):
    """Percent-encoded canonical ids, CID:n and plain numbers, in range."""
    return t("customer").select("c_custkey", text.compound_number(F.expr(_NUMBER.format(*["STRING"] * 9))).alias("number"))


@register("SELECT p_partkey, substr(sha256('lode:part:part.v1.0:' || p_name || p_partkey), 1, 32) AS sid_s, substr(sha256('lode:part:' || (row_number() OVER (ORDER BY p_partkey) + 99)), 1, 32) AS sid_c FROM part")
def sid_stamp(t, spark):
    """Ids from content, and from counters without a gap."""
    p = t("part").withColumn("sid_s", ident.sid("lode", "part", "part.v1.0", F.concat(F.col("p_name"), F.col("p_partkey").cast("string"))))
    return stamp.number(p, "p_partkey", 100, "lode", "part", parts=8).select("p_partkey", "sid_s", "sid_c")


@register("""
WITH k AS (SELECT substr(sha256('lode:part:v1:' || p_partkey), 1, 32) AS s FROM part WHERE p_partkey % 3 = 0 UNION SELECT substr(sha256('lode:part:v0:' || p_name || p_partkey), 1, 32) FROM part WHERE p_partkey % 5 = 0),
d AS (SELECT *, CASE WHEN p_size > 2 THEN substr(sha256('lode:part:v1:' || p_partkey), 1, 32) END AS s, substr(sha256('lode:part:v0:' || p_name || p_partkey), 1, 32) AS a FROM part)
SELECT CASE WHEN s IN (SELECT s FROM k) THEN 'already' WHEN s IS NULL THEN 'unstampable' WHEN a IN (SELECT s FROM k) THEN 'cross_pollinated' ELSE 'unstamped' END AS stamp, count(*) AS n FROM d GROUP BY 1
""")
def stamp_classify(t, spark):
    """What a crosswalk knows, knows by another anchor, has to number, or can't."""
    k = F.col("p_partkey").cast("string")
    full = F.concat(F.col("p_name"), k)
    a = ident.sid("lode", "part", "v1", k)
    known = t("part").where("p_partkey % 3 = 0").select(a.alias("sid_s")).union(t("part").where("p_partkey % 5 = 0").select(ident.sid("lode", "part", "v0", full))).distinct().withColumn("sid_c", F.lit("c"))
    anchor = F.when(F.col("p_size") > 2, F.struct(k.alias("payload"), F.lit("v1").alias("version")))
    got = stamp.classify(t("part"), "lode", "part", anchor, known, F.struct(full.alias("payload"), F.lit("v0").alias("version")))
    return got.groupBy("stamp").agg(F.count("*").alias("n"))


_FNV = "list_reduce(list_prepend(2166136261::HUGEINT, list_transform(range(1, len({0}) + 1), lambda i: unicode({0}[i])::HUGEINT)), lambda h, b: (xor(h::BIGINT, b::BIGINT)::HUGEINT * 16777619) % 4294967296)::BIGINT"


@register(f"SELECT c_custkey, {_FNV.format('c_name')} AS hash, {_FNV.format('c_name')} % 1024 AS bucket FROM customer")
def fnv_buckets(t, spark):
    """FNV-1a of a key and its bucket."""
    return t("customer").select("c_custkey", ident.fnv1a(F.col("c_name")).alias("hash"), ident.bucket(F.col("c_name")).alias("bucket"))


@register(f"SELECT p_partkey, lpad(lower(to_hex({_FNV.format('p_name')})), 8, '0') AS hash FROM part")
def short_hash(t, spark):
    """FNV-1a over UTF-16 units (the same as over bytes for ASCII), as hex."""
    return t("part").select("p_partkey", ident.fnv1a_utf16(F.col("p_name")).alias("hash"))


@register("SELECT c_custkey, sha256('{\"b\":{\"x\":' || c_nationkey || ',\"y\":null},\"k\":' || c_custkey || ',\"n\":\"' || c_name || '\"}') AS hash FROM customer")
def canonical_hash(t, spark):
    """Hash of JSON with keys in order and nulls kept."""
    c = t("customer").select("c_custkey", F.struct(F.col("c_name").alias("n"), F.struct(F.lit(None).cast("string").alias("y"), F.col("c_nationkey").alias("x")).alias("b"), F.col("c_custkey").alias("k")).alias("r"))
    return c.select("c_custkey", ident.content_hash(F.col("r"), c.schema["r"].dataType).alias("hash"))


@register("""
WITH h AS (SELECT c_custkey, sha1(unhex(substr(sha256('lode-seed'), 1, 32)) || c_name::BLOB) AS h FROM customer)
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || CASE WHEN substr(h, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(h, 17, 1) IN ('1', '5', '9', 'd') THEN '9' WHEN substr(h, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h
""")
def uuid_stamp(t, spark):
    """Version-5 UUIDs in built-in functions."""
    return t("customer").select("c_custkey", ident.uuid5("lode-seed", F.col("c_name")).alias("uuid"))


@register("""
WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY (c_custkey <= 1400)::INT, c_custkey) AS place FROM customer) SELECT c_custkey, place::INT AS place FROM s WHERE place <= 200
""")
def ring_chunk(t, spark):
    """A chunk after a cursor, wrapping to the head."""
    return paging.ring_chunk(t("customer").select("c_custkey"), "c_custkey", 1400, 200)


@register("SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey, o_orderkey) > (700, 100) ORDER BY o_custkey, o_orderkey LIMIT 64")
def keyset_page(t, spark):
    """The next page after a cursor's key, by a range predicate."""
    q = {"status": None}
    last = paging.decode_cursor(paging.encode_cursor("s1", "orders", q, [700, 100]), "s1", "orders", q, 2)
    return paging.after(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], last, 64).select("o_orderkey", "o_custkey")

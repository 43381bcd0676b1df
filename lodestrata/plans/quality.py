"""Gates, completeness, audits, distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, quality, rights
from .common import Registry

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql

_RULES = {
    "c_custkey": quality.Rule("integer", required=True, least=5),
    "c_name": quality.Rule("string", required=True, pattern="^Customer#[0-9]+$", max_length=18),
    "c_mktsegment": quality.Rule("string", enum=("BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")),
    "c_acctbal": quality.Rule("number", least=0, most=9000),
}
_BROKEN_SQL = """
v AS (
  SELECT c_custkey, list_filter([CASE WHEN c_custkey < 5 THEN 'c_custkey: min' END, CASE WHEN NOT regexp_full_match(c_name, 'Customer#[0-9]+') THEN 'c_name: pattern' END, CASE WHEN length(c_name) > 18 THEN 'c_name: maxLength' END,
    CASE WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD') THEN 'c_mktsegment: enum' END, CASE WHEN c_acctbal < 0 THEN 'c_acctbal: min' END, CASE WHEN c_acctbal > 9000 THEN 'c_acctbal: max' END], lambda x: x IS NOT NULL) AS v FROM customer
)"""


@register(f"""
WITH {_BROKEN_SQL}
SELECT c_custkey, array_to_string(v, ',') AS violations, CASE WHEN len(v) = 0 THEN 'pass' WHEN len(list_filter(v, lambda x: x NOT LIKE 'c_acctbal%' AND x NOT LIKE 'c_mktsegment%')) > 0 THEN 'halt' WHEN len(list_filter(v, lambda x: x LIKE 'c_mktsegment%')) > 0 THEN 'scope_exclude' ELSE 'warn' END AS outcome FROM v
""")
def schema_gate(t, spark):
    """Violations and what they lead to: scope rule before derived path before primary."""
    got = quality.gate(t("customer"), _RULES, scope=["^c_mktsegment: enum"], derived=["^c_acctbal"])
    return got.select("c_custkey", F.array_join("violations", ",").alias("violations"), "outcome")


@register(f"WITH {_BROKEN_SQL} SELECT violation, count(*) AS n FROM (SELECT unnest(v) AS violation FROM v) GROUP BY 1")
def violations_by_rule(t, spark):
    """Records against each rule."""
    return quality.by_rule(quality.gate(t("customer"), _RULES))


@register("""
WITH d AS (SELECT d.lang, d.source, length(d.text) > 0 AS has_text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)), g AS (
SELECT lang, count(*) AS total, count(*) FILTER (WHERE quality IS NOT NULL) AS gate_pass, count(*) FILTER (WHERE quality IS NOT NULL AND toxic = 0) AS fully_enriched FROM d GROUP BY lang)
SELECT *, floor(fully_enriched::DOUBLE / total * 100 * 100 + 0.5) / 100 AS raw_pct, CASE WHEN gate_pass > 0 THEN floor(fully_enriched::DOUBLE / gate_pass * 100 * 100 + 0.5) / 100 ELSE 100 END AS adjusted_pct FROM g
""")
def source_completeness(t, spark):
    """Complete records of all, and of those that pass the gate; 100 % of none."""
    d = t("documents").join(t("labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    return quality.completeness(d, "lang", ["quality"], ["toxic===0"])


@register("""
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality IS NOT NULL) AS a, count(*) FILTER (WHERE lang = 'en') AS b, count(*) FILTER (WHERE n_chars > 1000) AS c FROM documents LEFT JOIN labels USING (doc_id))
SELECT principle, met, n, floor(met::DOUBLE / n * 100 * 100 + 0.5) / 100 AS pct FROM (SELECT unnest(['labelled', 'english', 'long']) AS principle, unnest([a, b, c]) AS met, n FROM c)
""")
def audit_pct(t, spark):
    """Shares of records that meet each principle, in one pass."""
    d = t("documents").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.audit(d, {"labelled": F.col("quality").isNotNull(), "english": F.col("lang") == "en", "long": F.col("n_chars") > 1000})


@register("""
WITH d AS (SELECT l_partkey, count(*) AS degree FROM lineitem GROUP BY 1), r AS (SELECT degree, row_number() OVER (ORDER BY degree) AS i, count(*) OVER () AS n FROM d)
SELECT max(n) AS n, max(degree) AS max, min(degree) FILTER (WHERE i >= ceil(n * 0.5)) AS p50, min(degree) FILTER (WHERE i >= ceil(n * 0.95)) AS p95, min(degree) FILTER (WHERE i >= ceil(n * 0.99)) AS p99 FROM r
""")
def degree_distribution(t, spark):
    """Exact nearest-rank quantiles of rows per key."""
    return aggregate.quantiles(aggregate.degrees(t("lineitem"), "l_partkey"), "degree", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@register("SELECT CASE WHEN degree >= 40 THEN 40 WHEN degree >= 30 THEN 30 WHEN degree >= 20 THEN 20 ELSE 1 END::INT AS edge, count(*) AS n FROM (SELECT count(*) AS degree FROM lineitem GROUP BY l_partkey) GROUP BY 1")
def degree_histogram(t, spark):
    """Keys in cells of degree."""
    return aggregate.histogram(aggregate.degrees(t("lineitem"), "l_partkey"), "degree", [1, 20, 30, 40])


@register("""
WITH d AS (SELECT l_partkey, count(*) AS degree, count(DISTINCT l_suppkey) AS partners FROM lineitem GROUP BY 1) SELECT *, CASE WHEN l_partkey = 0 THEN 'sentinel_key' WHEN degree > partners THEN 'duplicate_edges' ELSE 'legitimate' END AS kind FROM d WHERE degree >= 35
""")
def max_degree_kinds(t, spark):
    """Why a key has so many rows."""
    return aggregate.explain_degree(t("lineitem"), "l_partkey", "l_suppkey", 35)


@register("SELECT lang, count(*) AS n, count(DISTINCT source) AS n_distinct FROM documents GROUP BY lang")
def distinct_per_group(t, spark):
    """Rows and distinct values by group."""
    return aggregate.distinct_per(t("documents"), "lang", "source")


@register("""
WITH lost AS (SELECT l_partkey, l_returnflag, l_suppkey FROM lineitem WHERE l_quantity < 25 AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 47))
SELECT CASE WHEN l_returnflag = 'N' THEN 'null' ELSE l_returnflag END AS kind, count(DISTINCT l_partkey) AS n_lost, count(DISTINCT l_suppkey) AS n_sources FROM lost GROUP BY 1
""")
def projection_loss(t, spark):
    """Codes that only a fallback reaches, once for each kind."""
    li = t("lineitem").withColumn("kind", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return aggregate.projection_loss(li.where("l_quantity >= 47"), li.where("l_quantity < 25"), "l_partkey", "kind", "l_suppkey")


@register("""
WITH o AS (SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 40) THEN 'linked' WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 100000 THEN 'small' ELSE 'other' END AS outcome FROM orders) SELECT outcome, count(*) AS n FROM o GROUP BY 1
""")
def label_productivity(t, spark):
    """Linked, or the first reason why not."""
    big = t("lineitem").where("l_quantity >= 40").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    o = t("orders").join(big, "o_orderkey", "left")
    return aggregate.productivity(o, "o_orderkey", F.col("hit"), [("pending", F.col("o_orderstatus") == "P"), ("small", F.col("o_totalprice") < 100000)])


@register("""
WITH f AS (SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_partkey % 7 > 0)
SELECT r.p_partkey, CASE WHEN f.p_partkey IS NULL THEN 'no_record' WHEN f.p_size > 45 THEN 'out_of_scope' WHEN f.p_retailprice > 990 THEN 'warned' ELSE 'valid' END AS outcome FROM part r LEFT JOIN f ON r.p_partkey = f.p_partkey
""")
def harvest_outcomes(t, spark):
    """Every requested id ends in one outcome."""
    p = t("part")
    return quality.outcomes(p.select("p_partkey"), "p_partkey", p.where("p_partkey % 7 > 0"), F.col("p_size") <= 45, {"p_retailprice": quality.Rule("number", required=True, most=990)})


@register("""
WITH x AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, [c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN 'SECRET:' || c_custkey ELSE 'OK:3' END, 'SECRET:9'] AS refs FROM customer)
SELECT c_custkey, c_name AS name, array_to_string(list_filter(refs, lambda r: NOT starts_with(r, 'SECRET:')), ',') AS refs, CASE WHEN c_custkey % 5 > 0 THEN 'withheld_by_rights_policy' END AS mark, c_mktsegment AS inner_name, c_custkey % 3 = 0 AS shown, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS term,
  (CASE WHEN c_custkey % 5 > 0 THEN 1 ELSE 0 END + 2 + CASE WHEN c_custkey % 4 > 0 THEN 1 ELSE 0 END)::INT AS n_licensed, (1 + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END)::INT AS n_vendor, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END::INT AS n_terms FROM x
""")
def rights_filter(t, spark):
    """Fields, map keys, list items and a restricted source's details withheld in structs, maps and nested arrays, marked, and counted by family."""
    k, secret = F.col("c_custkey"), F.col("c_acctbal")
    balance = F.when(k % 5 > 0, secret).alias("balance")
    inner = F.struct(F.col("c_mktsegment").alias("name"), secret.alias("balance"))
    c = t("customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.struct(balance, F.lit("x").alias("city")).alias("money"), F.create_map(F.lit("a"), inner).alias("by_kind"), F.array(F.array(inner)).alias("nested"),
        F.when(k % 4 > 0, F.create_map(F.lit("balance"), secret.cast("string"))).otherwise(F.create_map(F.lit("other"), F.lit("y"))).alias("notes"), F.array(F.col("c_mktsegment"), F.when(k % 2 == 0, F.concat(F.lit("SECRET:"), k.cast("string"))).otherwise("OK:3"), F.lit("SECRET:9")).alias("refs"),
        F.struct(F.struct(F.when(k % 3 == 0, "open").otherwise("closed_source").alias("primary_source")).alias("provenance"), F.struct(F.col("c_mktsegment").alias("reason_text")).alias("failure"), k.alias("n")).alias("signal"),
    )
    got = rights.apply(c, {"balance": "licensed"}, {"^SECRET:": "vendor"}, rights.Signal("terms", "^closed::", "closed_source", detail_path=("detail", "none"), paths=(("failure", "reason_text"),)), markers=True)
    w = F.col("withheld")
    return got.select("c_custkey", "name", F.array_join("refs", ",").alias("refs"), F.col("money.balance_visibility").alias("mark"), F.col("by_kind")["a"]["name"].alias("inner_name"), F.col("signal.failure.reason_text").isNotNull().alias("shown"), F.col("signal.failure.reason_text").alias("term"), w["licensed"].alias("n_licensed"), w["vendor"].alias("n_vendor"), w["terms"].alias("n_terms"))

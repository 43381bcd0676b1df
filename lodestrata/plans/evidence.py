"""Evidence queries: summaries, verdicts, roll-ups, pages.

Roles: a customer is a subject, its orders are trials, its lineitems are
measurements (returned ones are negative evidence), its events are reports.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import lipinski
from ..operators import acceptance, aggregate, paging
from .common import Registry

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql

_NEG_SQL = """
neg AS (
  SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
         CASE WHEN l_linestatus = 'F' THEN 'trial_failure' ELSE 'inactive_bioassay' END AS kind,
         CASE WHEN l_quantity >= 45 THEN 'critical' WHEN l_quantity >= 30 THEN 'major' WHEN l_quantity >= 10 THEN 'minor' ELSE 'unknown' END AS severity
  FROM lineitem WHERE l_returnflag = 'R'
)"""


def _negatives(t):
    """Returned lines, with a severity by quantity and an evidence type by state."""
    severity = F.when(F.col("l_quantity") >= 45, "critical").when(F.col("l_quantity") >= 30, "major").when(F.col("l_quantity") >= 10, "minor").otherwise("odd")
    kind = F.when(F.col("l_linestatus") == "F", "trial_failure").otherwise("inactive_bioassay")
    return t("lineitem").where("l_returnflag = 'R'").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", kind.alias("kind"), severity.alias("severity"))


@register("""
WITH tr AS (
  SELECT o_custkey AS c_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, count(*) FILTER (WHERE o_orderstatus = 'O') AS active FROM orders GROUP BY 1
), ev AS (
  SELECT user_id AS c_custkey, count(*) FILTER (WHERE event_type = 'error') AS negatives, count(*) FILTER (WHERE event_type = 'error' AND value >= 200) AS critical FROM events GROUP BY 1
), li AS (
  SELECT o.o_custkey AS c_custkey, count(*) FILTER (WHERE l_returnflag = 'A' AND l_quantity >= 48) AS activities, count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity >= 50) AS retracted
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1
), s AS (
  SELECT c.c_custkey, coalesce(completed, 0) + coalesce(active, 0) AS trials, coalesce(activities, 0) AS activities, coalesce(negatives, 0) AS negatives, coalesce(critical, 0) AS critical, coalesce(retracted, 0) AS retracted
  FROM customer c LEFT JOIN tr USING (c_custkey) LEFT JOIN ev USING (c_custkey) LEFT JOIN li USING (c_custkey)
)
SELECT *, CASE WHEN critical > 0 THEN 'none' WHEN trials + activities = 0 AND negatives = 0 AND retracted = 0 THEN 'none' WHEN trials + activities = 0 AND retracted > 0 THEN 'weak'
  WHEN trials >= 2 AND negatives <= 2 THEN 'strong' WHEN trials + activities > 0 AND negatives = 0 THEN 'strong' WHEN trials + activities > 0 AND negatives > 2 THEN 'mixed' ELSE 'weak' END AS signal
FROM s
""")
def repurposing_verdict(t, spark):
    """Four aggregates by subject and an ordered verdict, for all subjects at once."""
    trials = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("completed"), F.count_if(F.col("o_orderstatus") == "O").alias("active"))
    events = t("events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count_if(F.col("event_type") == "error").alias("negatives"), F.count_if((F.col("event_type") == "error") & (F.col("value") >= 200)).alias("critical"))
    # Lines are summed by order before they meet the orders, so that the join carries one row an order.
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count_if((F.col("l_returnflag") == "A") & (F.col("l_quantity") >= 48)).alias("a"), F.count_if((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50)).alias("r"))
    lines = lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("a").alias("activities"), F.sum("r").alias("retracted"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    s = t("customer").select("c_custkey").join(trials, "c_custkey", "left").join(events, "c_custkey", "left").join(lines, "c_custkey", "left")
    s = s.select("c_custkey", (n("completed") + n("active")).alias("trials"), n("activities").alias("activities"), n("negatives").alias("negatives"), n("critical").alias("critical"), n("retracted").alias("retracted"))
    return s.withColumn("signal", rules.verdict(*(F.col(c) for c in ("trials", "activities", "negatives", "critical", "retracted"))))


@register("""
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, count(*) FILTER (WHERE o_orderstatus = 'O') AS active,
       coalesce(array_to_string(list_slice(list(o_orderkey ORDER BY o_orderkey) FILTER (WHERE o_orderstatus IN ('F', 'O')), 1, 5), ','), '') AS examples
FROM orders GROUP BY o_custkey
""")
def trial_summary(t, spark):
    """Counts by state and the first five examples."""
    got = aggregate.summary(t("orders"), "o_custkey", {"completed": F.col("o_orderstatus") == "F", "active": F.col("o_orderstatus") == "O"}, F.col("o_orderkey"), F.col("o_orderstatus").isin("F", "O"))
    return got.withColumn("examples", F.array_join("examples", ","))


@register(f"""
WITH {_NEG_SQL}
SELECT l_partkey, count(*) AS total, count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, count(*) FILTER (WHERE severity = 'minor') AS minor,
  count(*) FILTER (WHERE severity = 'unknown') AS unknown, count(*) FILTER (WHERE kind = 'trial_failure') AS trial_failures, count(*) FILTER (WHERE kind = 'trial_failure' AND severity = 'critical') AS critical_failures
FROM neg GROUP BY l_partkey
""")
def negative_evidence_rollup(t, spark):
    """Totals, severity vector and severity-by-type table of each key; unknown severities count as such."""
    r = aggregate.rollup(_negatives(t), "l_partkey", "kind", "severity")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return r.select("l_partkey", "total", *[F.col("severity_rollup")[i].alias(s) for i, s in enumerate(rules.SEVERITIES)], n(F.try_element_at("type_rollup", F.lit("trial_failure"))).alias("trial_failures"), n(F.try_element_at("sev_by_type", F.lit("trial_failure"))[0]).alias("critical_failures"))


@register(f"""
WITH {_NEG_SQL}
SELECT p.l_partkey, count(n.kind) AS total, count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, count(*) FILTER (WHERE severity = 'minor') AS minor,
  count(*) FILTER (WHERE severity = 'unknown') AS unknown, count(DISTINCT n.kind)::INT AS n_types
FROM (SELECT DISTINCT l_partkey FROM neg) p LEFT JOIN (SELECT * FROM neg WHERE kind IN ('trial_failure')) n USING (l_partkey) GROUP BY p.l_partkey
""")
def filtered_rollup(t, spark):
    """Totals for the types of a client's filter, from the roll-up; unknown names in the filter drop out."""
    r = aggregate.rollup(_negatives(t), "l_partkey", "kind", "severity")
    return aggregate.filtered_rollup(r, "l_partkey", rules.event_filter(" Trial_Failure , nonsense"))


@register("SELECT l_partkey, 0::BIGINT AS total FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def empty_filter(t, spark):
    """A filter that names no known type keeps nothing."""
    r = aggregate.rollup(_negatives(t), "l_partkey", "kind", "severity")
    return aggregate.filtered_rollup(r, "l_partkey", rules.event_filter("nonsense")).select("l_partkey", "total")


@register(f"""
WITH {_NEG_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS position FROM neg WHERE kind = 'trial_failure'
)
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, position::INT AS position, ((position - 1) // 4)::INT AS page FROM r WHERE position > 2 AND position <= 7
""")
def paged_evidence(t, spark):
    """Offset and limit over the rows that a filter keeps, and the page each stands on."""
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    got = paging.page_of(_negatives(t), "l_partkey", order, 2, paging.clamp(5), F.col("kind") == "trial_failure")
    return got.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "position", F.floor((F.col("position") - 1) / 4).cast("int").alias("page"))


@register("""
WITH r AS (SELECT l_suppkey, l_orderkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1) // 64 AS page FROM lineitem)
SELECT l_suppkey, page::INT AS page, count(*) AS n, min(l_orderkey) AS first, max(l_orderkey) AS last FROM r GROUP BY l_suppkey, page
""")
def page_bounds(t, spark):
    """64 rows a page, with each page's first and last key."""
    paged = paging.pages(t("lineitem"), "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"])
    return paging.page_stats(paged, "l_suppkey", "l_orderkey")


@register(f"""
WITH {_NEG_SQL}, s AS (SELECT l_partkey, count(*) AS total, count(DISTINCT kind) AS types, min(CASE severity WHEN 'critical' THEN 0 WHEN 'major' THEN 1 WHEN 'minor' THEN 2 ELSE 3 END) AS w FROM neg GROUP BY l_partkey),
h AS (SELECT *, CASE w WHEN 0 THEN 'critical' WHEN 1 THEN 'major' WHEN 2 THEN 'minor' ELSE 'unknown' END AS highest FROM s)
SELECT l_partkey, highest, total || ' negative signal' || CASE WHEN total = 1 THEN '' ELSE 's' END || ' across ' || types || ' evidence type' || CASE WHEN types = 1 THEN '' ELSE 's' END || '; highest severity: ' || highest || '.' AS summary FROM h
""")
def evidence_response(t, spark):
    """Worst severity and a line of summary."""
    r = aggregate.rollup(_negatives(t), "l_partkey", "kind", "severity")
    highest = rules.highest_severity({s: F.col("severity_rollup")[i] for i, s in enumerate(rules.SEVERITIES)})
    r = r.withColumn("highest", highest)
    return r.select("l_partkey", "highest", rules.summary(F.col("total"), F.size("type_rollup"), F.col("highest")).alias("summary"))


@register("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN u <> 'percent' THEN CASE WHEN nm < 1000 THEN true WHEN nm > 10000 THEN false END WHEN v > 50 THEN true WHEN v < 20 THEN false END AS is_active,
  CASE WHEN u <> 'percent' THEN CASE WHEN nm < 1000 OR nm > 10000 THEN 'concentration_threshold_v1' ELSE 'concentration_inconclusive_v1' END WHEN v > 50 OR v < 20 THEN 'inhibition_threshold_v1' ELSE 'inhibition_inconclusive_v1' END AS method,
  (90 + CASE WHEN CASE WHEN u <> 'percent' THEN nm BETWEEN 0.001 AND 1e8 ELSE v BETWEEN 0 AND 100 END THEN 10 ELSE 0 END)::INT AS confidence
FROM (SELECT *, CASE u WHEN 'nM' THEN v WHEN 'uM' THEN v * 1000.0::DOUBLE END AS nm FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'nM' WHEN 'N' THEN 'uM' ELSE 'percent' END AS u, CASE l_returnflag WHEN 'A' THEN l_extendedprice ELSE l_quantity END AS v FROM lineitem))
""")
def activity_rules(t, spark):
    """Active, inactive or inconclusive from value and unit, and how far to trust it."""
    unit = F.when(F.col("l_returnflag") == "A", "nM").when(F.col("l_returnflag") == "N", "uM").otherwise("percent")
    li = t("lineitem").withColumn("v", F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).otherwise(F.col("l_quantity"))).withColumn("u", unit).withColumn("k", F.when(F.col("u") == "percent", "inhibition").otherwise("IC50"))
    a = rules.activity(F.col("v"), F.col("u"), F.col("k"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", a["is_active"].alias("is_active"), a["method"].alias("method"), rules.measurement_confidence(F.col("v"), F.col("u"), F.col("k"), F.lit("binding")).cast("int").alias("confidence"))


@register("""
SELECT p_partkey, ((p_retailprice > 950)::INT + (p_size > 25)::INT + (p_size % 7 > 5)::INT + (p_size % 15 > 10)::INT)::INT AS violations FROM part
""")
def lipinski_like(t, spark):
    """how many of four limits a row breaks."""
    over = lipinski(F.col("p_retailprice") - 450, F.col("p_size") - 20, F.col("p_size") % 7, F.col("p_size") % 15)
    return t("part").select("p_partkey", over.cast("int").alias("violations"))


@register("""
WITH f AS (SELECT l_partkey, count(DISTINCT l_linestatus) > 1 AS fits, min(l_quantity) <= 2 AS clash FROM lineitem GROUP BY 1),
s AS (SELECT l_partkey, count(*) AS n, sum(w) AS bonus FROM (SELECT DISTINCT l_partkey, l_returnflag, CASE l_returnflag WHEN 'R' THEN 5 ELSE 10 END AS w FROM lineitem) GROUP BY 1)
SELECT l_partkey, n::INT AS n_sources, greatest(0, CASE WHEN n = 1 THEN least(60, 40 + least(20, bonus) - CASE WHEN clash THEN 15 ELSE 0 END) ELSE least(100, 80 + (n - 2) * 3 + CASE WHEN fits THEN 5 ELSE 0 END + least(15, floor(bonus / 2.0 + 0.5)) - CASE WHEN clash THEN 30 ELSE 0 END) END)::INT AS score FROM s JOIN f USING (l_partkey)
""")
def source_scores(t, spark):
    """A fact's score by the sources that have it, whether its structure fits, and conflicts."""
    src = F.when(F.col("l_returnflag") == "A", "pubchem").when(F.col("l_returnflag") == "N", "chembl").otherwise("clinicaltrials")
    s = t("lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set(src)).alias("srcs"), (F.min("l_linestatus") != F.max("l_linestatus")).alias("fits"), (F.min("l_quantity") <= 2).alias("clash"))
    return s.select("l_partkey", F.size("srcs").alias("n_sources"), rules.source_score(F.col("srcs"), F.col("fits"), F.col("clash")).cast("int").alias("score"))


@register("""
WITH s AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o, sum(DISTINCT CASE o_orderstatus WHEN 'F' THEN 1010 WHEN 'O' THEN 2005 ELSE 3005 END) % 1000 AS bonus FROM orders GROUP BY 1),
d AS (SELECT *, CASE WHEN n = 1 THEN 40 + least(20, bonus) ELSE least(100, 80 + (n - 2) * 3 + least(15, floor(bonus / 2.0 + 0.5))) END AS sc FROM s),
e AS (SELECT *, floor((sc * 0.4::DOUBLE + sc * f::INT * 0.3::DOUBLE + sc * o::INT * 0.2::DOUBLE + 100 * 0.1::DOUBLE) / (0.4::DOUBLE + f::INT * 0.3::DOUBLE + o::INT * 0.2::DOUBLE + 0.1::DOUBLE) + 0.5) AS ov FROM d)
SELECT o_custkey, CASE WHEN n = 1 THEN least(60, ov) ELSE ov END::INT AS overall FROM e
""")
def entity_scores(t, spark):
    """The weighted mean over the dimensions that an entity has, at most 60 from one source."""
    src = F.when(F.col("o_orderstatus") == "F", "chembl").when(F.col("o_orderstatus") == "O", "clinicaltrials").otherwise("openalex")
    s = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set(src)).alias("srcs"))
    return s.select("o_custkey", rules.entity_score(F.col("srcs"), F.lit(False), F.lit(False), F.lit(True), F.lit(True)).cast("int").alias("overall"))


@register("""
WITH e AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS trials, count(*) FILTER (WHERE event_type = 'signup') AS activities, count(*) FILTER (WHERE event_type = 'error') AS negatives, count(*) FILTER (WHERE event_type = 'error' AND value > 240) AS critical, count(*) FILTER (WHERE event_type = 'view' AND value > 200) AS retracted FROM events GROUP BY 1)
SELECT user_id, CASE WHEN critical > 0 THEN 'Critical negative signal present (drug withdrawal / black box). Repurposing is not viable without explicit risk-benefit reassessment.'
  WHEN trials + activities = 0 AND negatives = 0 AND retracted = 0 THEN 'No repurposing evidence on file. Insufficient data to recommend.' WHEN trials + activities = 0 AND retracted > 0 THEN 'No positive evidence; only retracted-paper signals present. Treat any historical claim with caution.'
  WHEN trials >= 2 AND negatives <= 2 THEN 'Multiple progressed trials and few negative signals — strong repurposing candidate.' WHEN trials + activities > 0 AND negatives = 0 THEN 'Positive evidence present with no negative signals on record.'
  WHEN trials + activities > 0 AND negatives > 2 THEN 'Positive evidence weighed against multiple negative signals. Agent should surface both layers.' ELSE 'Sparse evidence; treat any single-source claim with caution.' END AS recommendation FROM e
""")
def recommendations(t, spark):
    """What a subject's evidence recommends."""
    kind = F.col("event_type")
    n = lambda test, name: F.count_if(test).alias(name)
    e = t("events").groupBy("user_id").agg(n(kind == "purchase", "trials"), n(kind == "signup", "activities"), n(kind == "error", "negatives"), n((kind == "error") & (F.col("value") > 240), "critical"), n((kind == "view") & (F.col("value") > 200), "retracted"))
    return e.select("user_id", rules.judged(*(F.col(c) for c in ("trials", "activities", "negatives", "critical", "retracted")))["recommendation"].alias("recommendation"))


@register("""
WITH u AS (
  SELECT 'trial::' || l_orderkey || '-' || l_linenumber AS id, 'trial_failure' AS evidence_type, l_partkey::VARCHAR AS subject, CASE WHEN l_quantity >= 45 THEN 'critical' ELSE 'minor' END AS severity FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'withdrawn::' || o_orderkey, 'drug_withdrawal', o_custkey::VARCHAR, 'critical' FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'faers::' || event_id, 'faers_adr_signal', user_id::VARCHAR, CASE WHEN value >= 400 THEN 'critical' WHEN value >= 200 THEN 'major' WHEN value >= 50 THEN 'minor' ELSE 'unknown' END FROM events WHERE event_type = 'error'
)
SELECT evidence_type, severity, count(*) AS n, count(DISTINCT id) AS ids, count(DISTINCT subject) AS subjects FROM u GROUP BY ALL
""")
def evidence_union(t, spark):
    """Builders of one shape and their union, duplicates kept."""
    c = lambda *xs: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    s = lambda n: F.col(n).cast("string")
    lines = t("lineitem").where("l_returnflag = 'R'").select(c("trial::", s("l_orderkey"), "-", s("l_linenumber")).alias("id"), F.lit("trial_failure").alias("evidence_type"), s("l_partkey").alias("subject"), F.when(F.col("l_quantity") >= 45, "critical").otherwise("minor").alias("severity"))
    gone = t("orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(c("withdrawn::", s("o_orderkey")).alias("id"), F.lit("drug_withdrawal").alias("evidence_type"), s("o_custkey").alias("subject"), F.lit("critical").alias("severity"))
    reports = t("events").where("event_type = 'error'").select(c("faers::", s("event_id")).alias("id"), F.lit("faers_adr_signal").alias("evidence_type"), s("user_id").alias("subject"), rules.tier(F.col("value"), 400, 200, 50, "unknown").alias("severity"))
    return lines.unionByName(gone).unionByName(reports).groupBy("evidence_type", "severity").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("subject").alias("subjects"))


@register("""
SELECT k AS event_type, count(e.event_id) AS n FROM (SELECT unnest(['error', 'view', 'refund']) AS k) LEFT JOIN events e ON e.event_type = k GROUP BY k
""")
def zero_filled_counts(t, spark):
    """A10: counts over known keys, 0 where there is none."""
    return aggregate.zero_filled(t("events"), "event_type", ["error", "view", "refund"])


@register("""
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS states, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities,
  CASE min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END) WHEN 1 THEN '1-URGENT' WHEN 2 THEN '2-HIGH' ELSE 'other' END AS worst
FROM orders GROUP BY o_custkey
""")
def signal_aggregate(t, spark):
    """Ordered distinct sets and the value of highest rank."""
    o = t("orders").withColumn("priority", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority")).otherwise("other"))
    got = aggregate.drug_signals(o, "o_custkey", ["o_orderstatus", "o_orderpriority"], {"1-URGENT": 3, "2-HIGH": 2, "other": 1}, "priority")
    return got.select("o_custkey", F.array_join("o_orderstatus", ",").alias("states"), F.array_join("o_orderpriority", ",").alias("priorities"), F.col("priority").alias("worst"))


@register("""
WITH g AS (SELECT l_partkey, count(*) AS n, count(*) FILTER (WHERE l_quantity > 40) AS n_true, count(*) FILTER (WHERE l_quantity < 20) AS n_false, count(DISTINCT l_suppkey) AS targets,
  count(*) FILTER (WHERE l_tax = 0)::DOUBLE / count(*) AS us, count(*) FILTER (WHERE l_linestatus = 'F')::DOUBLE / count(*) AS ps FROM lineitem GROUP BY 1)
SELECT l_partkey, n, n_true, n_false, n - n_true - n_false AS n_null, targets, CASE WHEN us > 0.3 THEN 'unitless' ELSE '' END || CASE WHEN us > 0.3 AND ps < 0.5 THEN ',' ELSE '' END || CASE WHEN ps < 0.5 THEN 'phase_coverage' ELSE '' END AS gaps FROM g
""")
def acceptance_findings(t, spark):
    """A flag's three states, distinct targets, and the gaps that acceptance checks name."""
    flag = F.when(F.col("l_quantity") > 40, True).when(F.col("l_quantity") < 20, False)
    got = aggregate.findings(t("lineitem"), "l_partkey", flag, "l_suppkey", F.col("l_tax") == 0, F.col("l_linestatus") == "F")
    return got.select("l_partkey", "n", "n_true", "n_false", "n_null", "targets", "gaps")


@register("""
WITH c AS (SELECT p_partkey AS id, p_size AS z, p_partkey AS k FROM part),
p AS (SELECT ps AS id, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 5000) AS cited, count(*) FILTER (WHERE c_custkey % 5 = 0) AS meshed, count(*) FILTER (WHERE c_nationkey > 12) AS recent, count(*) FILTER (WHERE c_custkey % 4 = 0) AS open, count(*) FILTER (WHERE c_custkey % 2 = 0) AS doi, count(*) FILTER (WHERE c_nationkey = 3) AS gone, count(*) FILTER (WHERE c_nationkey = 3 AND c_custkey % 2 = 0) AS proved, count(*) FILTER (WHERE c_custkey % 3 = 0) AS linked FROM (SELECT *, c_custkey % 700 AS ps FROM customer) GROUP BY 1),
a AS (SELECT l_partkey AS id, count(*) AS n, count(DISTINCT CASE WHEN l_quantity > 3 THEN l_suppkey END) AS targets, count(*) FILTER (WHERE l_returnflag = 'A' AND l_quantity > 10) AS ic50, count(*) FILTER (WHERE l_linestatus = 'F') AS unitless FROM lineitem GROUP BY 1),
t AS (SELECT o_orderkey % 1500 AS id, count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'P') AS drug, count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_custkey % 2 = 0) AS phased, sum((o_custkey % 7 = 0)::INT) AS conditions FROM orders GROUP BY 1),
n AS (SELECT user_id AS id, count(*) AS n, count(*) FILTER (WHERE value > 100) AS reasons, count(*) FILTER (WHERE value > 200) AS classified FROM events WHERE event_type = 'error' GROUP BY 1),
f AS (SELECT c.id, z, k, coalesce(p.n, 0) AS papers, coalesce(cited, 0) AS cited, coalesce(meshed, 0) AS meshed, coalesce(recent, 0) AS recent, coalesce(open, 0) AS open, coalesce(doi, 0) AS doi, coalesce(gone, 0) AS gone, coalesce(proved, 0) AS proved, coalesce(linked, 0) AS linked, coalesce(a.n, 0) AS acts, coalesce(targets, 0) AS targets, coalesce(ic50, 0) AS ic50, coalesce(unitless, 0) AS unitless, coalesce(t.n, 0) AS trials, coalesce(drug, 0) AS drug, coalesce(phased, 0) AS phased, coalesce(conditions, 0) AS conditions, coalesce(n.n, 0) AS negs, coalesce(reasons, 0) AS reasons, coalesce(classified, 0) AS classified
  FROM c LEFT JOIN p ON p.id = c.id LEFT JOIN a ON a.id = c.id LEFT JOIN t ON t.id = c.id LEFT JOIN n ON n.id = c.id),
g AS (SELECT id, list_filter([CASE WHEN z % 9 = 0 THEN 'structural_data' END, CASE WHEN z % 8 = 0 THEN 'lipinski_violations' END, CASE WHEN z % 5 = 0 THEN 'synonyms' END, CASE WHEN z % 2 * 45 + 10 < 50 THEN 'confidence_score' END, CASE WHEN z % 6 = 0 THEN 'max_phase' END, CASE WHEN z % 6 = 4 AND k % 2 = 0 THEN 'first_approval_year' END,
  CASE WHEN acts = 0 THEN 'active_count' END, CASE WHEN acts > 0 AND targets = 0 THEN 'target_diversity' END, CASE WHEN acts > 0 AND ic50 = 0 THEN 'ic50_values' END, CASE WHEN acts > 0 AND unitless / acts > 0.3::DOUBLE THEN 'units_standardized' END, CASE WHEN trials = 0 THEN 'trial_count' END, CASE WHEN drug > 0 AND phased / drug < 0.5::DOUBLE THEN 'phase_distribution' END, CASE WHEN trials > 0 AND conditions = 0 THEN 'conditions_covered' END,
  CASE WHEN negs = 0 THEN 'negative_outcomes' END, CASE WHEN negs > 0 AND reasons = 0 THEN 'why_stopped_text' END, CASE WHEN negs > 0 AND classified = 0 THEN 'failure_classification' END, CASE WHEN papers = 0 THEN 'paper_count' END, CASE WHEN papers > 0 AND cited / papers < 0.3::DOUBLE THEN 'citation_counts' END, CASE WHEN papers > 0 AND meshed / papers < 0.3::DOUBLE THEN 'mesh_terms' END, CASE WHEN papers > 0 AND recent = 0 THEN 'recent_papers' END, CASE WHEN papers > 0 AND open / papers < 0.2::DOUBLE THEN 'open_access_flag' END,
  CASE WHEN proved < gone THEN 'retraction_doi_proof' END, CASE WHEN z % 3 < 2 THEN 'source_count' END, CASE WHEN papers > 0 AND linked = 0 THEN 'paper_to_trial_links' END, CASE WHEN papers > 0 AND doi / papers < 0.5::DOUBLE THEN 'doi_traceability' END, CASE WHEN z % 3 = 0 THEN 'source_list_per_field' END, CASE WHEN z % 3 > 0 AND k % 4 = 0 THEN 'timestamp_per_extraction' END], lambda x: x IS NOT NULL) AS gaps FROM f)
SELECT id, array_to_string(gaps, ',') AS gaps, (SELECT count(*) FROM (SELECT unnest([['structural_data', 'lipinski_violations', 'synonyms', 'molecular_weight', 'confidence_score'], ['max_phase', 'first_approval_year', 'withdrawn_status'], ['active_count', 'target_diversity', 'ic50_values', 'units_standardized'], ['trial_count', 'phase_distribution', 'conditions_covered'], ['negative_outcomes', 'why_stopped_text', 'failure_classification'],
  ['paper_count', 'citation_counts', 'mesh_terms', 'recent_papers', 'open_access_flag'], ['retraction_doi_proof', 'retraction_source_provenance'], ['confidence_score', 'per_dimension_confidence', 'source_count', 'structural_match_flag'], ['paper_to_trial_links', 'doi_traceability'], ['source_list_per_field', 'timestamp_per_extraction', 'extraction_method_visible']]) AS q) WHERE NOT list_has_any(gaps, q))::INT AS answered FROM g
""")
def acceptance_scenarios(t, spark):
    """The named checks that each compound fails, and the questions that it answers."""
    k, z = F.col("p_partkey"), F.col("p_size")
    null = F.lit(None)
    c = t("part").select(
        k.alias("id"), F.when(z % 9 > 0, "C").alias("smiles"), F.lit("I").alias("inchi"), F.lit("F").alias("formula"), F.when(z % 8 > 0, 1).alias("violations"), (z % 5).alias("synonyms"), F.lit(1.0).alias("weight"), (z % 2 * 45 + 10).alias("overall"), F.when(z % 6 > 0, z % 6).alias("max_phase"),
        F.when(k % 2 == 1, 1999).alias("first_approval"), F.lit(False).alias("withdrawn"), F.lit(1).alias("structural"), F.lit(1).alias("bioactivity"), F.lit(True).alias("structural_match"), (z % 3).alias("sources"), F.when(k % 4 > 0, z % 3).otherwise(0).alias("timestamps"), (z % 3).alias("methods"),
    )
    u = F.col("c_custkey")
    papers = t("customer").select(
        (u % 700).alias("compound_id"), F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("citation_count"), F.when(u % 5 == 0, 1).otherwise(0).alias("mesh"), F.when(F.col("c_nationkey") > 12, 2021).otherwise(2001).alias("year"), (u % 4 == 0).alias("open_access"), F.when(u % 2 == 0, "10.1/x").alias("doi"),
        (F.col("c_nationkey") == 3).alias("retracted"), F.when(u % 2 == 0, "10.1/r").alias("retraction_doi"), F.lit("x").alias("retraction_source"), F.when(u % 3 == 0, 1).otherwise(0).alias("trial_mentions"),
    )
    q = F.col("l_quantity")
    acts = t("lineitem").select(F.col("l_partkey").alias("compound_id"), F.when(q > 3, F.col("l_suppkey")).alias("target_id"), F.when(F.col("l_returnflag") == "A", "IC50").otherwise("Ki").alias("kind"), (q - 10).alias("value"), F.when(F.col("l_linestatus") == "F", "unitless").otherwise("nM").alias("unit"))
    trials = t("orders").select((F.col("o_orderkey") % 1500).alias("compound_id"), (F.col("o_orderstatus") != "P").alias("drug"), F.when(F.col("o_custkey") % 2 == 0, 1).alias("phase"), (F.col("o_custkey") % 7 == 0).cast("int").alias("conditions"))
    negs = t("events").where("event_type = 'error'").select(F.col("user_id").alias("compound_id"), F.when(F.col("value") > 100, "r").otherwise("").alias("reason"), F.when(F.col("value") > 200, "SAFETY").alias("category"))
    return acceptance.gaps(acceptance.facts(c, papers, acts, trials, negs)).select("id", F.array_join("gaps", ",").alias("gaps"), F.col("answered").cast("int").alias("answered"))

"""What is written through the sinks and read back through the scans, and the query API over a published snapshot.

Each query writes into a new folder of the session's shared folder and returns
what reading gives; its SQL is over the table that was written.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import api
from ..functions import paths
from ..operators import state
from ..sources import flatfile, scan, sink
from .common import Registry, workspace

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql


def _text(c):
    return F.col(c).cast("string")


@register("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS seg FROM customer")
def jsonl_round_trip(t, spark):
    """JSON lines written, nulls left out, and read strictly."""
    at = workspace(spark, "jsonl")
    sink.jsonl(t("customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("seg")), at, "gzip")
    return scan.jsonl_strict(spark, at, T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double, seg string"))


def _broken_lines(t, spark, name):
    at = workspace(spark, name)
    k = F.col("c_custkey")
    line = F.when(k % 7 == 0, F.concat(F.lit('{"k": '), k.cast("string"))).when(k % 11 == 0, "#header").otherwise(F.to_json(F.struct(k.alias("k"), F.col("c_name").alias("n"))))
    t("customer").select(line.alias("value")).write.text(at)
    return at, T.StructType.fromDDL("k bigint, n string")


@register("SELECT c_custkey AS k, c_name AS n FROM customer WHERE c_custkey % 7 > 0 AND c_custkey % 11 > 0")
def lenient_scan(t, spark):
    """Malformed lines are left out."""
    return scan.jsonl_lenient(spark, *_broken_lines(t, spark, "lenient"))


@register("SELECT c_custkey % 7 = 0 AS malformed, count(*) AS n, CASE WHEN c_custkey % 7 > 0 THEN max(c_custkey) END AS last FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 > 0 GROUP BY 1, c_custkey % 7 > 0".replace(", CASE WHEN c_custkey % 7 > 0 THEN max(c_custkey) END AS last", ", max(CASE WHEN c_custkey % 7 > 0 THEN c_custkey END) AS last"))
def counting_scan(t, spark):
    """Malformed lines counted, header lines left out."""
    got = scan.jsonl_counting(spark, *_broken_lines(t, spark, "counting"), header=True)
    return got.groupBy("malformed").agg(F.count("*").alias("n"), F.max("record.k").alias("last"))


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def filtered_scan(t, spark):
    """Rows that meet a predicate, with an observation of what was seen and kept."""
    got, _ = scan.filtered(t("orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice") > 100000, "orders")
    return got


@register("SELECT p_partkey::VARCHAR AS cui, CASE WHEN p_size % 3 > 0 THEN p_name END AS str, CASE WHEN p_size % 2 = 0 THEN '\"' || p_brand ELSE p_brand END AS sab FROM part")
def pipe_delimited_scan(t, spark):
    """Pipe-delimited rows without quoting, empty cells null."""
    at = workspace(spark, "rrf")
    cells = [_text("p_partkey"), F.when(F.col("p_size") % 3 > 0, F.col("p_name")).otherwise(""), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('"'), "p_brand")).otherwise(F.col("p_brand"))]
    t("part").select(F.concat(F.concat_ws("|", *cells), F.lit("|")).alias("value")).write.text(at)
    return scan.rrf(spark, at, ["cui", "str", "sab"])


@register("SELECT 'P' || s_suppkey AS accession, 'E' || s_suppkey AS entry, s_name AS name, 'G' || s_nationkey AS gene, s_nationkey AS taxon, (s_suppkey * 3)::INT AS length, (s_suppkey % 3)::INT AS xrefs FROM supplier")
def protein_records(t, spark):
    """Tagged lines between separators."""
    at, k = workspace(spark, "proteins"), _text("s_suppkey")
    dr = F.array_join(F.transform(F.slice(F.array(F.lit(1), F.lit(2)), 1, (F.col("s_suppkey") % 3).cast("int")), lambda i: F.concat(F.lit("DR   PDB; "), i.cast("string"), F.lit("X; X-ray.\n"))), "")
    body = F.concat(
        F.lit("ID   E"), k, F.lit("   Reviewed;\nAC   P"), k, F.lit("; Q1;\nDE   RecName: Full="), F.col("s_name"), F.lit(" {ECO:1};\nGN   Name=G"), _text("s_nationkey"), F.lit(";\nOX   NCBI_TaxID="), _text("s_nationkey"), F.lit(";\n"), dr,
        F.lit("SQ   SEQUENCE   "), (F.col("s_suppkey") * 3).cast("string"), F.lit(" AA;  1 MW\n//"),
    )
    t("supplier").select(body.alias("value")).write.text(at)
    got = flatfile.proteins(flatfile.records(spark, at, "//"))
    return got.select("accession", "entry", "name", "gene", "taxon", "length", F.size("xrefs").alias("xrefs"))


@register("SELECT p_partkey AS cid, p_name AS formula, p_retailprice AS weight, p_brand AS smiles, CASE WHEN p_size % 2 = 0 THEN p_size / 4.0::DOUBLE END AS log_p FROM part WHERE p_partkey % 6 > 0")
def structure_records(t, spark):
    """Structure records by their tags; records without an id drop out, values that don't parse are null."""
    at = workspace(spark, "sdf")
    tag = lambda n, v: F.concat(F.lit(f"> <{n}>\n"), v, F.lit("\n\n"))
    body = F.concat(
        F.lit("mol\n"), F.when(F.col("p_partkey") % 6 > 0, tag("PUBCHEM_COMPOUND_CID", _text("p_partkey"))).otherwise(""), tag("PUBCHEM_MOLECULAR_FORMULA", F.col("p_name")), tag("PUBCHEM_MOLECULAR_WEIGHT", _text("p_retailprice")),
        tag("PUBCHEM_OPENEYE_CAN_SMILES", F.col("p_brand")), tag("PUBCHEM_XLOGP3", F.when(F.col("p_size") % 2 == 0, (F.col("p_size") / 4).cast("string")).otherwise("none")), F.lit("$$$$"),
    )
    t("part").select(body.alias("value")).write.text(at)
    return flatfile.compounds(flatfile.sdf(flatfile.records(spark, at, "$$$$"), "PUBCHEM_COMPOUND_CID")).select("cid", "formula", "weight", "smiles", "log_p")


@register("SELECT c_custkey::VARCHAR AS k, '\"' || c_name || '\", said ' || c_mktsegment AS n FROM customer")
def quoted_csv(t, spark):
    """Commas inside quotes, quotes doubled."""
    at = workspace(spark, "csv")
    t("customer").select(_text("c_custkey").alias("k"), F.concat(F.lit('"'), "c_name", F.lit('", said '), "c_mktsegment").alias("n")).write.csv(at, header=True, quote='"', escape='"')
    return scan.csv_rows(spark, at)


@register("SELECT p_partkey, 'of ' || p_name || ' & more' AS boxed, CASE WHEN p_size % 2 = 0 THEN 'inner outer' END AS usage, (CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END)::INT AS n FROM part")
def label_sections(t, spark):
    """Texts of a label's top-level sections by code; the first of a name counts, unknown codes don't."""
    part = lambda code, body: F.concat(F.lit(f'<section><code code="{code}"/>'), body, F.lit("</section>"))
    xml = F.concat(
        F.lit("<doc>"), part("34066-1", F.concat(F.lit("<b>of</b> "), "p_name", F.lit(" &amp; more"))), part("34066-1", F.lit("second")), part("0-0", F.lit("unknown")),
        F.when(F.col("p_size") % 2 == 0, part("34067-9", F.lit("<section>inner</section> outer"))).otherwise(""), F.lit("</doc>"),
    )
    got = t("part").select("p_partkey", flatfile.label_sections_udf(xml).alias("s"))
    return got.select("p_partkey", F.col("s")["boxed_warning"].alias("boxed"), F.try_element_at("s", F.lit("indications_and_usage")).alias("usage"), F.size("s").alias("n"))


@register("SELECT p_partkey::VARCHAR AS entry, p_name || ',' || p_brand AS names, p_type AS formula FROM part")
def section_records(t, spark):
    """Named sections with continuation lines."""
    at = workspace(spark, "sections")
    body = F.concat(F.lit("ENTRY       "), _text("p_partkey"), F.lit("\nNAME        "), "p_name", F.lit("\n            "), "p_brand", F.lit("\nFORMULA     "), "p_type", F.lit("\n///"))
    t("part").select(body.alias("value")).write.text(at)
    got = flatfile.sections(flatfile.records(spark, at, "///"))
    return got.select(F.col("sections")["ENTRY"][0].alias("entry"), F.array_join(F.col("sections")["NAME"], ",").alias("names"), F.col("sections")["FORMULA"][0].alias("formula"))


@register("SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS seg, NULL::VARCHAR AS other FROM customer")
def table_answers(t, spark):
    """Cells by their place in an answer's header; null where it has no such name."""
    k = F.col("c_custkey")
    header = F.when(k % 2 == 0, F.array(F.lit("seg"), F.lit("name"))).otherwise(F.array(F.lit("x"), F.lit("name")))
    got = scan.table_rows(t("customer"), header, F.array("c_mktsegment", "c_name"), ["name", "seg", "other"])
    return got.select("c_custkey", "name", "seg", F.col("other").cast("string").alias("other"))


@register("SELECT c_custkey, c_name || '!' AS plain FROM customer")
def layered_bytes(t, spark):
    """Bytes as they were below up to five layers of base64."""
    body = F.concat("c_name", F.lit("!")).cast("binary")
    wrapped = F.when(F.col("c_custkey") % 3 == 0, body).when(F.col("c_custkey") % 3 == 1, F.base64(body).cast("binary")).otherwise(F.base64(F.base64(body).cast("binary")).cast("binary"))
    return t("customer").select("c_custkey", flatfile.inflated(wrapped).cast("string").alias("plain"))


@register("SELECT 'U' || p_partkey AS unii, p_name AS name FROM part WHERE p_partkey % 4 > 0 AND p_size % 5 > 0")
def tab_separated(t, spark):
    """Trimmed rows with a valid key."""
    at = workspace(spark, "tsv")
    key = F.when(F.col("p_partkey") % 4 > 0, F.concat(F.lit(" U"), _text("p_partkey"), F.lit(" "))).otherwise("  ")
    t("part").select(F.when(F.col("p_size") % 5 > 0, key).otherwise("bad-key").alias("UNII"), F.col("p_name").alias("NAME")).write.csv(at, sep="\t", header=True, quote="")
    got, _ = scan.tsv(spark, at, "UNII", F.col("UNII").rlike(r"^U\d+$"))
    return got.select(F.col("UNII").alias("unii"), F.col("NAME").alias("name"))


@register("SELECT 'customer' AS name, count(*) AS records FROM customer UNION ALL SELECT 'nation', count(*) FROM nation")
def snapshot_manifest(t, spark):
    """Tables written with their counts, sealed, and found as they were sealed."""
    at = workspace(spark, "snapshot")
    made = sink.snapshot({"customer": t("customer"), "nation": t("nation")}, at, ["customer"])
    manifest = spark.createDataFrame(made, "table string, records bigint, bytes bigint")
    state.validate(manifest, state.sealed(manifest, ["customer"]), ["customer"])
    return manifest.select(F.col("table").alias("name"), "records")


@register("SELECT unnest(['first', 'stale', 'second', 'same']) AS step, unnest([true, false, true, true]) AS moved, unnest(['a', 'a', 'b', 'a']) AS reads")
def pointer_swaps(t, spark):
    """A pointer moves only from what it reads; of two movers one succeeds, and it may come back to an earlier state."""
    at = f"{workspace(spark, 'pointer')}/latest.json"
    out = []
    for step, before, after in (("first", None, "a"), ("stale", "x", "c"), ("second", "a", "b"), ("same", "b", "a")):
        out.append((step, sink.swap_pointer(spark, at, before, after), sink.read_text(spark, at)))
    return spark.createDataFrame(out, "step string, moved boolean, reads string")


@register("SELECT count(*) AS n, min(c_custkey) AS lo, max(c_custkey) AS hi, true AS apart FROM customer")
def range_sharded(t, spark):
    """Files by range of the key, no two of which overlap."""
    files = sink.range_shards(t("customer"), "c_custkey", workspace(spark, "shards"), 4, 200)
    from pyspark.sql import Window

    # A row a file.
    apart = F.coalesce(F.lag("hi").over(Window.orderBy("lo")) < F.col("lo"), F.lit(True))
    return files.withColumn("apart", apart).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bool_and("apart").alias("apart"))


@register("SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer")
def rewritten_in_place(t, spark):
    """A table replaced by rows read from it."""
    at = workspace(spark, "rewrite")
    t("customer").select("c_custkey", "c_acctbal").write.parquet(at)
    sink.rewrite(spark.read.parquet(at).withColumn("c_acctbal", F.col("c_acctbal") + 1), at)
    return spark.read.parquet(at)


@register("SELECT c_custkey, c_name, 'cc0' AS license FROM customer")
def licensed_table(t, spark):
    """Data with its license beside it."""
    import json

    at = workspace(spark, "header")
    sink.with_header(t("customer").select("c_custkey", "c_name"), at, {"license": "cc0", "cursor": 7})
    meta = json.loads(sink.read_text(spark, f"{at}/_meta.json"))
    return spark.read.json(f"{at}/data", schema="c_custkey bigint, c_name string").withColumn("license", F.lit(meta["license"]))


@register("SELECT p_partkey, p_size % 3 = 0 AS a, p_size % 2 = 0 AS list, p_brand = 'Brand#1' AS literal, p_size % 2 = 0 AS holds FROM part")
def required_paths(t, spark):
    """Presence of dotted paths, lists, literals and list members."""
    r = t("part").select("p_partkey", F.struct(F.when(F.col("p_size") % 3 == 0, "x").alias("b")).alias("a"), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("l"), F.col("p_brand").alias("brand"))
    return r.select("p_partkey", paths.present("a.b").alias("a"), paths.present("l[]").alias("list"), paths.present("brand===Brand#1").alias("literal"), paths.present('l~~"x"').alias("holds"))


def _engine(t, spark):
    """A snapshot of the API's tables, made from the driver's, published and opened."""
    root = workspace(spark, "engine")
    c, o, li, e = t("customer"), t("orders"), t("lineitem"), t("events")
    s = lambda x: F.concat(F.lit("c"), F.col(x).cast("string"))
    tables = {
        "compounds": c.select(s("c_custkey").alias("id"), F.col("c_custkey").alias("pubchem_cid"), F.concat(F.lit("CHEMBL"), _text("c_custkey")).alias("chembl_id"), F.array("c_name", "c_mktsegment").alias("synonyms"), F.col("c_mktsegment").alias("iupac_name"), F.lit("C2").alias("molecular_formula")),
        "trials": o.select(_text("o_orderkey").alias("id"), _text("o_orderkey").alias("nct_id"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "RECRUITING").otherwise("OTHER").alias("status"), F.lit(1.0).alias("phase")),
        "trial_links": o.select(s("o_custkey").alias("compound_id"), _text("o_orderkey").alias("nct_id")),
        "bioactivities": li.select(_text("l_orderkey").alias("id"), s("l_suppkey").alias("compound_id"), _text("l_partkey").alias("target_id"), F.col("l_quantity").alias("value"), F.lit("nM").alias("unit"), (F.col("l_quantity") > 45).alias("is_active")),
        "papers": t("part").select(_text("p_partkey").alias("id"), F.col("p_name").alias("title"), (F.col("p_size") == 1).alias("is_retracted"), F.array(F.concat(F.lit("c"), _text("p_partkey"))).alias("mentioned_compounds")),
        "neg_evidence": e.select(_text("event_id").alias("id"), F.col("event_type").alias("evidence_type"), s("user_id").alias("subject_id"), F.when(F.col("value") > 240, "critical").when(F.col("value") > 100, "major").otherwise("minor").alias("severity")),
        "xrefs": c.select(F.lit("unii").alias("kind"), F.concat(F.lit("U"), F.lpad(_text("c_custkey"), 9, "0")).alias("id"), F.col("c_custkey").alias("pubchem_cid")),
        "targets": li.groupBy(F.concat(F.lit("P"), F.lpad(_text("l_suppkey"), 5, "0")).alias("target")).agg(F.array_sort(F.collect_set(_text("l_partkey"))).alias("compound_ids")).select("target", "compound_ids", F.array().cast("array<string>").alias("trial_ids"), F.array(F.lit("n")).alias("neg_ids")),
    }
    api.publish(tables, root, "one")
    return api.Engine(spark, root, {"chembl_id": "licensed"})


_COMPOUNDS = "SELECT 'c' || c_custkey AS id, c_custkey AS pubchem_cid, c_mktsegment AS iupac_name FROM customer"


@register(f"{_COMPOUNDS} WHERE c_custkey IN (7, 9)")
def engine_compound(t, spark):
    """A compound by number, and by another identifier, without what may not be shown."""
    e = _engine(t, spark)
    one, two = e.compound("CID:7"), e.resolve("UNII:U000000009")
    assert "chembl_id" not in one.columns
    return one.unionByName(two).select("id", "pubchem_cid", "iupac_name")


@register("""
WITH n AS (SELECT event_id::VARCHAR AS id, event_type AS evidence_type, CASE WHEN value > 240 THEN 'critical' WHEN value > 100 THEN 'major' ELSE 'minor' END AS severity FROM events WHERE user_id = 3 AND event_type IN ('error', 'view')) SELECT id, evidence_type, severity, (SELECT count(*) FROM n) AS total FROM n ORDER BY id LIMIT 5 OFFSET 2
""")
def engine_negative_evidence(t, spark):
    """A page of a subject's signals of two kinds, and their total."""
    known = {"error", "view"}
    e = _engine(t, spark)
    own = e.table("neg_evidence").where("subject_id = 'c3'").where(F.col("evidence_type").isin(*known))
    page = own.orderBy("id").offset(2).limit(5)
    return page.select("id", "evidence_type", "severity", F.lit(own.count()).cast("long").alias("total"))


@register("""
WITH t AS (SELECT 'c' || o_custkey AS id, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, count(*) FILTER (WHERE o_orderstatus = 'O') AS active FROM orders GROUP BY 1), a AS (SELECT 'c' || l_suppkey AS id, count(*) FILTER (WHERE l_quantity > 45) AS activities FROM lineitem GROUP BY 1),
p AS (SELECT 'c' || p_partkey AS id, 1 AS retracted FROM part WHERE p_size = 1), n AS (SELECT 'c' || user_id AS id, count(*) AS negatives, count(*) FILTER (WHERE value > 240) AS critical FROM events GROUP BY 1),
s AS (SELECT 'c' || c_custkey AS compound_id, coalesce(completed, 0) + coalesce(active, 0) AS trials, coalesce(activities, 0) AS activities, coalesce(negatives, 0) AS negatives, coalesce(critical, 0) AS critical, coalesce(retracted, 0) AS retracted FROM customer LEFT JOIN t ON t.id = 'c' || c_custkey LEFT JOIN a ON a.id = 'c' || c_custkey LEFT JOIN p ON p.id = 'c' || c_custkey LEFT JOIN n ON n.id = 'c' || c_custkey)
SELECT compound_id, trials::BIGINT AS trials, CASE WHEN critical > 0 THEN 'none' WHEN trials + activities = 0 AND negatives = 0 AND retracted = 0 THEN 'none' WHEN trials + activities = 0 AND retracted > 0 THEN 'weak' WHEN trials >= 2 AND negatives <= 2 THEN 'strong' WHEN trials + activities > 0 AND negatives = 0 THEN 'strong' WHEN trials + activities > 0 AND negatives > 2 THEN 'mixed' ELSE 'weak' END AS signal FROM s
""")
def engine_repurposing(t, spark):
    """The verdicts of all compounds of a snapshot at once."""
    return _engine(t, spark).repurposing().select("compound_id", "trials", "signal")


@register("SELECT o_orderkey::VARCHAR AS nct_id, 'trial' AS kind FROM orders WHERE o_custkey = 4 UNION ALL SELECT l_orderkey::VARCHAR, 'activity' FROM lineitem WHERE l_suppkey = 4 UNION ALL SELECT '4', 'paper'")
def engine_lists(t, spark):
    """A compound's trials, activities and papers."""
    e = _engine(t, spark)
    return e.trials("c4").select("nct_id", F.lit("trial").alias("kind")).union(e.bioactivities("c4").select("id", F.lit("activity"))).union(e.papers("c4").select("id", F.lit("paper")))


@register("SELECT 'P' || lpad(l_suppkey::VARCHAR, 5, '0') AS target, count(DISTINCT l_partkey)::INT AS n_compound_ids, 1::INT AS n_neg_ids, array_to_string(list_sort(list(DISTINCT l_partkey::VARCHAR)), ',') AS ids FROM lineitem WHERE l_suppkey = 8 GROUP BY 1")
def engine_target(t, spark):
    """A target's counts, and the ids of one section."""
    got = _engine(t, spark).target(" p00008", ("drugs",))
    return got.select("target", "n_compound_ids", "n_neg_ids", F.array_join("compound_ids", ",").alias("ids"))


@register("""
WITH s AS (SELECT 'c' || c_custkey AS id, CASE WHEN lower(c_mktsegment) = 'building' THEN 90 WHEN starts_with(lower(c_name), 'building') OR starts_with(lower(c_mktsegment), 'building') THEN 70 END AS score, c_custkey FROM customer) SELECT id, score::INT AS score FROM s WHERE score > 0 ORDER BY score DESC, c_custkey LIMIT 12
""")
def engine_search(t, spark):
    """The best compounds of a name, through the tool interface."""
    return _engine(t, spark).call("search", {"query": " building ", "limit": 12}).select("id", "score")

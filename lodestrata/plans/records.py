"""Source rows as records, row filters, layout of records, cursors and snapshots."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ident, numeric, rules
from ..operators import aggregate, dedup, index, normalise, state
from ..sources import scan
from .common import Registry

register = Registry()
QUERIES, ORACLE_SQL = register.queries, register.sql

_WHEN = "2024-02-01T00:00:00Z"


def _text(c):
    return F.col(c).cast("string")


@register("""
SELECT 'lode::compound::CID:' || p_partkey AS id, 'K' || p_partkey AS inchi_key, p_retailprice AS weight, CASE WHEN p_size % 4 > 0 THEN p_size / 8.0::DOUBLE END AS log_p, p_size % 9 AS donors,
  ((p_retailprice > 500)::INT + coalesce((p_size % 4 > 0 AND p_size / 8.0::DOUBLE > 5)::INT, 0) + (p_size % 9 > 5)::INT + (p_size % 15 > 10)::INT)::INT AS violations, coalesce(CASE WHEN p_size % 2 = 0 THEN p_name END, p_type) AS smiles, 'pubchem' AS source FROM part WHERE p_partkey % 10 > 0
""")
def normalise_compounds(t, spark):
    """Compound rows; a weight that comes as a string, absent fields, rows without a structure key."""
    p, k = t("part"), F.col("p_partkey")
    raw = p.select(
        k.alias("CID"), F.when(k % 10 > 0, F.concat(F.lit("K"), k.cast("string"))).alias("InChIKey"), F.col("p_retailprice").cast("string").alias("MolecularWeight"), F.when(F.col("p_size") % 4 > 0, F.col("p_size") / 8.0).alias("XLogP"),
        (F.col("p_size") % 9).alias("HBondDonorCount"), (F.col("p_size") % 15).alias("HBondAcceptorCount"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("SMILES"), F.col("p_type").alias("CanonicalSMILES"),
    )
    got = normalise.compounds(raw, F.lit(_WHEN))
    return got.select("id", "inchi_key", F.col("molecular_weight.value").alias("weight"), F.col("properties.log_p.value").alias("log_p"), F.col("properties.h_bond_donors").alias("donors"), F.col("properties.lipinski_violations").cast("int").alias("violations"), F.col("smiles_canonical").alias("smiles"), F.col("provenance.sources")[0]["source"].alias("source"))


@register("""
SELECT 'lode::compound::chembl::CHEMBL' || p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 4.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE END AS max_phase, p_partkey % 3 = 0 AS withdrawn, p_partkey % 5 IN (0, 1) AS black_box, array_to_string(list_filter([p_brand, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END], lambda x: x <> ''), ',') AS atc FROM part
""")
def normalise_molecules(t, spark):
    """Molecule rows and their drug status; phases that are no numbers, flags as numbers and words, empty codes."""
    k = F.col("p_partkey")
    raw = t("part").select(
        F.concat(F.lit("CHEMBL"), k.cast("string")).alias("molecule_chembl_id"), F.when(k % 4 == 0, "4.0").when(k % 4 == 1, "0.5").when(k % 4 == 2, "NaN").alias("max_phase"), (k % 3 == 0).alias("withdrawn_flag"),
        F.when(k % 5 == 0, "1").when(k % 5 == 1, "true").when(k % 5 == 2, "0").alias("black_box_warning"), F.array(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_type"))).alias("atc_classifications"),
    )
    got = normalise.molecules(raw, F.lit(_WHEN))
    return got.select("id", F.col("drug_status.max_phase").alias("max_phase"), F.col("drug_status.withdrawn").alias("withdrawn"), F.col("drug_status.black_box_warning").alias("black_box"), F.array_join("drug_status.atc_codes", ",").alias("atc"))


@register("""
WITH r AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS k, l_quantity * 40 AS v, CASE l_linenumber % 5 WHEN 0 THEN 'nM' WHEN 1 THEN 'uM' WHEN 2 THEN '%' WHEN 3 THEN 'furlong' END AS u, CASE l_suppkey % 4 WHEN 0 THEN 'IC50' WHEN 1 THEN 'Ki' WHEN 2 THEN 'Inhibition' ELSE 'other thing' END AS t, l_partkey FROM lineitem WHERE l_returnflag <> 'N'),
n AS (SELECT *, CASE u WHEN 'nM' THEN 'nM' WHEN 'uM' THEN 'uM' WHEN '%' THEN 'percent' WHEN 'furlong' THEN 'other' ELSE 'unitless' END AS unit, CASE t WHEN 'IC50' THEN 'IC50' WHEN 'Ki' THEN 'Ki' WHEN 'Inhibition' THEN 'inhibition' ELSE 'other' END AS kind, CASE u WHEN 'nM' THEN v WHEN 'uM' THEN v * 1000 END AS nm FROM r)
SELECT kind, unit, CASE WHEN kind IN ('IC50', 'Ki') AND nm IS NOT NULL THEN CASE WHEN nm < 1000 THEN 'yes' WHEN nm > 10000 THEN 'no' ELSE 'open' END WHEN kind = 'inhibition' AND unit = 'percent' THEN CASE WHEN v > 50 THEN 'yes' WHEN v < 20 THEN 'no' ELSE 'open' END ELSE 'open' END AS active, count(*) AS n, count(DISTINCT l_partkey) AS targets FROM n GROUP BY ALL
""")
def normalise_activities(t, spark):
    """Measurements with unit, kind and activity by their rules; values that don't count drop out."""
    n = F.col("l_linenumber") % 5
    raw = t("lineitem").select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey")).alias("activity_id"), F.when(F.col("l_returnflag") == "N", -F.col("l_quantity")).otherwise(F.col("l_quantity") * 40).cast("string").alias("standard_value"),
        F.when(n == 0, "nM").when(n == 1, "uM").when(n == 2, "%").when(n == 3, "furlong").alias("standard_units"), F.element_at(F.array(*[F.lit(x) for x in ("IC50", "Ki", "Inhibition", "other thing")]), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("standard_type"), _text("l_partkey").alias("target_chembl_id"),
    )
    got = normalise.activities(raw, F.lit(_WHEN))
    return got.groupBy(F.col("activity_type").alias("kind"), "unit", F.when(F.col("is_active"), "yes").when(~F.col("is_active"), "no").otherwise("open").alias("active")).agg(F.count("*").alias("n"), F.count_distinct("target_id").alias("targets"))


@register("""
WITH r AS (SELECT o_orderkey, 'NCT' || lpad(o_orderkey::VARCHAR, CASE WHEN o_orderkey % 11 = 0 THEN 7 ELSE 8 END, '0') AS nct, CASE o_orderstatus WHEN 'F' THEN 'TERMINATED' WHEN 'O' THEN 'SUSPENDED' ELSE NULL END AS st FROM orders)
SELECT 'lode::trial::' || nct AS id, coalesce(st, 'UNKNOWN') AS status, st IS NOT NULL AS is_negative_outcome, CASE WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 3 = 1 THEN 2 END::INT AS phase, (CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END)::INT AS interventions, (CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END)::INT AS references_kept FROM r WHERE length(nct) = 11
""")
def normalise_trials(t, spark):
    """Registry rows; malformed numbers, the highest phase of a list, nameless interventions and references without a number."""
    k = F.col("o_orderkey")
    raw = t("orders").select(
        F.concat(F.lit("NCT"), F.when(k % 11 == 0, F.lpad(k.cast("string"), 7, "0")).otherwise(F.lpad(k.cast("string"), 8, "0"))).alias("nctId"), F.when(F.col("o_orderstatus") == "F", "TERMINATED").when(F.col("o_orderstatus") == "O", "SUSPENDED").alias("overallStatus"),
        F.when(k % 3 == 0, F.array(F.lit("PHASE2"), F.lit("PHASE3"))).when(k % 3 == 1, F.array(F.lit("PHASE2_PHASE3"))).otherwise(F.array(F.lit("NA"))).alias("phases"),
        F.array(F.struct(F.lit("a").alias("name"), F.lit("DRUG").alias("type")), F.struct(F.when(k % 2 == 0, "b").otherwise("").alias("name"), F.lit("DRUG").alias("type"))).alias("interventions"),
        F.array(F.struct(F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, "12a").alias("pmid"), F.lit("BACKGROUND").alias("type"))).alias("references"),
    )
    got = normalise.trials(raw, F.lit(_WHEN))
    return got.select("id", "status", "is_negative_outcome", F.col("phase").cast("int").alias("phase"), F.size("interventions").alias("interventions"), F.size("references").alias("references_kept"))


@register("""
WITH r AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'HALTED' WHEN 1 THEN 'ENDED' WHEN 2 THEN 'ENDED_PREMATURELY' WHEN 3 THEN 'UNKNOWN' ELSE 'AUTHORISED' END AS status FROM customer)
SELECT 'lode::trial::2024-' || c_custkey AS id, status, status IN ('HALTED', 'ENDED_PREMATURELY') AS is_negative_outcome, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END::INT AS phase, (c_custkey % 3)::INT AS products FROM r
""")
def normalise_eu_trials(t, spark):
    """Rows of the European registry, states by number and by name."""
    k = F.col("c_custkey")
    raw = t("customer").select(
        F.concat(F.lit("2024-"), k.cast("string")).alias("ctNumber"), F.when(k % 5 == 0, "6").when(k % 5 == 1, "8").when(k % 5 == 2, "Ended prematurely").when(k % 5 == 3, "what").otherwise("Authorised").alias("ctStatus"),
        F.when(k % 2 == 0, "Phase I").otherwise("Therapeutic (Phase 2)").alias("trialPhase"), F.slice(F.array(F.lit("x"), F.lit("y"), F.lit("")), 1, (k % 3).cast("int")).alias("product"),
    )
    got = normalise.eu_trials(raw, F.lit(_WHEN))
    return got.select("id", "status", "is_negative_outcome", F.col("phase").cast("int").alias("phase"), F.size("interventions").alias("products"))


@register("""
WITH r AS (SELECT doc_id, string_split(text, ' ')[1:12] AS w, doc_id % 4 AS m FROM documents)
SELECT CASE WHEN m < 3 THEN 'lode::paper::W' || doc_id ELSE 'lode::paper::doi-10.1000_' || doc_id END AS id, CASE WHEN m > 0 THEN '10.1000/' || doc_id END AS doi, CASE WHEN m = 1 THEN doc_id::VARCHAR END AS pmid, substr(trim(array_to_string(w, ' ')), 1, 20000) AS abstract, m = 2 AS is_retracted, CASE WHEN m = 2 THEN 'openalex' END AS retraction_source FROM r
""")
def normalise_papers(t, spark):
    """Works; ids normalised, and abstracts put together from inverted indexes."""
    k = F.col("doc_id")
    words = F.transform(F.slice(F.split("text", " "), 1, 12), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    grouped = F.transform(F.array_distinct(F.transform("words", lambda x: x["w"])), lambda w: F.struct(w, F.transform(F.filter(F.col("words"), lambda x: x["w"] == w), lambda x: x["i"])))
    raw = t("documents").select(k, words.alias("words")).select(
        F.when(k % 4 < 3, F.concat(F.lit("https://example.org/W"), k.cast("string"))).otherwise("https://example.org/x").alias("id"), F.when(k % 4 > 0, F.concat(F.lit("https://doi.org/10.1000/"), k.cast("string"))).otherwise("none").alias("doi"),
        F.when(k % 4 == 1, F.concat(F.lit("https://example.org/"), k.cast("string"))).alias("pmid"), F.lit("a title").alias("title"), F.map_from_entries(grouped).alias("abstract_inverted_index"), (k % 4 == 2).alias("is_retracted"),
    )
    got = normalise.papers(raw, F.lit(_WHEN))
    return got.select("id", "doi", "pmid", "abstract", "is_retracted", "retraction_source")


@register("""
SELECT 'lode::drug_label::setid::s' || p_partkey AS id, substr(repeat(p_name, 40), 1, 500) AS title, (1 + (p_size % 2))::INT AS n_ndcs, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_size::VARCHAR END AS rxcui, p_partkey % 3 = 0 AS boxed, p_partkey % 3 < 2 AS extracted FROM part
""")
def normalise_labels(t, spark):
    """Labels; single codes as lists, empty items dropped, long titles cut."""
    k = F.col("p_partkey")
    sections = F.when(k % 3 == 0, F.create_map(F.lit("boxed_warning"), F.lit("w"))).when(k % 3 == 1, F.create_map(F.lit("warnings"), F.lit("w")))
    raw = t("part").select(F.concat(F.lit("s"), k.cast("string")).alias("setid"), F.repeat("p_name", F.lit(40)).alias("title"), F.array(F.lit("1"), F.when(F.col("p_size") % 2 == 1, "2").otherwise("")).alias("ndcs"), F.when(F.col("p_size") % 3 > 0, _text("p_size")).alias("rxcui"), sections.alias("sections"))
    got = normalise.labels(raw, F.lit(_WHEN))
    return got.select("id", "title", F.size("ndcs").alias("n_ndcs"), F.array_join("rxcui", ",").alias("rxcui"), F.col("has_boxed_warning").alias("boxed"), F.col("sections_extracted").alias("extracted"))


@register("""
SELECT 'atc_class' AS kind, count(*) AS n, min('lode::atc_class::' || n_name) AS first FROM nation WHERE n_nationkey % 4 > 0 UNION ALL
SELECT 'orangebook ' || CASE s_suppkey % 4 WHEN 0 THEN 'NDA' WHEN 1 THEN 'ANDA' WHEN 2 THEN 'BLA' ELSE 'OTHER' END, count(*), min('lode::orangebook::' || CASE s_suppkey % 4 WHEN 0 THEN 'NDA' WHEN 1 THEN 'ANDA' WHEN 2 THEN 'BLA' ELSE 'X' END || s_suppkey) FROM supplier GROUP BY 1 UNION ALL
SELECT 'nci ' || (CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END), count(*), min(p_name || '.') FROM part GROUP BY 1 UNION ALL
SELECT 'protein ' || CASE WHEN c_custkey % 2 = 0 THEN 'named' ELSE 'submitted' END, count(*), min(CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END) FROM customer GROUP BY 1
""")
def normalise_vocabularies(t, spark):
    """Classes, applications, thesaurus concepts and proteins, counted by what they become."""
    s, p, c = F.col("s_suppkey"), F.col("p_size"), F.col("c_custkey")
    a = normalise.classes(t("nation").select(F.when(F.col("n_nationkey") % 4 > 0, F.col("n_name")).alias("level5")), F.lit(_WHEN)).select(F.lit("atc_class").alias("kind"), F.col("id").alias("x"))
    kind = F.when(s % 4 == 0, "NDA").when(s % 4 == 1, "ANDA").when(s % 4 == 2, "BLA").otherwise("X")
    b = normalise.applications(t("supplier").select(F.concat(kind, s.cast("string")).alias("application_number")), F.lit(_WHEN)).select(F.concat(F.lit("orangebook "), F.col("application_type")), "id")
    names = F.array(F.struct(F.lit("PT").alias("termType"), F.col("p_name").alias("name")), F.struct(F.when(p % 2 == 0, "SY").otherwise("XX").alias("termType"), F.lit("s").alias("name")), F.struct(F.lit("AB").alias("termType"), F.lit("").alias("name")))
    d = normalise.terms(t("part").select(_text("p_partkey").alias("code"), names.alias("synonyms"), F.array(F.concat("p_name", F.lit("."))).alias("definitions")), F.lit(_WHEN)).select(F.concat(F.lit("nci "), F.size("synonyms").cast("string")), "definition")
    e = normalise.proteins(t("customer").select(_text("c_custkey").alias("primaryAccession"), F.when(c % 2 == 0, F.col("c_name")).alias("recommendedName"), F.array("c_mktsegment").alias("submissionNames"))).select(F.when(F.col("uniprot_accession").cast("long") % 2 == 0, "protein named").otherwise("protein submitted"), "protein_name")
    return a.union(b).union(d).union(e).groupBy("kind").agg(F.count("*").alias("n"), F.min("x").alias("first"))


@register("""
SELECT o_custkey, sum(CASE WHEN o_orderkey % 5 > 0 THEN 1 ELSE 0 END)::INT AS indications, sum(CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 THEN 1 ELSE 0 END)::INT AS trials, sum(CASE WHEN o_orderkey % 4 > 0 THEN 1 ELSE 0 END)::INT AS refs, sum(CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END ELSE 0 END)::INT AS ids FROM orders GROUP BY 1
""")
def row_mappers(t, spark):
    """Nested lists without items that lack their key, and references without ids."""
    k = F.col("o_orderkey")
    trial = F.struct(F.when(k % 3 > 0, k.cast("string")).otherwise("").alias("report_id"))
    one = F.struct(F.when(k % 5 > 0, k.cast("string")).alias("disease_id"), F.lit("3").alias("max_clinical_stage"), F.array(trial).alias("trials"))
    ref = F.struct(F.lit("x").alias("source"), F.when(k % 4 > 0, F.array(F.lit("1"), F.when(k % 2 == 0, "2").otherwise(""))).otherwise(F.array(F.lit(""))).alias("ids"))
    o = t("orders").groupBy("o_custkey").agg(F.collect_list(one).alias("i"), F.collect_list(ref).alias("r")).select("o_custkey", normalise.indications(F.col("i")).alias("i"), normalise.cross_references(F.col("r")).alias("r"))
    total = lambda c, f: F.aggregate(F.transform(c, lambda x: F.size(x[f])), F.lit(0), lambda a, b: a + b)
    return o.select("o_custkey", F.size("i").alias("indications"), total("i", "trials").alias("trials"), F.size("r").alias("refs"), total("r", "ids").alias("ids"))


@register("""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN 'K' END AS ik, CASE p_partkey % 3 WHEN 0 THEN ['unichem'] WHEN 1 THEN ['fda_srs'] END AS src, CASE WHEN p_size % 5 > 0 THEN 'U' END AS unii, CASE WHEN p_size % 2 = 0 THEN 'R' END AS rx, CASE WHEN p_size % 4 > 0 THEN p_size % 4 END AS ver, CASE WHEN p_size % 3 > 0 THEN 'a' END AS terms, CASE WHEN p_size % 6 > 0 THEN p_size % 6 - 1 END AS ph FROM part)
SELECT p_partkey, ik IS NOT NULL AND NOT coalesce(list_contains(src, 'unichem'), false) AS unichem, ik IS NOT NULL AND NOT coalesce(list_contains(src, 'fda_srs'), false) AS srs, unii IS NOT NULL AND rx IS NULL AS rxnorm, unii IS NOT NULL AND coalesce(ver, 0) < 2 AS label, unii IS NOT NULL AND (coalesce(ver, 0) < 3 OR terms IS NULL) AS reports, coalesce(ph >= 1, false) AS clinical FROM r
""")
def eligibility(t, spark):
    """Who is still to be enriched by five sources, and what is clinical; absent fields decide."""
    k, z = F.col("p_partkey"), F.col("p_size")
    r = t("part").select(
        k, F.when(k % 7 > 0, "K").alias("ik"), F.when(k % 3 == 0, F.array(F.lit("unichem"))).when(k % 3 == 1, F.array(F.lit("fda_srs"))).alias("src"), F.when(z % 5 > 0, "U").alias("unii"), F.when(z % 2 == 0, "R").alias("rx"),
        F.when(z % 4 > 0, z % 4).alias("ver"), F.when(z % 3 > 0, F.array(F.lit("a"))).alias("terms"), F.when(z % 6 > 0, z % 6 - 1).alias("ph"),
    )
    c = F.col
    both = r.select(k, normalise.lacks_source(c("ik"), c("src"), "unichem").alias("unichem"), normalise.lacks_source(c("ik"), c("src"), "fda_srs").alias("srs"), normalise.lacks_code(c("unii"), c("rx")).alias("rxnorm"), normalise.older_version(c("unii"), c("ver"), 2).alias("label"), normalise.unattempted(c("unii"), c("ver"), c("terms"), 3).alias("reports"))
    return both.join(normalise.clinical(r, "ph").select(k, F.lit(True).alias("clinical")), "p_partkey", "left").withColumn("clinical", F.coalesce("clinical", F.lit(False)))


@register("""
WITH r AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'RXNORM' WHEN 1 THEN 'MTHSPL' ELSE 'GS' END AS sab, CASE p_partkey % 5 WHEN 0 THEN 'O' WHEN 1 THEN '' ELSE 'N' END AS sup, CASE p_partkey % 4 WHEN 0 THEN 'SPA' ELSE 'ENG' END AS lat, CASE p_size % 2 WHEN 0 THEN 'NDC' ELSE 'UNII' END AS atn FROM part)
SELECT sab, count(*) FILTER (WHERE sup = 'N' AND lat = 'ENG') AS names, count(*) FILTER (WHERE sup <> 'O' AND (atn = 'UNII' OR sab <> 'GS')) AS attributes FROM r GROUP BY sab
""")
def vocabulary_filters(t, spark):
    """Rows of vocabularies by source, suppression and language."""
    k, z = F.col("p_partkey"), F.col("p_size")
    r = t("part").select(
        F.when(z % 3 == 0, "RXNORM").when(z % 3 == 1, "MTHSPL").otherwise("GS").alias("SAB"), F.when(k % 5 == 0, "O").when(k % 5 == 1, "").otherwise("N").alias("SUPPRESS"), F.when(k % 4 == 0, "SPA").otherwise("ENG").alias("LAT"), F.lit("c").alias("CODE"),
        F.when(z % 2 == 0, "NDC").otherwise("UNII").alias("ATN"), F.lit("1").alias("RXCUI"), F.lit(" v ").alias("ATV"),
    )
    names = None
    for s in ("RXNORM", "MTHSPL", "GS"):
        one = normalise.vocabulary_rows(r, s)
        names = one if names is None else names.union(one)
    n, a = names.groupBy("SAB").agg(F.count("*").alias("names")), normalise.attribute_rows(r).groupBy("SAB").agg(F.count("*").alias("attributes"))
    return r.select(F.col("SAB")).distinct().join(n, "SAB", "left").join(a, "SAB", "left").select(F.col("SAB").alias("sab"), F.coalesce("names", F.lit(0)).alias("names"), F.coalesce("attributes", F.lit(0)).alias("attributes"))


@register("""
SELECT p_brand AS name, substr(coalesce(NULL, p_type) || ' — aka: ' || p_name || ', b', 1, 120) AS snippet, p_partkey AS id FROM part
""".replace("\\u2014", "—"))
def index_entries(t, spark):
    """What a hit of the search index shows."""
    return index.entries(t("part"), "p_partkey", F.array("p_brand", "p_name", F.lit("b")), F.lit("z"), F.col("p_type"))


@register("""
WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS p, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}') AS content_hash FROM customer) SELECT c_custkey, (p // 64)::INT AS shard, (p % 64)::INT AS place, content_hash FROM n
""")
def record_locators(t, spark):
    """Shard and place of each record in key order, and its hash."""
    c = t("customer").select("c_custkey", "c_name")
    return index.locators(c, "c_custkey", c.schema, 64)


@register("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority || o_orderstatus, o_orderkey) AS place, substr(o_orderpriority, 1, 3) AS cut FROM orders")
def concatenated_order(t, spark):
    """Order by the concatenation of two columns, not by the one and then the other; texts cut to a length."""
    w = Window.partitionBy("o_custkey").orderBy(F.concat("o_orderpriority", "o_orderstatus"), "o_orderkey")
    return t("orders").select("o_orderkey", F.row_number().over(w).cast("long").alias("place"), F.substring("o_orderpriority", 1, 3).alias("cut"))


@register("SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey)) AS l_partkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def first_surfaced(t, spark):
    """Of a failed trial only the first compound that surfaced it is recorded."""
    return dedup.first_by(t("lineitem").where("l_returnflag = 'R'"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_partkey")


@register("""
WITH r AS (SELECT p_partkey, p_size * 1.0::DOUBLE AS v, CASE WHEN p_size % 3 = 0 THEN 'furlong' ELSE 'nM' END AS u, p_retailprice AS w, CASE WHEN p_partkey % 2 = 0 THEN 'nM' ELSE 'uM' END AS x FROM part), n AS (SELECT *, CASE u WHEN 'nM' THEN v END AS a, CASE x WHEN 'nM' THEN w ELSE w * 1000 END AS b FROM r), q AS (SELECT *, greatest(a, b) / least(a, b) AS ratio FROM n WHERE true)
SELECT p_partkey, w IS NOT NULL AS matched, CASE WHEN a IS NULL THEN NULL WHEN ratio < 10 THEN 'agree' WHEN ratio < 100 THEN 'soft_agree' ELSE 'conflict' END AS agreement FROM q
""")
def unit_agreement(t, spark):
    """Measurements compared across units; an unknown unit matches, and says nothing of agreement."""
    c = rules.compared(F.col("p_size").cast("double"), F.when(F.col("p_size") % 3 == 0, "furlong").otherwise("nM"), F.col("p_retailprice"), F.when(F.col("p_partkey") % 2 == 0, "nM").otherwise("uM"))
    return t("part").select("p_partkey", c.alias("c")).select("p_partkey", "c.matched", "c.agreement")


@register("""
WITH b AS (SELECT 's' || s_suppkey AS source, 'c' || s_suppkey AS cursor_id, (s_suppkey % 3 * 1000)::INT AS chunk_size, (s_suppkey % 4)::INT AS cycles FROM supplier WHERE s_suppkey % 5 > 0), r AS (SELECT 's' || s_suppkey AS source, 'n' || s_suppkey AS next_id, s_suppkey % 2 = 0 AS wrapped, (s_suppkey * 10)::INT AS processed FROM supplier WHERE s_suppkey % 3 > 0)
SELECT coalesce(b.source, r.source) AS source, CASE WHEN r.source IS NOT NULL THEN next_id ELSE cursor_id END AS cursor_id, coalesce(chunk_size, 5000)::INT AS chunk_size, coalesce(processed, 0)::INT AS processed_in_run, (coalesce(cycles, 0) + coalesce(wrapped::INT, 0))::INT AS cycles_completed FROM b FULL JOIN r ON b.source = r.source
""")
def cursor_table(t, spark):
    """Cursors after a run; complete cycles count up, chunk sizes stay, sources without a run keep theirs."""
    k = F.col("s_suppkey")
    s = lambda x: F.concat(F.lit(x), k.cast("string"))
    before = t("supplier").where("s_suppkey % 5 > 0").select(s("s").alias("source"), s("c").alias("cursor_id"), (k % 3 * 1000).cast("int").alias("chunk_size"), (k % 4).cast("int").alias("cycles_completed"))
    runs = t("supplier").where("s_suppkey % 3 > 0").select(s("s").alias("source"), s("n").alias("next_cursor_id"), (k % 2 == 0).alias("wrapped"), (k * 10).cast("int").alias("processed"), F.lit(1).alias("eligible"))
    return state.next_cursors(before, runs, F.lit(_WHEN)).select("source", "cursor_id", "chunk_size", "processed_in_run", "cycles_completed")


@register("""
SELECT c_custkey, 'snapshots/2024-02-01/77-2/neg-evidence/bucket-' || lpad((c_custkey % 1024)::VARCHAR, 4, '0') || CASE WHEN c_custkey % 3 = 0 THEN '/manifest.json' ELSE '/shard-' || lpad((c_custkey % 7)::VARCHAR, 3, '0') || '.bin' END AS key FROM customer
""")
def object_keys(t, spark):
    """Keys of shards and manifests below a snapshot's prefix."""
    prefix = state.object_prefix(state.snapshot_id("2024-02-01", "77", "2"))
    k = F.col("c_custkey")
    return t("customer").select(k, state.shard_key(F.lit(prefix), "neg-evidence", k % 1024, F.when(k % 3 > 0, k % 7)).alias("key"))


@register("""
SELECT doc_id, CASE WHEN regexp_matches(m, 'timeout|timed out') THEN 'timeout' WHEN regexp_matches(m, 'short read|short range read|etag|not found|disappeared|missing') THEN 'source_unavailable' WHEN regexp_matches(m, 'decompress|gunzip|incorrect header check|unexpected end|invalid|json|parse|unexpected token') THEN 'parse_failed' ELSE 'source_unavailable' END AS failure_class,
  regexp_matches(m, 'timeout|timed out') OR regexp_matches(m, 'short read|short range read|etag|not found|disappeared|missing') OR NOT regexp_matches(m, 'decompress|gunzip|incorrect header check|unexpected end|invalid|json|parse|unexpected token') AS retryable
FROM (SELECT doc_id, lower(['Request timed out', 'NoSuchKey: not found', 'Unexpected token < in JSON', 'gunzip: incorrect header check', 'etag drift', 'ECONNRESET', ''][doc_id % 7 + 1] || ' ' || substr(text, 1, 40)) AS m FROM documents)
""")
def load_failures(t, spark):
    """Failures of reads by class, and whether another try may help."""
    said = F.element_at(F.array(*[F.lit(x) for x in ("Request timed out", "NoSuchKey: not found", "Unexpected token < in JSON", "gunzip: incorrect header check", "etag drift", "ECONNRESET", "")]), (F.col("doc_id") % 7 + 1).cast("int"))
    f = scan.failure_class(F.concat(said, F.lit(" "), F.substring("text", 1, 40)))
    return t("documents").select("doc_id", f.alias("f")).select("doc_id", "f.failure_class", "f.retryable")


@register("SELECT count(*) AS tables, sum(n)::BIGINT AS records, sum(n * 10)::BIGINT AS bytes, sum(n * 25)::BIGINT AS raw_bytes, sum(n * 25)::DOUBLE / sum(n * 10) AS ratio FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)")
def snapshot_totals(t, spark):
    """Records, bytes and ratio over a snapshot's tables."""
    m = t("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("records")).select("records", (F.col("records") * 10).alias("bytes"), (F.col("records") * 25).alias("raw_bytes"))
    return aggregate.totals(m)


@register("""
WITH n AS (SELECT 'chebi_id' AS kind, 'CHEBI:' || p_partkey AS x FROM part UNION ALL SELECT 'rxcui', 'RX' || p_partkey FROM part UNION ALL SELECT 'unii', ' a' || p_partkey || ' ' FROM part)
SELECT kind, min(CASE kind WHEN 'chebi_id' THEN 'CHEBI:' || regexp_extract(x, '([0-9]+)$', 1) WHEN 'rxcui' THEN regexp_extract(x, '([0-9]+)$', 1) ELSE upper(trim(x)) END) AS first, count(*) AS n FROM n GROUP BY kind
""")
def normalized_identifiers(t, spark):
    """external ids as they stand in indexes."""
    from ..functions.text import normalized_identifier

    k = _text("p_partkey")
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("kind"), b.alias("x")) for a, b in (("chebi_id", F.concat(F.lit("CHEBI:"), k)), ("rxcui", F.concat(F.lit("RX"), k)), ("unii", F.concat(F.lit(" a"), k, F.lit(" "))))]))
    return t("part").select(each.alias("e")).groupBy("e.kind").agg(F.min(normalized_identifier(F.col("e.kind"), F.col("e.x"))).alias("first"), F.count("*").alias("n"))


@register("""
SELECT p_partkey, nullif(lower(trim('  ' || p_name || ' ')), '') AS cleaned, coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, ''), p_type) AS filled, substr(regexp_replace(lower(p_name || p_type), '[^a-z0-9]', '', 'g'), 1, 80) AS print, upper(trim(split_part(p_brand || ':x' || p_size, ':', 1))) AS prefix, CASE WHEN p_size % 3 = 0 THEN 'a:b' || p_partkey END AS tail,
  (CASE WHEN p_size % 2 = 0 THEN 1 ELSE 2 END)::INT AS kept, make_date(2020 + (p_size % 5)::INT, (p_size % 12 + 1)::INT, (p_partkey % 28 + 1)::INT) AS day, (p_size + 3)::BIGINT AS total, CASE p_size % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'major' ELSE 'minor' END AS worst FROM part
""")
def text_functions(t, spark):
    """Small functions over strings, dates and lists."""
    from ..functions import text

    k, z = F.col("p_partkey"), F.col("p_size")
    date = F.concat_ws("/", (z % 12 + 1).cast("string"), (k % 28 + 1).cast("string"), (2020 + z % 5).cast("string"))
    tail = F.when(z % 3 == 0, F.concat(F.lit("lode::A::B"), k.cast("string"))).when(z % 3 == 1, "other::x").otherwise("lode::")
    return t("part").select(
        k, text.clean(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("cleaned"), text.first_filled(F.when(z % 2 == 0, "").otherwise(F.col("p_brand")), F.col("p_type")).alias("filled"), text.title_print(F.concat("p_name", "p_type")).alias("print"),
        text.xref_parts(F.concat("p_brand", F.lit(":x"), z.cast("string")))["prefix"].alias("prefix"), text.id_tail(tail, "lode::").alias("tail"), F.size(text.safe_list(F.array(F.lit("a"), F.when(z % 2 == 0, "").otherwise("b"), F.lit(None)))).alias("kept"),
        numeric.us_date(date).alias("day"), numeric.nested_sum(F.array(F.struct(z.alias("n")), F.struct(F.lit(3).alias("n")), F.struct(F.lit(None).cast("int").alias("n"))), "n").alias("total"),
        numeric.best_by(F.array(F.lit("minor"), F.when(z % 3 == 0, "critical").when(z % 3 == 1, "major").otherwise("odd")), {"critical": 3, "major": 2, "minor": 1}).alias("worst"),
    )


@register("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'P' || lpad((c_custkey % 100000)::VARCHAR, 5, '0') END AS accession FROM customer")
def target_accessions(t, spark):
    """Protein accessions in upper case; others null."""
    from ..functions.text import target_accession

    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, "P1234").when(k % 4 == 1, F.concat(F.lit(" p"), F.lpad((k % 100000).cast("string"), 5, "0"))).when(k % 4 == 2, k.cast("string")).otherwise("")
    return t("customer").select(k, target_accession(raw).alias("accession"))


@register("SELECT p_partkey, sha256('x:' || p_name) AS h FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) AND p_size % 4 < 2 AND p_partkey % 3 < 2")
def enrichment_queue(t, spark):
    """Rows of an older version that haven't failed too often, and aren't known to have no answer."""
    p = t("part").withColumn("version", F.col("p_size") % 4).withColumn("attempts", F.when(F.col("p_partkey") % 3 < 2, 2).otherwise(3))
    due = state.to_enrich(p, "version", 2, "attempts")
    got = state.without_misses(due, t("lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return got.select("p_partkey", F.sha2(F.concat(F.lit("x:"), "p_name"), 256).alias("h"))


@register("""
SELECT c_custkey, CASE WHEN c_acctbal > 9000 AND c_custkey % 2 = 0 THEN 'dose,count' WHEN c_acctbal > 9000 THEN 'dose' WHEN c_custkey % 2 = 0 THEN 'count' ELSE '' END AS conflicts, CASE WHEN c_nationkey::VARCHAR <> '' AND c_custkey::VARCHAR <> '' AND c_custkey % 3 > 0 THEN c_custkey || '::' || c_nationkey END AS link,
  CASE WHEN c_custkey % 10 < 3 THEN 'hardfail' WHEN c_custkey % 10 < 6 THEN 'warn' ELSE 'info' END AS tier, xor(xor(c_custkey, c_custkey * 3), c_nationkey)::BIGINT AS checksum FROM customer
""")
def record_checks(t, spark):
    """Named conflicts, tiers by percentage, link keys and checksums of offsets."""
    from ..operators import merge, quality

    k = F.col("c_custkey")
    return t("customer").select(
        k, F.array_join(rules.conflicts([("dose", F.col("c_acctbal") > 9000), ("count", k % 2 == 0)]), ",").alias("conflicts"), merge.link_key(F.when(k % 3 > 0, k), F.col("c_nationkey")).alias("link"),
        quality.severity_tier((k % 10 * 10).cast("double"), 30.0, 60.0).alias("tier"), ident.xor_checksum(F.array(k, k * 3, F.col("c_nationkey").cast("long"))).alias("checksum"),
    )


@register("""
WITH x AS (SELECT p_partkey % 900 AS k, 'old' AS src FROM part WHERE p_partkey % 2 = 0 AND p_partkey < 900), n AS (SELECT p_partkey % 900 AS k FROM part WHERE p_partkey < 900) SELECT sha256('s' || k) AS sid_s, 'old' AS src FROM x UNION ALL SELECT sha256('s' || k), 'new' FROM n WHERE k NOT IN (SELECT k FROM x)
""")
def crosswalk_append(t, spark):
    """A crosswalk with entries whose id it doesn't have; what it has stays as it is."""
    from ..operators import stamp

    k = t("part").where("p_partkey < 900").select(F.sha2(F.concat(F.lit("s"), _text("p_partkey")), 256).alias("sid_s"), "p_partkey")
    old = k.where("p_partkey % 2 = 0").select("sid_s", F.lit("old").alias("src"))
    return stamp.append(old, k.select("sid_s", F.lit("new").alias("src")))


@register("""
WITH r AS (SELECT CASE WHEN event_id % 40 > 0 THEN user_id END AS k, event_type, event_id, strftime(ts, '%Y-%m-%d') AS run FROM events), w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY run DESC) AS n FROM (SELECT k, run, max(event_id) AS last FROM r WHERE k IS NOT NULL GROUP BY 1, 2))
SELECT k, run, last FROM w WHERE n = 1 UNION ALL SELECT NULL, run, event_id FROM r WHERE k IS NULL
""")
def latest_runs(t, spark):
    """Of many runs the latest one's row for each key; rows without a key all stay."""
    from ..operators import merge

    e = t("events").select(F.when(F.col("event_id") % 40 > 0, F.col("user_id")).alias("k"), F.date_format("ts", "yyyy-MM-dd").alias("run"), F.col("event_id").alias("last"))
    keyed = e.where("k is not null").groupBy("k", "run").agg(F.max("last").alias("last"))
    return merge.runs(keyed.unionByName(e.where("k is null")), "k", "run")


@register("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'unichem' ELSE 'x' END AS source, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN true END AS matched FROM customer
""")
def bootstrap_flags(t, spark):
    """A flag set where a source list and an identifier say so."""
    from ..operators import merge

    k = F.col("c_custkey")
    ids = F.struct(F.array(F.when(k % 3 == 0, "unichem").otherwise("x")).alias("sources"), F.when(k % 2 == 0, "U").alias("unii"), F.lit(None).cast("boolean").alias("unichem_matched"))
    c = t("customer").select(k, ids.alias("ids"))
    got = c.select(k, merge.bootstrap_flag(F.col("ids"), c.schema["ids"].dataType).alias("ids"))
    return got.select(k, F.col("ids.sources")[0].alias("source"), F.col("ids.unichem_matched").alias("matched"))


@register("""
SELECT unnest(['snomed', 'mesh']) AS vocabulary, unnest(['sid_c,sid_s', 'code,preferred_str,sid_c,sid_s']) AS columns, (SELECT count(*) FROM nation) AS n
""")
def public_projections(t, spark):
    """What public projections of vocabularies show."""
    from ..operators import rights

    n = t("nation").select(_text("n_nationkey").alias("sid_s"), _text("n_regionkey").alias("sid_c"), F.col("n_name").alias("code"), F.col("n_name").alias("preferred_str"), F.lit("private").alias("cui"))
    out = None
    for v in ("snomed", "mesh"):
        got = rights.public(n, v)
        one = got.agg(F.count("*").alias("n")).select(F.lit(v).alias("vocabulary"), F.lit(",".join(sorted(got.columns))).alias("columns"), "n")
        out = one if out is None else out.union(one)
    return out


@register("""
SELECT unnest(['anomaly', 'hold', 'advance', 'first', 'lost', 'same', 'merge', 'empty', 'page', 'last_page', 'token', 'incomplete', 'html', 'json', 'share', 'prune', 'breaker', 'bucket', 'drained', 'frozen', 'bisected']) AS what,
  unnest(['anomaly_zero_fetch_hold:5', 'no_updates_hold:5', 'advance:7', 'first_run_skip', 'sentinel_present_pointer_missing', 'same_run_skip', 'merge', 'empty_buffer_abort', 'True', 'False', '9', '5', 'True', 'False', 'b,d', 's1', 'False,False,False,True', '0.0,0.5', '3:25:backlog_exhausted', 'True', 'a,c|b']) AS decision
""")
def run_decisions(t, spark):
    """Decisions between runs, which are the driver's."""

    def fetch(ids):
        if "b" in ids and len(ids) > 1:
            raise ValueError("refused")
        return {i: {} for i in ids if i != "b"}

    breaker, bucket = state.Breaker(2), state.TokenBucket(2.0)
    d = state.drain(25, lambda n: 10.0, 10, 1000.0, 10.0)
    found, none = scan.bisecting(["a", "b", "c"], fetch)
    out = {
        "anomaly": ":".join(state.cursor_decision(0, "5", "7")), "hold": ":".join(state.cursor_decision(3, "5", "7", False)), "advance": ":".join(state.cursor_decision(3, "5", "7")),
        "first": state.merge_decision(None, "r", False, True), "lost": state.merge_decision(None, "r", True, True), "same": state.merge_decision({"run_id": "r"}, "r", True, True), "merge": state.merge_decision({"run_id": "q"}, "r", True, True), "empty": state.merge_decision({"run_id": "q"}, "r", True, False),
        "page": str(scan.should_fetch_next(1, 10, 10, 25, 5)), "last_page": str(scan.should_fetch_next(3, 5, 10, 25, 5)), "token": scan.next_token("5", "9", True), "incomplete": scan.next_token("5", "9", False), "html": str(scan.html_guard("  <!DOCTYPE html><p>")), "json": str(scan.html_guard("{}")),
        "share": ",".join(scan.worker_share(list("abcd"), 1, 2)), "prune": ",".join(state.prunable(["s1", "s2", "s3", "s4"], "s2", 2)), "breaker": ",".join(str(breaker.record(x)) for x in (False, True, False, False)), "bucket": ",".join(str(bucket.wait(0.0)) for _ in range(2)),
        "drained": f"{d.chunks}:{d.processed}:{d.stop_reason}", "frozen": str(state.frozen("a", "a", 5, 0)), "bisected": ",".join(sorted(found)) + "|" + ",".join(sorted(none)),
    }
    return spark.createDataFrame(list(out.items()), "what string, decision string")

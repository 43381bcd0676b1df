import base64
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.functions import ident, numeric, paths, rules, text


def one(spark, c, **cols):
    """The value of an expression over one row of string or number columns."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return row.select(c.alias("x")).first()["x"]


def each(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def fnv(data, width=1):
    h = 2166136261
    for i in range(0, len(data), width):
        h = (h ^ int.from_bytes(data[i : i + width], "big")) * 16777619 % 2**32
    return h


def test_fnv_public_vectors(spark):
    assert each(spark, ident.fnv1a, ["", "a", "foobar", None]) == [0x811C9DC5, 0xE40C292C, 0xBF9CF968, None]


def test_fnv_bytes_and_units(spark):
    words = ["é", "日本", "\U0001f600x", "plain"]
    assert each(spark, ident.fnv1a, words) == [fnv(w.encode()) for w in words]
    assert each(spark, ident.fnv1a_utf16, words) == [f"{fnv(w.encode('utf-16-be'), 2):08x}" for w in words]


def test_sid_is_null_without_payload(spark):
    import hashlib

    want = hashlib.sha256(b"ns:small_molecule:v1:KEY").hexdigest()[:32]
    assert each(spark, lambda v: ident.sid("ns", "small_molecule", "v1", v), ["KEY", None]) == [want, None]


def test_uuid5(spark):
    import hashlib
    import uuid

    space = uuid.UUID(bytes=hashlib.sha256(b"seed").digest()[:16])
    assert each(spark, lambda v: ident.uuid5("seed", v), ["a", "ü"]) == [str(uuid.uuid5(space, x)) for x in ("a", "ü")]


def test_canonical_json_orders_keys_and_keeps_nulls(spark):
    df = spark.sql("select named_struct('b', 1, 'a', array(named_struct('z', cast(null as int), 'y', 'x'))) as r")
    got = df.select(ident.canonical_json(F.col("r"), df.schema["r"].dataType).alias("j")).first()["j"]
    assert got == '{"a":[{"y":"x","z":null}],"b":1}'


def test_anchor_prefers_the_first(spark):
    df = spark.createDataFrame([("10.1/x", "W1"), ("", "W2"), (None, None)], "doi string, openalex_id string")
    got = [r["a"] and tuple(r["a"]) for r in df.select(ident.anchor("paper", df.columns).alias("a")).collect()]
    assert got == [("10.1/x", "paper.doi.v1.0"), ("W2", "paper.openalex.v1.0"), None]


def test_tokens(spark):
    assert each(spark, text.search_tokens, ["Aspirin (acetyl-salicylic) ÉTÉ a x1", None, "b b"]) == [["aspirin", "acetyl", "salicylic", "été", "x1"], [], []]
    assert each(spark, text.link_tokens, ["The Blood, the b5; pH", None]) == [["the", "blood"], []]


def test_normalisers(spark):
    assert each(spark, text.clean, ["  Ab ", " ", None]) == ["ab", None, None]
    assert each(spark, text.doi, ["https://doi.org/10.1234/AB", "http://dx.doi.org/10.99/x", "10.12/x", None]) == ["10.1234/ab", None, None, None]
    assert each(spark, lambda v: text.doi(v, trailing=True), ["10.1234/ab."]) == ["10.1234/ab"]
    assert each(spark, text.accession, [" p12345-2 ", "", None]) == ["P12345", None, None]
    assert each(spark, text.trial_ids, ["NCT00000001 NCT00000002 NCT00000001", None]) == [["NCT00000001", "NCT00000002"], []]


@pytest.mark.parametrize(
    "raw, want",
    [("0042-0220-01", "00042022001"), ("50242-040-62", "50242004062"), ("12345-6789-0", "12345678900"), ("12345-6789-01", "12345678901"), ("12345678901", "12345678901"), ("1-2-3", None), ("1234567890", None), ("", None), (None, None), ("abcd-1234-12", None)],
)
def test_ndc(spark, raw, want):
    assert each(spark, text.ndc11, [raw]) == [want]


def test_names(spark):
    assert each(spark, text.is_code, ["50-78-2", "CHEBI:15365", "NSC-123456", "x" * 81, "12,3-[4]", "Aspirin", "", None]) == [True] * 5 + [False, True, True]
    assert each(spark, text.shortest_name, [["50-78-2", "Tylenol", "Aspirin", "Acetaminophen"], ["50-78-2"]], "array<string>") == ["Tylenol", None]


def test_identifier_chain(spark):
    raw = ["CID:2244", "2244", "chembl25", "bsynrymutxbxsq-uhfffaoysa-n", "UNII:r16co5y76e", "DB00945", "chebi:15365", "kegg:d00109", "RXCUI:1191", "what", None]
    want = [("pubchem_cid", "2244")] * 2 + [("chembl_id", "CHEMBL25"), ("inchi_key", "BSYNRYMUTXBXSQ-UHFFFAOYSA-N"), ("unii", "R16CO5Y76E"), ("drugbank_id", "DB00945"), ("chebi_id", "CHEBI:15365"), ("kegg_drug_id", "D00109"), ("rxcui", "1191"), None, None]
    assert [x and tuple(x) for x in each(spark, text.identifier, raw)] == want


def test_compound_number(spark):
    assert each(spark, text.compound_number, ["CID%3A2244", "0", "10000000000", "10000000001", "x", "%zz", None]) == [2244, None, 10_000_000_000, None, None, None, None]


def test_small_parsers(spark):
    assert tuple(each(spark, text.disease_parts, ["MONDO_0005148"])[0]) == ("mondo", "0005148", "MONDO", "mondo:0005148", "disease.mondo.v1.0")
    assert each(spark, text.disease_parts, ["NCIT_C1"])[0]["anchor_payload"] == "unclassified_ontology:NCIT_C1"
    assert each(spark, text.disease_parts, ["_x", "1_x", None]) == [None] * 3
    assert [x and tuple(x) for x in each(spark, text.xref_parts, ["umls:C1", "A:b:c", "none", ":x"])] == [("UMLS", "C1"), ("A", "b:c"), None, None]
    assert each(spark, lambda v: text.id_tail(v, "lode::neg::"), ["lode::neg::trial::NCT1", "lode::neg::", "x", "lode::neg::é"]) == ["trial:nct1", None, None, None]
    assert each(spark, text.strip_markup, ["<b>a &amp;lt; b</b>\n <i>c</i>"]) == ["a &lt; b c"]
    assert each(spark, text.abstract, [{"b": [1], "a": [0, 2]}], "map<string,array<int>>") == ["a b a"]


def test_units_and_activity(spark):
    df = spark.createDataFrame([(999.0, "nM", "IC50"), (1.0, "uM", "IC50"), (10.0, "uM", "Ki"), (11.0, "uM", "Ki"), (50.0, "percent", "inhibition"), (51.0, "percent", "inhibition"), (19.9, "percent", "inhibition"), (None, "nM", "IC50"), (-1.0, "nM", "IC50"), (1.0, "other", "IC50"), (float("nan"), "nM", "IC50")], "v double, u string, k string")
    got = [r["a"]["is_active"] for r in df.select(rules.activity(F.col("v"), F.col("u"), F.col("k")).alias("a")).collect()]
    assert got == [True, None, None, False, None, True, False, None, None, None, None]


def test_ki_kd_compat(spark):
    assert each(spark, rules.activity_type, ["Ki", "kd", "IC50", "% Inhibition", "x", None]) == ["Ki", "Kd", "IC50", "inhibition", "other", "other"]
    assert each(spark, lambda v: rules.activity_type(v, compat_ki_kd=True), ["Ki", "IC50"]) == ["other", "IC50"]


def test_source_scores(spark):
    got = each(spark, lambda s: rules.source_score(s, F.lit(False), F.lit(False)), [["pubchem"], ["x"], ["pubchem", "chembl"], ["pubchem", "pubchem"], [], None], "array<string>")
    assert got == [50, 40, 90, 90, 0, 0]
    assert each(spark, lambda s: rules.source_score(s, F.lit(True), F.lit(True)), [["pubchem"], ["pubchem", "chembl"]], "array<string>") == [35, 65]


def test_verdict_order(spark):
    cases = [((0, 0, 0, 0, 0), "none"), ((5, 5, 1, 1, 0), "none"), ((0, 0, 0, 0, 2), "weak"), ((2, 0, 2, 0, 0), "strong"), ((1, 0, 0, 0, 0), "strong"), ((1, 1, 3, 0, 0), "mixed"), ((1, 0, 1, 0, 0), "weak"), ((0, 0, 1, 0, 0), "weak")]
    df = spark.createDataFrame([(*c, w) for c, w in cases], "t int, a int, n int, c int, r int, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", rules.verdict(*(F.col(x) for x in "tancr")).alias("got")).collect())


def test_failure_categories(spark):
    raw = ["adverse events", "lack of funding", "slow accrual; lack of funding", "", None, "nothing of the kind", "COVID-19 pandemic", "sae seen", "SAE seen"]
    got = [(x["category"], x["confidence"]) for x in each(spark, rules.failure_category, raw)]
    assert got == [("SAFETY", 80), ("FUNDING", 85), ("FUNDING", 75), ("OTHER", 0), ("OTHER", 0), ("OTHER", 30), ("COVID", 90), ("OTHER", 30), ("SAFETY", 80)]


def test_filters():
    assert rules.event_filter(None) is None and rules.event_filter("  ") is None
    assert rules.event_filter("nope") == []
    assert rules.event_filter(" Paper_Retraction,trial_failure,trial_failure") == ["paper_retraction", "trial_failure"]
    assert rules.event_filter(",".join(["x"] * 10 + ["trial_failure"])) == []


def test_tiers_at_thresholds(spark):
    assert each(spark, rules.event_severity, [99, 100, 999, 1000], "int") == ["minor", "major", "major", "critical"]
    assert each(spark, rules.report_severity, [99, 100, 1000, 10000], "int") == ["unknown", "minor", "major", "critical"]


def test_numbers(spark):
    assert each(spark, lambda v: numeric.half_up(v, 2), [0.125, 2.675, -0.125], "double") == [0.13, 2.68, -0.12]
    assert each(spark, numeric.int8, [[0.5, -2.0, 1.0, 0.0039]], "array<double>") == [[64, -128, 127, 0]]
    assert each(spark, numeric.us_date, ["1/2/2024 0:00", "13/1/2024", None])[1:] == [None, None]
    assert str(each(spark, numeric.us_date, ["1/2/2024 0:00"])[0]) == "2024-01-02"
    assert each(spark, numeric.phase, [["PHASE1", "PHASE3"], ["NA"], [], None], "array<string>") == [3, None, None, None]
    assert one(spark, numeric.percent(F.lit(0), F.lit(0))) == 100.0 and one(spark, numeric.percent(F.lit(0), F.lit(0), None)) is None
    assert each(spark, numeric.ewma, [[10.0, 20.0], []], "array<double>") == [17.0, 0.0]
    assert one(spark, numeric.best_by(F.array(F.lit("Class III"), F.lit("Class I"), F.lit("?")), {"Class I": 3, "Class III": 1})) == "Class I"


@settings(max_examples=15, deadline=None)
@given(st.binary(min_size=5, max_size=40), st.binary(min_size=5, max_size=40))
def test_tanimoto(spark, a, b):
    n = min(len(a), len(b))
    both = sum((x & y).bit_count() for x, y in zip(a[4:n], b[4:n], strict=True))
    either = sum((x | y).bit_count() for x, y in zip(a[4:n], b[4:n], strict=True))
    got = one(spark, numeric.tanimoto(F.lit(base64.b64encode(a).decode()), F.lit(base64.b64encode(b).decode())))
    assert math.isclose(got, both / either if either else 0.0)


def test_freshness(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    assert each(spark, lambda v: numeric.is_fresh(v, now, 7), ["2024-01-30T00:00:00Z", "2024-01-01T00:00:00Z", "2025-01-01T00:00:00Z", "junk", None]) == [True, False, True, False, False]


def test_paths(spark):
    df = spark.sql("select named_struct('b', 1, 'l', array('x'), 'e', cast(array() as array<string>), 's', 'on', 'n', cast(null as string)) as a")
    want = {"a.b": True, "a.l[]": True, "a.e[]": False, "a.n": False, "a.s===on": True, 'a.s==="off"': False, 'a.l~~"x"': True, 'a.n===x': False}
    got = df.select(*[paths.present(p).alias(f"c{i}") for i, p in enumerate(want)]).first()
    assert list(got) == list(want.values())
    assert df.select(paths.missing(list(want)).alias("m")).first()["m"] == [p for p, v in want.items() if not v]


def test_ewma_without_restart(spark):
    got = each(spark, lambda x: F.round(numeric.ewma(x, restart=False), 9), [[10.0, 20.0], [0.0, 20.0], [0.0, 0.0, 5.0], [3.0], [], [None, 1.0], [1.0, None, 2.0]], "array<double>")
    assert got == [17.0, 14.0, 3.5, 3.0, None, None, None]
    assert each(spark, numeric.ewma, [[0.0, 20.0]], "array<double>") == [20.0]

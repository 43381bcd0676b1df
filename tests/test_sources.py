import gzip
import hashlib
import io
import json
import random
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources import flatfile, scan, sink

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


@pytest.fixture
def lines(tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('#{"license":"cc0"}\n{"a":1,"b":"x"}\n\n{"a":bad}\n{"b":"y","c":3}\n')
    return str(p)


def test_jsonl_scans(spark, lines, tmp_path):
    assert scan.jsonl_strict(spark, str(tmp_path / "none.jsonl"), SCHEMA).count() == 0
    with pytest.raises(Exception):
        scan.jsonl_strict(spark, lines, SCHEMA).collect()
    assert {r["b"] for r in scan.jsonl_lenient(spark, lines, SCHEMA).collect()} == {"x", "y"}
    got = scan.jsonl_counting(spark, lines, SCHEMA, header=True).collect()
    assert sorted(r["malformed"] for r in got) == [False, False, True]
    assert {r["record"]["b"] for r in got if r["record"]} == {"x", "y"}


def test_filtered_scan_observes(spark):
    df, seen = scan.filtered(spark.range(10), F.col("id") > 6, "f")
    assert df.count() == 3 and seen.get == {"seen": 10, "kept": 3}


def test_delimited(spark, tmp_path):
    (tmp_path / "r.rrf").write_text('C1|ENG|a "quoted|x|\nC2|FRE|b|\n')
    got = scan.rrf(spark, str(tmp_path / "r.rrf"), ["cui", "lat", "str", "code"]).orderBy("cui").collect()
    assert [tuple(r) for r in got] == [("C1", "ENG", 'a "quoted', "x"), ("C2", "FRE", "b", None)]
    (tmp_path / "c.csv").write_text('n,t\n1,"say ""hi"", you"\n')
    assert scan.csv_rows(spark, str(tmp_path / "c.csv")).first()["t"] == 'say "hi", you'
    (tmp_path / "t.tsv").write_text("UNII\tname\n ABC \tx\n\ty\nTOOLONG\tz\n")
    df, seen = scan.tsv(spark, str(tmp_path / "t.tsv"), "UNII", F.length("UNII") == 3)
    assert [tuple(r) for r in df.collect()] == [("ABC", "x")] and seen.get == {"processed": 3, "dropped": 2}


def test_protein_records(spark, tmp_path):
    (tmp_path / "p.dat").write_text(
        "ID   ONE_HUMAN   Reviewed;  120 AA.\nAC   P11111; Q22222;\nDE   RecName: Full=Protein one {ECO:1};\nGN   Name=ONE {ECO:2}; Synonyms=UNO;\nOS   Homo sapiens\nOS   (Human).\nOX   NCBI_TaxID=9606;\n"
        "CC   -!- FUNCTION: Does a thing\nCC       and another {ECO:3}.\nCC   -!- SUBUNIT: None.\nDR   PDB; 1ABC; X-ray.\nDR   HGNC; HGNC:1; ONE.\nSQ   SEQUENCE   120 AA;  1 MW;\n     MAAA\n//\n"
        "ID   TWO   x\nAC   P33333;\n//\nID   BAD\n//\n"
    )
    got = flatfile.proteins(flatfile.records(spark, str(tmp_path / "p.dat"), "//")).orderBy("accession").collect()
    assert [r["accession"] for r in got] == ["P11111", "P33333"]
    r = got[0]
    assert (r["secondary"], r["name"], r["gene"], r["organism"], r["taxon"], r["length"]) == (["Q22222"], "Protein one", "ONE", "Homo sapiens (Human)", 9606, 120)
    assert [tuple(x) for x in r["xrefs"]] == [("PDB", "1ABC"), ("HGNC", "HGNC:1")] and r["functions"] == ["Does a thing and another."]


def test_structure_records(spark, tmp_path):
    (tmp_path / "s.sdf").write_text("x\n> <PUBCHEM_COMPOUND_CID>\n7\n\n> <PUBCHEM_MOLECULAR_WEIGHT>\n18.0\n\n> <PUBCHEM_MOLECULAR_WEIGHT>\n19.0\n\n$$$$\ny\n> <OTHER>\n1\n\n$$$$\n")
    got = flatfile.compounds(flatfile.sdf(flatfile.records(spark, str(tmp_path / "s.sdf"), "$$$$"), "PUBCHEM_COMPOUND_CID")).collect()
    assert [(r["cid"], r["weight"], r["log_p"]) for r in got] == [(7, 18.0, None)]


def test_sections(spark):
    df = spark.createDataFrame([("ENTRY       D00109\nNAME        Aspirin;\n            Acetyl\nNAME        later\n",)], "value string")
    assert flatfile.sections(df).first()["sections"] == {"ENTRY": ["D00109"], "NAME": ["Aspirin;", "Acetyl"]}


def test_label_sections(spark):
    xml = '<doc><section><code code="34066-1"/><text>Boxed &amp; <section><code code="34068-7"/>inner</section> end</text></section><section><code code="34066-1"/>again</section><section/><section><code code="0"/>none</section></doc>'
    assert flatfile.label_sections(xml) == {"boxed_warning": "Boxed & inner end"}
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.XML", xml)
    df = spark.createDataFrame([(buf.getvalue(),), (b"junk",), (None,)], "b binary").select(flatfile.label_sections_udf(flatfile.zipped_xml("b")).alias("m"))
    assert [r["m"] for r in df.collect()] == [{"boxed_warning": "Boxed & inner end"}, None, None]


def test_inflate(spark):
    import base64

    import zstandard

    raw = b'{"a":1}\n'
    z = zstandard.ZstdCompressor().compress(raw)
    df = spark.createDataFrame([(z,), (gzip.compress(raw),), (base64.b64encode(base64.b64encode(z)),), (b"plain text!",)], "b binary").select(flatfile.inflated("b").alias("o"))
    assert [bytes(r["o"]) for r in df.collect()] == [raw, raw, raw, b"plain text!"]


def test_pointer():
    assert scan.pointer('{"date": "2024-01-01"}')["prefix"] == "snapshots/2024-01-01/"
    assert scan.pointer('{"version": 2, "snapshot_id": "s", "object_prefix": "p/"}') == {"snapshot": "s", "prefix": "p/"}
    for bad in ("", "[]", "{}", '{"version": 2, "snapshot_id": "s"}', '{"date": "d", "version": 2, "snapshot_id": "s", "object_prefix": "p/"}'):
        with pytest.raises(scan.PointerError):
            scan.pointer(bad)


def test_connector(tmp_path):
    p = tmp_path / "u.jsonl"
    p.write_text("".join(json.dumps({"id": i, "updated": f"2024-01-0{i}"}) + "\n" for i in (1, 2, 3)))
    c = scan.FileConnector(str(p))
    assert c.check("2024-01-02") and not c.check("2024-01-03")
    got = c.fetch("2024-01-01")
    assert [r["id"] for r in got.records] == [2, 3] and got.next_since == "2024-01-03"


def test_fetching():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            e = OSError("busy")
            if len(calls) == 1:
                e.retry_after = 2
            raise e
        return "ok"

    assert scan.retrying(flaky, sleep=waits.append, rng=random.Random(1)) == "ok" and waits[0] == 2.0 and 0.5 <= waits[1] <= 1.0
    assert scan.should_fetch_next(1, 100, 100, 250, 9) and not scan.should_fetch_next(3, 50, 100, 250, 9)
    assert scan.next_token("a", "b", True) == "b" and scan.next_token("a", "b", False) == "a"

    def fetch(ids):
        if "bad" in ids:
            raise ValueError
        return {i: {} for i in ids if i != "none"}

    found, none = scan.bisecting(["a", "bad", "b", "none"], fetch)
    assert set(found) == {"a", "b"} and none == {"bad", "none"}
    assert scan.html_guard("  <!DOCTYPE html>") and not scan.html_guard('{"a":1}')


def test_sinks(spark, tmp_path):
    root = f"file://{tmp_path}"
    sink.put_once(spark, f"{root}/p.json", "one")
    with pytest.raises(Exception):
        sink.put_once(spark, f"{root}/p.json", "two")
    assert not sink.swap_pointer(spark, f"{root}/p.json", "zero", "two") and sink.read_text(spark, f"{root}/p.json") == "one"
    assert sink.swap_pointer(spark, f"{root}/p.json", "one", "two") and sink.read_text(spark, f"{root}/p.json") == "two"
    # A claim that a dead writer has left is carried out, and whoever finds it fails; the pointer may come back to an earlier state.
    claim = f"{root}/p.json.from-" + hashlib.sha256(b"two").hexdigest()[:24]
    sink.put_once(spark, claim, "three")
    assert not sink.swap_pointer(spark, f"{root}/p.json", "two", "four") and sink.read_text(spark, f"{root}/p.json") == "two"
    assert not sink.swap_pointer(spark, f"{root}/p.json", "two", "four", grace=-1) and sink.read_text(spark, f"{root}/p.json") == "three"
    assert sink.swap_pointer(spark, f"{root}/p.json", "three", "two") and sink.swap_pointer(spark, f"{root}/p.json", "two", "five") and sink.read_text(spark, f"{root}/p.json") == "five"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: sink.swap_pointer(spark, f"{root}/p.json", "five", f"w{i}"), range(8)))
    assert sum(won) == 1 and sink.read_text(spark, f"{root}/p.json").startswith("w")
    df = spark.range(100).select("id")
    assert [(m["table"], m["records"]) for m in sink.snapshot({"t": df}, f"{root}/snap", ["t"])] == [("t", 100)]
    with pytest.raises(ValueError):
        sink.snapshot({"t": df.limit(0)}, f"{root}/snap2", ["t"])
    shards = sink.range_shards(df, "id", f"{root}/shards", 4, 30).collect()
    assert sum(r["n"] for r in shards) == 100 and all(a["hi"] < b["lo"] for a, b in zip(shards, shards[1:]))
    sink.rewrite(spark.read.parquet(f"{root}/snap/t").where("id < 5"), f"{root}/snap/t")
    assert spark.read.parquet(f"{root}/snap/t").count() == 5


def test_table_rows(spark):
    df = spark.createDataFrame([(["n", "v"], ["a", "1"])], "h array<string>, c array<string>")
    assert tuple(scan.table_rows(df, F.col("h"), F.col("c"), ["v", "zz"]).select("v", "zz").first()) == ("1", None)

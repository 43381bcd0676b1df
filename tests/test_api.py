import pytest

from lodestrata import api
from lodestrata.sources import scan


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    root = "file://" + str(tmp_path_factory.mktemp("api"))
    t = lambda n, rows: spark.createDataFrame(rows, api.TABLES[n])
    tables = {
        "compounds": t("compounds", [("c1", 1, "CHEMBL1", ["Aspirin"], "acid", "C9"), ("c2", 2, None, ["Asparagine", "aspirin salt"], "x", "C4"), ("c3", 3, None, None, None, None)]),
        "trials": t("trials", [("t1", "N1", "COMPLETED", 2.0), ("t2", "N2", "RECRUITING", 1.0), ("t3", "N3", "TERMINATED", 1.0)]),
        "trial_links": t("trial_links", [("c1", "N1"), ("c1", "N2"), ("c1", "N1"), ("c2", "N3")]),
        "bioactivities": t("bioactivities", [("b1", "c1", "t", 1.0, "nM", True), ("b2", "c2", "t", 1.0, "nM", None)]),
        "papers": t("papers", [("p1", "x", True, ["c2", "c2"]), ("p2", "y", False, ["c1"])]),
        "neg_evidence": t("neg_evidence", [(f"n{i:02d}", "trial_failure" if i % 2 else "paper_retraction", "c1", "major") for i in range(5)] + [("z", "odd_type", "c3", "critical")]),
        "xrefs": t("xrefs", [("chembl_id", "CHEMBL1", 1), ("unii", "ABCDEFGHIJ", 2)]),
        "targets": t("targets", [("P12345", ["c1", "c2"], ["N1"], [])]),
    }
    api.publish(tables, root, "s1")
    return api.Engine(spark, root, {"chembl_id": "licensed"})


def status(f, *a, **k):
    with pytest.raises(api.ApiError) as e:
        f(*a, **k)
    return e.value.status


def test_compound(engine):
    r = engine.compound("CID:1").first()
    assert r["id"] == "c1" and "chembl_id" not in r.asDict() and r["withheld"] == {"licensed": 1}
    assert status(engine.compound, "CID:99") == 404 and status(engine.compound, "what") == 400


def test_negative_evidence(engine):
    page, head = engine.negative_evidence("c1", offset=1, limit=3)
    assert [r["id"] for r in page.orderBy("position").collect()] == ["n01", "n02", "n03"]
    assert head["total"] == 5 and head["pagination"]["next_offset"] == 4 and head["highest_severity"] == "major"
    page, head = engine.negative_evidence("c1", "trial_failure")
    assert page.count() == head["total"] == 2
    page, head = engine.negative_evidence("c1", "unheard_of")
    assert page.count() == head["total"] == 0 and head["highest_severity"] == "none"
    assert engine.negative_evidence("c2")[1]["total"] == 0


def test_repurposing(engine):
    got = {r["compound_id"]: (r["trials"], r["activities"], r["negatives"], r["retracted"], r["signal"]) for r in engine.repurposing().collect()}
    assert got == {"c1": (2, 1, 5, 0, "mixed"), "c2": (0, 0, 0, 1, "weak"), "c3": (0, 0, 1, 0, "none")}
    assert engine.repurposing("c2").count() == 1


def test_lists(engine):
    assert {r["nct_id"] for r in engine.trials("c1").collect()} == {"N1", "N2"}
    assert [r["id"] for r in engine.papers("c1").collect()] == ["p2"] and engine.bioactivities("c2").count() == 1


def test_target(engine):
    r = engine.target(" p12345", ("drugs",)).first()
    assert (r["n_compound_ids"], r["n_neg_ids"], r["compound_ids"]) == (2, 0, ["c1", "c2"])
    assert status(engine.target, "P12345", ("x",)) == 400 and status(engine.target, "Q99999") == 404 and status(engine.target, "zz") == 400


def test_resolve_and_search(engine):
    assert engine.resolve("chembl1").first()["id"] == "c1" and engine.resolve("UNII:abcdefghij").first()["id"] == "c2"
    assert status(engine.resolve, "D00109") == 403 and status(engine.resolve, "DB00001") == 404 and status(engine.resolve, "?") == 400
    assert [(r["id"], r["score"]) for r in engine.search("aspirin").collect()] == [("c1", 90), ("c2", 70)]
    assert status(engine.search, " ") == 400


def test_tools(engine):
    assert engine.call("search", {"query": "aspirin", "limit": 1}).count() == 1
    assert status(engine.call, "nope", {}) == -32601 and status(engine.call, "resolve", {"x": 1}) == -32602
    assert engine.health()["status"] == "ok"


def test_a_missing_table_is_no_empty_table(spark, tmp_path):
    with pytest.raises(scan.SourceLoadError) as e:
        api.Engine(spark, f"file://{tmp_path}")
    assert e.value.failure_class == "source_unavailable" and e.value.retryable
    with pytest.raises(scan.SourceLoadError):
        api.Engine(spark, f"file://{tmp_path}", direct=True).trials("c1").collect()


def test_a_second_publication_moves_the_pointer(spark, tmp_path):
    df = spark.createDataFrame([("c1", "N1")], api.TABLES["trial_links"])
    root = f"file://{tmp_path}"
    api.publish({"trial_links": df}, root, "a")
    api.publish({"trial_links": df.union(df)}, root, "b")
    assert api.Engine(spark, root).table("trial_links").count() == 2

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import aggregate, dedup, evidence, index, joins, merge, paging, quality, rights, stamp, state


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_first_and_last(spark):
    df = frame(spark, [("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), (None, 1, "n"), (None, 2, "m")], "k string, s int, v string")
    assert rows(dedup.first_by(df, ["k"], ["s"]).select("k", "v"), "v") == [(None, "n"), ("a", "y"), ("b", "z")]
    assert rows(dedup.last_by(df, ["k"], ["s"]).select("k", "v"), "v") == [(None, "m"), ("a", "x"), ("b", "z")]
    assert rows(dedup.first_by(df.limit(0), ["k"], ["s"])) == []


def test_min_key_and_preferred(spark):
    df = frame(spark, [("a", 5, "p"), ("a", 3, "q"), ("a", 3, "q"), ("b", None, None)], "k string, n int, s string")
    assert rows(dedup.min_key(df, ["k"], "n")) == [("a", 3, 1)]
    got = dedup.preferred(df.where("k = 'a'"), ["k"], "s", F.col("n"), "n")
    assert rows(got) == [("a", "q", ["p"])]


def test_cumulative_keeps_null_keys(spark):
    prev = frame(spark, [("a", 1), ("b", 2), (None, 9)], "k string, v int")
    cur = frame(spark, [("b", None), ("c", 3), (None, 9)], "k string, v int")
    assert rows(merge.cumulative(prev, cur, "k"), "origin", "k") == [("c", 3, "from_current"), ("a", 1, "kept"), (None, 9, "no_key"), (None, 9, "no_key"), ("b", None, "replaced")]


def test_deep_merge_fills(spark):
    kind = "k string, e struct<unii:string,ids:array<string>,n:int>, s array<string>"
    prev = frame(spark, [("a", ("U", ["1"], 1), ["x"]), ("b", None, None)], kind)
    cur = frame(spark, [("a", ("", [], 2), ["y", "x"]), ("b", ("V", ["2"], None), ["z"]), ("c", None, [])], kind)
    got = {r["k"]: r for r in merge.deep(prev, cur, "k", ("s",)).collect()}
    assert tuple(got["a"]["e"]) == ("U", ["1"], 2) and got["a"]["s"] == ["x", "y"]
    assert tuple(got["b"]["e"]) == ("V", ["2"], None) and got["b"]["s"] == ["z"]
    assert got["c"]["e"] is None and got["c"]["s"] == []
    again = {r["k"]: r for r in merge.deep(merge.deep(prev, cur, "k", ("s",)), cur, "k", ("s",)).collect()}
    assert again == got


def test_fold_deltas(spark):
    base = frame(spark, [(1, "a", 1), (2, "b", None)], "k int, x string, y int")
    deltas = frame(spark, [(1, None, 5, 1), (1, "z", None, 2), (1, "w", 6, 0), (3, "n", None, 0)], "k int, x string, y int, r int")
    assert rows(merge.fold_deltas(base, deltas, "k", "r")) == [(1, "z", 5), (2, "b", None), (3, "n", None)]


def test_union_by_keeps_existing(spark):
    df = spark.sql("select array(named_struct('source','a','v',1)) p, array(named_struct('source','a','v',2), named_struct('source','b','v',3)) c")
    got = df.select(merge.union_by(F.col("p"), F.col("c"), "source").alias("u")).first()["u"]
    assert [tuple(x) for x in got] == [("a", 1), ("b", 3)]


def test_retry_queue(spark):
    q = frame(spark, [("a", "t0", "t0", 0, "e"), ("b", "t0", "t0", 9, "e"), ("c", "t0", "t0", 3, "e")], "id string, first_failed_at string, last_attempt_at string, retries int, last_error string")
    f = frame(spark, [("a", "x" * 300), ("b", "y"), ("d", "z")], "id string, error string")
    got = rows(merge.retry_queue(q, f, frame(spark, [("c",)], "id string"), F.lit("t1")).select("id", "first_failed_at", "last_attempt_at", "retries", F.length("last_error")))
    assert got == [("a", "t0", "t1", 1, 200), ("d", "t1", "t1", 0, 1)]


def test_array_joins_never_loop(spark):
    left = frame(spark, [("a",), ("b",), (None,)], "id string")
    right = frame(spark, [(["a", "b", "a"], 1), (["b"], 2), (None, 3), ([], 4)], "ids array<string>, v int")
    got = joins.join_on_array(left, right, "id", "ids")
    assert rows(got.select("id", "v")) == [("a", 1), ("b", 1), ("b", 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    lists = joins.list_join(left, right.withColumn("k", F.get("ids", 0)), "id", "k", ["v"], "vs")
    assert {r["id"]: r["vs"] and [x["v"] for x in r["vs"]] for r in lists.collect()} == {"a": [1], "b": [2], None: None}


def test_set_similarity(spark):
    left = frame(spark, [(1, ["a", "b", "g"]), (2, ["zz"]), (3, [])], "l int, t array<string>")
    right = frame(spark, [(10, ["b", "g", "d"]), (11, ["g", "b", "d", "d"]), (12, ["a"])], "r int, u array<string>")
    assert rows(joins.set_similarity_join(left, right, "l", "t", "r", "u")) == [(1, 10, 0.5)]
    thirds = frame(spark, [(1, ["a", "b", "c"])], "l int, t array<string>")
    assert rows(joins.set_similarity_join(thirds, right, "l", "t", "r", "u")) == [(1, 12, 0.33)]


def test_triples_name_the_first_reason(spark):
    e = frame(spark, [("s1", "t1", 1), ("s2", "t1", 1), ("sx", "t1", 1), ("s1", "tx", 1), ("s1", "t1", None)], "s string, t string, v int")
    subjects = frame(spark, [("s1", "S1"), ("s2", None)], "key string, sid string")
    targets = frame(spark, [("t1", "T1")], "key string, sid string")
    got = joins.triples(e, "s", subjects, "t", targets, [("no_value", F.col("v").isNull())])
    assert sorted(str(r["skip_reason"]) for r in got.collect()) == ["None", "no_value", "object_not_found", "subject_not_found", "subject_unstamped"]


def test_lookups(spark):
    table = frame(spark, [("P1", ["P2", "X"]), ("P0", ["X"]), ("P2", None)], "p string, s array<string>")
    want = frame(spark, [("X",), ("P2",), ("none",)], "k string")
    assert rows(joins.tiered_lookup(want, "k", table, "p", "s")) == [("P2", "P2"), ("X", "P0"), ("none", None)]
    t = frame(spark, [("d1", None, 1), (None, "p2", 2)], "doi string, pmid string, v int")
    df = frame(spark, [("d1", "p2"), (None, "p2"), (None, None)], "doi string, pmid string")
    assert sorted(str(r["v"]) for r in joins.fallback_lookup(df, t, [("doi", "doi"), ("pmid", "pmid")], "v", "v").collect()) == ["1", "2", "None"]
    points = frame(spark, [(5,), (10,), (11,)], "x int")
    ranges = frame(spark, [("r", 5, 10), ("q", 10, 40)], "id string, lo int, hi int")
    assert rows(joins.range_lookup(points, "x", ranges, "lo", "hi", 8).select("x", "id")) == [(5, "r"), (10, "q"), (10, "r"), (11, "q")]


def test_promotion_guard(spark):
    a, b = frame(spark, [(1,), (2,)], "k int"), frame(spark, [(1,), (3,)], "k int")
    joins.promotion_guard(a, a, "k")
    with pytest.raises(ValueError, match="aren't staged"):
        joins.promotion_guard(a, b, "k")
    with pytest.raises(ValueError, match="rows"):
        joins.promotion_guard(a, b.limit(1), "k")


def test_rollup_and_filter(spark):
    df = frame(spark, [("c", "trial_failure", "critical"), ("c", "trial_failure", "odd"), ("c", "paper_retraction", None), ("d", "paper_retraction", "minor")], "k string, t string, s string")
    r = aggregate.rollup(df, "k", "t", "s")
    got = {x["k"]: (x["total"], x["severity_rollup"], x["type_rollup"]) for x in r.collect()}
    assert got["c"] == (3, [1, 0, 0, 2], {"trial_failure": 2, "paper_retraction": 1})
    for wanted, totals in ((None, [3, 1]), ([], [0, 0]), (["trial_failure"], [2, 0])):
        assert [x["total"] for x in aggregate.filtered_rollup(r, "k", wanted).orderBy("k").collect()] == totals
    broken = r.withColumn("total", F.col("total") + 1)
    with pytest.raises(Exception, match="inconsistent"):
        aggregate.filtered_rollup(broken, "k", None).collect()


def test_quantiles_are_nearest_rank(spark):
    df = spark.range(1, 101).select(F.col("id").alias("v"))
    assert rows(aggregate.quantiles(df, "v", {"p50": 0.5, "p99": 0.99})) == [(100, 100, 50, 99)]
    assert rows(aggregate.quantiles(df.limit(0), "v", {"p50": 0.5})) == [(0, None, None)]


def test_pages_at_the_boundary(spark):
    df = spark.range(65).select(F.lit("k").alias("k"), "id")
    assert rows(paging.page_stats(paging.pages(df, "k", ["id"]), "k", "id")) == [("k", 0, 64, 0, 63), ("k", 1, 1, 64, 64)]


def test_sealed_pages(spark):
    df = frame(spark, [("a", i, "x" * n) for i, n in enumerate([10, 10, 500, 10, 10])] + [(None, 0, "y")], "k string, i int, t string")
    got = rows(paging.sealed_pages(df, "k", ["i"], 2, 200).select("k", "i", "page"), "k", "i")
    assert got == [(None, 0, 0), ("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("a", 4, 2)]


def test_ring(spark):
    df = frame(spark, [(c,) for c in "abcde"], "id string")
    take = lambda cursor, n: [r["id"] for r in paging.ring_chunk(df, "id", cursor, n).orderBy("place").collect()]
    assert take("d", 3) == ["e", "a", "b"] and take(None, 2) == ["a", "b"] and take("e", 9) == list("abcde") and take("b", 2) == ["c", "d"]


def test_cursors():
    q = {"type": "x"}
    c = paging.encode_cursor("s1", "f", q, ["k", 3])
    assert paging.decode_cursor(c, "s1", "f", q, 2) == ["k", 3]
    for args, status in ((("s2", "f", q, 2), 409), (("s1", "g", q, 2), 400), (("s1", "f", {}, 2), 400), (("s1", "f", q, 3), 400)):
        with pytest.raises(paging.CursorError) as e:
            paging.decode_cursor(c, *args)
        assert e.value.status == status
    with pytest.raises(paging.CursorError):
        paging.decode_cursor("%%%", "s1", "f", q, 2)
    assert paging.pagination(10, 5, 5, 15) == {"offset": 10, "limit": 5, "returned": 5, "has_more": False, "next_offset": None}
    assert [paging.clamp(x) for x in (None, 0, 500, 7)] == [50, 1, 200, 7]


def test_inverse_pivot(spark):
    edges = frame(spark, [("t1", "c1"), ("t1", "c1"), ("t2", "c1"), (None, "c2")], "t string, c string")
    trials = frame(spark, [("c1", "n2"), ("c1", "n1")], "c string, id string")
    got = index.inverse_pivot(edges, "t", "c", {"trials": trials, "none": trials.limit(0)})
    assert rows(got) == [("t1", ["c1"], ["n1", "n2"], []), ("t2", ["c1"], ["n1", "n2"], [])]


def test_verified_pages(spark):
    import hashlib

    good = hashlib.sha256(b"a").hexdigest()
    assert index.verified(frame(spark, [("a", good)], "b string, d string"), "b", "d").count() == 1
    with pytest.raises(Exception, match="hash mismatch"):
        index.verified(frame(spark, [("x", good)], "b string, d string"), "b", "d").collect()


def test_gate_tiers(spark):
    r = {"a": quality.Rule("integer", required=True, least=1), "s": quality.Rule("string", enum=("x",)), "l": quality.Rule("array", max_items=1, items=quality.Rule("string", max_length=2))}
    df = frame(spark, [(1, "x", ["ab"]), (None, "x", []), (2, "y", []), (3, "x", ["abc", "d"])], "a int, s string, l array<string>")
    got = quality.gate(df, r, scope=["^s: enum"], derived=["^l"])
    assert [(x["violations"], x["outcome"]) for x in got.collect()] == [([], "pass"), (["a: required"], "halt"), (["s: enum"], "scope_exclude"), (["l: maxItems", "l[]: maxLength"], "warn")]
    with pytest.raises(quality.GateError):
        quality.enforce(got)
    assert quality.enforce(got.where("outcome <> 'halt'")).count() == 2


def test_severity_and_deferrals(spark):
    df = frame(spark, [("a", 10.0), ("b", None), ("c", 95.0), ("d", 80.0)], "src string, pct double").withColumn("tier", quality.severity_tier(F.col("pct"), 50, 90))
    assert [r["tier"] for r in df.orderBy("src").collect()] == ["hardfail", "hardfail", "info", "warn"]
    held = frame(spark, [("a", "2024-02-01"), ("b", "2023-01-01")], "src string, until string")
    assert [r["tier"] for r in quality.deferred(df, held, "src", F.lit("2024-01-01")).orderBy("src").collect()] == ["warn", "hardfail", "info", "warn"]
    assert quality.worst(df).first()["worst"] == "hardfail" and quality.worst(df.limit(0)).first()["worst"] == "info"


def test_asserts():
    quality.assert_monotone(1, 1, "n")
    for f, args in ((quality.assert_monotone, (2, 1, "n")), (quality.assert_yield, (0, "s")), (quality.assert_counts, (1, 2, "c"))):
        with pytest.raises(quality.GateError):
            f(*args)


def test_fold_deltas_keeps_base_rows_without_a_key(spark):
    base = spark.createDataFrame([(None, "x", ["a"]), (None, "y", ["a"]), (1, "z", ["a"])], "k int, v string, src array<string>")
    deltas = spark.createDataFrame([(None, "w", ["b"], 1), (1, None, ["b", "a"], 2), (1, "q", ["c"], 1)], "k int, v string, src array<string>, r int")
    got = merge.fold_deltas(base, deltas, "k", "r", ("src",)).collect()
    assert sorted((r["k"] or 0, r["v"], r["src"]) for r in got) == [(0, "x", ["a"]), (0, "y", ["a"]), (1, "q", ["a", "c", "b"])]


def test_rights_reach_maps_and_nested_arrays(spark):
    df = spark.createDataFrame([(1,)], "i int").selectExpr("map('m', named_struct('secret', 1, 'ok', 2)) AS m", "array(array(named_struct('secret', 1, 'ok', 2)), null) AS n", "map('secret', 'x', 'open', 'y') AS k", "named_struct('id', 's::1', 'url', 'u', 'severity', 'minor', 'detail', named_struct('term', 't', 'n', 5)) AS s")
    got = rights.apply(df, {"secret": "f"}, None, rights.Signal("g", "^s::", "nobody"), markers=True)
    r = got.first()
    assert r["m"]["m"].asDict() == {"secret_visibility": rights.WITHHELD, "ok": 2} and r["n"][0][0]["ok"] == 2 and r["n"][1] is None and r["k"] == {"open": "y"}
    assert r["s"]["id"] is None and r["s"]["url"] is None and r["s"]["detail"]["term"] is None and r["s"]["detail"]["n"] == 5 and r["s"]["severity"] == "minor"
    assert r["withheld"] == {"f": 3, "g": 1}
    again = rights.apply(got.drop("withheld"), {"secret": "f"}, None, rights.Signal("g", "^s::", "nobody"), markers=True).first()
    assert again["withheld"] == {"f": 0, "g": 0}


def test_rights_are_idempotent(spark):
    df = spark.sql("select 1 id, named_struct('secret', 'x', 'open', array(named_struct('secret', 2, 'v', 3), named_struct('secret', null, 'v', 4))) a, array('OK:1', 'BAD:2', null) l")
    once = rights.apply(df, {"secret": "f1"}, {"^BAD:": "f2"})
    r = once.first()
    assert r["withheld"] == {"f1": 2, "f2": 1} and r["l"] == ["OK:1", None] and [x["v"] for x in r["a"]["open"]] == [3, 4]
    twice = rights.apply(once.drop("withheld"), {"secret": "f1"}, {"^BAD:": "f2"}).first()
    assert twice["withheld"] == {"f1": 0, "f2": 0} and twice["a"] == r["a"]
    with pytest.raises(ValueError):
        rights.public(df, "nope")


def test_evidence_builders(spark):
    trials = frame(spark, [("N1", "2020", "ctis", 1), ("N1", "2021", "ct", 2)], "nct_id string, completion string, source string, seq int")
    neg = frame(spark, [("N1", "c1", "adverse events", 1), ("N2", None, None, 2)], "nct_id string, compound_id string, status_reason string, seq int")
    got = evidence.trial_failures(neg, trials).orderBy("id").collect()
    assert [(r["id"], r["severity"], r["confidence"], r["occurred_date"], r["source"]) for r in got] == [("lode::neg::trial::N1", "critical", 80, "2021", "clinicaltrials_gov"), ("lode::neg::trial::N2", "unknown", 40, None, "clinicaltrials_gov")]
    c = frame(spark, [("CID:1", ["warn", "", "warn"], ["A1"])], "id string, warnings array<string>, application_numbers array<string>")
    assert [r["id"].split("::")[3:5] for r in evidence.boxed_warnings(c).orderBy("id").collect()] == [["CID:1", "0"], ["CID:1", "2"]]
    a = frame(spark, [(1, "c", False, "concentration_threshold_v1", None), (2, "c", False, "x_inconclusive_v1", 1), (3, "c", None, None, 1), (4, "c", True, None, 1)], "id int, compound_id string, is_active boolean, is_active_method string, score int")
    assert [(r["id"], r["confidence"]) for r in evidence.inactive_assays(a).collect()] == [("lode::neg::bioassay::1", 60)]
    p = frame(spark, [("p", "10.1/a(b)", None, "9", True, "pubmed", None, None)], "id string, doi string, openalex_id string, pmid string, is_retracted boolean, retraction_source string, retraction_nature string, retraction_date string")
    r = evidence.retractions(p).first()
    assert (r["id"], r["source"], r["reason_category"]) == ("lode::neg::retraction::10.1_a_b_", "pubmed_pubtype", "Retraction")
    t = frame(spark, [("N1", [(None,), ("c2",)], 100, "d"), ("N2", [], 0, "d")], "nct_id string, interventions array<struct<compound_id:string>>, serious_events_count int, completion string")
    assert [(r["subject_id"], r["severity"]) for r in evidence.adverse_events(t).collect()] == [("c2", "major")]
    w = frame(spark, [("i", None, True, None), ("j", None, False, None)], "id string, chembl_id string, withdrawn boolean, withdrawn_reason string")
    assert [r["source_id"] for r in evidence.withdrawals(w).collect()] == ["i"]
    s = frame(spark, [("i", None, [("Pain, Severe", 10000), ("x", 1)])], "id string, unii string, terms array<struct<term:string,count:int>>")
    assert [(r["id"], r["severity"]) for r in evidence.report_signals(s).orderBy("severity").collect()] == [("lode::neg::faers::i::pain__severe", "critical"), ("lode::neg::faers::i::x", "unknown")]


def test_stamping(spark):
    df = frame(spark, [("k1", "alt1"), ("k2", "alt2"), (None, "alt3"), ("k4", "alt4")], "k string, a string")
    from lodestrata.functions.ident import sid

    known = df.where("k = 'k1'").select(sid("n", "c", "v1", F.col("k")).alias("sid_s"), F.lit("C1").alias("sid_c")).union(df.where("k = 'k2'").select(sid("n", "c", "v0", F.col("a")), F.lit("C2")))
    anchor = F.struct(F.col("k").alias("payload"), F.lit("v1").alias("version"))
    other = F.struct(F.col("a").alias("payload"), F.lit("v0").alias("version"))
    got = stamp.classify(df, "n", "c", anchor, known, other)
    assert {r["a"]: (r["stamp"], r["sid_c"]) for r in got.collect()} == {"alt1": ("already", "C1"), "alt2": ("cross_pollinated", "C2"), "alt3": ("unstampable", None), "alt4": ("unstamped", None)}
    new = stamp.number(spark.range(1000).select(F.col("id").alias("k")), "k", 7, "n", "c", parts=5)
    assert [(r["k"], r["counter_value"]) for r in new.orderBy("k").collect()] == [(i, i + 7) for i in range(1000)]


def test_failure_runs(spark):
    marks = [False, True, True, True, True, False, True]
    df = frame(spark, [("e", i, m) for i, m in enumerate(marks)] + [("f", 0, True)], "e string, i int, failed boolean")
    got = [r["state"] for r in state.failure_runs(df, "e", "i", "failed").orderBy("e", "i").collect()]
    assert got == ["healthy", "first_failure", "first_failure", "newly_failing", "still_failing", "recovered", "first_failure", "first_failure"]


def test_decisions():
    assert state.cursor_decision(0, "a", "b") == ("anomaly_zero_fetch_hold", "a")
    assert state.cursor_decision(5, "a", "b") == ("advance", "b")
    assert state.cursor_decision(5, "a", "b", False) == ("no_updates_hold", "a")
    d = state.merge_decision
    assert [d(None, "r", False, False), d(None, "r", True, True), d({"x": 1}, "r", True, True), d({"run_id": "r"}, "r", True, True), d({"run_id": "q"}, "r", True, False), d({"run_id": "q"}, "r", True, True)] == ["first_run_skip", "sentinel_present_pointer_missing", "pointer_missing_run_id", "same_run_skip", "empty_buffer_abort", "merge"]
    assert state.prunable(["1", "2", "3", "4"], "1", 2) == ["2"]
    b = state.Breaker()
    assert [b.record(x) for x in (False, False, True, False, False, False, True)] == [False] * 5 + [True, True]


def test_drain():
    got = state.drain(100, lambda n: 10.0, 30, budget_ms=1000, cold_ms=50)
    assert (got.chunks, got.processed, got.stop_reason) == (4, 100, "backlog_exhausted")
    assert state.drain(100, lambda n: 40.0, 30, budget_ms=100, cold_ms=50).stop_reason == "time_budget"
    assert state.drain(100, lambda n: 1.0, 30, budget_ms=100, cold_ms=5, most=40).processed == 40
    assert state.drain(100, lambda n: 1.0, 30, budget_ms=10, cold_ms=50).processed == 0


def test_labels_by_code_sets(spark):
    compounds = frame(spark, [(1, [1, 2]), (2, [2, 1, 1]), (3, [3]), (4, [None]), (5, [9]), (3, [2]), (6, None)], "id int, codes array<int>")
    labels = frame(spark, [(10, [1, 2], True), (11, [2, 3], False), (12, [3, 3, None], None), (10, [3], True), (13, [8], True), (14, None, True), (15, [1], False)], "label int, lc array<int>, has_boxed_warning boolean")
    lists = {r["id"]: (r["labels"], r["boxed"]) for r in joins.label_links(compounds, "id", "codes", labels, "label", "lc").collect()}
    assert lists == {1: ([10, 11, 15], 1), 2: ([10, 11, 15], 1), 3: ([10, 11, 12], 1)}
    got = joins.label_counts(compounds, "id", "codes", labels, "label", "lc")
    assert {r["id"]: (r["n_labels"], r["first"], r["boxed"]) for r in got.collect()} == {k: (len(x), min(x), b) for k, (x, b) in lists.items()}


def test_label_query_groups_pairs_of_code_sets(spark):
    """The query joins sums of labels of equal codes, and never collects a compound's labels."""
    from __spark_entry__ import TESTDATA, queries

    got = queries()["label_links"](spark, f"{TESTDATA}/sf0.001")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_theirs" in plan and "collect_list" not in plan


@pytest.mark.parametrize("kind", ["long", "string", "timestamp"])
def test_numbers_follow_the_order_beyond_a_sample(spark, kind):
    """So many rows that Spark only samples them for the ranges; a null comes first."""
    key = F.format_string("%06d", "id") if kind == "string" else F.timestamp_seconds(F.col("id") * 3600) if kind == "timestamp" else F.col("id")
    df = spark.range(30000).select(F.when(F.col("id") > 0, key).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("other")).orderBy("other")
    new = stamp.number(df, "k", 7, "n", "c", parts=5)
    assert new.columns == ["k", "id", "other", "counter_value", "sid_c"]
    assert new.count() == 30000 and new.where("counter_value <> id + 7").count() == 0
    assert stamp.number(df.limit(0), "k", 7, "n", "c").count() == 0


def test_locators_follow_the_key_beyond_a_sample(spark):
    df = spark.range(50000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("other")).orderBy("other")
    got = index.locators(df, "id", df.schema, 64)
    assert [(r["id"], r["shard"] * 64 + r["place"], len(r["content_hash"])) for r in got.orderBy("id").collect()] == [(i, i, 64) for i in range(50000)]

"""Registered queries over whole tables, against brute force."""

import random
import re
from collections import defaultdict

from lodestrata.plans import evidence, joins, text


def test_jaccard_link_reads_whole_texts(spark, tmp_path):
    docs = [(1, "alpha beta gamma\ndelta epsilon zeta"), (2, "nothing here\nred green blue"), (3, "red green blue"), (4, "first line\n\nalpha beta red"), (5, None)]
    items = [(1, "alpha beta gamma"), (2, "delta epsilon zeta alpha beta"), (3, "red green\nblue")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    tokens = lambda t: {x for x in re.split("[^a-z0-9]+", (t or "").lower()) if len(x) > 2}
    want = {}
    for d, t in docs:
        x = tokens(t)
        best = max(((len(x & tokens(u)) / len(x | tokens(u)), -i) for i, u in items if x & tokens(u)), default=None)
        if best:
            want[d] = -best[1], max(0.01, int(best[0] * 100 + 0.5) / 100)
    got = {r[0]: (r[1], r[2]) for r in joins.QUERIES["jaccard_link"](spark, str(tmp_path)).collect()}
    assert got == want and got[1] == (2, 0.83) and got[2][0] == 3


def test_lineitem_queries_take_every_line(spark, tmp_path):
    rng = random.Random(2)
    orders = [(o, o % 7) for o in range(40)]
    lines = [(rng.randrange(40), rng.randrange(30), rng.randrange(12), float(rng.randint(1, 50)), rng.choice("ANR"), rng.choice("FO")) for _ in range(200)]
    suppliers = [(k, 500.0 + 100 * k) for k in range(14)]
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put(orders, "o_orderkey long, o_custkey long", "orders")
    put(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string", "lineitem")
    put(suppliers, "s_suppkey long, s_acctbal double", "supplier")
    put([(c,) for c in range(9)], "c_custkey long", "customer")
    run = lambda of, name: {r[0]: tuple(r)[1:] for r in of.QUERIES[name](spark, str(tmp_path)).collect()}
    said = lambda xs: ",".join(map(str, xs))
    parts, flags, bought, buyers = (defaultdict(set) for _ in range(4))
    n = defaultdict(int)
    states, least = defaultdict(set), defaultdict(lambda: 99.0)
    for o, p, s, q, f, state in lines:
        parts[s].add(p)
        states[p].add(state)
        least[p] = min(least[p], q)
        flags[p].add(f)
        bought[o % 7].add(s)
        buyers[s].add(o % 7)
        n[o % 7] += 1

    assert run(joins, "bidirectional_links") == {s: (said(sorted(ps)), s % 3 != 0) for s, ps in parts.items()}
    got = {c: (k, set(map(int, x.split(","))) if x else set()) for c, (k, x) in run(joins, "nested_list_join").items()}
    assert got == {c: (n[c], bought[c]) for c in range(9)}
    got = run(joins, "two_source_build")
    rich = {k for k, v in suppliers if v > 1000}
    assert {k: r[:2] for k, r in got.items()} == {k: (k in parts, k in rich) for k in rich | parts.keys()}
    got = run(text, "target_inverse_pivot")
    assert {s: (set(map(int, r[0].split(","))), r[1], r[2]) for s, r in got.items()} == {s: (parts[s], len(b), min(b)) for s, b in buyers.items()}

    worth = {"A": 10, "N": 10, "R": 5}
    def score(p):
        f, fits, clash = flags[p], len(states[p]) > 1, least[p] <= 2
        bonus = sum(map(worth.get, f))
        if len(f) == 1:
            return max(0, min(60, 40 + min(20, bonus) - 15 * clash))
        return max(0, min(100, 80 + (len(f) - 2) * 3 + 5 * fits + min(15, int(bonus / 2 + 0.5)) - 30 * clash))

    assert run(evidence, "source_scores") == {p: (len(f), score(p)) for p, f in flags.items()}


def test_queries_that_write_and_read_match_brute_force(spark):
    """The records and storage queries have SQL; here a few of them run where the session names a shared folder."""
    from lodestrata.plans import records, storage

    sf = "/root/testdata/sf0.001"
    assert storage.QUERIES["pointer_swaps"](spark, sf).count() == 4
    got = {r["k"]: r["n"] for r in storage.QUERIES["lenient_scan"](spark, sf).collect()}
    assert got and all(k % 7 and k % 11 for k in got)
    assert records.QUERIES["load_failures"](spark, sf).where("failure_class = 'timeout' and not retryable").count() == 0


def test_ewma_of_zeros_and_unordered_events(spark, tmp_path):
    """A first value of 0 weighs like any other, as the SQL has it; events without an id come last."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    rows = [(1, 2, 20.0), (1, 1, 0.0), (2, 1, 0.0), (2, 2, 0.0), (2, 3, 5.0), (3, None, 9.0), (3, 4, 1.0), (3, 5, 2.0), (3, 6, 3.0), (4, 7, None), (4, 8, 1.0), (5, 9, 4.0)]
    spark.createDataFrame(rows, "user_id long, event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {r["user_id"]: r["mean"] for r in queries()["ewma_fold"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS FROM '{tmp_path}/events.parquet/*.parquet'")
    assert got == dict(con.sql(oracle_sql()["ewma_fold"]).fetchall()) == {1: 14.0, 2: 3.5, 3: 2.61, 4: None, 5: 4.0}

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import mixing


def brute_targets(sizes):
    """sizes: source -> size; by raising one level until the budget is spent."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if 2.0 * sizes[s] <= level * w[s]}
        if not full:
            out |= {s: level * w[s] for s in open_}
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def brute(docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    marks = lambda t: len(re.findall(r"[\x21-\x2B\x2D\x2F-\x40\x5B-\x60\x7B-\x7E]+", t or ""))
    sizes = {}
    for _, s, t in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    target, out = brute_targets(sizes), {}
    for s in sizes:
        keyed = []
        for d, src, t in docs:
            if src == s:
                u = (int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:12], 16) + 0.5) / 2.0**48
                q = size(t) / (size(t) + marks(t)) if size(t) + marks(t) else 0
                keyed.append((-math.log(u) / max(0.25, q * q), d, size(t)))
        want = math.floor(target[s])
        epochs = want // sizes[s] if sizes[s] else 0
        left = want - epochs * sizes[s]
        for _, d, n in sorted(keyed):
            out[d] = n * epochs + min(n, left)
            left -= min(n, left)
    return target, sizes, out


@pytest.fixture(scope="module")
def docs():
    out = []
    for i in range(700):
        source = [None, "a", "b", "b", "é", "z" * 3][i % 6] if i % 3 else "hot"
        text = None if i % 50 == 7 else "" if i % 50 == 8 else "word, " * (i % 37) + "%%% ## " * (i % 11)
        out.append((i, source, text))
    return out + [(9000, "hot", "very " * 20_000), (9001, "tiny", "one"), (9002, "empty", None)]


@pytest.mark.parametrize("keep", [True, False])
def test_equals_brute_force(spark, docs, keep, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 4)
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("size", F.lit("clash")).withColumn("mix_key", F.lit(1))
    got = mixing.mix(df, keep_text=keep)
    assert got.columns == [c for c in ("doc_id", "source", "text", "mix_key", "size", "source_size", "target", "taken") if keep or c != "text"]
    rows = got.collect()
    target, sizes, taken = brute(docs)
    assert {r["doc_id"]: r["taken"] for r in rows} == taken
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
    for s in sizes:
        assert abs(sum(r["taken"] for r in rows if r["source"] == s) - target[s]) <= 1
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", "x y z w"), (1, "a", "x y z w"), (None, "a", "p q"), (None, "a", None)], "doc_id long, source string, text string")
    got = mixing.mix(df)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got.collect()) == [("1", 4), ("1", 4), ("None", 0), ("None", 2)]
    assert 13 <= sum(r["taken"] for r in got.collect()) <= 15
    assert mixing.mix(df.limit(0)).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix(df.withColumn("text", F.lit(None).cast("string"))).collect())

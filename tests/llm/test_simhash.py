import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestrata.llm import components, scratch, simhash


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_classes(prints, ids, radius=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 300))) for _ in range(60)]
    out = list(base)
    for t in base[:30]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "edit"
            out.append(" ".join(v))
    out += base[:5] + [None, "", "  \t", "one", "one two", "ÄÖ ÄÖ\x0bTHE the", "x" * 50_000, "a b c " * 5000]
    rng.shuffle(out)
    return out


def test_equals_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    prints = [brute_print(t) for t in texts]
    want = brute_classes(prints, list(range(len(texts))))
    assert got == {i: (f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, want, strict=True))}


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "zz yy xx"), (3, None), (2, "")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(df).collect())
    assert got == sorted([("1", "1"), ("1", "1"), ("None", "1"), ("None", "None"), ("3", "2"), ("2", "2")])
    empty = simhash.near_duplicates(df.limit(0))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.count() == 0


def test_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 6000, np.uint64)
    flip = x[:3000].copy()
    for _ in range(3):
        flip ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    tree = simhash.VPTree(x[::3], 5, 3)
    leaf, fp = tree.leaves(np.concatenate([x, flip]))
    at = {}
    for a, b in zip(leaf.tolist(), fp.tolist(), strict=True):
        at.setdefault(b, set()).add(a)
    assert all(at[a] & at[b] for a, b in zip(x[:3000].tolist(), flip.tolist(), strict=True))
    assert max(np.bincount(leaf)) < len(fp) / 4  # it does divide


@pytest.mark.parametrize("rows", [40, 10**9])
def test_deep_trees_and_split_shards(spark, monkeypatch, rows):
    """A tree of several levels, with and without shards in blocks, gives what one comparison of all gives."""
    monkeypatch.setattr(simhash, "LEAF_ROWS", 32)
    monkeypatch.setattr(simhash, "SHARD_ROWS", rows)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 300, np.uint64)
    dense = x[0] ^ (np.uint64(1) << rng.integers(0, 64, (200, 2)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)
    x = np.unique(np.concatenate([x, dense, x[:40] ^ np.uint64(7)]))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    s = scratch.Scratch(spark, "t")
    got = {r["node"]: r["root"] for r in components.components(simhash.links(df, s), s).collect()}
    want = brute_classes(x.tolist(), x.view(np.int64).tolist())
    assert [got.get(v, v) for v in x.view(np.int64).tolist()] == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5), (None, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df, scratch.Scratch(spark, "t")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = sorted({v for e in real for v in e})
    root = {v: v for v in nodes}
    for _ in nodes:
        for a, b in real:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert components.components(df.limit(0), scratch.Scratch(spark, "t")).count() == 0


def test_forest_matches_pairs():
    rng = np.random.default_rng(5)
    x = np.unique(np.concatenate([rng.integers(0, 2**63, 50, np.uint64), (np.uint64(1) << np.arange(40, dtype=np.uint64))]))
    want = brute_classes(x.tolist(), list(range(len(x))))
    assert simhash.forest(x, 3).tolist() == want
    assert simhash.forest(x[:0], 3).tolist() == []


def test_scratch_is_the_shared_folder(spark):
    assert scratch.folder(spark) == spark.conf.get("spark.checkpoint.dir")
    s = scratch.Scratch(spark, "t")
    df = s.put(spark.range(5), "x")
    assert df.count() == 5
    s.drop(df)
    with pytest.raises(Exception):
        spark.read.parquet(df._scratch).where(F.col("id") > 0).count()


def test_components_in_rounds_and_at_once(spark):
    """The driver's way for few edges gives what the rounds give, of hubs, a path and repeated edges."""
    rng = random.Random(4)
    edges = [(i, i - 1) for i in range(2, 40)] + [(99, k) for k in range(60, 99)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(3, 3), (None, 7), (-5, 2**62)] * 2
    df = spark.createDataFrame(edges, "a long, b long")
    s = scratch.Scratch(spark, "t")
    rounds, once = ({tuple(r) for r in components.components(df, s, few=n).collect()} for n in (0, components.FEW))
    assert rounds == once and len(once) == len({n for n, _ in once})


def test_small_tables_take_few_tasks(spark, many_partitions):
    """A table of few rows isn't written by as many tasks as the session's shuffles have partitions."""
    s = scratch.Scratch(spark, "t")
    s.sized(500)
    df = s.put(spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count(), "x")
    assert len(df.inputFiles()) == 2 * spark.sparkContext.defaultParallelism and df.count() == 500
    s.sized(10**9)
    assert len(s.put(spark.range(9000).groupBy((F.col("id") % 3000).alias("k")).count(), "y").inputFiles()) == 64

"""SimHash near-duplicates, linked exactly by a distributed vantage-point tree.

1. Fingerprints: 64-bit majority vote over the XXH64 values of word shingles.
2. Equal fingerprints collapse first (partial aggregation), so copies cost one row.
3. A vantage-point tree is fitted on a bounded hash-ordered sample of the
   distinct fingerprints. Each node sends a fingerprint x to its inner side if
   d(v, x) <= mu and to its outer side if d(v, x) > mu - radius. By the triangle
   inequality two fingerprints within ``radius`` of each other then share at
   least one leaf, and every other branch is pruned. Leaves are the shards.
4. A shard links its fingerprints exactly and returns a forest (at most one row
   for each entry), never its pairs. Of radius + 2 blocks of bits two
   fingerprints within the radius share two whole ones, so only those that do
   are compared.
5. Triangle bounds prune little of random fingerprints, so the tree isn't made
   ever deeper: a leaf of over ``SHARD_ROWS`` entries, which a larger corpus or
   a dense cluster has, is divided once more by each of radius + 1 blocks of
   bits, of which two neighbours share one; only what is over the bound even
   then is dealt out as pairs of parts.
6. Components of the forests over all shards give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch

#: Fingerprints an average leaf is meant to own, sampled fingerprints for each leaf, and the most that are sampled.
LEAF_ROWS, SAMPLE_PER_LEAF, SAMPLE_MOST = 2048, 32, 1 << 18
#: A shard with more entries is divided.
SHARD_ROWS = 24_000
#: A run of more fingerprints that share blocks of bits is searched from one to the next instead of pair by pair.
RUN = 64
#: Candidates that each node of the tree tries as vantage point.
TRIES = 24


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> bytes:
    """SimHash of a UTF-8 text as 8 bytes, highest bit first.

    A-Z are lower-cased, words are what ASCII white space divides, shingles of
    ``words`` words are joined by a space (all words where there are fewer; no
    word: zero). A bit is 1 if over half of the shingles' XXH64 values have it.
    """
    w = text.lower().split()
    if not w:
        return bytes(8)
    k = min(words, len(w))
    h = xxhash.xxh64_digest
    got = b"".join([h(s, seed) for s in map(b" ".join, zip(*(w[i:] for i in range(k)), strict=False))])
    n = len(got) // 8
    votes = np.zeros(64, np.int64)
    raw = np.frombuffer(got, np.uint8).reshape(n, 8)
    for at in range(0, n, 8192):
        votes += np.unpackbits(raw[at : at + 8192], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > n).tobytes()


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, fp long) of each row; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [int.from_bytes(fingerprint(t or b"", words), "big", signed=True) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


class VPTree:
    """A complete binary vantage-point tree over 64-bit fingerprints under Hamming distance."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.depth, self.radius = depth, radius
        self.at = np.zeros((1 << depth) - 1, np.uint64)
        self.mu = np.zeros((1 << depth) - 1, np.int16)
        rng = np.random.default_rng(7)
        own = {0: np.unique(sample)}
        for node in range(len(self.at)):
            x = own.pop(node)
            if len(x):
                v, mu = self._split(x, rng)
            else:
                v, mu = np.uint64(0), 32
            self.at[node], self.mu[node] = v, mu
            d = np.bitwise_count(x ^ self.at[node]).astype(np.int16)
            own[2 * node + 1], own[2 * node + 2] = x[d <= mu], x[d > mu - radius]

    def _split(self, x: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int]:
        """The vantage point and distance with the least sum of squared sides, overlap counted."""
        best = (np.inf, x[0], 32)
        for v in rng.choice(x, min(TRIES, len(x)), replace=False):
            upto = np.cumsum(np.bincount(np.bitwise_count(x ^ v), minlength=65)) / len(x)
            short = np.concatenate([np.zeros(self.radius), upto[: 65 - self.radius]])
            cost = upto**2 + (1 - short) ** 2
            mu = int(cost.argmin())
            if cost[mu] < best[0]:
                best = (cost[mu], v, mu)
        return best[1], best[2]

    def leaves(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, fingerprint) for each leaf that each fingerprint has to be in."""
        node = np.zeros(len(fp), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(fp ^ self.at[node]).astype(np.int16)
            inner, outer = d <= self.mu[node], d > self.mu[node] - self.radius
            fp, node = np.concatenate([fp[inner], fp[outer]]), np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2])
        return node - len(self.at), fp


def blocks(n: int) -> list[int]:
    """Masks of n blocks that the 64 bits are divided into."""
    cut = [round(64 * i / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cut, cut[1:], strict=False)]


def spread(fp: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct values the index of its component's first value, all pairs compared."""
    n = len(fp)
    root, some = np.arange(n), np.zeros(n, bool)
    step = max(1, (1 << 21) // max(n, 1))
    for a in range(0, n, step):
        some[a : a + step] = (np.bitwise_count(fp[a : a + step, None] ^ fp[None, :]) <= radius).sum(axis=1) > 1
    left = np.flatnonzero(some)
    while len(left):
        first, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            step = max(1, (1 << 21) // len(left))
            for a in range(0, len(front), step):
                hit |= (np.bitwise_count(fp[front[a : a + step, None]] ^ fp[None, left]) <= radius).any(axis=0)
            front, left = left[hit], left[~hit]
            root[front] = first
    return root


def forest(fp: np.ndarray, radius: int) -> np.ndarray:
    """For each of the distinct values the index of its component's first value, within ``radius`` of each other link by link."""
    n = len(fp)
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sorted_by = []
    for x, y in combinations(blocks(radius + 2), 2):
        key = fp & np.uint64(x | y)
        order = np.argsort(key, kind="stable")
        key = key[order]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        sorted_by.append((key, order, cut, np.diff(cut)))
    # Fingerprints that share most blocks anyway are compared once instead of in every run.
    if sum((size.astype(float) ** 2).sum() for *_, size in sorted_by) > float(n) ** 2:
        return spread(fp, radius)
    for key, order, cut, size in sorted_by:
        for k in np.flatnonzero(size > RUN):
            run = order[cut[k] : cut[k + 1]]
            to = run[spread(fp[run], radius)]
            one.append(run[to != run])
            two.append(to[to != run])
        # Pairs of short runs, by their distance in the order.
        short = np.repeat(size <= RUN, size)
        i, by = np.flatnonzero(short[:-1]) if n else np.zeros(0, np.int64), 1
        while len(i):
            i = i[key[i] == key[i + by]]
            near = i[np.bitwise_count(fp[order[i]] ^ fp[order[i + by]]) <= radius]
            one.append(order[near])
            two.append(order[near + by])
            by += 1
            i = i[i + by < n]
    a, b = np.concatenate(one), np.concatenate(two)
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        on = x != y
        if not on.any():
            break
        a, b, x, y = a[on], b[on], x[on], y[on]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root


def links(distinct: DataFrame, scratch: Scratch, radius: int = 3) -> DataFrame:
    """(a long, b long): edges between distinct fingerprints whose components are those of all pairs within ``radius``."""
    spark = distinct.sparkSession
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF_ROWS))))
    depth = min(depth, int(np.log2(SAMPLE_MOST / SAMPLE_PER_LEAF)))
    take = SAMPLE_PER_LEAF << depth
    sample = [r[0] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(take).collect()] if depth else []
    tree = spark.sparkContext.broadcast(VPTree(np.array(sample, np.int64).view(np.uint64), depth, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, fp = tree.value.leaves(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(fp.view(np.int64))], ["leaf", "fp"])

    entries = scratch.put(distinct.select("fp").mapInArrow(deal, "leaf long, fp long"), "shards")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(pdf["fp"].to_numpy(np.int64))
        root = fp[forest(fp.view(np.uint64), radius)]
        on = root != fp
        return pd.DataFrame({"a": fp[on], "b": root[on]})

    # Sizes are few rows: at most one a leaf, then one a block of bits of a large leaf that is still too large.
    many = F.col("count") > SHARD_ROWS
    large = scratch.put(entries.groupBy("leaf").count().where(many).select("leaf"), "large")
    if large.isEmpty():
        return entries.groupBy("leaf").applyInPandas(link, "a long, b long")
    got = entries.join(large.hint("merge"), "leaf", "left_anti").groupBy("leaf").applyInPandas(link, "a long, b long")
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    parts = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(x)).cast("long")) for x in blocks(radius + 1)])).alias("t", "v")
    # A fingerprint of several large leaves stands once in each block's table.
    entries = scratch.put(entries.join(large.hint("merge"), "leaf", "left_semi").select("fp").distinct().select(parts, "fp"), "divided")
    sizes = entries.groupBy("t", "v").count().where(many).select("t", "v", F.ceil(F.col("count") * 2 / SHARD_ROWS).cast("int").alias("n"))
    rows = entries.join(sizes.hint("merge"), ["t", "v"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), "n").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("t", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    return got.union(rows.groupBy("t", "v", "i", "j").applyInPandas(link, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, fingerprint string, component_id long), one row for each row of ``docs``.

    Fingerprints that differ in at most ``radius`` bits are linked;
    component_id is the least doc_id that links reach. Null texts count as
    empty: fingerprint zero, linked like any other. A null doc_id keeps its row
    and takes no part in minima (its component_id is null if it stands alone).
    Ids are cast to
    long, what can't be cast is null. Repeated rows are kept. Other columns of ``docs`` play no part. An empty
    table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    own = scratch.put(fingerprints(docs, words, id_col, text_col), "fingerprints")
    scratch.sized(own.count())
    distinct = scratch.put(own.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    roots = scratch.put(components(links(distinct, scratch, radius), scratch), "roots")
    rooted = scratch.put(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root")), "rooted")
    least = scratch.put(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "least")
    classes = scratch.put(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return scratch.near(own.join(classes, "fp")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Near copies by Jaccard similarity of word shingles: SimHash and MinHash find candidates, the shingles themselves decide.

1. Each text is the set of 64-bit hashes of its word shingles; equal sets collapse first.
2. SimHash classes of the vantage-point tree (``simhash``) give each text one
   candidate, the first of its class. At a similarity of 0.8 fingerprints differ
   in about 10 of 64 bits, too many for a tree to prune by, so
3. ``BANDS`` bands of ``ROWS`` MinHash values each add the sets that share a
   band. At similarity s a pair shares none with a probability of
   (1 - s**ROWS)**BANDS: 6e-5 at 0.8, less above.
4. In each of ``ROUNDS`` rounds a set is compared, exactly, on the shingles, with
   the set of another class that leads most of its bands' buckets. Once those links are merged, what is left are the
   sets of buckets that hold several classes. Of them all pairs of different
   classes that can be similar enough are compared: those that share one of their
   rarest shingles, at a place that leaves enough to share after it. Nothing is
   dropped and no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from . import textvec as tv
from .components import components
from .scratch import Scratch

BANDS, ROWS = 32, 6
ROUNDS = 2
#: Sets of a bucket whose pairs are one task's work.
BLOCK = 256
#: Shingles whose MinHash values are worked on at once.
STEP = 2048

_rng = np.random.default_rng(23)
_A = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64)
_C = _rng.integers(0, 2**63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_D = _rng.integers(0, 2**63, BANDS, np.uint64)


def shingle_sets(text: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text.

    Words are what ASCII white space divides, A-Z in lower case; a text of
    fewer than ``words`` words is one shingle, one of no word the empty set.
    """
    for first, end, raw, off in tv.slices(text, lower=False):
        s, e, row = tv.spans(raw, off, tv.BLANKS)
        h = tv.word_hashes(raw, s, e)
        x, at = tv.joined(h, row, words)
        own, cut = tv.bounds(row, end - first), tv.bounds(row[at], end - first)
        for i in range(end - first):
            n = int(own[i + 1] - own[i])
            if 0 < n < words:
                yield tv.joined(h[own[i] : own[i + 1]], np.zeros(n, np.int64), n)[0]
            else:
                yield np.unique(x[cut[i] : cut[i + 1]])


def _id(x: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(x.tobytes(), 5) - 2**63


def band_keys(x: np.ndarray) -> np.ndarray:
    """A key for each band of a set's MinHash values; none for the empty set."""
    if not len(x):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), STEP):
            np.minimum(low, (x[at : at + STEP, None] * _A + _B).min(axis=0), out=low)
        return tv.mix((tv.mix(low).reshape(BANDS, ROWS) * _C).sum(axis=1, dtype=np.uint64) + _D)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, s, n, keys): the id and size of each row's set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, n, keys = [], [], []
            for x in shingle_sets(b.column(1), words):
                s.append(_id(x))
                n.append(len(x))
                keys.append(band_keys(x).view(np.int64))
            off = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))], ["doc_id", "s", "n", "keys"])

    return docs.mapInArrow(run, "doc_id long, s long, n long, keys array<long>")


def _members(docs: DataFrame, words: int) -> DataFrame:
    """(s long, x array<long>) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                sets = list(shingle_sets(b.column(0).slice(at, 256), words))
                off = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([_id(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))], ["s", "x"])

    return docs.select("text").mapInArrow(run, "s long, x array<long>")


def _block(least: float):
    """Links between sets of different classes of one pair of blocks: a forest with the components of all such pairs."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = pdf["x"].map(len).to_numpy()
        _, at = np.unique(np.concatenate(pdf["x"].to_numpy()), return_inverse=True)
        row = np.repeat(np.arange(len(pdf)), n)
        both = np.zeros((len(pdf), len(pdf)), np.float32)
        for first in range(0, int(at.max()) + 1, 4096):
            on = (at >= first) & (at < first + 4096)
            has = np.zeros((len(pdf), 4096), np.float32)
            has[row[on], at[on] - first] = 1
            both += has @ has.T
        c = pdf["c"].to_numpy()
        alike = (both / (n[:, None] + n[None] - both) >= least) & (c[:, None] != c[None])
        s, out = pdf["s"].to_numpy(), [np.zeros((2, 0), np.int64)]
        left = np.flatnonzero(alike.any(axis=1))
        while len(left):
            front, left = left[:1], left[1:]
            while len(front) and len(left):
                hit = alike[np.ix_(front, left)]
                new = hit.any(axis=0)
                out.append(np.stack([s[left[new]], s[front[hit[:, new].argmax(axis=0)]]]))
                front, left = left[new], left[~new]
        got = np.concatenate(out, axis=1)
        return pd.DataFrame({"a": got[0], "b": got[1]})

    return run


def near_duplicates(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, component_id long), one row for each row of ``docs``.

    Texts whose sets of ``words``-word shingles have a Jaccard similarity of
    ``least`` or more are linked; component_id is the least doc_id that links
    reach. Ids are cast to long, what can't be cast is null. Null texts count as empty, and texts of no word as equal. A null
    doc_id keeps its row and takes no part in minima. Repeated rows are kept;
    an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "nearsets")
    docs = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = scratch.put(_sketches(docs, words), "sketches")
    scratch.sized(sketch.count())
    near = scratch.near
    prints = scratch.put(near(simhash.near_duplicates(docs, words).where("doc_id <> component_id").select("doc_id", "component_id")).distinct(), "prints")
    # Equal sets have equal keys.
    distinct = scratch.put(sketch.groupBy("s").agg(F.min("doc_id").alias("first_doc"), F.first("n").alias("n")), "distinct")
    one = near(sketch.join(distinct.withColumnRenamed("first_doc", "f").select("s", "f"), "s").where(F.col("doc_id").eqNullSafe(F.col("f"))).select("s", "n", "keys")).dropDuplicates(["s"])
    table = scratch.put(one.select("s", "n", F.explode("keys").alias("h")), "bands")
    sizes = scratch.put(table.groupBy("h").agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("k")).where("low <> high").select("h", "k"), "buckets")
    table = scratch.put(table.join(sizes.select("h"), "h").distinct(), "shared")

    # The texts of whatever is in a bucket with another set, each set once.
    printed = near(prints.select("doc_id").union(prints.select("component_id")).distinct())
    wanted = near(table.select("s").union(near(sketch.join(printed.hint("merge"), "doc_id").select("s"))).distinct()).join(distinct, "s").select("s", "first_doc")
    wanted = scratch.put(wanted, "wanted")
    texts = near(docs.join(near(wanted.select(F.col("first_doc").alias("f")).distinct()).hint("merge"), F.col("doc_id").eqNullSafe(F.col("f")), "left_semi"))
    sets = scratch.put(near(_members(texts, words).join(wanted.select("s"), "s", "left_semi")).dropDuplicates(["s"]), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar enough."""
        got = near(pairs.join(sets.select(F.col("s").alias("a"), F.col("x").alias("l")).hint("merge"), "a")).join(sets.select(F.col("s").alias("b"), F.col("x").alias("r")).hint("merge"), "b")
        common = F.size(F.array_intersect("l", "r"))
        return got.withColumn("k", common).where(F.col("k") / (F.size("l") + F.size("r") - F.col("k")) >= least).select("a", "b")

    sizes_ok = lambda x, y: F.least(x, y) / F.greatest(x, y) >= least
    links, tried, roots = [], [], None

    def merge(pairs: DataFrame) -> bool:
        """Compare the pairs (a, b) that haven't been compared yet."""
        nonlocal roots
        pairs = near(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
        for x in tried:
            pairs = near(pairs).join(x.hint("merge"), ["a", "b"], "left_anti")
        tried.append(scratch.put(pairs, "tried"))
        links.append(scratch.put(linked(tried[-1]), "links"))
        if links[-1].isEmpty():
            return False
        roots = scratch.put(components(reduce(DataFrame.union, links), scratch), "roots")
        return True

    def classed() -> DataFrame:
        """The rows of the buckets that hold several classes."""
        rows = table if roots is None else table.join(roots.withColumnRenamed("node", "s").hint("merge"), "s", "left").withColumn("c", F.coalesce("root", "s")).drop("root")
        rows = scratch.put(rows, "named") if roots is not None else rows.withColumn("c", F.col("s"))
        main = near(near(rows.groupBy("h", "c").agg(F.count("*").alias("k"))).groupBy("h").agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.count("*").alias("k")).where("k > 1"))
        return scratch.put(rows.join(main.select("h", "main").hint("merge"), "h"), "classed")

    # SimHash: each set with the one of its class's first document.
    ids = scratch.put(sketch.where("doc_id is not null").select("doc_id", "s").distinct(), "ids")
    merge(near(prints.join(ids.hint("merge"), "doc_id")).withColumnRenamed("s", "a").join(ids.select(F.col("doc_id").alias("component_id"), F.col("s").alias("b")).hint("merge"), "component_id").where("a <> b").select("a", "b"))
    # A set in large buckets is near to what its group has in common: as a leader it links most. The second round's isn't of the main class.
    hub = scratch.put(near(table.join(sizes.hint("merge"), "h")).groupBy("s").agg(F.sum("k").alias("hub")), "hubs")
    table = scratch.put(table.join(hub.hint("merge"), "s"), "led")
    for turn in range(ROUNDS):
        rows = classed()
        by = F.struct("hub", "s")
        lead = near(rows.groupBy("h").agg(F.max_by(F.struct("s", "n", "c"), F.when(F.col("c") != F.col("main") if turn % 2 else F.lit(True), by)).alias("l")))
        tries = near(rows.join(lead.hint("merge"), "h")).where((F.col("c") != F.col("l.c")) & sizes_ok(F.col("n"), F.col("l.n"))).groupBy("s", F.col("l.s").alias("lead")).agg(F.count("*").alias("k"))
        if not merge(near(tries).groupBy("s").agg(F.max_by("lead", F.struct("k", "lead")).alias("lead")).select(F.col("s").alias("a"), F.col("lead").alias("b"))):
            break
    # What is left, exactly: two sets have to have ``common(n, m)`` shingles in common, so of the shingles of either in one
    # order, the rarest first, they share one that as many follow in both. Sets without such a partner are done.
    common = lambda n, m: F.ceil((n + m) * (least / (1 + least)) - 1e-9)
    open_ = scratch.put(near(classed().select("s", "n", "c").distinct()).join(sets.hint("merge"), "s"), "open")
    each = open_.select("s", F.explode("x").alias("w"))
    known = scratch.put(each.groupBy("w").agg(F.count("*").alias("f")).where("f > 1"), "known")
    rare = near(each.join(known.hint("merge"), "w")).groupBy("s").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("ws"))
    # Shingles that no other of these sets has come first; the smallest set that one is similar to has least * n.
    rare = open_.select("s", "n", "c").join(near(rare).hint("merge"), "s").select("s", "n", "c", F.posexplode("ws").alias("i", "e"), (F.col("n") - F.size("ws")).alias("alone"))
    rare = rare.select(F.col("e.w").alias("w"), "s", "n", "c", (F.col("n") - F.col("alone") - F.col("i")).alias("left")).where(F.col("left") >= F.ceil(F.col("n") * F.lit(least) - 1e-9))
    rare = scratch.put(rare, "rare")
    l, r = (rare.select("w", *[F.col(x).alias(f"{side}_{x}") for x in ("s", "n", "c", "left")]) for side in "lr")
    fits = (F.col("l.w") == F.col("r.w")) & (F.col("l_c") != F.col("r_c")) & sizes_ok(F.col("l_n"), F.col("r_n")) & (F.least("l_left", "r_left") >= common(F.col("l_n"), F.col("r_n")))
    alive = scratch.put(l.alias("l").join(r.alias("r").hint("merge"), fits, "left_semi").select("w", F.col("l_s").alias("s"), F.col("l_c").alias("c")), "alive")

    # Their pairs are compared bucket by bucket, in pairs of blocks, which give back links only.
    sizes = scratch.put(alive.groupBy("w").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("k")), "sizes")
    rows = near(alive.join(sizes.hint("merge"), "w")).withColumn("own", F.pmod(F.xxhash64("s"), "k").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("w", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "s", "c").join(sets.hint("merge"), "s")
    rows = near(rows)
    links.append(scratch.put(rows.groupBy("w", "i", "j").applyInPandas(_block(least), "a long, b long"), "links"))
    if not links[-1].isEmpty():
        roots = scratch.put(components(reduce(DataFrame.union, links), scratch), "roots")
    if roots is None:
        roots = links[0].select(F.col("a").alias("node"), F.col("b").alias("root"))

    rooted = scratch.put(distinct.join(roots.withColumnRenamed("node", "s"), "s", "left").select("s", "first_doc", F.coalesce("root", "s").alias("root")), "rooted")
    lowest = scratch.put(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "least")
    classes = scratch.put(rooted.join(lowest, "root").select("s", "component_id"), "classes")
    return near(sketch.select("doc_id", "s").join(classes, "s").select("doc_id", "component_id"))

"""Benchmark passages in documents: size-partitioned MinHash containment search, exactly verified.

Test items are partitioned by their number of shingles into classes doubling
from 16. For a class of up to u shingles a document counts as windows of 2u
shingles, u apart: wherever a passage of u shingles stands, one window holds all
of it, and that window isn't so much longer than the item that MinHash can't see
it. This is the size partitioning of LSH Ensemble (Zhu et al., VLDB 2016) with
the long side cut to the short one's scale: at containment 0.8 the Jaccard
similarity of item and window is 0.19 or more, which 64 one-row bands miss with
a probability of 1e-6. Items of up to 8 shingles are looked up shingle by
shingle. Every candidate is verified on the shingles themselves, over the whole
document.

The benchmark is the query set, in blocks of ``BLOCK_ITEMS`` items, each sent to
the executors in turn; documents are scanned where they lie and never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

BLOCK_ITEMS = 20_000
#: Bytes of the items of a block on average, at most.
BLOCK_BYTES = 1 << 26
BANDS = 64
#: Shingles in a block, and the most shingles of an item that is looked up directly.
UNIT, TINY = 16, 8

_rng = np.random.default_rng(11)
_A = _rng.integers(0, 2**63, BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS, np.uint64)


def _words(text: str) -> list[bytes]:
    for _, _, raw, off in tv.slices(pa.array([text], pa.large_string())):
        s, e, _ = tv.spans(raw, off, _ONLY_WORDS)
        data = raw.tobytes()
        return [data[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
    return []


#: Marks divide words as white space does.
_ONLY_WORDS = np.where(tv.CLASSES == tv.WORD, tv.WORD, tv.SPACE).astype(np.uint8)


def _grams(words: list[bytes], k: int) -> set[bytes]:
    return set(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


class Index:
    """The sketches of one block of test items."""

    def __init__(self, items: list[tuple[int, str | None]], words: int):
        self.words = words
        self.ids, self.grams = [], []
        tiny, sized = defaultdict(list), defaultdict(list)
        for item, text in items:
            w = _words(text or "")
            if not w:
                continue
            k = min(words, len(w))
            at = len(self.ids)
            self.ids.append(item)
            self.grams.append((k, _grams(w, k)))
            h = np.unique(_hashes(text, k))
            if k < words or len(h) <= TINY:
                tiny[k] += [(x, at) for x in h.tolist()]
            else:
                level = max(0, int(np.ceil(np.log2(len(h) / UNIT))))
                sized[level].append((at, (h[:, None] * _A + _B).min(axis=0)))
        self.tiny = {k: self._lookup(np.array([x for x, _ in v], np.uint64), np.array([i for _, i in v])) for k, v in tiny.items()}
        self.sized = {level: [self._lookup(np.array([m[j] for _, m in v], np.uint64), np.array([i for i, _ in v])) for j in range(BANDS)] for level, v in sized.items()}

    @staticmethod
    def _lookup(key: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by = np.argsort(key, kind="stable")
        seen = np.zeros(1 << 16, bool)
        seen[(key >> np.uint64(48)).astype(np.int64)] = True
        return key[by], item[by], seen

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray, np.ndarray], value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into value, item) of all equal keys."""
        key, item, seen = table
        at = np.flatnonzero(seen[(value >> np.uint64(48)).astype(np.int64)])
        lo, hi = np.searchsorted(key, value[at]), np.searchsorted(key, value[at], "right")
        n = hi - lo
        run = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        return np.repeat(at, n), item[run]

    def candidates(self, raw: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
        """Rows, and the items each may hold."""
        out: dict[int, set[int]] = defaultdict(set)
        s, e, row = tv.spans(raw, off, _ONLY_WORDS)
        h = tv.word_hashes(raw, s, e)

        def add(rows: np.ndarray, items: np.ndarray) -> None:
            for r, i in set(zip(rows.tolist(), items.tolist(), strict=True)):
                out[r].add(i)

        for k, table in self.tiny.items():
            x, at = tv.joined(h, row, k)
            found, item = self._find(table, x)
            add(row[at[found]], item)
        x, at = tv.joined(h, row, self.words)
        if self.sized and len(x):
            own = row[at]
            edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            first = np.repeat(edge, np.diff(np.append(edge, len(own))))
            block = np.flatnonzero((np.arange(len(own)) - first) % UNIT == 0)
            levels = [(block, own[block])]
            while len(levels) <= max(self.sized):
                r = levels[-1][1]
                edge = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                first = np.repeat(edge, np.diff(np.append(edge, len(r))))
                pair = np.flatnonzero((np.arange(len(r)) - first) % 2 == 0)
                levels.append((pair, r[pair]))
            for j in range(BANDS):
                low = x * _A[j] + _B[j]
                for level, (start, r) in enumerate(levels):
                    low = np.minimum.reduceat(low, start)
                    if level in self.sized:
                        wide = low.copy()
                        same = r[1:] == r[:-1]
                        wide[:-1][same] = np.minimum(low[:-1][same], low[1:][same])
                        found, item = self._find(self.sized[level][j], wide)
                        if len(found):
                            add(r[found], item)
        return out

    def matches(self, text: pa.Array, threshold: float) -> Iterator[tuple[int, int, float]]:
        """(row, item_id, containment) at the threshold or more."""
        for at, _, raw, off in tv.slices(text):
            for r, items in sorted(self.candidates(raw, off).items()):
                w = _words(raw[off[r] : off[r + 1]].tobytes().decode())
                grams = {}
                for i in sorted(items):
                    k, need = self.grams[i]
                    if k not in grams:
                        grams[k] = _grams(w, k)
                    share = len(need & grams[k]) / len(need)
                    if share >= threshold:
                        yield at + r, self.ids[i], share


def _hashes(text: str | None, k: int) -> np.ndarray:
    for _, _, raw, off in tv.slices(pa.array([text], pa.large_string())):
        s, e, row = tv.spans(raw, off, _ONLY_WORDS)
        return tv.joined(tv.word_hashes(raw, s, e), row, k)[0]
    return np.zeros(0, np.uint64)


def indexes(benchmark: DataFrame, words: int, item_col: str, text_col: str) -> Iterator:
    """Broadcast indexes of the benchmark's blocks, one after another."""
    items = benchmark.select(F.col(item_col).try_cast("long"), F.col(text_col).cast("string")).dropDuplicates()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(items.columns[1])), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES)) if n else 0
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64(*items.columns), F.lit(blocks)) == b)
        yield benchmark.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in own.collect()], words))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id long, item_id long, containment double): items of whose shingles a document holds the share ``threshold`` or more.

    Words are runs of ASCII letters and digits and of any other characters
    beyond ASCII, in lower case; an item of fewer words than ``words`` counts as
    one shingle of them all, one without words matches nothing. Null texts match
    nothing; a null id is returned as null. A repeated document gives its rows
    again, a repeated item (same id and text) counts once. Empty tables give an
    empty result. Other columns play no part.
    """
    own = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema, out = "doc_id long, item_id long, containment double", None

    for index in indexes(benchmark, words, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = list(index.value.matches(b.column(1), threshold))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([r for r, _, _ in got], pa.int64())), pa.array([i for _, i, _ in got], pa.int64()), pa.array([c for _, _, c in got], pa.float64())], ["doc_id", "item_id", "containment"]
                )

        part = own.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item by the rule of ``contaminated``.

    One block of items is one pass over the texts. Of several blocks each is a
    pass of its own, so that a worker holds one index at a time; what they find
    is left out by two 64-bit hashes of the text.
    """
    blocks = list(indexes(benchmark, words, item_col, item_text_col))
    at, schema = docs.columns.index(text_col), docs.schema

    def passing(index, keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                on = np.full(b.num_rows, keep)
                on[[r for r, _, _ in index.value.matches(b.column(at), threshold)]] = not keep
                yield b.filter(pa.array(on))

        return run

    if len(blocks) <= 1:
        return docs.mapInArrow(passing(blocks[0], True), schema) if blocks else docs
    text = F.col(f"`{text_col}`").cast("string")
    prints = lambda d: [F.xxhash64(text).alias("one"), F.xxhash64(F.lit("second"), text).alias("two")]
    gone = None
    for index in blocks:
        part = docs.mapInArrow(passing(index, False), schema).select(*prints(docs))
        gone = part if gone is None else gone.union(part)
    gone = gone.distinct().hint("merge")  # grows with the corpus
    one, two = prints(docs)
    return docs.join(gone, (one == gone["one"]) & (two == gone["two"]), "left_anti")


#: The same rule in plain SQL, for DuckDB.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), d AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
  WHERE k IN (SELECT least(5, len(regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+'))) FROM benchmark)
), b0 AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), b1 AS (
  SELECT item_id, w, least(5, len(w)) AS k FROM b0 WHERE len(w) > 0
), b2 AS (
  SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b1
), b AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM b2
), n AS (
  SELECT item_id, count(*) AS n FROM b GROUP BY item_id
), hit AS (
  SELECT d.doc_id, b.item_id, count(DISTINCT b.g) AS c
  FROM d JOIN b ON d.k = b.k AND array_to_string(d.w[d.i:d.i + d.k - 1], ' ') = b.g GROUP BY d.doc_id, b.item_id
)
SELECT doc_id, item_id, c::DOUBLE / n AS containment FROM hit JOIN n USING (item_id) WHERE c::DOUBLE / n >= 0.8
"""

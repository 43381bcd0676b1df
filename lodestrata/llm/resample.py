"""Quality by importance resampling (DSIR, Xie et al., 2023).

Target texts and all raw texts each give a bag-of-hashed-n-grams model: words
and pairs of neighbouring words, in ``BUCKETS`` buckets. A text's weight is the
log-ratio of the two models over its n-grams; texts of more than ``LENGTH``
n-grams count as that many, else length would outweigh everything. Gumbel noise
from a hash of the id turns the k greatest keys into a sample without
replacement in proportion to the weights.

The raw counts cover every text. The k-th key is found by four histograms over
16 bits each, so that no key but the threshold reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import Scratch

BUCKETS, LENGTH, SMOOTH = 1 << 14, 256, 1.0
#: Target texts that are learned from, at most, by a hash of the id.
TARGET_ROWS = 10_000
#: Share of the rows that the sample keeps.
KEEP = 0.85


def ngrams(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each word or run of marks, and of each two that follow each other."""
    s, e, row = tv.spans(raw, off)
    h = tv.word_hashes(raw, s, e)
    two, at = tv.joined(h, row, 2)
    shift = np.uint64(64 - int(np.log2(BUCKETS)))
    return np.concatenate([h >> shift, two >> shift]).astype(np.int64), np.concatenate([row, row[at]])


def counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of buckets over all rows of (text, is_target), and over the targets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            mark = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for at, _, raw, off in tv.slices(b.column(0)):
                bucket, row = ngrams(raw, off)
                total[0] += np.bincount(bucket, minlength=BUCKETS)
                total[1] += np.bincount(bucket[mark[at + row]], minlength=BUCKETS)
        on = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(total[0][on]), pa.array(total[1][on])], ["bucket", "raw", "target"])

    out = np.zeros((2, BUCKETS), np.float64)
    for r in docs.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        out[:, r["bucket"]] = r["raw"], r["target"]
    return out[0], out[1]


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket; 0 throughout without targets."""
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda n: np.log(n + SMOOTH) - np.log(n.sum() + SMOOTH * BUCKETS)
    return p(target) - p(raw)


def _order(x: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers in the order of the doubles."""
    b = np.ascontiguousarray(x + 0.0, np.float64).view(np.int64)
    return np.where(b < 0, b ^ np.int64(0x7FFFFFFFFFFFFFFF), b)


def threshold(keys: DataFrame, k: int) -> tuple[int, int]:
    """(the k-th greatest of long column ``ord``, how many of the rows that have it are among the k); 1 <= k <= rows."""
    high, part = k, F.col("ord")
    value = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(part.bitwiseXOR(F.lit(-(1 << 63)).cast("long")), shift).bitwiseAND(F.lit(0xFFFF))
        at = keys if shift == 48 else keys.where(F.shiftrightunsigned(part.bitwiseXOR(F.lit(-(1 << 63)).cast("long")), shift + 16) == value)
        for r in sorted(at.groupBy(digit.alias("d")).count().collect(), key=lambda r: -r["d"]):
            if high <= r["count"]:
                value = value << 16 | r["d"]
                break
            high -= r["count"]
    return (value ^ (1 << 63)) - (1 << 64 if value ^ (1 << 63) >= 1 << 63 else 0), high


def resample(docs: DataFrame, target_ids: DataFrame, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", seed: int = 5, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(doc_id long, log_weight double, gumbel_key double, selected boolean) of each row of ``docs``.

    ``target_ids``: ids of texts of the wanted kind in its first column; nulls
    and repeats don't count. The ceiling of ``keep`` times the rows is selected.
    Null and empty texts have log_weight 0. Equal ids have equal noise; rows
    that tie in key go by id, then text hash, and rows equal in all three are
    told apart at random only if the threshold falls among them. An empty table
    gives an empty one; other columns play no part.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    ids = target_ids.select(F.col(f"`{target_ids.columns[0]}`").try_cast("long").alias("t")).where("t is not null").distinct()
    share = int(min(1.0, target_rows / max(1, ids.count())) * (1 << 20))
    ids = ids.where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < share)  # about target_rows ids at most
    own = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    marked = own.join(F.broadcast(ids), F.col("doc_id") == F.col("t"), "left").select("text", F.col("t").isNotNull().alias("is_target"))
    ratio = spark.sparkContext.broadcast(log_ratio(*counts(marked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.zeros(0)]
            for at, end, raw, off in tv.slices(b.column(1)):
                bucket, row = ngrams(raw, off)
                n = np.bincount(row, minlength=end - at)
                total = np.bincount(row, weights=ratio.value[bucket], minlength=end - at)
                parts.append(total / np.maximum(n, 1) * np.minimum(n, LENGTH))
            w = np.concatenate(parts)
            i = b.column(0).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            u = ((tv.mix(tv.mix(i) + np.uint64(seed)) >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52
            key = w - np.log(-np.log(u))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w), pa.array(key), pa.array(_order(key)), b.column(2)], ["doc_id", "log_weight", "gumbel_key", "ord", "tie"])

    keyed = own.select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(run, "doc_id long, log_weight double, gumbel_key double, ord long, tie long")
    keyed = scratch.put(keyed, "keys")
    n = keyed.count()
    k = min(n, int(np.ceil(keep * n)))
    if k < 1:
        return keyed.select("doc_id", "log_weight", "gumbel_key", F.lit(False).alias("selected"))
    at, take = threshold(keyed, k)
    first = F.row_number().over(Window.partitionBy("ord").orderBy("doc_id", "tie")) <= take
    apart = keyed.where(F.col("ord") != at).withColumn("selected", F.col("ord") > at)
    tied = keyed.where(F.col("ord") == at).withColumn("selected", first)
    return apart.union(tied).select("doc_id", "log_weight", "gumbel_key", "selected")

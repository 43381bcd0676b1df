"""Token counts with a digest cache.

Counts are stored under (content digest, tokenizer-version digest). A call
joins its texts' digests to the stored counts, sends one text of each distinct
missing digest to the tokenizer, appends the new counts, and reads all counts
back from the cache.

Content is normalised before it is digested, by the one rule that can't change
a count of these tokenizers: runs of ASCII white space are one space each, and
go at the ends. It is used only if the tokenizer's own file says that white
space is never part of a token (``blank_free``); else the digest is the text's.

For such a tokenizer a text's count is also the sum over the pieces that white
space divides, so each worker keeps the counts of pieces that it has met, in
this task or an earlier one, and gives only new ones to the library.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Pieces whose counts a worker keeps, about; later ones are counted each time they come.
PIECES = 600_000
_BLANK = r"[\x20\x09-\x0D]+"


class _Late(dict):
    """Counts of one call's new pieces, with the kept ones behind them."""

    def __init__(self, kept: dict, new: dict):
        super().__init__(new)
        self.kept = kept

    def __missing__(self, piece: bytes) -> int:
        return self.kept[piece]


class Counter:
    """Counts of one tokenizer file: ``.json`` by tokenizers, ``.model`` by sentencepiece."""

    def __init__(self, path: str, blob: bytes | None = None):
        self.kind = os.path.splitext(path)[1]
        blob = open(path, "rb").read() if blob is None else blob
        if self.kind == ".json":
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.lib = Tokenizer.from_buffer(blob)
            self.lib.no_truncation()
            self.lib.no_padding()
            self.blank_free = _blank_free(json.loads(blob))
        elif self.kind == ".model":
            from sentencepiece import SentencePieceProcessor

            self.lib = SentencePieceProcessor(model_proto=blob)
            self.blank_free = False
        else:
            raise ValueError(f"no library for {path}")
        self.known: dict[bytes, int] = {}

    def _encode(self, texts: list[str]) -> list[int]:
        if self.kind == ".model":
            return [len(x) for x in self.lib.encode(texts, num_threads=1)]
        return [len(x.ids) for x in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[bytes]) -> list[int]:
        """Of UTF-8 texts."""
        if not self.blank_free:
            return self._encode([t.decode() for t in texts]) if texts else []
        known, pieces = self.known, [t.split() for t in texts]
        new = list({p for own in pieces for p in own if p not in known})
        n: list[int] = []
        for at in range(0, len(new), 4096):
            n += self._encode([p.decode() for p in new[at : at + 4096]])
        here = dict(zip(new, n, strict=True))
        if len(known) < PIECES:
            known.update(here)
        else:  # frequent pieces came early and stay
            late = _Late(known, here)
            return [sum(map(late.__getitem__, own)) for own in pieces]
        return [sum(map(known.__getitem__, own)) for own in pieces]


_last: dict[tuple[str, str], Counter] = {}


def kept_counter(path: str, blob: bytes, version: str) -> Counter:
    """The process's counter of a tokenizer, with the pieces that earlier tasks have met; only the last tokenizer's is kept."""
    key = os.path.splitext(path)[1], version
    if key not in _last:
        _last.clear()
        _last[key] = Counter(path, blob)
    return _last[key]


def _blank_free(spec: dict) -> bool:
    """Whether the file drops all white space between pieces, before its model sees them.

    True for one first splitter that keeps matches of a pattern only, none of
    whose alternatives can match white space, with added tokens that have none
    and take none from their sides, and normalisers that work character by
    character or on white space.
    """
    pre = spec.get("pre_tokenizer") or {}
    first = pre["pretokenizers"][0] if pre.get("type") == "Sequence" else pre
    norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    norms = norm["normalizers"] if norm["type"] == "Sequence" else [norm]
    return (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and first.get("pattern") == {"Regex": _KNOWN_SPLIT}
        and all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " " for n in norms)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens") or [])
    )


# Fixed value: a splitter pattern of public tokenizers of which no alternative matches white space.
_KNOWN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def version_of(path: str) -> str:
    """Digest of the tokenizer's file and of the rule by which it is used."""
    return hashlib.sha256(b"no special tokens, no truncation\0" + open(path, "rb").read()).hexdigest()


def digest_of(text: Column, blank_free: bool) -> Column:
    """128 bits of SHA-256 of the normalised content, as 32 hex digits."""
    text = F.coalesce(text, F.lit(""))
    text = F.btrim(F.regexp_replace(text, _BLANK, " "), F.lit(" ")) if blank_free else text
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 32)


def count_tokens(docs: DataFrame, tokenizer: str, cache_dir: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, digest string, n_bytes long, n_tokens long) of each row of ``docs``.

    ``tokenizer``: path of a .json or .model file, read on the driver and sent
    to the executors. ``cache_dir``: a Parquet table of (digest, n_tokens,
    version) that is read and appended to, partitioned by version; without it
    the cache lives as long as this call's scratch folder. A null text counts
    as an empty one: 0 bytes, and the tokens of "". Repeated rows and null ids
    keep their rows; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokencount")
    counter, version = Counter(tokenizer), version_of(tokenizer)
    cache_dir = cache_dir or f"{scratch.root}/cache"
    schema = "digest string, n_tokens long, version string"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_dir)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), digest_of(text, counter.blank_free).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    own = scratch.put(own, "digests")
    missing = own.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id")).alias("first"))
    if there:
        stored = spark.read.schema(schema).parquet(cache_dir).where(F.col("version") == version)
        missing = missing.join(stored, "digest", "left_anti")
    missing = scratch.put(missing.select("digest", F.col("first.doc_id").alias("doc_id")), "missing")

    # One text of each missing digest: of the rows with the least id, in case ids repeat the first that a task meets.
    texts = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", digest_of(F.col("text"), counter.blank_free))
    same = (texts["digest"] == missing["digest"]) & texts["doc_id"].eqNullSafe(missing["doc_id"])
    texts = texts.join(missing.hint("shuffle_hash"), same, "left_semi").select("digest", "text")
    blob = spark.sparkContext.broadcast(open(tokenizer, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept_counter(tokenizer, blob.value, version)
        for b in batches:
            got = b.column(1).cast(pa.binary()).to_pylist()
            n = np.concatenate([np.zeros(0, np.int64), *(np.array(own.counts(got[i : i + 256]), np.int64) for i in range(0, len(got), 256))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    # Rows that repeat with their id are counted each, and stored once.
    found = texts.mapInArrow(run, "digest string, n_tokens long").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).withColumn("version", F.lit(version))
    found.write.mode("append").partitionBy("version").parquet(cache_dir)
    # Two calls at a time may store a digest twice, with equal counts.
    stored = spark.read.schema(schema).parquet(cache_dir).where(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    stored = scratch.put(stored, "counts")
    return own.join(stored, "digest").select("doc_id", "digest", "n_bytes", "n_tokens")

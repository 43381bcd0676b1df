"""Writing: JSON lines, snapshots with manifests, pointers, range-sorted shards."""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """One object a line, nulls left out."""
    df.write.mode("errorifexists").json(path, compression=compression)


def with_header(df: DataFrame, path: str, meta: dict) -> None:
    """Data, and its license and cursor beside it as ``_meta.json``."""
    df.write.mode("errorifexists").json(f"{path}/data", compression="gzip")
    put_once(df.sparkSession, f"{path}/_meta.json", json.dumps(meta, sort_keys=True))


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; one that is there raises."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Rename over a file that may be there, in one step."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    src, dst = _fs(spark, fresh)[1], _fs(spark, path)[1]
    fs, _ = _fs(spark, path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(src), fs.makeQualified(dst), how)


def swap_pointer(spark: SparkSession, path: str, before: str | None, after: str, grace: float = 60.0) -> bool:
    """Replace a pointer only if it still reads ``before``; of several writers one succeeds, and readers always find a pointer.

    A writer first creates a claim named by the state that it replaces; creating
    is refused where the file is, so a state is left by one writer only. A claim
    older than ``grace`` seconds is one that a dead writer has left: the next one
    carries it out, and then fails. Needs a file system whose create without overwrite and whose rename are atomic.
    """

    def claim_of(state: str | None) -> str:
        return f"{path}.from-{hashlib.sha256((state or '').encode()).hexdigest()[:24]}"

    def carry_out(claim: str, state: str) -> None:
        _fs(spark, path)[0].delete(_fs(spark, claim_of(state))[1], False)  # of an earlier time that the pointer read so
        fresh = f"{path}.{uuid.uuid4().hex}"
        put_once(spark, fresh, state)
        _replace(spark, fresh, path)
        _fs(spark, path)[0].delete(_fs(spark, claim)[1], False)

    if read_text(spark, path) != before:
        return False
    claim = claim_of(before)
    try:
        put_once(spark, claim, after)
    except Exception:
        fs, p = _fs(spark, claim)
        if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > grace and (other := read_text(spark, claim)) and read_text(spark, path) == before:
            carry_out(claim, other)
        return False
    if read_text(spark, path) != before:
        _fs(spark, path)[0].delete(_fs(spark, claim)[1], False)
        return False
    carry_out(claim, after)
    return True


def snapshot(tables: dict[str, DataFrame], root: str, required: list[str]) -> list[dict]:
    """Every table as Parquet below ``root``; returns the manifest (table, records, bytes). A required table that is missing or empty raises."""
    if lost := [t for t in required if t not in tables]:
        raise ValueError(f"required tables missing: {lost}")
    manifest = []
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
        n = df.sparkSession.read.parquet(f"{root}/{name}").count()
        if name in required and not n:
            raise ValueError(f"required table {name} is empty")
        fs, p = _fs(df.sparkSession, f"{root}/{name}")
        manifest.append({"table": name, "records": n, "bytes": fs.getContentSummary(p).getLength()})
    return manifest


def range_shards(df: DataFrame, key: str, path: str, shards: int, rows_per_file: int) -> DataFrame:
    """Range-sorted Parquet files; returns (file, n, lo, hi), ordered by range."""
    df.repartitionByRange(shards, key).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows_per_file).mode("errorifexists").parquet(path)
    got = df.sparkSession.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    return got.orderBy("lo")


def merged_index(parts: list[DataFrame], workers: int) -> DataFrame:
    """Worker manifests as one range-sorted index; a missing worker raises."""
    if len(parts) != workers:
        raise ValueError(f"{len(parts)} of {workers} workers have finished")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("lo")


def rewrite(df: DataFrame, path: str) -> None:
    """Replace a table that ``df`` may read from: written beside it, then renamed."""
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    fresh, old = f"{path}.next", f"{path}.old"
    df.write.mode("overwrite").parquet(fresh)
    fs.delete(_fs(spark, old)[1], True)
    if fs.exists(p):
        fs.rename(p, _fs(spark, old)[1])
    fs.rename(_fs(spark, fresh)[1], p)
    fs.delete(_fs(spark, old)[1], True)

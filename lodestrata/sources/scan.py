"""Reading: strict, lenient and counting scans, and what connectors have to keep to."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    got = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(got)


def jsonl_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A missing path is an empty table; a malformed line raises when it is read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def jsonl_lenient(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Malformed lines are left out."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def jsonl_counting(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """One column ``record`` (null where malformed) and ``malformed``; lines that start with # go if ``header``."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    if header:
        lines = lines.where(~F.startswith("value", F.lit("#")))
    parsed = F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    got = lines.select(parsed.alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return got.select(F.when(~bad, F.struct(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])).alias("record"), bad.alias("malformed"))


def filtered(df: DataFrame, predicate: Column, name: str) -> tuple[DataFrame, object]:
    """Rows that meet a predicate, and an observation of rows seen and kept, filled by the first action."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("seen"), F.count_if(predicate).alias("kept")).where(predicate), seen


def parquet(spark: SparkSession, path: str, columns: list[str], predicate: Column | None = None) -> DataFrame:
    """Projection and filter, both of which reach the scan."""
    df = spark.read.parquet(path)
    return (df if predicate is None else df.where(predicate)).select(*columns)


def rrf(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Pipe-delimited rows of strings without quoting; a row's missing columns are null, those beyond are left out."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_end"]])
    return spark.read.csv(path, sep="|", schema=schema, quote="", escape="", mode="PERMISSIVE").drop("_end")


def csv_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Quotes doubled inside quotes."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', inferSchema=False)


def tsv(spark: SparkSession, path: str, key: str, valid: Column) -> tuple[DataFrame, object]:
    """Trimmed columns of rows whose key is valid, and an observation of rows processed and dropped."""
    from pyspark.sql import Observation

    df = spark.read.csv(path, sep="\t", header=True, quote="")
    df = df.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in df.columns])
    good, seen = F.col(key).isNotNull() & F.coalesce(valid, F.lit(False)), Observation(f"tsv-{key}")
    return df.observe(seen, F.count("*").alias("processed"), F.count_if(~good).alias("dropped")).where(good), seen


def table_rows(df: DataFrame, header: Column, cells: Column, wanted: list[str]) -> DataFrame:
    """Cells of a column-oriented answer by their place in its header; null where the header has no such name."""
    at = lambda n: F.array_position(header, n).cast("int")
    return df.select("*", *[F.when(at(n) > 0, F.get(cells, at(n) - 1)).alias(n) for n in wanted])


class PointerError(ValueError):
    """A pointer that doesn't say which snapshot is meant. Never read as "no data" (G17)."""


def pointer(text: str) -> dict:
    """A legacy (date) or current (snapshot_id, object_prefix, version 2) pointer; a mixture of both is refused."""
    try:
        got = json.loads(text)
    except ValueError as e:
        raise PointerError("pointer is no JSON") from e
    if not isinstance(got, dict):
        raise PointerError("pointer is no object")
    new, old = {"snapshot_id", "object_prefix"} & got.keys(), "date" in got
    if new and got.get("version") == 2 and not old and len(new) == 2 and str(got["object_prefix"]).endswith("/"):
        return {"snapshot": got["snapshot_id"], "prefix": got["object_prefix"]}
    if old and not new and "version" not in got:
        return {"snapshot": got["date"], "prefix": f"snapshots/{got['date']}/"}
    raise PointerError("pointer of unknown or mixed shape")


def snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the snapshot that ``latest.json`` points to; all tables of a request have to come from one pointer read."""
    text = "\n".join(r.value for r in spark.read.text(f"{root}/latest.json", wholetext=True).collect())
    return spark.read.parquet(f"{root}/{pointer(text)['prefix']}{table}")


class SourceLoadError(RuntimeError):
    """A source that couldn't be read: which, for what, how it failed, and whether another try may help. Never read as "no data"."""

    def __init__(self, source: str, target: str, failure_class: str, retryable: bool):
        super().__init__(f"{source}: {failure_class} while reading {target}")
        self.source, self.target, self.failure_class, self.retryable = source, target, failure_class, retryable


def failure_class(message: Column, code: Column | None = None) -> Column:
    """struct(failure_class, retryable) of an error's message; what fits nothing is taken to pass, never for missing evidence."""
    m = F.lower(F.coalesce(message, F.lit("")))
    out = lambda name, again: F.struct(F.lit(name).alias("failure_class"), F.lit(again).alias("retryable"))
    packed = F.coalesce(code.rlike("^Z_"), F.lit(False)) if code is not None else F.lit(False)
    return (
        F.when(packed, out("parse_failed", False))
        .when(m.rlike("timeout|timed out"), out("timeout", True))
        .when(m.rlike(UNAVAILABLE), out("source_unavailable", True))
        .when(m.rlike(UNREADABLE), out("parse_failed", False))
        .otherwise(out("source_unavailable", True))
    )


# Words of messages that tell a failure's class.
UNAVAILABLE = "short read|short range read|etag|not found|disappeared|missing"
UNREADABLE = "decompress|gunzip|incorrect header check|unexpected end|invalid|json|parse|unexpected token"


def load_error(spark: SparkSession, source: str, target: str, error: Exception) -> SourceLoadError:
    """The typed error of a failed read."""
    text = f"{type(error).__name__} {error}".replace("PATH_NOT_FOUND", "not found").replace("FileNotFound", "not found")
    got = spark.range(1).select(failure_class(F.lit(text[:2000])).alias("f")).first()["f"]
    return SourceLoadError(source, target, got["failure_class"], got["retryable"])


def html_guard(body: str, kind: str = "") -> bool:
    """Whether an answer is a web page instead of data."""
    return "html" in kind.lower() or body.lstrip()[:15].lower().startswith(("<!doctype html", "<html"))


def retrying(call: Callable[[], object], tries: int = 4, base: float = 0.5, most: float = 30.0, sleep: Callable[[float], None] = time.sleep, rng: random.Random | None = None) -> object:
    """Call again after errors with ``retry_after`` or with doubling, jittered waits; the last error is raised."""
    rng = rng or random.Random()
    for i in range(tries):
        try:
            return call()
        except Exception as e:
            if i == tries - 1 or getattr(e, "final", False):
                raise
            after = getattr(e, "retry_after", None)
            sleep(min(most, float(after)) if after is not None else min(most, base * 2**i) * (0.5 + rng.random() / 2))
    raise AssertionError


def should_fetch_next(page: int, got: int, page_size: int, total: int | None, most_pages: int) -> bool:
    """Whether another page is due."""
    return page < most_pages and got >= page_size and (total is None or page * page_size < total)


def next_token(now: str, latest: str | None, complete: bool) -> str:
    """The token after a loop; it moves only if all pages were read."""
    return latest if complete and latest and latest > now else now


def bisecting(ids: list[str], fetch: Callable[[list[str]], dict[str, dict]]) -> tuple[dict[str, dict], set[str]]:
    """(entities, ids without one); a batch that the source refuses (ValueError) is halved. Every id ends in exactly one."""
    found, none, todo = {}, set(), [ids] if ids else []
    while todo:
        batch = todo.pop()
        try:
            got = fetch(batch)
        except ValueError:
            if len(batch) == 1:
                none.add(batch[0])
            else:
                todo += [batch[: len(batch) // 2], batch[len(batch) // 2 :]]
            continue
        found |= {k: v for k, v in got.items() if k in set(batch)}
        none |= set(batch) - got.keys()
    if found.keys() & none or found.keys() | none != set(ids):
        raise RuntimeError("an id was lost or is in both")
    return found, none


@dataclass
class Fetched:
    records: list[dict]
    next_since: str | None


class Connector:
    """What a source offers: ``check`` whether it has updates since a token, ``fetch`` them."""

    def check(self, since: str | None) -> bool:
        raise NotImplementedError

    def fetch(self, since: str | None) -> Fetched:
        raise NotImplementedError


class FileConnector(Connector):
    """A connector over local JSON lines with a field that tokens are compared to; stands in for network sources."""

    def __init__(self, path: str, at: str = "updated"):
        self.path, self.at = path, at

    def _rows(self, since: str | None) -> Iterator[dict]:
        with open(self.path, encoding="utf-8") as f:
            for line in f:
                if line.strip():
                    r = json.loads(line)
                    if since is None or r[self.at] > since:
                        yield r

    def check(self, since: str | None) -> bool:
        return next(self._rows(since), None) is not None

    def fetch(self, since: str | None) -> Fetched:
        rows = list(self._rows(since))
        return Fetched(rows, max((r[self.at] for r in rows), default=since))


def worker_share(chunks: list[str], worker: int, workers: int) -> list[str]:
    """A worker's chunks, dealt in turn."""
    return chunks[worker::workers]

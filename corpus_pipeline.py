"""From raw documents to a training mix, in five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet below the shared folder and reads it back as the next one's docs,
so that a lost executor never reaches back over more than one stage. Stages work
on all rows that their predecessor kept. Columns beyond those of ``documents``
pass through the stages under any name; the last one adds size, source_size,
target and taken, in place of columns of these names. Ids that aren't integers
count as null: their rows are nobody's near copy, and stay. A null text goes in
the first stage; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, langid, linededup, mixing, nearsets
from lodestrata.llm.scratch import Scratch


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; null, empty and letterless texts go, and texts that fit no learned language better than another."""
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(docs, model, 1 / len(model.langs) + 1e-9 if len(model.langs) > 1 else 0.0)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later places of repeated three-line windows are cut; a document of which nothing is left goes."""
    # The operator's own columns have no place here; the documents' of their names step aside.
    aside = {c: _free(docs, f"{c}_own") for c in ("n_lines", "n_removed") if c in docs.columns}
    got = linededup.dedup_lines(docs.withColumnsRenamed(aside))
    got = got.where((F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\n\r\f\x0b")) != ""))
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return got.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts linked at a 5-word Jaccard similarity of 0.8 or more the document of least doc_id stays.

    SimHash classes and MinHash bands give the candidates, the shingles decide.
    Rows of one doc_id stay or go together; rows of a null doc_id stay.
    """
    key = _free(docs, "gone")
    got = nearsets.near_duplicates(docs, 5, 0.8)
    gone = got.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct().hint("merge")  # grows with the corpus
    return docs.join(gone, F.col("doc_id").try_cast("long") == F.col(key), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the words of each that the mix takes, in columns of its own (size, source_size, target, taken)."""
    return mixing.mix(docs)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mix)]

#: SQL has neither XXH64 with a seed nor trained models; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table; what stages have left behind is deleted once their rows are written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        mark = Scratch.mark()
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        Scratch.close_since(mark)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs

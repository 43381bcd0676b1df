"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, layout, linededup, media, mixing, resample, simhash, tokencount, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return resample.resample(_documents(spark, sf_dir), good)


def op2_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no images; every vector of ``embeddings`` is drawn as one."""
    return media.copies(media.postcards(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))).withColumnRenamed("id", "vec_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = F.col("doc_id")
    model = langid.learn(docs.where(~langid.held_out(out)))
    return langid.identify(docs, model).select("doc_id", langid.held_out(out).alias("held_out"), "lang_pred", "score")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = layout.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return got.select("page_id", "text", F.length("text").alias("n_chars"), F.size(F.split("text", "\n")).alias("n_lines"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = linededup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix(_documents(spark, sf_dir).select("doc_id", "source", "text"), keep_text=False)
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    rid = F.col("doc_id")
    learned = docs.where(~langid.held_out(rid, 3, 1))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = toxicity.sampled(labels.where(~langid.held_out(rid, 3, 1)))
    model = toxicity.learn(learned.join(F.broadcast(sample), "doc_id"), langid.learn(learned))
    return toxicity.score(docs, model).select("doc_id", langid.held_out(rid, 3, 1).alias("held_out"), "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = tokencount.count_tokens(_documents(spark, sf_dir), str(public_tokenizers.path("word_bpe_49k.json")))
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {f.__name__: f for f in (op1_importance_resampling, op2_image_copies, op3_simhash, op4_language, op5_html_text, op6_line_dedup, op7_mixing, op8_toxicity, op9_token_counts, op10_decontamination)}
ORACLE_SQL = {"op6_line_dedup": linededup.ORACLE, "op7_mixing": mixing.ORACLE, "op10_decontamination": decontaminate.ORACLE}

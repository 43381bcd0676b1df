"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is ``-ln(u) / weight`` with u from a hash of its id, so the
documents of a source in key order are a weighted sample without replacement
(Efraimidis and Spirakis, 2006) and reruns agree. A source first gives its
complete epochs; what is left of its budget goes to documents in key order until
their running sum of sizes reaches it, the last one by its leading words only.

No source is ever sorted in one task, and no text is shuffled. Keys fall into
bins whose share of a source is bounded; sums of (source, bin) give the running
sum at each bin's edge, and only the bin in which a source's budget ends is put
in order. That gives each source a last key and what it takes there, by which
every row decides for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linededup import _free
from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
MARKS = r"[\x21-\x2B\x2D\x2F-\x40\x5B-\x60\x7B-\x7E]+"
#: Shares of sources in code-point order, repeating; budget and cap as multiples of what there is.
CYCLE, BUDGET, CAP = (5.0, 2.0, 1.0), 1.5, 2.0
#: Rows of a bin, on average, and the least quality weight.
BIN_ROWS, LEAST = 2048, 0.25


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """LEAST to 1: the share of words among words and runs of odd marks, squared. Junk in marks and digits is drawn later."""
    words, marks = F.regexp_count(text, F.lit(WORD)), F.regexp_count(text, F.lit(MARKS))
    q = words / F.nullif(words + marks, F.lit(0))
    return F.greatest(F.lit(LEAST), F.coalesce(q * q, F.lit(0.0)))


def uniform(rid: Column, seed: str) -> Column:
    """A number in (0, 1) for an id, the same in every run."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(rid.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def targets(sizes: DataFrame, source: str, size: str, cycle=CYCLE, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """``sizes`` (one row for each source) with ``target``: the budget shared by weight, none above ``cap`` times its size.

    With L(i) = (budget - caps before i) / (weights from i on) over sources by
    ascending cap over weight, the level that water-filling ends at is the
    greatest L(i), so that no loop is needed.
    """
    s = F.col(size).cast("double")
    n = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (n % len(cycle) + 1).cast("int"))
    by = Window.orderBy("_ratio", F.col(source).asc_nulls_last())
    out = sizes.withColumn("_w", w).withColumn("_cap", s * cap).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    whole = Window.partitionBy()
    out = out.withColumn("_budget", F.sum(s).over(whole) * budget)
    before = F.coalesce(F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("_w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = out.withColumn("_level", (F.col("_budget") - before) / after)
    out = out.withColumn("target", F.least("_cap", F.max("_level").over(whole) * F.col("_w")))
    return out.drop("_w", "_cap", "_ratio", "_budget", "_level")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None, seed: str = "mix", cycle=CYCLE, budget: float = BUDGET, cap: float = CAP, keep_text: bool = True) -> DataFrame:
    """``docs`` with (size, source_size, target, taken): words, the source's words and target, words that the mix takes.

    Every row is returned, with taken 0 to 2 times its size; ``taken // size``
    are whole copies, the rest leading words. A null text has size 0; null is a
    source of its own, last in order. Equal ids of one source tie: where the
    budget ends among them, they share what is left alike. Existing columns of
    the four names are replaced. ``quality`` is a column of weights of LEAST or
    more. Without ``keep_text`` the text column is dropped. An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    docs = docs.drop("size", "source_size", "target", "taken")
    text, rid = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`")
    key, at, src = (_free(docs, x) for x in ("mix_key", "mix_bin", "mix_source"))
    weight = F.greatest(F.lit(LEAST), F.coalesce(quality if quality is not None else quality_of(text), F.lit(LEAST)))
    keyed = docs.withColumn("size", size_of(text)).withColumn(key, -F.ln(uniform(rid, seed)) / weight).withColumn(src, F.col(f"`{source_col}`"))
    narrow = scratch.put((keyed if keep_text else keyed.drop(text_col)).select(*([src, "size", key] if keep_text else ["*"])), "keys")

    bins = max(64, -(-narrow.count() // BIN_ROWS))
    # Equal shares at the least weight; at most 1 / LEAST times as many rows where weights are 1.
    binned = narrow.withColumn(at, F.floor((F.lit(1.0) - F.exp(-F.col(key) * LEAST)) * bins).cast("long"))
    sums = scratch.put(binned.groupBy(src, at).agg(F.sum("size").alias("words")), "bins")
    per = targets(sums.groupBy(src).agg(F.sum("words").alias("source_size")), src, "source_size", cycle, budget, cap).withColumnRenamed(src, "_s")
    whole = F.floor("target").cast("long")
    epochs = F.coalesce(F.floor(whole / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    per = scratch.put(per.withColumn("_epochs", epochs).withColumn("_left", whole - F.col("_epochs") * F.col("source_size")), "sources")

    same = F.col(src).eqNullSafe(F.col("_s"))
    ends = sums.withColumn("_upto", F.sum("words").over(Window.partitionBy(src).orderBy(at))).join(per, same).where("_upto > _left")
    ends = ends.groupBy("_s", "_left").agg(F.min_by(F.struct(F.col(at).alias("at"), (F.col("_upto") - F.col("words")).alias("before")), at).alias("_end"))
    ends = scratch.put(ends, "ends")
    last = binned.join(ends, same & (F.col(at) == F.col("_end.at"))).groupBy("_s", "_left", F.col("_end.before").alias("_before"), key).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    last = last.withColumn("_upto", F.col("_before") + F.sum("words").over(Window.partitionBy("_s").orderBy(key))).where("_upto > _left")
    last = last.groupBy(F.col("_s").alias("_l")).agg(F.min_by(F.struct(F.col(key).alias("key"), F.floor((F.col("_left") - F.col("_upto") + F.col("words")) / F.col("n")).alias("each")), key).alias("_last"))
    per = scratch.put(per.join(last, F.col("_s").eqNullSafe(F.col("_l")), "left").drop("_l"), "last")

    rows = (keyed if keep_text else narrow).join(per, same, "left")
    part = F.when(F.col(key) < F.col("_last.key"), F.col("size")).when(F.col(key) == F.col("_last.key"), F.least("size", "_last.each")).otherwise(0)
    out = rows.withColumn("taken", (F.col("size") * F.col("_epochs") + part).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col], "size", "source_size", "target", "taken")


#: The same rule in plain SQL, for DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
         len(regexp_extract_all(text, '[\x21-\x2B\x2D\x2F-\x40\x5B-\x60\x7B-\x7E]+')) AS m,
         (('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s
), l AS (
  SELECT *, source_size * 2.0::DOUBLE AS c, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS b FROM w
), v AS (
  SELECT *, (b - coalesce(sum(c) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM l
), t AS (
  SELECT source, source_size, least(c, max(lv) OVER () * w) AS target FROM v
), k AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(floor(target)::BIGINT // nullif(source_size, 0), 0) AS epochs,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / greatest(0.25::DOUBLE, coalesce((w::DOUBLE / nullif(w + m, 0)) * (w::DOUBLE / nullif(w + m, 0)), 0)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * epochs + least(size, greatest(0, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM k
"""

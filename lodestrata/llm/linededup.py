"""Repeated passages: overlapping three-line windows, found over the whole corpus.

Every run of three consecutive lines is hashed; of the places where a window
stands the first, by (doc_id, position), keeps it, and the lines that later
places cover are removed, overlapping windows merged. Windows cross the network
as 128 hash bits and a place, never as text; a window that a third of the
documents share is summed up before the shuffle, and the join back to its places
is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

_BLANK = " \t\r\f\x0b"


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def dedup_lines(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from ``text_col``, and (n_lines int, n_removed int) at the end.

    Lines end at a line feed; they are compared without white space at their
    ends, and blank lines don't count in windows but go with a passage that they
    stand in. The first place of a window is the least by (id, null ids last;
    text hash; position). Rows of equal id and text are one document and are all
    cut alike. A null text stays null with 0 lines; texts of fewer than
    ``window`` lines that aren't blank stay as they are; a text that is a later
    copy throughout becomes empty. Existing columns named n_lines or n_removed
    are replaced. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    docs = docs.drop("n_lines", "n_removed")
    key, starts = _free(docs, "row_key"), _free(docs, "later_at")
    text, rid = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`")
    row_key = F.xxhash64(rid, text)

    own = docs.select(row_key.alias("k"), rid.alias("id"), F.split(text, "\n").alias("lines"))
    own = own.select("k", "id", F.filter(F.transform("lines", lambda s: F.btrim(s, F.lit(_BLANK))), lambda s: s != "").alias("lines")).where(F.size("lines") >= window)
    parts = lambda i: [F.get("lines", i + j) for j in range(window)]
    own = own.select("k", "id", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("lines") - window), lambda i: F.struct(F.xxhash64(*parts(i)).alias("h"), F.xxhash64(F.lit("second"), *parts(i)).alias("g")))).alias("at", "w"))
    place = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("k").alias("k"), F.col("at").alias("at"))
    places = scratch.put(own.select("w.h", "w.g", place.alias("place")), "windows")

    first = places.groupBy("h", "g").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = scratch.put(first, "repeated")
    later = places.join(first, ["h", "g"]).where(F.col("place") != F.col("first"))
    later = later.groupBy(F.col("place.k").alias(key)).agg(F.array_sort(F.collect_set("place.at")).alias(starts))
    later = scratch.put(later, "later")

    # Lambdas evaluate what they use anew for each item; struct fields bound by an outer lambda are there already.
    lines = F.split(text, "\n")
    solid = F.filter(F.transform(lines, lambda s, i: F.when(F.btrim(s, F.lit(_BLANK)) != "", i)), lambda i: i.isNotNull())
    out = docs.withColumn(key, row_key).join(later.hint("merge"), key, "left")  # later grows with the corpus

    def cut(x):
        # Covered lines run from a window's first to its last, blank ones between them too.
        covered = F.flatten(F.transform(x["starts"], lambda p: F.sequence(F.get(x["solid"], p), F.get(x["solid"], p + window - 1))))
        return F.struct(x["lines"].alias("lines"), F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), covered).alias("kept"))

    def join(x):
        return F.struct(F.array_join(F.transform(x["kept"], lambda i: F.get(x["lines"], i)), "\n").alias("text"), F.size(x["kept"]).alias("n"))

    bound = F.transform(F.transform(F.array(F.struct(lines.alias("lines"), solid.alias("solid"), F.col(starts).alias("starts"))), cut), join)
    slim = _free(out, "slim")
    out = out.withColumn(slim, F.when(F.col(starts).isNotNull(), F.get(bound, 0)))
    out = out.withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1))
    out = out.withColumn("n_removed", F.when(F.col(starts).isNull(), 0).otherwise(F.col("n_lines") - F.col(f"{slim}.n")))
    out = out.withColumn(text_col, F.when(F.col(starts).isNull(), F.col(f"`{text_col}`")).otherwise(F.col(f"{slim}.text"))).drop(slim)
    return out.drop(key, starts)


#: The same rule in plain SQL, for DuckDB: doc_ids are unique in its tables.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), i AS (
  SELECT doc_id, unnest(range(0, len(lines)::BIGINT)) AS i, unnest(lines) AS line FROM l WHERE text IS NOT NULL
), s AS (
  SELECT doc_id, i, trim(line, chr(32) || chr(9) || chr(13) || chr(12) || chr(11)) AS t FROM i
), q AS (
  SELECT doc_id, i, t, row_number() OVER d AS p, lead(t, 1) OVER d AS t1, lead(t, 2) OVER d AS t2, lead(i, 2) OVER d AS i2
  FROM s WHERE t <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY t, t1, t2 ORDER BY doc_id, p) AS n FROM q WHERE i2 IS NOT NULL
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i2 + 1)) AS i FROM r WHERE n > 1
), k AS (
  SELECT i.doc_id, string_agg(i.line, chr(10) ORDER BY i.i) FILTER (WHERE c.i IS NULL) AS kept, count(*) AS n_lines, count(c.i) AS n_removed
  FROM i LEFT JOIN c ON i.doc_id = c.doc_id AND i.i = c.i GROUP BY i.doc_id
)
SELECT l.doc_id, coalesce(k.n_lines, 0)::INT AS n_lines, coalesce(k.n_removed, 0)::INT AS n_removed,
       md5(CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END) AS text_md5
FROM l LEFT JOIN k USING (doc_id)
"""

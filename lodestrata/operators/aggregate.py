"""Roll-ups, summaries, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import SEVERITIES, in_filter


def rollup(df: DataFrame, key: str, kind: str, severity: str) -> DataFrame:
    """Per key the total, counts by severity (unknown ones counted as such) and the severity-by-type table.

    (key, total, severity_rollup array of 4, type_rollup map, sev_by_type map of arrays of 4), in two partial
    aggregations: by (key, type), then by key.
    """
    known = F.when(F.col(severity).isin(*SEVERITIES), F.col(severity)).otherwise("unknown")
    counts = F.array(*[F.count_if(known == s) for s in SEVERITIES])
    by = df.groupBy(key, F.coalesce(F.col(kind), F.lit("unknown")).alias("_t")).agg(F.count("*").alias("_n"), counts.alias("_s"))
    entry = F.array_sort(F.collect_list(F.struct("_t", "_n", "_s")))
    out = by.groupBy(key).agg(F.sum("_n").alias("total"), F.array(*[F.sum(F.col("_s")[i]) for i in range(4)]).alias("severity_rollup"), entry.alias("_e"))
    return out.select(
        key, "total", "severity_rollup",
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["_t"].alias("k"), e["_n"].alias("v")))).alias("type_rollup"),
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["_t"].alias("k"), e["_s"].alias("v")))).alias("sev_by_type"),
    )


def filtered_rollup(rolled: DataFrame, key: str, wanted: list[str] | None) -> DataFrame:
    """Totals for a subset of types, from the roll-up alone. A roll-up whose parts don't add up raises."""
    sums = F.aggregate(F.map_values("type_rollup"), F.lit(0).cast("long"), lambda s, x: s + x)
    checked = F.when(sums == F.col("total"), F.col("sev_by_type")).otherwise(F.raise_error(F.concat(F.lit("inconsistent roll-up of "), F.col(key).cast("string"))))
    picked = F.filter(F.map_entries(checked), lambda e: in_filter(e["key"], wanted))
    each = lambda i: F.aggregate(picked, F.lit(0).cast("long"), lambda s, e: s + e["value"][i])
    out = rolled.select(key, *[each(i).alias(s) for i, s in enumerate(SEVERITIES)], F.size(picked).alias("n_types"))
    return out.withColumn("total", sum((F.col(s) for s in SEVERITIES[1:]), F.col(SEVERITIES[0])))


def summary(df: DataFrame, key: str, flags: dict[str, Column], example: Column, counted: Column, most: int = 5) -> DataFrame:
    """Per key a count of each flag, and the first ``most`` of the ordered examples of counted rows.

    Only ``most`` examples of a key and task are shuffled, however many it has.
    """
    totals = df.groupBy(F.col(key).alias("_k")).agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in flags.items()])
    shown = df.where(F.coalesce(counted, F.lit(False))).select(F.col(key).alias("_k2"), example.alias("_e")).where("_e is not null")
    ranked = shown.withColumn("_n", F.row_number().over(Window.partitionBy("_k2").orderBy("_e"))).where(F.col("_n") <= most)
    lists = ranked.groupBy("_k2").agg(F.array_sort(F.collect_list("_e")).alias("examples"))
    out = totals.join(lists, F.col("_k").eqNullSafe(F.col("_k2")), "left")
    return out.select(F.col("_k").alias(key), *flags, F.coalesce("examples", F.array().cast(lists.schema["examples"].dataType)).alias("examples"))


def zero_filled(df: DataFrame, kind: str, known: list[str]) -> DataFrame:
    """A10: (kind, n) for every known kind, 0 where there is none; other kinds are left out."""
    keys = df.sparkSession.createDataFrame([(k,) for k in known], f"{kind} string")
    got = df.where(F.col(kind).isin(*known)).groupBy(kind).agg(F.count("*").alias("n"))
    return keys.join(got, kind, "left").select(kind, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def distinct_per(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows and distinct values of each group."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.count_distinct(value).alias("n_distinct"))


def projection_loss(projected: DataFrame, fallback: DataFrame, code: str, kind: str, source: str) -> DataFrame:
    """Per kind the distinct codes that only the fallback has; a code of several kinds counts in each, once."""
    lost = fallback.join(projected.select(code).distinct(), code, "left_anti")
    return lost.groupBy(F.coalesce(kind, F.lit("null")).alias(kind)).agg(F.count_distinct(code).alias("n_lost"), F.count_distinct(source).alias("n_sources"))


def productivity(labels: DataFrame, key: str, linked: Column, reasons: list[tuple[str, Column]]) -> DataFrame:
    """Labels by outcome: linked, or the first reason that holds, or other."""
    out = F.when(F.coalesce(linked, F.lit(False)), "linked")
    for name, test in reasons:
        out = out.when(F.coalesce(test, F.lit(False)), name)
    return labels.withColumn("outcome", out.otherwise("other")).groupBy("outcome").agg(F.count_distinct(key).alias("n"))


def degrees(df: DataFrame, key: str, *, distinct: str | None = None) -> DataFrame:
    """Rows of each key (and distinct partners), null keys left out."""
    out = df.where(F.col(key).isNotNull()).groupBy(key)
    return out.agg(F.count("*").alias("degree"), *([F.count_distinct(distinct).alias("partners")] if distinct else []))


def quantiles(values: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row: n, max and nearest-rank quantiles (the ceil(share * n)-th smallest value), exact.

    Ranks are taken over distinct values with their counts, so that what meets
    in one task is as many rows as there are different values.
    """
    by = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    run = by.withColumn("upto", F.sum("c").over(Window.orderBy("v"))).withColumn("n", F.sum("c").over(Window.partitionBy()))
    return run.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("v").alias("max"), *[F.min(F.when(F.col("upto") >= F.ceil(F.col("n") * p), F.col("v"))).alias(name) for name, p in shares.items()])


def histogram(values: DataFrame, column: str, edges: list[int]) -> DataFrame:
    """Rows in each cell [edge, next edge), by its lower edge; below the first edge nothing counts."""
    cell = None
    for e in sorted(edges, reverse=True):
        cell = F.when(F.col(column) >= e, e) if cell is None else cell.when(F.col(column) >= e, e)
    return values.withColumn("edge", cell).where("edge is not null").groupBy("edge").agg(F.count("*").alias("n"))


def explain_degree(df: DataFrame, key: str, partner: str, least: int) -> DataFrame:
    """Keys of at least ``least`` rows: duplicate_edges if partners repeat, sentinel_key for placeholder keys, else legitimate."""
    got = degrees(df, key, distinct=partner).where(F.col("degree") >= least)
    sentinel = F.lower(F.trim(F.col(key).cast("string"))).isin("", "0", "-1", "null", "none", "n/a", "unknown")
    return got.withColumn("kind", F.when(sentinel, "sentinel_key").when(F.col("degree") > F.col("partners"), "duplicate_edges").otherwise("legitimate"))


def peak_per(df: DataFrame, at: str, width: str) -> DataFrame:
    """One row: the busiest tumbling window's start and count; the first of equals."""
    by = df.groupBy(F.window(at, width).alias("w")).agg(F.count("*").alias("n"))
    return by.agg(F.max("n").alias("peak"), F.min_by(F.col("w.start"), F.struct(-F.col("n"), F.col("w.start"))).alias("peak_start"))


def source_health(df: DataFrame, entity: str, source: str, at: str) -> DataFrame:
    """Per source its entities and the latest of their latest stamps."""
    latest = df.where(F.col(source).isNotNull()).groupBy(entity, source).agg(F.max(at).alias("at"))
    return latest.groupBy(source).agg(F.count("*").alias("records"), F.max("at").alias("last_seen"))


def findings(df: DataFrame, key: str, flag: Column, target: str, unitless: Column, phased: Column) -> DataFrame:
    """Per key counts of a flag's three states, distinct targets, and gaps that acceptance checks name."""
    got = df.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(flag, F.lit(False))).alias("n_true"), F.count_if(F.coalesce(~flag, F.lit(False))).alias("n_false"), F.count_if(flag.isNull()).alias("n_null"),
        F.count_distinct(target).alias("targets"), (F.count_if(unitless) / F.count("*")).alias("unitless_share"), (F.count_if(phased) / F.count("*")).alias("phase_share"),
    )
    gaps = F.array(F.when(F.col("unitless_share") > 0.3, F.lit("unitless")), F.when(F.col("phase_share") < 0.5, F.lit("phase_coverage")))
    return got.withColumn("gaps", F.array_join(F.filter(gaps, lambda x: x.isNotNull()), ","))


def index_size(df: DataFrame, key: str, page: int) -> DataFrame:
    """One row: edges, keys, pages if packed, pages of the largest key."""
    d = degrees(df, key)
    return d.agg(F.sum("degree").alias("edges"), F.count("*").alias("keys"), F.ceil(F.sum("degree") / page).alias("packed_pages"), F.ceil(F.max("degree") / page).alias("largest_pages"))


def drug_signals(df: DataFrame, key: str, sets: list[str], rank: dict[str, int], ranked: str) -> DataFrame:
    """Per key ordered distinct values of each column in ``sets``, and the value of ``ranked`` of highest rank."""
    order = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in rank.items() for x in kv]), F.col(ranked)), F.lit(-1))
    return df.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in sets], F.max_by(ranked, F.when(F.col(ranked).isNotNull(), order)).alias(ranked))


def totals(manifest: DataFrame) -> DataFrame:
    """One row of a snapshot's tables, records, bytes, and bytes as read over bytes as written."""
    return manifest.agg(F.count("*").alias("tables"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.sum("raw_bytes").alias("raw_bytes")).withColumn("ratio", F.col("raw_bytes") / F.nullif(F.col("bytes"), F.lit(0)))

"""Negative evidence: seven builders of one shape, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.ident import fnv1a_utf16
from ..functions.text import slug
from .dedup import last_by

COLUMNS = ("id", "evidence_type", "subject_id", "reason_category", "reason_text", "severity", "confidence", "occurred_date", "source", "source_id")


def _row(df: DataFrame, prefix: str, **c: Column | str | int | None) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    made = {n: lit(c.get(n)) for n in COLUMNS}
    made["id"] = F.concat(F.lit(f"{prefix}::neg::"), made["id"])
    kinds = {"confidence": "int"}
    return df.select(*[made[n].cast(kinds.get(n, "string")).alias(n) for n in COLUMNS])


def trial_failures(negatives: DataFrame, trials: DataFrame, prefix: str = "lode") -> DataFrame:
    """negatives(nct_id, compound_id, status_reason, seq), trials(nct_id, completion, source, seq): the last trial of a number is meant."""
    t = last_by(trials.where("nct_id is not null"), ["nct_id"], ["seq"]).select(F.col("nct_id").alias("_n"), "completion", F.col("source").alias("_s"))
    j = negatives.join(t, negatives["nct_id"] == t["_n"], "left").withColumn("_f", rules.failure_category(F.col("status_reason")))
    return _row(
        j, prefix, id=F.concat(F.lit("trial::"), "nct_id"), evidence_type="trial_failure", subject_id=F.col("compound_id"), reason_category=F.col("_f.category"), reason_text=F.col("status_reason"),
        severity=rules.failure_severity(F.col("_f.category")), confidence=F.greatest(F.lit(40), F.least(F.lit(80), F.col("_f.confidence"))), occurred_date=F.col("completion"),
        source=F.when(F.col("_s") == "ctis", "ctis_ema").otherwise("clinicaltrials_gov"), source_id=F.col("nct_id"),
    )


def adverse_events(trials: DataFrame, prefix: str = "lode") -> DataFrame:
    """trials(nct_id, interventions array<struct<compound_id>>, serious_events_count, completion): of the first intervention with a compound."""
    subject = F.get(F.filter(F.transform("interventions", lambda i: i["compound_id"]), lambda c: c.isNotNull()), 0)
    return _row(
        trials.where("serious_events_count > 0"), prefix, id=F.concat(F.lit("ae::"), "nct_id"), evidence_type="serious_adverse_event_per_trial", subject_id=subject,
        reason_category="serious_adverse_events_recorded", severity=rules.event_severity(F.col("serious_events_count")), confidence=90, occurred_date=F.col("completion"), source="clinicaltrials_gov", source_id=F.col("nct_id"),
    )


def boxed_warnings(compounds: DataFrame, prefix: str = "lode") -> DataFrame:
    """compounds(id, warnings array<string>, application_numbers array<string>): one row for each text, its place and hash in the id."""
    each = compounds.select("id", "application_numbers", F.posexplode("warnings").alias("_i", "_t")).where(F.length("_t") > 0)
    return _row(
        each, prefix, id=F.concat(F.lit("boxed::"), "id", F.lit("::"), F.col("_i").cast("string"), F.lit("::"), fnv1a_utf16(F.col("_t"))), evidence_type="black_box_warning", subject_id=F.col("id"),
        reason_category="fda_mandated_boxed_warning", reason_text=F.col("_t"), severity="critical", confidence=100, source="openfda_drug_label", source_id=F.coalesce(F.get("application_numbers", 0), F.col("id")),
    )


def withdrawals(compounds: DataFrame, prefix: str = "lode") -> DataFrame:
    """compounds(id, chembl_id, withdrawn boolean, withdrawn_reason)."""
    return _row(
        compounds.where("withdrawn"), prefix, id=F.concat(F.lit("withdrawn::"), "id"), evidence_type="drug_withdrawal", subject_id=F.col("id"), reason_category="withdrawn_from_market",
        reason_text=F.col("withdrawn_reason"), severity="critical", confidence=90, source="chembl_withdrawn", source_id=F.coalesce("chembl_id", "id"),
    )


def report_signals(compounds: DataFrame, prefix: str = "lode") -> DataFrame:
    """compounds(id, unii, terms array<struct<term, count>>): one row for each term. Ids may meet where slugs are cut."""
    each = compounds.select("id", "unii", F.explode("terms").alias("_t"))
    return _row(
        each, prefix, id=F.concat(F.lit("faers::"), "id", F.lit("::"), slug(F.col("_t.term"))), evidence_type="faers_adr_signal", subject_id=F.col("id"), reason_category="meddra_pt_adr",
        reason_text=F.col("_t.term"), severity=rules.report_severity(F.col("_t.count")), confidence=85, source="openfda_faers", source_id=F.coalesce("unii", "id"),
    )


def retractions(papers: DataFrame, prefix: str = "lode") -> DataFrame:
    """papers(id, doi, openalex_id, pmid, is_retracted, retraction_source, retraction_nature, retraction_date)."""
    name = F.coalesce(F.regexp_replace(F.nullif("doi", F.lit("")), "[^a-zA-Z0-9.]", "_"), "openalex_id", "pmid", F.lit("unknown"))
    both = F.col("retraction_source") == "multi_source_consensus"
    return _row(
        papers.where("is_retracted"), prefix, id=F.concat(F.lit("retraction::"), name), evidence_type="paper_retraction", subject_id=F.col("id"), reason_category=F.coalesce("retraction_nature", F.lit("Retraction")),
        severity="major", confidence=F.when(both, 100).otherwise(90), occurred_date=F.col("retraction_date"), source=F.when(F.col("retraction_source") == "pubmed", "pubmed_pubtype").otherwise("retraction_watch"),
        source_id=F.coalesce("doi", "pmid", "openalex_id"),
    )


def inactive_assays(activities: DataFrame, prefix: str = "lode") -> DataFrame:
    """activities(id, compound_id, is_active, is_active_method, score): inactive ones, inconclusive methods left out."""
    method = F.coalesce("is_active_method", F.lit("value_threshold_v1"))
    return _row(
        activities.where((F.col("is_active") == F.lit(False)) & ~F.contains(method, F.lit("inconclusive"))), prefix, id=F.concat(F.lit("bioassay::"), F.col("id").cast("string")), evidence_type="inactive_bioassay",
        subject_id=F.col("compound_id"), reason_category="measured_inactive", severity="minor", confidence=F.coalesce("score", F.lit(60)), source="chembl_inactive", source_id=F.col("id"),
    )

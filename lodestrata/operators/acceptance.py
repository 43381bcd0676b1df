"""Named checks of what a client can answer from one compound's records, for all compounds at once.

Each linked table is summed up by compound first; a check is a condition over
those sums under which the answer has a gap. Questions list the checks that
they need, so a question is answered where none of its checks has a gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Questions and the checks that each needs.
QUESTIONS = {
    "compound_lookup": ("structural_data", "lipinski_violations", "synonyms", "molecular_weight", "confidence_score"),
    "drug_status": ("max_phase", "first_approval_year", "withdrawn_status"),
    "bioactivity_profile": ("active_count", "target_diversity", "ic50_values", "units_standardized"),
    "clinical_history": ("trial_count", "phase_distribution", "conditions_covered"),
    "failure_evidence": ("negative_outcomes", "why_stopped_text", "failure_classification"),
    "literature_support": ("paper_count", "citation_counts", "mesh_terms", "recent_papers", "open_access_flag"),
    "retraction_check": ("retraction_doi_proof", "retraction_source_provenance"),
    "confidence_per_claim": ("confidence_score", "per_dimension_confidence", "source_count", "structural_match_flag"),
    "cross_link_validation": ("paper_to_trial_links", "doi_traceability"),
    "provenance_audit": ("source_list_per_field", "timestamp_per_extraction", "extraction_method_visible"),
}


def _count(test: Column, name: str) -> Column:
    return F.count_if(F.coalesce(test, F.lit(False))).alias(name)


def facts(compounds: DataFrame, papers: DataFrame, activities: DataFrame, trials: DataFrame, negatives: DataFrame) -> DataFrame:
    """One row a compound: its own fields, and counts over its papers, activities, trials and negatives (compound_id)."""
    c = F.col
    p = papers.groupBy("compound_id").agg(
        F.count("*").alias("papers"), _count(c("citation_count") > 0, "cited"), _count(c("mesh") > 0, "meshed"), _count(c("year") >= 2020, "recent"), _count(c("open_access"), "open"), _count(F.length("doi") > 0, "with_doi"),
        _count(c("retracted"), "retracted"), _count(c("retracted") & c("retraction_doi").isNotNull(), "proved"), _count(c("retracted") & c("retraction_source").isNotNull(), "sourced"), _count(c("trial_mentions") > 0, "linked"),
    )
    a = activities.groupBy("compound_id").agg(F.count("*").alias("activities"), F.count_distinct("target_id").alias("targets"), _count((c("kind") == "IC50") & (c("value") > 0), "ic50"), _count(c("unit") == "unitless", "unitless"))
    t = trials.groupBy("compound_id").agg(F.count("*").alias("trials"), _count(c("drug"), "drug_trials"), _count(c("drug") & c("phase").isNotNull(), "phased"), F.sum("conditions").alias("conditions"))
    n = negatives.groupBy("compound_id").agg(F.count("*").alias("negatives"), _count(F.length("reason") > 0, "reasons"), _count(c("category").isNotNull(), "classified"))
    out = compounds
    for side in (p, a, t, n):
        out = out.join(side, out["id"] == side["compound_id"], "left").drop("compound_id")
    return out.na.fill(0, ["papers", "cited", "meshed", "recent", "open", "with_doi", "retracted", "proved", "sourced", "linked", "activities", "targets", "ic50", "unitless", "trials", "drug_trials", "phased", "conditions", "negatives", "reasons", "classified"])


def checks() -> dict[str, Column]:
    """Where each check finds a gap, over ``facts``; never null."""
    c = F.col
    share = lambda part, whole, least: (c(whole) > 0) & (c(part) / F.nullif(c(whole), F.lit(0)) < least)
    empty = lambda x: F.length(F.coalesce(c(x), F.lit(""))) == 0
    out = {
        "structural_data": empty("smiles") | empty("inchi") | empty("formula"),
        "lipinski_violations": c("violations").isNull(),
        "synonyms": F.coalesce(c("synonyms"), F.lit(0)) == 0,
        "molecular_weight": F.coalesce(c("weight"), F.lit(0)) == 0,
        "confidence_score": F.coalesce(c("overall"), F.lit(0)) < 50,
        "max_phase": c("max_phase").isNull(),
        "first_approval_year": c("first_approval").isNull() & F.coalesce(c("max_phase") == 4, F.lit(False)),
        "withdrawn_status": c("withdrawn").isNull(),
        "active_count": c("activities") == 0,
        "target_diversity": (c("activities") > 0) & (c("targets") == 0),
        "ic50_values": (c("activities") > 0) & (c("ic50") == 0),
        "units_standardized": (c("activities") > 0) & (c("unitless") / F.nullif(c("activities"), F.lit(0)) > 0.3),
        "trial_count": c("trials") == 0,
        "phase_distribution": share("phased", "drug_trials", 0.5),
        "conditions_covered": (c("trials") > 0) & (c("conditions") == 0),
        "negative_outcomes": c("negatives") == 0,
        "why_stopped_text": (c("negatives") > 0) & (c("reasons") == 0),
        "failure_classification": (c("negatives") > 0) & (c("classified") == 0),
        "paper_count": c("papers") == 0,
        "citation_counts": share("cited", "papers", 0.3),
        "mesh_terms": share("meshed", "papers", 0.3),
        "recent_papers": (c("papers") > 0) & (c("recent") == 0),
        "open_access_flag": share("open", "papers", 0.2),
        "retraction_doi_proof": c("proved") < c("retracted"),
        "retraction_source_provenance": c("sourced") < c("retracted"),
        "per_dimension_confidence": c("structural").isNull() | c("bioactivity").isNull(),
        "source_count": F.coalesce(c("sources"), F.lit(0)) < 2,
        "structural_match_flag": c("structural_match").isNull(),
        "paper_to_trial_links": (c("papers") > 0) & (c("linked") == 0),
        "doi_traceability": share("with_doi", "papers", 0.5),
        "source_list_per_field": F.coalesce(c("sources"), F.lit(0)) == 0,
        "timestamp_per_extraction": F.coalesce(c("timestamps") < c("sources"), F.lit(True)),
        "extraction_method_visible": F.coalesce(c("methods") < c("sources"), F.lit(True)),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def gaps(df: DataFrame) -> DataFrame:
    """(id, gaps, answered): the checks that a compound fails, in order, and how many questions it answers without a gap."""
    tests = checks()
    failed = F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())
    whole = sum((F.when(~F.arrays_overlap(F.col("gaps"), F.array(*[F.lit(x) for x in names])), 1).otherwise(0) for names in QUESTIONS.values()), F.lit(0))
    return df.select("id", failed.alias("gaps")).withColumn("answered", whole)

"""Source rows as records: one projection a source, typed, with provenance; rows without their key drop out.

Columns that a source's table lacks are null. ``at`` is the time of reading, and
``space`` the first part of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, rules, text

SPACE = "lode"
# Stopped states of the two trial registries, assay kinds, synonym kinds that count, kinds of applications.
NEGATIVE = ("TERMINATED", "WITHDRAWN", "SUSPENDED")
EU_NEGATIVE = ("ENDED_PREMATURELY", "TERMINATED", "HALTED", "CANCELLED", "WITHDRAWN")
ASSAYS = {"B": "binding", "F": "functional", "A": "admet", "T": "toxicity", "P": "physicochemical"}
SYNONYM_KINDS = ("SY", "AB", "PT")
APPLICATIONS = ("NDA", "ANDA", "BLA")


def _col(df: DataFrame, name: str, kind: str) -> Column:
    """A column by its name, cast where it parses; null of that type if the table lacks it."""
    return F.col(f"`{name}`").try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _list(df: DataFrame, name: str, kind: str = "array<string>") -> Column:
    got = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)
    return F.coalesce(got, F.array().cast(kind))


def provenance(source: str, source_id: Column, at: Column, method: str) -> Column:
    return F.struct(F.array(F.struct(F.lit(source).alias("source"), source_id.cast("string").alias("source_id"), at.alias("timestamp"), F.lit(method).alias("extraction_method"))).alias("sources"), at.alias("last_updated"))


def _id(space: str, kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{space}::{kind}::"), key.cast("string"))


def compounds(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Upper-camel compound rows; a weight may come as a string; rows without an InChIKey drop out."""
    s, n = (lambda c: _col(df, c, "string")), (lambda c, k="double": _col(df, c, k))
    weight = n("MolecularWeight")
    props = F.struct(
        F.when(n("XLogP").isNotNull(), F.struct(n("XLogP").alias("value"), F.lit("XLogP3").alias("method"))).alias("log_p"),
        F.when(n("TPSA").isNotNull(), F.struct(n("TPSA").alias("value"), F.lit("angstrom_squared").alias("unit"))).alias("tpsa"),
        n("Complexity").alias("complexity"), n("HBondDonorCount", "int").alias("h_bond_donors"), n("HBondAcceptorCount", "int").alias("h_bond_acceptors"), n("RotatableBondCount", "int").alias("rotatable_bonds"),
        numeric.lipinski(weight, n("XLogP"), n("HBondDonorCount"), n("HBondAcceptorCount")).alias("lipinski_violations"),
    )
    return df.where(F.length(s("InChIKey")) > 0).select(
        _id(space, "compound", F.concat(F.lit("CID:"), s("CID"))).alias("id"), n("CID", "long").alias("pubchem_cid"), s("InChIKey").alias("inchi_key"),
        F.coalesce(s("SMILES"), s("CanonicalSMILES"), s("IsomericSMILES"), F.lit("")).alias("smiles_canonical"), F.coalesce(s("InChI"), F.lit("")).alias("inchi"), F.coalesce(s("MolecularFormula"), F.lit("")).alias("molecular_formula"),
        F.struct(weight.alias("value"), F.lit("Da").alias("unit")).alias("molecular_weight"), s("IUPACName").alias("iupac_name"), _list(df, "synonyms").alias("synonyms"), props.alias("properties"),
        provenance("pubchem", s("CID"), at, "pubchem_pug_rest_v1").alias("provenance"),
    )


def drug_status(df: DataFrame) -> Column:
    """Phase, approval, withdrawal, warning and class codes of a molecule row; a phase that isn't finite is null."""
    phase = _col(df, "max_phase", "double")
    flag = lambda c: F.coalesce(F.lower(_col(df, c, "string")).isin("true", "1"), F.lit(False))
    return F.struct(
        F.when(~F.isnan(phase) & (F.abs(phase) < float("inf")), phase).alias("max_phase"), _col(df, "first_approval", "int").alias("first_approval_year"), F.coalesce(_col(df, "withdrawn_flag", "boolean"), F.lit(False)).alias("withdrawn"),
        _col(df, "withdrawn_reason", "string").alias("withdrawn_reason"), flag("black_box_warning").alias("black_box_warning"), text.safe_list(_list(df, "atc_classifications")).alias("atc_codes"),
    )


def molecules(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Molecule rows with their drug status."""
    key = _col(df, "molecule_chembl_id", "string")
    return df.where(F.length(key) > 0).select(_id(space, "compound::chembl", key).alias("id"), key.alias("chembl_id"), _col(df, "standard_inchi_key", "string").alias("inchi_key"), drug_status(df).alias("drug_status"), provenance("chembl", key, at, "chembl_rest_v2").alias("provenance"))


def activities(df: DataFrame, at: Column, space: str = SPACE, compat_ki_kd: bool = False) -> DataFrame:
    """Measurements; negative and unreadable values drop out; unit, kind, assay, activity and confidence by their rules."""
    key, value = _col(df, "activity_id", "string"), _col(df, "standard_value", "double")
    raw = _col(df, "standard_units", "string")
    unit, kind = numeric.unit(raw), rules.activity_type(_col(df, "standard_type", "string"), compat_ki_kd)
    assay = numeric.lookup(ASSAYS, _col(df, "assay_type", "string"))
    good = df.where(key.isNotNull() & (value >= 0) & (value < float("inf")))
    return good.select(
        _id(space, "bioactivity", F.concat(F.lit("CHEMBL_ACT_"), key)).alias("id"), _col(df, "compound_id", "string").alias("compound_id"), F.coalesce(_col(df, "target_chembl_id", "string"), F.lit("unknown")).alias("target_id"),
        kind.alias("activity_type"), value.alias("value"), unit.alias("unit"), raw.alias("unit_raw"), rules.activity(value, unit, kind).alias("a"), rules.measurement_confidence(value, unit, kind, assay).alias("confidence"),
        assay.alias("assay_type"), _col(df, "target_organism", "string").alias("organism"), provenance("chembl", key, at, "chembl_rest_v1").alias("provenance"),
    ).withColumns({"is_active": F.col("a.is_active"), "is_active_method": F.col("a.method")}).drop("a")


def trials(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Registry rows of a well-formed number; stopped states (suspended ones too, G2) are negative outcomes; at most 100 conditions and 200 references."""
    key = _col(df, "nctId", "string")
    status = F.coalesce(_col(df, "overallStatus", "string"), F.lit("UNKNOWN"))
    refs = F.filter(_list(df, "references", "array<struct<pmid:string,type:string>>"), lambda r: F.coalesce(r["pmid"].rlike(r"^\d+$"), F.lit(False)))
    return df.where(key.rlike(r"^NCT\d{8}$")).select(
        _id(space, "trial", key).alias("id"), key.alias("nct_id"), status.alias("status"), _col(df, "whyStopped", "string").alias("status_reason"), status.isin(*NEGATIVE).alias("is_negative_outcome"), numeric.phase(_list(df, "phases")).alias("phase"),
        F.slice(_list(df, "conditions"), 1, 100).alias("conditions"), F.filter(_list(df, "interventions", "array<struct<name:string,type:string>>"), lambda i: F.length(i["name"]) > 0).alias("interventions"),
        F.struct(_col(df, "enrollment", "int").alias("target"), _col(df, "enrollmentType", "string").alias("type")).alias("enrollment"), F.struct(_col(df, "startDate", "string").alias("start"), _col(df, "completionDate", "string").alias("completion")).alias("dates"),
        _col(df, "leadSponsor", "string").alias("sponsor"), F.slice(refs, 1, 200).alias("references"), provenance("clinicaltrials", key, at, "ct_gov_v2_api").alias("provenance"),
    )


def eu_trials(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Rows of the European registry; the state by number or by name."""
    key, raw = _col(df, "ctNumber", "string"), _col(df, "ctStatus", "string")
    status = F.when(raw.rlike(r"^\d+$"), numeric.eu_state(code=raw.try_cast("int"))).otherwise(numeric.eu_state(name=raw))
    products = F.filter(F.slice(_list(df, "product"), 1, 50), lambda p: F.length(p) > 0)
    return df.where(F.length(key) > 0).select(
        _id(space, "trial", key).alias("id"), key.alias("ct_number"), status.alias("status"), _col(df, "endReason", "string").alias("status_reason"), status.isin(*EU_NEGATIVE).alias("is_negative_outcome"),
        numeric.eu_phase(_col(df, "trialPhase", "string")).alias("phase"), F.slice(_list(df, "conditions"), 1, 100).alias("conditions"), F.transform(products, lambda p: F.struct(p.alias("name"), F.lit("DRUG").alias("type"))).alias("interventions"),
        _col(df, "totalNumberEnrolled", "int").alias("enrollment"), _col(df, "sponsor", "string").alias("sponsor"), provenance("ctis", key, at, "ctis_public_api_v1").alias("provenance"),
    )


def papers(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Works with a title; ids normalised, the abstract put together, at most 2,000 and 20,000 characters of either."""
    work, doi = text.work_id(_col(df, "id", "string")), text.doi(_col(df, "doi", "string"))
    title = F.coalesce(_col(df, "title", "string"), _col(df, "display_name", "string"), F.lit(""))
    body = F.substring(text.abstract(F.col("abstract_inverted_index")), 1, 20000) if "abstract_inverted_index" in df.columns else F.lit(None).cast("string")
    gone = F.coalesce(_col(df, "is_retracted", "boolean"), F.lit(False))
    key = F.coalesce(work, F.concat(F.lit("doi-"), F.regexp_replace(doi, "[^a-zA-Z0-9.]", "_")))
    return df.where((F.length(_col(df, "id", "string")) > 0) & (title != "") & key.isNotNull()).select(
        _id(space, "paper", key).alias("id"), doi.alias("doi"), work.alias("openalex_id"), text.trailing_digits(_col(df, "pmid", "string")).alias("pmid"), F.substring(title, 1, 2000).alias("title"), body.alias("abstract"),
        _col(df, "publication_year", "int").alias("publication_year"), F.coalesce(_col(df, "cited_by_count", "int"), F.lit(0)).alias("citation_count"), gone.alias("is_retracted"), F.when(gone, "openalex").alias("retraction_source"),
        F.coalesce(text.trial_ids(body), F.array().cast("array<string>")).alias("mentioned_trial_ids"), provenance("openalex", F.coalesce(work, doi), at, "openalex_works_api").alias("provenance"),
    )


def labels(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Drug labels; lists without empty items, a title of 500 characters, at most 20 dosage forms."""
    key = _col(df, "setid", "string")
    rxcui = F.col("rxcui") if "rxcui" in df.columns and df.schema["rxcui"].dataType.typeName() == "array" else F.array(_col(df, "rxcui", "string"))
    sections = F.col("sections") if "sections" in df.columns else F.lit(None).cast("map<string,string>")
    return df.where(F.length(key) > 0).select(
        _id(space, "drug_label::setid", key).alias("id"), key.alias("setid"), _col(df, "spl_version", "string").alias("spl_version"), F.substring(F.coalesce(_col(df, "title", "string"), F.lit("")), 1, 500).alias("title"),
        text.safe_list(rxcui).alias("rxcui"), text.safe_list(_list(df, "ndcs")).alias("ndcs"), F.slice(text.safe_list(_list(df, "dosage_forms")), 1, 20).alias("dosage_forms"),
        F.try_element_at(sections, F.lit("boxed_warning")).isNotNull().alias("has_boxed_warning"), sections.isNotNull().alias("sections_extracted"), provenance("dailymed", key, at, "dailymed_rest_v2").alias("provenance"),
    )


def classes(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Classification rows with a code of the fifth level."""
    key = _col(df, "level5", "string")
    names = [f"level{i}{x}" for i in range(1, 5) for x in ("", "_description")]
    return df.where(F.length(key) > 0).select(_id(space, "atc_class", key).alias("id"), *[_col(df, n, "string").alias(n) for n in names], key.alias("level5"), _col(df, "who_name", "string").alias("who_name"), provenance("who_atc_via_chembl", key, at, "chembl_rest_v1_atc_class").alias("provenance"))


def applications(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Applications, their kind by the number's first letters; at most 10 submissions."""
    key = _col(df, "application_number", "string")
    kind = None
    for k in APPLICATIONS:
        test = F.startswith(key, F.lit(k))
        kind = F.when(test, k) if kind is None else kind.when(test, k)
    return df.where(F.length(key) > 0).select(
        _id(space, "orangebook", key).alias("id"), key.alias("application_number"), kind.otherwise("OTHER").alias("application_type"), _col(df, "sponsor_name", "string").alias("sponsor_name"),
        _list(df, "products", "array<struct<brand_name:string,route:string>>").alias("products"), F.slice(_list(df, "submissions"), 1, 10).alias("submissions"), provenance("fda_orangebook", key, at, "openfda_drugsfda_v1").alias("provenance"),
    )


def terms(df: DataFrame, at: Column, space: str = SPACE) -> DataFrame:
    """Thesaurus concepts; names of three kinds, at most 50; the first definition, 1,000 characters."""
    key = _col(df, "code", "string")
    names = F.filter(_list(df, "synonyms", "array<struct<termType:string,name:string>>"), lambda s: s["termType"].isin(*SYNONYM_KINDS) & (F.length(s["name"]) > 0))
    return df.where(F.length(key) > 0).select(_id(space, "nci_concept", key).alias("id"), key.alias("code"), _col(df, "name", "string").alias("name"), F.slice(F.transform(names, lambda s: s["name"]), 1, 50).alias("synonyms"), F.substring(F.get(_list(df, "definitions"), 0), 1, 1000).alias("definition"), provenance("nci_thesaurus", key, at, "evs_rest_api_v1").alias("provenance"))


def proteins(df: DataFrame) -> DataFrame:
    """Primary fields of protein records; the recommended name before the first submitted one."""
    key = _col(df, "primaryAccession", "string")
    return df.where(F.length(key) > 0).select(
        key.alias("uniprot_accession"), _col(df, "uniProtkbId", "string").alias("uniprot_id"), F.coalesce(_col(df, "recommendedName", "string"), F.get(_list(df, "submissionNames"), 0)).alias("protein_name"), F.get(_list(df, "genes"), 0).alias("gene_symbol"),
        F.struct(_col(df, "taxonId", "int").alias("taxon_id"), _col(df, "scientificName", "string").alias("scientific_name")).alias("organism"), _col(df, "length", "int").alias("sequence_length"),
    )


def mapped(items: Column, key: str, form) -> Column:
    """A list's items in another form; items without ``key`` drop out; a null list is empty."""
    kept = F.filter(items, lambda x: F.length(x[key]) > 0)
    return F.coalesce(F.transform(kept, form), F.array())


def indications(items: Column) -> Column:
    """Indications with a disease, and their trials with a report id."""
    return F.transform(
        F.filter(items, lambda x: F.length(x["disease_id"]) > 0),
        lambda x: F.struct(x["disease_id"].alias("disease_id"), x["max_clinical_stage"].alias("max_clinical_stage"), F.filter(x["trials"], lambda t: F.length(t["report_id"]) > 0).alias("trials")),
    )


def cross_references(refs: Column) -> Column:
    """References with a source and at least one id that isn't empty."""
    kept = F.filter(refs, lambda r: r["source"].isNotNull() & r["ids"].isNotNull())
    trimmed = F.transform(kept, lambda r: F.struct(r["source"].alias("source"), F.filter(r["ids"], lambda i: F.length(i) > 0).alias("ids")))
    return F.filter(trimmed, lambda r: F.size(r["ids"]) > 0)


def clinical(df: DataFrame, phase: str = "max_phase") -> DataFrame:
    """P10: rows of phase 1 or more; null isn't."""
    return df.where(F.coalesce(F.col(phase) >= 1, F.lit(False)))


# Rows that an enricher still has to work on. Nulls decide as if absent.
def lacks_source(inchi_key: Column, sources: Column, source: str) -> Column:
    """A structure key, and the source not among those that have answered."""
    return (F.length(F.coalesce(inchi_key, F.lit(""))) > 0) & ~F.coalesce(F.array_contains(sources, source), F.lit(False))


def lacks_code(unii: Column, rxcui: Column) -> Column:
    """A substance id, and no drug code."""
    return unii.isNotNull() & rxcui.isNull()


def older_version(unii: Column, version: Column, current: int) -> Column:
    """A substance id, and an enrichment version below the current one."""
    return (F.length(F.coalesce(unii, F.lit(""))) > 0) & (F.coalesce(version, F.lit(0)) < current)


def unattempted(unii: Column, version: Column, terms: Column, current: int) -> Column:
    """Of an older version, or of the current one without a list of terms (an empty list is an answer)."""
    return (F.length(F.coalesce(unii, F.lit(""))) > 0) & ((F.coalesce(version, F.lit(0)) < current) | terms.isNull())


# Vocabularies whose package codes are taken.
CODE_SOURCES = ("RXNORM", "MTHSPL")


def vocabulary_rows(df: DataFrame, source: str) -> DataFrame:
    """Concept names of one vocabulary that aren't suppressed, in English, with a code."""
    return df.where((F.col("SAB") == source) & (F.col("SUPPRESS") == "N") & (F.col("LAT") == "ENG") & (F.length("CODE") > 0))


def attribute_rows(df: DataFrame) -> DataFrame:
    """Attribute rows that aren't suppressed: substance ids of any source, package codes of the accepted ones."""
    shown = F.coalesce(F.nullif(F.col("SUPPRESS"), F.lit("")), F.lit("N")) == "N"
    wanted = (F.col("ATN") == "UNII") | (F.col("ATN") == "NDC") & F.col("SAB").isin(*CODE_SOURCES)
    return df.where(shown & wanted & (F.length("RXCUI") > 0) & (F.length(F.trim("ATV")) > 0))

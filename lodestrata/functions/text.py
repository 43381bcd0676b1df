"""Strings: normalising, tokenising, identifier shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ontology prefixes that have a namespace of their own.
DISEASE_NAMESPACES = {"OBA": "oba", "MONDO": "mondo", "EFO": "efo", "HP": "hp", "Orphanet": "orphanet"}
OTHER_NAMESPACE = "unclassified_ontology"

DOI = r"^10\.\d{4,}/\S+$"


def clean(x: Column) -> Column:
    """trimmed and lower case; null if nothing is left."""
    return F.nullif(F.lower(F.trim(x)), F.lit(""))


def first_filled(*xs: Column) -> Column:
    """F32: the first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs])


def search_tokens(x: Column) -> Column:
    """distinct runs of letters and digits of any script, of 2 to 50 characters."""
    parts = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), r"\s+")
    return F.array_distinct(F.filter(parts, lambda t: F.length(t).between(2, 50)))


def link_tokens(x: Column) -> Column:
    """distinct runs of a-z and 0-9 of more than two characters."""
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "), " ")
    return F.array_distinct(F.filter(parts, lambda t: F.length(t) > 2))


def safe_list(xs: Column) -> Column:
    """Only strings that aren't empty."""
    return F.filter(F.coalesce(xs, F.array().cast("array<string>")), lambda x: F.length(x) > 0)


def doi(x: Column, trailing: bool = False) -> Column:
    """without the resolver's address, lower case; null if it isn't of a DOI's shape. ``trailing``: punctuation at the end goes first."""
    x = F.trim(x)
    if trailing:
        x = F.regexp_replace(x, r"[.,;:)\]]+$", "")
    x = F.lower(F.regexp_replace(x, r"^https?://(dx\.)?doi\.org/", ""))
    return F.when(x.rlike(DOI), x)


def extract_first(x: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def work_id(x: Column) -> Column:
    """W and digits."""
    return extract_first(x, r"W\d+")


def trailing_digits(x: Column) -> Column:
    """the digits that a PubMed address ends in."""
    return extract_first(x, r"(\d+)$", 1)


def trial_ids(x: Column) -> Column:
    """distinct NCT numbers in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"NCT\d{8}"), F.lit(0)))


def abstract(inverted: Column) -> Column:
    """words of an inverted index map<word, array<position>> in order of position."""
    pairs = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.trim(F.array_join(F.transform(F.array_sort(pairs), lambda s: s["w"]), " "))


def accession(x: Column) -> Column:
    """trimmed, upper case, without an isoform's number; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(F.trim(x)), r"-\d+$", ""), F.lit(""))


def ndc11(x: Column) -> Column:
    """a package code of 4-4-2, 5-3-2, 5-4-1 or 5-4-2 digits, or of 11, as 11 digits; null else."""
    x = F.trim(x)
    part = F.split(x, "-")
    padded = F.concat(F.lpad(F.get(part, 0), 5, "0"), F.lpad(F.get(part, 1), 4, "0"), F.lpad(F.get(part, 2), 2, "0"))
    shape = r"^(\d{4}-\d{4}-\d{2}|\d{5}-\d{3}-\d{2}|\d{5}-\d{4}-\d{1,2})$"
    return F.when(x.rlike(r"^\d{11}$"), x).when(x.rlike(shape), padded)


def is_code(x: Column) -> Column:
    """whether a name is a systematic code: registry number, CURIE, catalogue number, very long, or mostly not letters."""
    letters = F.length(F.regexp_replace(x, "[^a-zA-Z]", ""))
    return F.coalesce(x, F.lit("")).eqNullSafe("") | x.rlike(r"^\d+-\d+-\d+$") | x.rlike(r"^[A-Z]+:\d+$") | x.rlike(r"^[A-Z]{2,}[- ]?\d{3,}$") | (F.length(x) > 80) | (letters < F.length(x) * 0.5)


def shortest_name(names: Column) -> Column:
    """The shortest name that isn't a code, the first of equals."""
    ranked = F.transform(names, lambda s, i: F.struct(F.length(s).alias("n"), i.alias("i"), s.alias("s")))
    return F.array_min(F.filter(ranked, lambda r: ~is_code(r["s"])))["s"]


def strip_markup(x: Column) -> Column:
    """without tags, the five XML entities decoded, white space collapsed."""
    x = F.regexp_replace(x, "<[^>]+>", " ")
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(mark))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def disease_parts(x: Column) -> Column:
    """struct(namespace, numeric_id, ontology_prefix, anchor_payload, canonicalization_version); null if it is no PREFIX_rest."""
    x = F.trim(x)
    prefix, rest = F.regexp_extract(x, "^([A-Za-z]+)_(.+)$", 1), F.regexp_extract(x, "^([A-Za-z]+)_(.+)$", 2)
    space = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in DISEASE_NAMESPACES.items() for v in kv]), prefix), F.lit(OTHER_NAMESPACE))
    payload = F.concat(space, F.lit(":"), F.when(space == OTHER_NAMESPACE, x).otherwise(rest))
    parts = F.struct(space.alias("namespace"), rest.alias("numeric_id"), prefix.alias("ontology_prefix"), payload.alias("anchor_payload"), F.concat(F.lit("disease."), space, F.lit(".v1.0")).alias("canonicalization_version"))
    return F.when(x.rlike("^[A-Za-z]+_.+$"), parts)


def xref_parts(x: Column) -> Column:
    """struct(prefix, value) of PREFIX:VALUE, split at the first colon; null without one, or if a side is empty."""
    x = F.trim(x)
    parts = F.split(x, ":", 2)
    return F.when(x.rlike("^[^:]+:.+$"), F.struct(F.upper(F.trim(F.get(parts, 0))).alias("prefix"), F.trim(F.get(parts, 1)).alias("value")))


def id_tail(x: Column, prefix: str) -> Column:
    """what follows ``prefix``, with :: as : and in lower case; null if empty, still doubled or not ASCII."""
    tail = F.lower(F.replace(F.substring(x, len(prefix) + 1, 1 << 20), F.lit("::"), F.lit(":")))
    return F.when(F.startswith(x, F.lit(prefix)) & (F.length(tail) > 0) & ~F.contains(tail, F.lit("::")) & tail.rlike(r"^[\x00-\x7F]+$"), tail)


def title_print(x: Column) -> Column:
    """the first 80 of a title's letters and digits, lower case."""
    return F.substring(F.regexp_replace(F.lower(x), "[^a-z0-9]", ""), 1, 80)


def slug(x: Column) -> Column:
    """F16: lower case, anything but letters and digits as _, 40 characters."""
    return F.substring(F.regexp_replace(F.lower(x), "[^a-z0-9]", "_"), 1, 40)


def label(subject: Column, predicate: Column, target: Column) -> Column:
    """a triple's display label."""
    return F.concat_ws(" ", subject, predicate, target)


def identifier(x: Column) -> Column:
    """struct(kind, normalized) by an ordered chain of shapes; null if none fits."""
    x = F.trim(x)
    chain = (
        ("pubchem_cid", r"(?i)^(?:[a-z]+::compound::CID:|CID:)?(\d+)$", lambda g: g),
        ("chembl_id", r"(?i)^(CHEMBL\d+)$", F.upper),
        ("inchi_key", r"(?i)^([A-Z]{14}-[A-Z]{10}-[A-Z])$", F.upper),
        ("unii", r"(?i)^UNII:([A-Z0-9]{10})$", F.upper),
        ("drugbank_id", r"(?i)^(DB\d{5})$", F.upper),
        ("chebi_id", r"(?i)^CHEBI:(\d+)$", lambda g: F.concat(F.lit("CHEBI:"), g)),
        ("kegg_drug_id", r"(?i)^(?:KEGG:)?(D\d{5})$", F.upper),
        ("rxcui", r"(?i)^RXCUI:(\d+)$", lambda g: g),
    )
    out = None
    for kind, shape, form in chain:
        value = F.struct(F.lit(kind).alias("kind"), form(F.regexp_extract(x, shape, 1)).alias("normalized"))
        out = F.when(x.rlike(shape), value) if out is None else out.when(x.rlike(shape), value)
    return out


def compound_number(x: Column, most: int = 10_000_000_000) -> Column:
    """The number of a percent-encoded canonical id, CID:n or n, from 1 to ``most``; null else."""
    x = F.trim(F.coalesce(F.try_url_decode(x), F.lit("")))
    n = F.regexp_extract(x, r"(?i)^(?:[a-z]+::compound::CID:|CID:)?(\d{1,11})$", 1).try_cast("long")
    return F.when(n.between(1, most), n)


def target_accession(x: Column) -> Column:
    """A protein accession in upper case; null if it isn't of that shape."""
    x = F.upper(F.trim(x))
    return F.when(x.rlike(r"^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})$"), x)


def normalized_identifier(kind: Column, x: Column) -> Column:
    """an external id as it stands in indexes."""
    return F.when(kind == "chebi_id", F.concat(F.lit("CHEBI:"), F.regexp_extract(x, r"(\d+)$", 1))).when(kind == "rxcui", F.regexp_extract(x, r"(\d+)$", 1)).otherwise(F.upper(F.trim(x)))

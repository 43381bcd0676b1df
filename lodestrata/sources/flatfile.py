"""Flat files: records split by separators, parsed by regular expressions, nested XML by a small UDF."""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """One row for each record; ``separator`` stands between records, as a line of its own."""
    got = spark.read.text(path, lineSep=f"\n{separator}\n")
    body = F.regexp_replace("value", rf"\n?{re.escape(separator)}\s*$", "")
    return got.select(body.alias("value")).where(F.length(F.trim("value")) > 0)


def _lines(tag: str) -> Column:
    """A protein record's lines of a two-letter tag, joined by blanks."""
    return F.array_join(F.regexp_extract_all("value", F.lit(rf"(?m)^{tag}   (.*)$"), F.lit(1)), " ")


def proteins(blocks: DataFrame) -> DataFrame:
    """(accession, secondary, entry, name, gene, organism, taxon, length, xrefs, functions) of protein records, by tagged lines."""
    acs = F.filter(F.transform(F.split(_lines("AC"), ";"), lambda x: F.trim(x)), lambda x: x != "")
    de = _lines("DE")
    one = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    bare = lambda c: F.trim(F.regexp_replace(c, r"\s*\{[^}]*\}", ""))
    dr = F.transform(F.regexp_extract_all("value", F.lit(r"(?m)^DR   (\S+; [^;\n]+)"), F.lit(1)), lambda x: F.struct(F.get(F.split(x, "; "), 0).alias("source"), F.get(F.split(x, "; "), 1).alias("id")))
    # Comments: a block starts at -!-, and goes on over indented lines.
    cc = F.regexp_replace(F.array_join(F.regexp_extract_all("value", F.lit(r"(?m)^CC   (.*)$"), F.lit(1)), "\n"), r"\n +", " ")
    functions = F.transform(F.regexp_extract_all(cc, F.lit(r"(?m)^-!- FUNCTION: (.*)$"), F.lit(1)), bare)
    return blocks.select(
        F.get(acs, 0).alias("accession"), F.slice(acs, 2, 1000).alias("secondary"), one("value", r"(?m)^ID   (\S+)").alias("entry"), bare(one(de, r"RecName: Full=([^;]+);")).alias("name"),
        bare(one(_lines("GN"), r"Name=([^;]+);")).alias("gene"), F.nullif(F.regexp_replace(_lines("OS"), r"\.$", ""), F.lit("")).alias("organism"), one(_lines("OX"), r"NCBI_TaxID=(\d+)").cast("int").alias("taxon"),
        one("value", r"(?m)^SQ   SEQUENCE\s+(\d+) AA").cast("int").alias("length"), dr.alias("xrefs"), functions.alias("functions"),
    ).where("accession is not null")


def _first_of_each(pairs: Column) -> Column:
    """A map of structs (k, v), the first of equal keys. Bound once by an outer lambda, so that pairs are parsed once."""

    def pick(x: Column) -> Column:
        keys = F.array_distinct(F.transform(x["p"], lambda q: q["k"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(x["p"], F.array_position(F.transform(x["p"], lambda q: q["k"]), k).cast("int") - 1)["v"]))

    return F.transform(F.array(F.struct(pairs.alias("p"))), pick)[0]


def sdf(blocks: DataFrame, id_tag: str) -> DataFrame:
    """(tags map) of structure records that have the id tag: ``> <TAG>`` lines, each followed by its value up to a blank line."""
    pairs = F.arrays_zip(F.regexp_extract_all("value", F.lit(r"(?ms)^> *<([^>\n]+)>[^\n]*\n(.*?)(?=\n\s*\n|\n> *<|\z)"), F.lit(1)).alias("k"), F.regexp_extract_all("value", F.lit(r"(?ms)^> *<([^>\n]+)>[^\n]*\n(.*?)(?=\n\s*\n|\n> *<|\z)"), F.lit(2)).alias("v"))
    # Of repeated tags the first counts.
    return blocks.select(_first_of_each(F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), F.trim(p["v"]).alias("v")))).alias("tags")).where(F.try_element_at("tags", F.lit(id_tag)).isNotNull())


def compounds(sdf_rows: DataFrame) -> DataFrame:
    """Typed columns of structure records; what doesn't parse is null."""
    tag = lambda n: F.try_element_at("tags", F.lit(n))
    return sdf_rows.select(
        tag("PUBCHEM_COMPOUND_CID").try_cast("long").alias("cid"), tag("PUBCHEM_MOLECULAR_FORMULA").alias("formula"), tag("PUBCHEM_MOLECULAR_WEIGHT").try_cast("double").alias("weight"),
        tag("PUBCHEM_IUPAC_INCHIKEY").alias("inchi_key"), F.coalesce(tag("PUBCHEM_SMILES"), tag("PUBCHEM_OPENEYE_CAN_SMILES")).alias("smiles"), F.coalesce(tag("PUBCHEM_XLOGP3"), tag("PUBCHEM_XLOGP3_AA")).try_cast("double").alias("log_p"),
        tag("PUBCHEM_CACTVS_TPSA").try_cast("double").alias("tpsa"), tag("PUBCHEM_CACTVS_HBOND_DONOR").try_cast("int").alias("donors"), tag("PUBCHEM_CACTVS_HBOND_ACCEPTOR").try_cast("int").alias("acceptors"),
    ).where("cid is not null")


def sections(blocks: DataFrame, indent: int = 12) -> DataFrame:
    """(sections map<string, array<string>>): names at a line's start, values after ``indent`` columns, continuation lines without a name."""
    joined = F.regexp_replace("value", rf"\n {{{indent}}}", "\u0001")
    lines = F.filter(F.split(joined, "\n"), lambda x: x.rlike(r"^[A-Z_]+\s"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([A-Z_]+)", 1).alias("k"), F.transform(F.split(F.regexp_replace(x, r"^[A-Z_]+\s+", ""), "\u0001"), lambda v: F.trim(v)).alias("v")))
    return blocks.select(_first_of_each(pairs).alias("sections"))


# LOINC codes of label sections.
LABEL_SECTIONS = {
    "34066-1": "boxed_warning", "34067-9": "indications_and_usage", "34068-7": "dosage_and_administration", "34070-3": "contraindications", "43685-7": "warnings_and_precautions", "34071-1": "warnings",
    "34084-4": "adverse_reactions", "34073-7": "drug_interactions", "43684-0": "use_in_specific_populations", "34088-5": "overdosage", "34090-1": "clinical_pharmacology",
}
_SECTION = re.compile(r"<(/?)section\b[^>]*?(/?)>", re.I)
_CODE = re.compile(r"<code\b[^>]*\bcode=\"([^\"]+)\"", re.I)


def label_sections(xml: str, most: int = 5000) -> dict[str, str]:
    """Texts of a label's top-level sections by name, tags taken out, at most ``most`` characters; the first of a name counts."""
    out, depth, start = {}, 0, 0
    for m in _SECTION.finditer(xml):
        if m[2]:
            continue
        if not m[1]:
            if not depth:
                start = m.end()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                body = xml[start : m.start()]
                code = _CODE.search(body)
                name = LABEL_SECTIONS.get(code[1]) if code else None
                if name and name not in out:
                    text = re.sub(r"<[^>]+>", " ", body)
                    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
                        text = text.replace(entity, mark)
                    out[name] = re.sub(r"\s+", " ", text).strip()[:most]
    return out


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def label_sections_udf(xml: pd.Series) -> pd.Series:
    """S14 over a column; nesting has to be counted, which no built-in does."""
    return xml.map(lambda x: label_sections(x) if isinstance(x, str) else None)


@F.pandas_udf(T.StringType())
def zipped_xml(blob: pd.Series) -> pd.Series:
    """The first .xml member of each archive; null without one, or if it is no archive."""

    def one(b: bytes | None) -> str | None:
        try:
            with zipfile.ZipFile(io.BytesIO(b)) as z:
                name = next((n for n in z.namelist() if n.lower().endswith(".xml")), None)
                return z.read(name).decode("utf-8", "replace") if name else None
        except (zipfile.BadZipFile, TypeError):
            return None

    return blob.map(one)


@F.pandas_udf(T.BinaryType())
def inflated(blob: pd.Series) -> pd.Series:
    """Bytes as they were before zstd, gzip or up to five layers of base64, told by their first bytes."""
    import base64
    import binascii
    import gzip

    def one(b: bytes | None) -> bytes | None:
        for _ in range(6):
            if b is None or b[:4] == b"\x28\xb5\x2f\xfd" or b[:2] == b"\x1f\x8b":
                break
            try:
                b = base64.b64decode(b, validate=True)
            except (binascii.Error, ValueError):
                return b
        if b is not None and b[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj().decompress(b)
        return gzip.decompress(b) if b is not None and b[:2] == b"\x1f\x8b" else b

    return blob.map(one)

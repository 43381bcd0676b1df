"""Identifiers and hashes."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FNV-1a, 32 bits.
FNV_BASIS, FNV_PRIME = 2166136261, 16777619


def sid(space: str | Column, kind: Column | str, *parts: Column | str) -> Column:
    """The first 32 hex digits of SHA-256 over colon-joined parts; null if a part is."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    joined = [x for p in (space, kind, *parts) for x in (F.lit(":"), lit(p))][1:]
    return F.substring(F.sha2(F.concat(*joined), 256), 1, 32)


def _fnv(hexed: Column, width: int, unit: Column | None = None) -> Column:
    """FNV-1a over hex digits, ``width`` of them a unit. The product is taken in two halves, within 64 bits."""
    mod = F.lit(1 << 32).cast("long")

    def fold(x: Column) -> Column:
        n = (F.length(x) / width).cast("int")
        steps = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i <= n)
        return F.aggregate(steps, F.lit(FNV_BASIS).cast("long"), lambda h, i: (h.bitwiseXOR(F.conv(F.substr(x, (i - 1) * width + 1, F.lit(width)), 16, 10).cast("long")) * FNV_PRIME) % mod)

    # Bound once by an outer lambda: inner ones evaluate what they use anew for each item.
    return F.when(hexed.isNotNull(), F.transform(F.array(hexed), fold)[0])


def fnv1a(x: Column) -> Column:
    """Over UTF-8 bytes, as an unsigned long."""
    return _fnv(F.hex(F.encode(x, "UTF-8")), 2)


def fnv1a_utf16(x: Column) -> Column:
    """Over UTF-16 code units, as 8 hex digits."""
    return F.lpad(F.lower(F.hex(_fnv(F.hex(F.encode(x, "UTF-16BE")), 4))), 8, "0")


def bucket(x: Column, buckets: int = 1024) -> Column:
    """The bucket of a key."""
    return fnv1a(x) % buckets


def uuid5(seed: str, name: Column) -> Column:
    """A version-5 UUID whose namespace is the first 16 bytes of the seed's SHA-256."""
    space = hashlib.sha256(seed.encode()).hexdigest()[:32]
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("long").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def sorted_struct(c: Column, kind: T.DataType) -> Column:
    """A column with the fields of all its structs in order of name, and doubles that are whole as longs' text has them."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[sorted_struct(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: sorted_struct(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(F.transform_values(c, lambda k, v: sorted_struct(v, kind.valueType)))))
    return c


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """JSON with keys in order at every depth and nulls kept.

    Whole doubles print as 1.0 here; cast such fields to long before hashing
    where hashes have to agree with writers that print 1.
    """
    return F.to_json(sorted_struct(c, kind), {"ignoreNullFields": "false"})


def content_hash(c: Column, kind: T.DataType) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(c, kind), 256)


def xor_checksum(offsets: Column) -> Column:
    """XOR over an array of longs."""
    return F.aggregate(offsets, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x.cast("long")))


# Anchors by class, in order of preference.
ANCHORS = {
    "small_molecule": (("inchi_key", "compound.inchikey.v1.0"),),
    "bioactivity": (("chembl_activity_id", "bioactivity.chembl.v1.0"),),
    "paper": (("doi", "paper.doi.v1.0"), ("openalex_id", "paper.openalex.v1.0")),
    "target": (("uniprot_accession", "target.uniprot.v1.0"), ("ensembl_gene_id", "target.ensembl.v1.0")),
    "trial": (("nct_id", "trial.nct.v1.0"), ("ct_number", "trial.ctis.v1.0")),
}


def anchor(kind: str, columns: list[str]) -> Column:
    """struct(payload, version) of the first anchor of a class that is filled; null if none is."""
    options = [F.when(F.length(F.col(c)) > 0, F.struct(F.col(c).cast("string").alias("payload"), F.lit(v).alias("version"))) for c, v in ANCHORS[kind] if c in columns]
    return F.coalesce(*options) if options else F.lit(None).cast("struct<payload:string,version:string>")

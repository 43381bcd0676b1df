"""Numbers, units, dates, arrays, similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units as sources write them, and factors to nM.
UNITS = {
    "nM": "nM", "uM": "uM", "μM": "uM", "mM": "mM", "M": "M", "%": "percent", "percent": "percent",
    "ratio": "unitless", "pKa": "unitless", "pKi": "unitless", "pIC50": "unitless", "": "unitless", "unitless": "unitless",
}
TO_NM = {"nM": 1.0, "uM": 1e3, "mM": 1e6, "M": 1e9}
# Trial phases and states.
PHASES = {"EARLY_PHASE1": 0, "PHASE1": 1, "PHASE1_PHASE2": 1, "PHASE2": 2, "PHASE2_PHASE3": 2, "PHASE3": 3, "PHASE4": 4}
EU_PHASES = (("Phase 1", 1), ("Phase I", 1), ("Phase 2", 2), ("Phase II", 2), ("Phase 3", 3), ("Phase III", 3), ("Phase 4", 4), ("Phase IV", 4))
EU_CODES = {2: "AUTHORISED", 3: "AUTHORISED", 4: "AUTHORISED", 5: "AUTHORISED", 6: "HALTED", 8: "ENDED", 11: "NOT_YET_AUTHORISED"}
EU_STATES = {
    "Authorised": "AUTHORISED", "Under evaluation": "UNDER_EVALUATION", "Ongoing": "ONGOING", "Ended": "ENDED", "Ended prematurely": "ENDED_PREMATURELY", "Halted": "HALTED",
    "Cancelled": "CANCELLED", "Not authorised": "NOT_YET_AUTHORISED",
}


def lookup(table: dict, key: Column, default=None) -> Column:
    """A literal map's value; ``default`` for other keys and null."""
    got = F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key) if table else F.lit(None)
    got = F.when(key.isNotNull(), got)
    return got if default is None else F.coalesce(got, F.lit(default))


def half_up(x: Column, digits: int = 0) -> Column:
    """floor(x * 10^d + 0.5) / 10^d, on doubles."""
    by = float(10**digits)
    return F.floor(x * by + 0.5) / by if digits else F.floor(x + 0.5)


def unit(x: Column) -> Column:
    """a unit's normal form; empty or null is unitless, an unknown one other."""
    x = F.trim(F.coalesce(x, F.lit("")))
    return lookup(UNITS, x, "other")


def to_nm(value: Column, unit: Column) -> Column:
    """a concentration in nM; null in other units."""
    return value * lookup(TO_NM, unit)


def lipinski(weight: Column, log_p: Column, donors: Column, acceptors: Column) -> Column:
    """how many of the four limits are broken; nulls break none."""
    over = lambda x, top: F.when(x > top, 1).otherwise(0)
    return over(weight, 500) + over(log_p, 5) + over(donors, 5) + over(acceptors, 10)


def jaccard(a: Column, b: Column) -> Column:
    """of two token sets; 0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def words64(base64: Column, skip: int = 4) -> Column:
    """A base64 bit string as 64-bit words, its first ``skip`` bytes left out; the last word is filled up with zeros."""

    def cut(hexed: Column) -> Column:
        n = F.greatest(F.lit(0), F.length(hexed) - 2 * skip)
        return F.transform(
            F.filter(F.sequence(F.lit(0), F.floor((n + 15) / 16).cast("int")), lambda i: i * 16 < n),
            lambda i: F.conv(F.rpad(F.substr(hexed, i * 16 + 2 * skip + 1, F.lit(16)), 16, "0"), 16, -10).cast("long"),
        )

    return F.transform(F.array(F.hex(F.unbase64(base64))), cut)[0]


def tanimoto_words(a: Column, b: Column) -> Column:
    """of two arrays of 64-bit words, over the shorter's length; 0 if neither has a bit."""
    n = F.least(F.size(a), F.size(b))
    pairs = F.slice(F.arrays_zip(a.alias("a"), b.alias("b")), F.lit(1), n)
    add = lambda f: F.aggregate(pairs, F.lit(0), lambda s, p: s + F.bit_count(f(p["0"], p["1"])))
    both, either = add(lambda x, y: x.bitwiseAND(y)), add(lambda x, y: x.bitwiseOR(y))
    return F.when(either > 0, both / either).otherwise(0.0)


def tanimoto(a: Column, b: Column) -> Column:
    """of two base64 fingerprints with a 4-byte length prefix, over the bytes that both have."""
    words = F.transform(F.arrays_zip(words64(a), words64(b)), lambda p: F.struct(p["0"].alias("a"), p["1"].alias("b")))
    # Bits beyond the shorter one's end don't count: its last word is cut there.
    bits = F.least(F.octet_length(F.unbase64(a)), F.octet_length(F.unbase64(b))) * 8 - 32
    masked = F.transform(
        F.filter(F.transform(words, lambda w, i: F.struct(w["a"].alias("a"), w["b"].alias("b"), (bits - i * 64).alias("n"))), lambda w: w["n"] > 0),
        lambda w: F.struct(*[F.when(w["n"] >= 64, w[k]).otherwise(w[k].bitwiseAND(_mask(w["n"]))).alias(k) for k in "ab"]),
    )
    add = lambda f: F.aggregate(masked, F.lit(0), lambda s, p: s + F.bit_count(f(p["a"], p["b"])))
    both, either = add(lambda x, y: x.bitwiseAND(y)), add(lambda x, y: x.bitwiseOR(y))
    return F.when(either > 0, both / either).otherwise(0.0)


def _mask(bits: Column) -> Column:
    """A long whose highest ``bits`` (a multiple of 8 below 64) bits are set."""
    table = F.array(*[F.lit(((1 << 64) - (1 << (64 - 8 * k))) - (1 << 64) if k else 0) for k in range(8)])
    return F.get(table, F.floor(bits / 8).cast("int"))


def phase(phases: Column) -> Column:
    """the highest phase of a list; null if it has none."""
    return F.array_max(F.transform(phases, lambda p: lookup(PHASES, p)))


def eu_phase(x: Column) -> Column:
    """the first phase name, in table order, that the string has."""
    out = None
    for name, n in EU_PHASES:
        test = F.contains(x, F.lit(name))
        out = F.when(test, n) if out is None else out.when(test, n)
    return out


def eu_state(code: Column | None = None, name: Column | None = None) -> Column:
    """a state from its number or its name."""
    return lookup(EU_CODES, code, "UNKNOWN") if code is not None else lookup(EU_STATES, name, "UNKNOWN")


def percent(part: Column, whole: Column, empty: float | None = 100.0, digits: int = 2) -> Column:
    """rounded half up; ``empty`` (or null) if the whole is 0."""
    return F.when(whole > 0, half_up(part / F.nullif(whole, F.lit(0)) * 100, digits)).otherwise(F.lit(empty).cast("double"))


def us_date(x: Column) -> Column:
    """M/D/YYYY, with or without a time after it, as a date; null else."""
    return F.try_to_date(F.regexp_extract(F.trim(x), r"^(\d{1,2}/\d{1,2}/\d{4})(?:\s|$)", 1), "M/d/yyyy")


def age_days(then: Column, now: Column) -> Column:
    """whole and part days between two timestamps."""
    return (F.unix_micros(now) - F.unix_micros(then)) / 86_400_000_000.0


def is_fresh(then: Column, now: Column, days: float) -> Column:
    """Within ``days``; null or unreadable is stale, the future is fresh."""
    then = F.try_to_timestamp(then.cast("string"))
    return F.coalesce(age_days(then, now) < days, F.lit(False))


def int8(v: Column) -> Column:
    """each value times 127, rounded half up, kept in -128..127."""
    return F.transform(v, lambda x: F.greatest(F.lit(-128), F.least(F.lit(127), F.floor(x.cast("double") * 127 + 0.5))).cast("int"))


def nested_sum(items: Column, field: str) -> Column:
    """The sum of a field over an array of structs."""
    return F.aggregate(F.coalesce(F.transform(items, lambda x: F.coalesce(x[field], F.lit(0)).cast("long")), F.array().cast("array<long>")), F.lit(0).cast("long"), lambda s, x: s + x)


def best_by(items: Column, ranks: dict[str, int]) -> Column:
    """the listed name of highest rank; null if none is ranked."""
    scored = F.transform(items, lambda x: F.struct(lookup(ranks, x).alias("r"), x.alias("x")))
    return F.array_max(F.filter(scored, lambda s: s["r"].isNotNull()))["x"]


def ewma(xs: Column, alpha: float = 0.7, restart: bool = True) -> Column:
    """An exponentially weighted mean over an ordered array.

    The first value stands for itself. With ``restart`` a mean of 0 means none
    yet, so that one after it does too, and an empty array has 0; without it 0
    is a value like others, and an empty array has null.
    """
    if not restart:
        keep = round(1 - alpha, 12)
        return F.aggregate(F.slice(xs, 2, F.greatest(F.size(xs), F.lit(1))), F.get(xs, 0).cast("double"), lambda s, x: s * keep + x * alpha)
    return F.aggregate(xs, F.lit(0.0), lambda s, x: F.when(s == 0, x.cast("double")).otherwise(s * (1 - alpha) + x * alpha))

"""Gates, completeness, audits, regressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.paths import present


@dataclass
class Rule:
    """What a schema asks of a field. ``kind``: string, number, integer, boolean, array or struct."""

    kind: str
    required: bool = False
    least: float | None = None
    most: float | None = None
    pattern: str | None = None
    enum: tuple = ()
    max_length: int | None = None
    min_items: int | None = None
    max_items: int | None = None
    iso8601: bool = False
    items: Rule | None = None
    shape: dict[str, Rule] = field(default_factory=dict)


ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _broken(x: Column, at: str, r: Rule) -> list[tuple[str, Column]]:
    """(path: rule, whether it is broken) for one field; null and absent are the same."""
    out = [(f"{at}: required", x.isNull())] if r.required else []
    if r.kind == "number":
        out.append((f"{at}: type", F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))))
    if r.kind == "integer":
        out.append((f"{at}: type", x.cast("double") != F.floor(x.cast("double"))))
    for name, test in (
        ("min", x < r.least if r.least is not None else None),
        ("max", x > r.most if r.most is not None else None),
        ("pattern", ~x.rlike(r.pattern) if r.pattern else None),
        ("enum", ~x.isin(*r.enum) if r.enum else None),
        ("maxLength", F.length(x) > r.max_length if r.max_length is not None else None),
        ("minItems", F.size(x) < r.min_items if r.min_items is not None else None),
        ("maxItems", F.size(x) > r.max_items if r.max_items is not None else None),
        ("iso8601", ~x.rlike(ISO) if r.iso8601 else None),
    ):
        if test is not None:
            out.append((f"{at}: {name}", x.isNotNull() & test))
    if r.items:
        for name in _names(f"{at}[]", r.items):
            out.append((name, F.coalesce(F.exists(x, _breaks(f"{at}[]", r.items, name)), F.lit(False))))
    for k, sub in r.shape.items():
        out += [(n, x.isNotNull() & t) for n, t in _broken(x[k], f"{at}.{k}", sub)]
    return out


def _names(at: str, r: Rule) -> list[str]:
    """What _broken names for a rule, without a column to test."""
    out = [f"{at}: required"] * r.required + [f"{at}: type"] * (r.kind in ("number", "integer"))
    for name, asked in (("min", r.least is not None), ("max", r.most is not None), ("pattern", r.pattern), ("enum", r.enum), ("maxLength", r.max_length is not None), ("minItems", r.min_items is not None), ("maxItems", r.max_items is not None), ("iso8601", r.iso8601)):
        out += [f"{at}: {name}"] * bool(asked)
    out += _names(f"{at}[]", r.items) if r.items else []
    for k, sub in r.shape.items():
        out += _names(f"{at}.{k}", sub)
    return out


def _breaks(at: str, r: Rule, name: str):
    return lambda y: F.coalesce(dict(_broken(y, at, r))[name], F.lit(False))


def violations(rules: dict[str, Rule]) -> Column:
    """What a record breaks, as "path: rule", in order of the rules."""
    tests = [t for c, r in rules.items() for t in _broken(F.col(c), c, r)]
    return F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests]), lambda v: v.isNotNull())


def tiered(violation: Column, scope: list[str], derived: list[str]) -> Column:
    """scope_exclude if a scope pattern matches, else derived if its path is a derived one, else primary."""
    out = None
    for kind, shapes in (("scope_exclude", scope), ("derived", derived)):
        for s in shapes:
            out = F.when(violation.rlike(s), kind) if out is None else out.when(violation.rlike(s), kind)
    return F.lit("primary") if out is None else out.otherwise("primary")


def gate(df: DataFrame, rules: dict[str, Rule], scope: list[str] = (), derived: list[str] = ()) -> DataFrame:
    """With ``violations`` and ``outcome``: halt on a primary one, else scope_exclude, else warn, else pass."""
    v = df.withColumn("violations", violations(rules))
    kinds = F.transform("violations", lambda x: tiered(x, list(scope), list(derived)))
    out = F.when(F.size("violations") == 0, "pass").when(F.array_contains(kinds, "primary"), "halt").when(F.array_contains(kinds, "scope_exclude"), "scope_exclude").otherwise("warn")
    return v.withColumn("outcome", out)


class GateError(ValueError):
    """Records that must not go on."""


def enforce(gated: DataFrame, samples: int = 5) -> DataFrame:
    """The rows to go on with; raises if a record halts."""
    if bad := gated.where("outcome = 'halt'").limit(samples).collect():
        raise GateError(f"primary violations, among them {[r['violations'] for r in bad]}")
    return gated.where("outcome in ('pass', 'warn')")


def by_rule(gated: DataFrame) -> DataFrame:
    """(violation, n) over all records."""
    return gated.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


def completeness(df: DataFrame, group: str, gate_paths: list[str], full_paths: list[str]) -> DataFrame:
    """Per group how many records pass the gate and have everything; percent of all and of those that pass (100 of none, G15)."""
    ok, full = F.lit(True), F.lit(True)
    for p in gate_paths:
        ok = ok & present(p)
    for p in full_paths:
        full = full & present(p)
    got = df.groupBy(group).agg(F.count("*").alias("total"), F.count_if(ok).alias("gate_pass"), F.count_if(ok & full).alias("fully_enriched"))
    return got.withColumn("raw_pct", percent(F.col("fully_enriched"), F.col("total"))).withColumn("adjusted_pct", percent(F.col("fully_enriched"), F.col("gate_pass")))


def audit(df: DataFrame, tests: dict[str, Column], digits: int = 2) -> DataFrame:
    """One row for each named test: how many records meet it, in percent; null of no records (G15). One pass over the table."""
    got = df.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(t, F.lit(False))).alias(f"t{i}") for i, t in enumerate(tests.values())])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("principle"), F.col(f"t{i}").alias("met")) for i, name in enumerate(tests)])).alias("e")
    return got.select("n", each).select("e.principle", "e.met", "n").withColumn("pct", percent(F.col("met"), F.col("n"), None, digits))


def severity_tier(pct: Column, hard: float, warn: float) -> Column:
    """Hardfail, warn or info by a percentage."""
    return F.when(pct.isNull() | (pct < hard), "hardfail").when(pct < warn, "warn").otherwise("info")


def worst(df: DataFrame, tier: str = "tier") -> DataFrame:
    """One row: the worst tier; info of no rows."""
    rank = F.when(F.col(tier) == "hardfail", 0).when(F.col(tier) == "warn", 1).otherwise(2)
    return df.agg(F.coalesce(F.min_by(tier, rank), F.lit("info")).alias("worst"))


def deferred(df: DataFrame, deferrals: DataFrame, key: str, today: Column) -> DataFrame:
    """Hardfails with a deferral that hasn't expired are warnings."""
    open_ = deferrals.where(F.col("until") >= today).select(F.col(key).alias("_k")).distinct()
    out = df.join(open_, df[key] == open_["_k"], "left")
    return out.withColumn("tier", F.when((F.col("tier") == "hardfail") & F.col("_k").isNotNull(), "warn").otherwise(F.col("tier"))).drop("_k")


def run_delta(df: DataFrame, run: str, value: str, by: str | None = None) -> DataFrame:
    """Each run's value, the one before, and the change in percent of that (null without one)."""
    w = Window.partitionBy(*([by] if by else [])).orderBy(run)
    out = df.withColumn("previous", F.lag(value).over(w))
    return out.withColumn("change_pct", F.when(F.col("previous") > 0, F.floor((F.col(value) - F.col("previous")) / F.col("previous") * 10000 + 0.5) / 100))


def regression(runs: DataFrame, run: str, value: str, most_drop: float = 30.0, by: str | None = None) -> DataFrame:
    """Runs with a flag for a fall of more than ``most_drop`` percent."""
    return run_delta(runs, run, value, by).withColumn("abort", F.coalesce(F.col("change_pct") < -most_drop, F.lit(False)))


def assert_monotone(before: int, after: int, what: str) -> None:
    """A count that must not fall."""
    if after < before:
        raise GateError(f"{what} fell from {before} to {after}")


def assert_yield(n: int, step: str) -> None:
    """A step that made nothing must not pass for one that had nothing to do."""
    if n <= 0:
        raise GateError(f"{step} made no rows")


def assert_counts(seen: int, recorded: int, what: str) -> None:
    """Records read equal what the source's cursor says."""
    if seen != recorded:
        raise GateError(f"{what}: {seen} records seen, {recorded} recorded")


def outcomes(requested: DataFrame, key: str, found: DataFrame, scope: Column, tests: dict[str, Rule]) -> DataFrame:
    """Every requested key with one outcome: no_record, out_of_scope, failed, warned or valid."""
    v = found.withColumn("_v", violations(tests)).withColumn("_in", F.coalesce(scope, F.lit(False)))
    v = v.select(F.col(key).alias("_k"), "_v", "_in")
    j = requested.select(key).distinct().join(v, F.col(key) == F.col("_k"), "left")
    required = F.exists("_v", lambda x: F.endswith(x, F.lit(": required")))
    out = F.when(F.col("_k").isNull(), "no_record").when(~F.col("_in"), "out_of_scope").when(required, "failed").when(F.size("_v") > 0, "warned").otherwise("valid")
    return j.select(key, out.alias("outcome"))

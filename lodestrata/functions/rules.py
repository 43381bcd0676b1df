"""Rules, scores and classifications as ordered CASE expressions."""

from __future__ import annotations

import re._constants as _re
import re._parser as _re_parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_up, lookup, to_nm

# Kinds of measurement, thresholds in nM and percent, source weights.
CONCENTRATIONS = ("IC50", "Ki", "EC50", "Kd", "AC50", "IC90", "GI50")
STANDARD_UNITS = ("nM", "uM", "mM", "M", "percent")
ACTIVE_NM, INACTIVE_NM, ACTIVE_PERCENT, INACTIVE_PERCENT = 1_000, 10_000, 50, 20
SOURCE_WEIGHTS = {"pubchem": 10, "chembl": 10, "clinicaltrials": 5, "openalex": 5, "s2": 5, "semantic_scholar": 5, "pubmed": 7, "dailymed": 10, "open_targets": 8}
SINGLE_CEILING, MULTI_FLOOR = 60, 80
SEVERITIES = ("critical", "major", "minor", "unknown")
EVIDENCE_TYPES = ("trial_failure", "inactive_bioassay", "drug_withdrawal", "black_box_warning", "faers_adr_signal", "serious_adverse_event_per_trial", "paper_retraction")


def activity_type(x: Column, compat_ki_kd: bool = False) -> Column:
    """G1: a measurement's normal name. ``compat_ki_kd``: Ki and Kd become other, as an upper-cased lookup in a mixed-case table has it."""
    names = {n.upper(): n for n in CONCENTRATIONS if not (compat_ki_kd and n in ("Ki", "Kd"))}
    return F.coalesce(lookup(names, F.upper(x)), F.when(F.contains(F.lower(x), F.lit("inhibition")), "inhibition"), F.lit("other"))


def activity(value: Column, unit: Column, kind: Column) -> Column:
    """struct(is_active, method) from a measured value."""
    none = F.lit(None).cast("boolean")
    nm = to_nm(value, unit)
    out = lambda flag, method: F.struct(flag.alias("is_active"), F.lit(method).alias("method"))
    yes, no = F.lit(True), F.lit(False)
    conc, inhib = kind.isin(*CONCENTRATIONS) & nm.isNotNull(), (kind == "inhibition") & (unit == "percent")
    return (
        F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")) | (value < 0), out(none, "no_numeric_value"))
        .when(conc & (nm < ACTIVE_NM), out(yes, "concentration_threshold_v1"))
        .when(conc & (nm > INACTIVE_NM), out(no, "concentration_threshold_v1"))
        .when(conc, out(none, "concentration_inconclusive_v1"))
        .when(inhib & (value > ACTIVE_PERCENT), out(yes, "inhibition_threshold_v1"))
        .when(inhib & (value < INACTIVE_PERCENT), out(no, "inhibition_threshold_v1"))
        .when(inhib, out(none, "inhibition_inconclusive_v1"))
        .otherwise(out(none, "non_standard_metric"))
    )


def measurement_confidence(value: Column, unit: Column, kind: Column, assay: Column) -> Column:
    """50, and more for each of unit, kind, assay and range that is standard."""
    nm = to_nm(value, unit)
    if_ = lambda test, n: F.when(F.coalesce(test, F.lit(False)), n).otherwise(0)
    fits = F.when(nm.isNotNull(), nm.between(0.001, 1e8)).otherwise((unit == "percent") & value.between(0, 100))
    return F.lit(50) + if_(unit.isin(*STANDARD_UNITS), 20) + if_(kind.isin(*CONCENTRATIONS, "inhibition"), 10) + if_((assay != "") & (assay != "other"), 10) + if_(fits, 10)


def source_score(sources: Column, structural: Column, conflict: Column) -> Column:
    """Of one fact by its sources (repeats count, G7): up to 60 from one, 80 and more from several, less on conflict."""
    n = F.coalesce(F.size(sources), F.lit(0))
    bonus = F.aggregate(F.coalesce(sources, F.array().cast("array<string>")), F.lit(0), lambda s, x: s + lookup(SOURCE_WEIGHTS, x, 0))
    clash, fits = F.coalesce(conflict, F.lit(False)), F.coalesce(structural, F.lit(False))
    one = 40 + F.least(F.lit(20), bonus) - F.when(clash, 15).otherwise(0)
    many = MULTI_FLOOR + (n - 2) * 3 + F.when(fits, 5).otherwise(0) + F.least(F.lit(15), half_up(bonus / 2).cast("int")) - F.when(clash, 30).otherwise(0)
    return F.when(n <= 0, 0).when(n == 1, F.greatest(F.lit(0), F.least(F.lit(SINGLE_CEILING), one))).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), many)))


def entity_score(sources: Column, structural: Column, conflict: Column, has_bioactivity: Column, has_clinical: Column) -> Column:
    """The weighted mean over the dimensions that are there, at most 60 from one source."""
    plain = source_score(sources, structural, F.lit(False))
    bio = F.coalesce(has_bioactivity & F.array_contains(sources, "chembl"), F.lit(False)).cast("double")
    clinical = F.coalesce(has_clinical & F.array_contains(sources, "clinicaltrials"), F.lit(False)).cast("double")
    complete = F.when(F.coalesce(F.size(sources), F.lit(0)) > 0, 100).otherwise(0)
    total = source_score(sources, structural, conflict) * 0.4 + plain * bio * 0.3 + plain * clinical * 0.2 + complete * 0.1
    overall = half_up(total / (0.4 + bio * 0.3 + clinical * 0.2 + 0.1)).cast("int")
    return F.when(F.size(sources) == 1, F.least(F.lit(SINGLE_CEILING), overall)).otherwise(overall)


def bump(score: Column, agreement: Column) -> Column:
    """A score moved by agreement between sources, kept in 0..100."""
    by = F.when(agreement == "agree", 10).when(agreement == "soft_agree", 5).when(agreement == "conflict", -15).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score + by))


def agreement(ratio: Column) -> Column:
    """How well two values agree by their ratio; null if there is none."""
    return F.when(ratio < 10, "agree").when(ratio < 100, "soft_agree").when(ratio.isNotNull() & (ratio < float("inf")), "conflict")


def compared(value: Column, unit: Column, other: Column, other_unit: Column) -> Column:
    """struct(matched, agreement) of two measurements: any other one is a match, but where a unit has no factor nothing can be said of agreement."""
    a, b = to_nm(value, unit), to_nm(other, other_unit)
    ratio = F.when((a > 0) & (b > 0), F.greatest(a, b) / F.least(a, b))
    return F.struct(other.isNotNull().alias("matched"), agreement(ratio).alias("agreement"))


def tier(count: Column, critical: int, major: int, minor: int | None = None, least: str = "minor") -> Column:
    """Severity by count."""
    out = F.when(count >= critical, "critical").when(count >= major, "major")
    return (out if minor is None else out.when(count >= minor, "minor")).otherwise(least)


def event_severity(count: Column) -> Column:
    return tier(count, 1000, 100)


def report_severity(count: Column) -> Column:
    return tier(count, 10000, 1000, 100, "unknown")


def failure_severity(category: Column) -> Column:
    """Of a trial's failure, by its category."""
    return F.when(category == "SAFETY", "critical").when(category.isin("EFFICACY", "REGULATORY"), "major").when(category.isin("ENROLLMENT", "LOGISTICS", "FUNDING", "BUSINESS", "COVID"), "minor").otherwise("unknown")


# What each verdict recommends.
RECOMMENDATIONS = {
    "critical": "Critical negative signal present (drug withdrawal / black box). Repurposing is not viable without explicit risk-benefit reassessment.",
    "nothing": "No repurposing evidence on file. Insufficient data to recommend.",
    "retracted": "No positive evidence; only retracted-paper signals present. Treat any historical claim with caution.",
    "trials": "Multiple progressed trials and few negative signals \u2014 strong repurposing candidate.",
    "clean": "Positive evidence present with no negative signals on record.",
    "mixed": "Positive evidence weighed against multiple negative signals. Agent should surface both layers.",
    "sparse": "Sparse evidence; treat any single-source claim with caution.",
}


def judged(trials: Column, activities: Column, negatives: Column, critical: Column, retracted: Column) -> Column:
    """struct(signal, recommendation) of a subject's evidence; the order of the cases decides."""
    positive = trials + activities
    cases = (
        (critical > 0, "none", "critical"),
        ((positive == 0) & (negatives == 0) & (retracted == 0), "none", "nothing"),
        ((positive == 0) & (retracted > 0), "weak", "retracted"),
        ((trials >= 2) & (negatives <= 2), "strong", "trials"),
        ((positive > 0) & (negatives == 0), "strong", "clean"),
        ((positive > 0) & (negatives > 2), "mixed", "mixed"),
    )
    said = lambda signal, why: F.struct(F.lit(signal).alias("signal"), F.lit(RECOMMENDATIONS[why]).alias("recommendation"))
    out = F
    for test, signal, why in cases:
        out = out.when(test, said(signal, why))
    return out.otherwise(said("weak", "sparse"))


def verdict(trials: Column, activities: Column, negatives: Column, critical: Column, retracted: Column) -> Column:
    """The signal alone."""
    return judged(trials, activities, negatives, critical, retracted)["signal"]


def highest_severity(counts: dict[str, Column]) -> Column:
    """The worst severity with a count above 0, or none."""
    out = None
    for s in SEVERITIES:
        out = F.when(counts[s] > 0, s) if out is None else out.when(counts[s] > 0, s)
    return out.otherwise("none")


def summary(total: Column, types: Column, highest: Column) -> Column:
    """One line on a subject's negative evidence."""
    plural = lambda n: F.when(n == 1, "").otherwise("s")
    text = F.concat(total.cast("string"), F.lit(" negative signal"), plural(total), F.lit(" across "), types.cast("string"), F.lit(" evidence type"), plural(types), F.lit("; highest severity: "), highest, F.lit("."))
    return F.when(total == 0, "No negative signals recorded.").otherwise(text)


def predicate(kind: Column) -> Column:
    """Inhibits for inhibition measures, else binds."""
    return F.when(kind.isin("IC50", "IC90", "Ki", "inhibition"), "inhibits").otherwise("binds")


def conflicts(pairs: list[tuple[str, Column]]) -> Column:
    """Names of the tests that hold, in order."""
    return F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in pairs]), lambda x: x.isNotNull())


def diverges(a: Column, b: Column, share: float = 0.5) -> Column:
    """Two counts more than ``share`` of the larger apart."""
    return F.abs(a - b) > F.greatest(a, b) * share


def source_status(age: Column, count: Column, stale: float, critical: float) -> Column:
    """MISSING without records, else by age in days."""
    return F.when(F.coalesce(count, F.lit(0)) == 0, "MISSING").when(age.isNull() | (age > critical), "CRITICAL").when(age > stale, "STALE").otherwise("HEALTHY")


def negative_outcome(state: Column) -> Column:
    """States that count as failed; suspension is one of them."""
    return F.coalesce(state.isin("TERMINATED", "WITHDRAWN", "SUSPENDED"), F.lit(False))


def event_filter(raw: str | None, known=EVIDENCE_TYPES, most: int = 10) -> list[str] | None:
    """The known types of a comma list's first ten; None if no filter was asked for, which is not the same as an empty one."""
    if raw is None or not raw.strip():
        return None
    return list(dict.fromkeys(t for t in (p.strip().lower() for p in raw.split(",")[:most]) if t in known))


def in_filter(kind: Column, wanted: list[str] | None) -> Column:
    """All rows without a filter, none with an empty one."""
    return F.lit(True) if wanted is None else kind.isin(*wanted) if wanted else F.lit(False)


def search_score(query: str, names: Column, long_name: Column, formula: Column, chembl: Column, number: Column) -> Column:
    """The first rung of the ladder that a record reaches; 0 if none."""
    q = F.lit(query.lower())
    names = F.transform(F.coalesce(names, F.array().cast("array<string>")), F.lower)
    long_name, formula, chembl = (F.lower(F.coalesce(x, F.lit(""))) for x in (long_name, formula, chembl))
    return (
        F.when(F.coalesce(number.cast("string"), F.lit("")) == q, 100)
        .when(chembl == q, 95)
        .when(F.exists(names, lambda s: s == q), 90)
        .when(formula == q, 85)
        .when(F.exists(names, lambda s: F.startswith(s, q)), 70)
        .when(F.startswith(long_name, q), 60)
        .when(F.exists(names, lambda s: F.contains(s, q)), 50)
        .when(F.contains(long_name, q), 40)
        .when(F.contains(formula, q), 30)
        .otherwise(0)
    )


# Categories of failure in order, their confidence, and patterns (case-insensitive but for acronyms).
FAILURE_RULES = (
    ("SAFETY", 80, (
        r"(?i)adverse event", r"\bSAE\b", r"(?i)toxicit", r"(?i)side effect", r"(?i)safety concern", r"(?i)safety signal", r"(?i)safety reason", r"(?i)safety issue", r"(?i)\bDSMB\b.*safet",
        r"(?i)data monitoring.*safet", r"(?i)serious.*adverse", r"(?i)unacceptable.*toxicit", r"(?i)drug.related.*death", r"(?i)unexpected.*safety", r"(?i)histological findings", r"(?i)precautionary measure",
    )),
    ("EFFICACY", 80, (
        r"(?i)lack of efficacy", r"(?i)no efficacy", r"(?i)futility", r"(?i)futile", r"(?i)not effective", r"(?i)did not (meet|show|demonstrate).*efficacy", r"(?i)failed to (show|demonstrate)",
        r"(?i)interim analysis.*futility", r"(?i)primary endpoint.*not met", r"(?i)insufficient.*response", r"(?i)interim analysis.*(no difference|no efficacy|study closure)",
        r"(?i)(treatment|drug|intervention).*not effective", r"(?i)no significant.*(difference|advantage|benefit)", r"(?i)no.*clinical advantage", r"(?i)efficacy of.*rendered.*less relevant",
    )),
    ("ENROLLMENT", 75, (
        r"(?i)slow accrual", r"(?i)slow recruit", r"(?i)slow enroll", r"(?i)unable to (recruit|enroll)", r"(?i)could not.*recruit", r"(?i)poor (accrual|enrollment|recruitment)",
        r"(?i)insufficient.*(enrollment|subjects|patients)", r"(?i)no longer.*recruit", r"(?i)accrual.*goal", r"(?i)enrollment.*(stop|halt|slow|low|lagging|delayed|not met)",
        r"(?i)low (enrollment|recruitment|accrual|inclusion)", r"(?i)lagging enroll", r"(?i)inadequate accrual", r"(?i)no accrual", r"(?i)lack of (accrual|enrol|recruit|inclusion|enroll)",
        r"(?i)not finding patients", r"(?i)not reaching recruitment", r"(?i)recruitment (difficult|failure|too slow|not.*met|not.*feasible|not.*goal|did not.*meet)", r"(?i)inclusion (rate|difficult)",
        r"(?i)subjects? did not meet", r"(?i)no enrollment", r"(?i)no participants.*enroll", r"(?i)administratively closed", r"(?i)target enrollment", r"(?i)enroll(ment)? was not met",
        r"(?i)delayed patient enrollment", r"(?i)abandoned.*accrual", r"(?i)stopped enroll", r"(?i)never (initiated|enrolled)",
    )),
    ("FUNDING", 85, (
        r"(?i)no funding", r"(?i)lack of fund", r"(?i)loss of fund", r"(?i)no.*fund", r"(?i)financial reason", r"(?i)financial constraint", r"(?i)budget", r"(?i)grant.*(end|expired|denied)",
        r"(?i)sponsor.*(withdrew|withdrawn).*(support|funding|fund)", r"(?i)(receive|received) (no )?funding", r"(?i)did not receive funding",
    )),
    ("LOGISTICS", 75, (
        r"(?i)shortage.*suppl", r"(?i)supply.*(shortage|issue|problem)", r"(?i)manufactur", r"(?i)drug.*(unavailable|shortage|discontinued|expired)", r"(?i)\bIMP expired",
        r"(?i)(drug|device).*(no longer available|discontinued)", r"(?i)site.*(closed|unavailable)", r"(?i)investigator.*(unavailable|left|moved|leaving|abroad)", r"(?i)surgery.*stopped",
        r"(?i)unable to (obtain|source|produce)", r"(?i)equipment.*(failure|issue|technical|problem)", r"(?i)technical (problem|limit|failure)", r"(?i)staff.*(shortage|left|unavailable|turnover)",
        r"(?i)personnel.*(lack|left|unavailable)", r"(?i)lack of.*personnel", r"(?i)no clinical investigator", r"(?i)loss of.*team", r"(?i)pharmaceutical company discontinued", r"(?i)infusion set",
    )),
    ("BUSINESS", 70, (
        r"(?i)sponsor (decision|decided|suspended|withdrew|terminat)", r"(?i)business (decision|reason)", r"(?i)strategic (decision|reason|change)", r"(?i)protocol.*(amendment|modify|modified|change|deviation)",
        r"(?i)several studies.*(at the same time|going on)", r"(?i)competing stud", r"(?i)redundant.*stud", r"(?i)superseded", r"(?i)administrative (reason|decision|withdrawal|closed)",
        r"(?i)\bIRB\b.*(withdrew|reviewing|hold|on hold)", r"(?i)company.*(decision|decided|discontinued)", r"(?i)structural change", r"(?i)change in clinical strategy",
        r"(?i)\bPI\b.*(left|leaving|change|moved|withdrew|no longer|not at|abroad|graduation|medical leave)", r"(?i)principal investigator.*(left|leaving|change|move|withdrew|disagree)",
        r"(?i)investigator (moved|left|leaving|changed)", r"(?i)sponsor.*did not reach.*agreement", r"(?i)(study|research) (cancelled|abandoned|never initiated)", r"(?i)study plan was changed",
        r"(?i)not feasible", r"(?i)study determined.*not.*feasible", r"(?i)no progress", r"(?i)agreed with the sponsor", r"(?i)BARDA decision", r"(?i)(terminate|terminated) contract",
        r"(?i)development terminated", r"(?i)research(ers)?.*(finished|unable to continue|left)", r"(?i)staff turnover", r"(?i)prohibitively expensive",
    )),
    ("REGULATORY", 80, (
        r"(?i)(IRB|EC|ethics|ethical).*(reject|denied|approval|approve|issue|review|hold|committee)", r"(?i)not approved by (IRB|EC|ethics)", r"(?i)(rejected|denied|withdrew|withdrawn).*(IRB|ethics|ethical|EC)",
        r"(?i)no (IRB|EC|ethics|ethical) approval", r"(?i)(IRB|ethics committee|ethics).*decision", r"(?i)ethical (issue|concern|reason)",
    )),
    ("COVID", 90, (r"(?i)covid", r"(?i)pandemic", r"(?i)SARS-CoV-2", r"(?i)coronavirus")),
)


def _stems(tree) -> list[str] | None:
    """Lower-case strings of which a text has one wherever the parsed pattern matches; None if none can be told."""
    best, run = None, ""

    def better(a: list[str] | None, b: list[str] | None) -> list[str] | None:
        if a is None or b is None:
            return a or b
        return a if min(map(len, a)) >= min(map(len, b)) else b

    for op, arg in [*tree, (None, None)]:
        if op is _re.LITERAL:
            run += chr(arg).lower()
            continue
        best, run = better(best, [run] if run.strip() else None), ""
        if op is _re.SUBPATTERN:
            best = better(best, _stems(arg[3]))
        elif op is _re.BRANCH:
            each = [_stems(x) for x in arg[1]]
            best = better(best, [s for e in each for s in e] if all(each) else None)
    return best


def failure_category(text: Column, rules=FAILURE_RULES) -> Column:
    """struct(category, confidence, n_matched, n_categories) of a reason.

    A category's score is its confidence and 5 for each pattern that matches;
    the first of equals wins; more than one category costs 10 (not below 50).
    Empty text is OTHER with 0, text without a match OTHER with 30. A pattern is
    tried only on texts that hold a string without which it can't match.
    """

    def hit(p: str, low: Column) -> Column:
        stems, there = _stems(_re_parser.parse(p)), F.lit(False)
        for s in sorted(set(stems or [])):
            there = there | F.contains(low, F.lit(s))
        found = text.rlike(p).cast("int")
        return F.when(there, found).otherwise(0) if stems else found

    def ranked(low: Column) -> Column:
        hits = [sum((hit(p, low) for p in patterns), F.lit(0)) for _, _, patterns in rules]
        each = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(n).alias("confidence"), h.alias("hits"), F.lit(-i).alias("order")) for i, ((c, n, _), h) in enumerate(zip(rules, hits, strict=True))])
        return F.filter(each, lambda r: r["hits"] > 0)

    # Through one-element arrays, so that the text is lower-cased and the patterns are tried once for each row.
    matched = F.transform(F.array(F.lower(text)), ranked)
    return F.transform(matched, _decide(text))[0]


def _example(tree, turn: int) -> str:
    """A text that the parsed pattern matches; ``turn`` picks a branch."""
    out = ""
    for op, arg in tree:
        if op is _re.LITERAL:
            out += chr(arg)
        elif op is _re.SUBPATTERN:
            out += _example(arg[3], turn)
        elif op is _re.BRANCH:
            out += _example(arg[1][turn % len(arg[1])], turn)
        elif op in (_re.MAX_REPEAT, _re.MIN_REPEAT):
            out += " of the " if arg[1] is _re.MAXREPEAT else _example(arg[2], turn) * arg[0]
        elif op is _re.ANY:
            out += " "
    return out


def example_reasons(rules=FAILURE_RULES) -> list[str]:
    """A reason for each pattern of the table, its branches taken in turn."""
    return [_example(_re_parser.parse(p), i) for i, p in enumerate(p for _, _, ps in rules for p in ps)]


def _decide(text: Column):
    def decide(m: Column) -> Column:
        best = F.array_max(F.transform(m, lambda r: F.struct((r["confidence"] + r["hits"] * 5).alias("score"), r["order"].alias("order"), r["category"].alias("category"), r["confidence"].alias("confidence"), r["hits"].alias("hits"))))
        n = F.size(m)
        empty = text.isNull() | (F.trim(text) == "")
        category = F.when(empty | (n == 0), "OTHER").otherwise(best["category"])
        confidence = F.when(empty, 0).when(n == 0, 30).when(n > 1, F.greatest(F.lit(50), best["confidence"] - 10)).otherwise(best["confidence"])
        return F.struct(category.alias("category"), confidence.alias("confidence"), F.when(empty | (n == 0), 0).otherwise(best["hits"]).alias("n_matched"), F.when(empty, 0).otherwise(n).alias("n_categories"))

    return decide

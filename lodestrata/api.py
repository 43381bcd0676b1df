"""The query API: what a client asks of one snapshot, as DataFrames and SQL views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import rules
from .functions.text import compound_number, identifier, target_accession
from .operators import aggregate, index, paging, rights
from .sources import scan

#: Tables of a snapshot, and the columns that the API reads of each.
TABLES = {
    "compounds": "id string, pubchem_cid long, chembl_id string, synonyms array<string>, iupac_name string, molecular_formula string",
    "trials": "id string, nct_id string, status string, phase double",
    "trial_links": "compound_id string, nct_id string",
    "bioactivities": "id string, compound_id string, target_id string, value double, unit string, is_active boolean",
    "papers": "id string, title string, is_retracted boolean, mentioned_compounds array<string>",
    "neg_evidence": "id string, evidence_type string, subject_id string, severity string",
    "xrefs": "kind string, id string, pubchem_cid long",
    "targets": "target string, compound_ids array<string>, trial_ids array<string>, neg_ids array<string>",
}
#: Identifier kinds that are resolved for nobody, since their source doesn't allow it.
RESTRICTED_KINDS = frozenset({"kegg_drug_id"})
COMPLETED, ACTIVE = "COMPLETED", ("RECRUITING", "ACTIVE_NOT_RECRUITING", "ENROLLING_BY_INVITATION", "NOT_YET_RECRUITING")


class ApiError(Exception):
    """A request that can't be answered; ``status`` as in HTTP."""

    def __init__(self, status: int, reason: str):
        super().__init__(reason)
        self.status = status


class Engine:
    """Z01-Z08 over one snapshot, which ``latest.json`` in ``root`` names; ``direct``: the tables are in ``root`` itself.

    A pointer or table that can't be read raises ``SourceLoadError``: it's never
    taken for one without rows (G17, R19). All tables come from the one snapshot
    that the pointer named when the engine was made.
    """

    def __init__(self, spark: SparkSession, root: str, withheld: dict[str, str] | None = None, direct: bool = False):
        self.spark, self.withheld = spark, withheld or {}
        prefix = ""
        if not direct:
            at = f"{root}/latest.json"
            try:
                text = "\n".join(r.value for r in spark.read.text(at, wholetext=True).collect())
            except Exception as e:
                raise scan.load_error(spark, "pointer", at, e) from e
            prefix = scan.pointer(text)["prefix"]
        self.root = f"{root}/{prefix}".rstrip("/")

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise ApiError(404, f"no table {name}")
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except Exception as e:
            raise scan.load_error(self.spark, name, f"{self.root}/{name}", e) from e

    def views(self) -> None:
        """Register every table that the snapshot has as a view of its name."""
        for name in TABLES:
            if scan.exists(self.spark, f"{self.root}/{name}"):
                self.table(name).createOrReplaceTempView(name)

    def _cid(self, raw: str) -> int:
        got = self.spark.range(1).select(compound_number(F.lit(raw)).alias("n")).first()["n"]
        if got is None:
            raise ApiError(400, f"no compound id: {raw}")
        return got

    def _one(self, df: DataFrame, what: str) -> DataFrame:
        if df.isEmpty():
            raise ApiError(404, f"no {what}")
        return rights.apply(df, self.withheld) if self.withheld else df

    def compound(self, raw: str) -> DataFrame:
        """The compound of an id, without what may not be shown."""
        n = self._cid(raw)
        return self._one(self.table("compounds").where(F.col("pubchem_cid") == n), f"compound {n}")

    def negative_evidence(self, compound_id: str, event_type: str | None = None, offset: int = 0, limit: int | None = None) -> tuple[DataFrame, dict]:
        """A page of signals, and totals, pagination and verdict over all that the filter keeps."""
        wanted = rules.event_filter(event_type)
        own = self.table("neg_evidence").where(F.col("subject_id") == compound_id)
        r = aggregate.filtered_rollup(aggregate.rollup(own, "subject_id", "evidence_type", "severity"), "subject_id", wanted).first()
        by = {s: (r[s] if r else 0) for s in rules.SEVERITIES}
        total, limit = sum(by.values()), paging.clamp(limit)
        highest = next((s for s in rules.SEVERITIES if by[s]), "none")
        page = paging.page_of(own, "subject_id", ["id"], max(0, offset), limit, rules.in_filter(F.col("evidence_type"), wanted))
        returned = max(0, min(limit, total - offset))
        return page, {"total": total, "signals_by_severity": by, "highest_severity": highest, "pagination": paging.pagination(offset, limit, returned, total)}

    def repurposing(self, compound_id: str | None = None) -> DataFrame:
        """Four summaries and the verdict, of one compound or of all at once."""
        only = lambda df, c: df if compound_id is None else df.where(F.col(c) == compound_id)
        links = only(self.table("trial_links"), "compound_id").distinct()
        trials = links.join(self.table("trials").select("nct_id", "status"), "nct_id").groupBy("compound_id").agg(F.count_if(F.col("status") == COMPLETED).alias("completed"), F.count_if(F.col("status").isin(*ACTIVE)).alias("active"))
        acts = only(self.table("bioactivities"), "compound_id").groupBy("compound_id").agg(F.count_if("is_active").alias("activities"))
        papers = self.table("papers").where("is_retracted").select(F.explode(F.array_distinct("mentioned_compounds")).alias("compound_id"))
        papers = only(papers, "compound_id").groupBy("compound_id").agg(F.count("*").alias("retracted"))
        neg = only(self.table("neg_evidence"), "subject_id").groupBy(F.col("subject_id").alias("compound_id")).agg(F.count("*").alias("negatives"), F.count_if(F.col("severity") == "critical").alias("critical"))
        out = only(self.table("compounds").select(F.col("id").alias("compound_id")), "compound_id")
        for side in (trials, acts, papers, neg):
            out = out.join(side, "compound_id", "left")
        out = out.na.fill(0).withColumn("trials", F.col("completed") + F.col("active"))
        return out.withColumn("signal", rules.verdict(*(F.col(c) for c in ("trials", "activities", "negatives", "critical", "retracted"))))

    def bioactivities(self, compound_id: str) -> DataFrame:
        """Z04."""
        return self.table("bioactivities").where(F.col("compound_id") == compound_id)

    def trials(self, compound_id: str) -> DataFrame:
        """By the link table."""
        links = self.table("trial_links").where(F.col("compound_id") == compound_id).select("nct_id")
        return self.table("trials").join(links, "nct_id", "left_semi")

    def papers(self, compound_id: str) -> DataFrame:
        """By the mentions in each paper."""
        return self.table("papers").where(F.array_contains("mentioned_compounds", compound_id))

    def target(self, accession: str, sections: tuple[str, ...] = ()) -> DataFrame:
        """Counts always, ids of the sections asked for (drugs, trials, negative-evidence)."""
        names = {"drugs": "compound_ids", "trials": "trial_ids", "negative-evidence": "neg_ids"}
        if bad := set(sections) - names.keys():
            raise ApiError(400, f"no section {sorted(bad)}")
        key = self.spark.range(1).select(target_accession(F.lit(accession)).alias("a")).first()["a"]
        if key is None:
            raise ApiError(400, f"no accession: {accession}")
        got = self.table("targets").where(F.col("target") == key)
        return self._one(got.select("target", *[F.size(c).alias(f"n_{c}") for c in names.values()], *[names[s] for s in sections]), f"target {key}")

    def resolve(self, raw: str) -> DataFrame:
        """An identifier of any kind to its compound."""
        got = self.spark.range(1).select(identifier(F.lit(raw)).alias("i")).first()["i"]
        if got is None:
            raise ApiError(400, f"no identifier: {raw}")
        if got["kind"] in RESTRICTED_KINDS:
            raise ApiError(403, f"{got['kind']} may not be resolved")
        if got["kind"] == "pubchem_cid":
            hit: Column = F.col("pubchem_cid") == int(got["normalized"])
        else:
            n = self.table("xrefs").where((F.col("kind") == got["kind"]) & (F.col("id") == got["normalized"])).agg(F.min("pubchem_cid").alias("n")).first()["n"]
            if n is None:
                raise ApiError(404, f"unknown {got['kind']}")
            hit = F.col("pubchem_cid") == n
        return self._one(self.table("compounds").where(hit), "compound")

    def search(self, query: str, limit: int | None = None) -> DataFrame:
        """The best compounds by the score ladder."""
        if not query or not query.strip():
            raise ApiError(400, "empty query")
        score = rules.search_score(query.strip(), F.col("synonyms"), F.col("iupac_name"), F.col("molecular_formula"), F.col("chembl_id"), F.col("pubchem_cid"))
        slim = self.table("compounds").select("id", "pubchem_cid", "chembl_id", "synonyms", "iupac_name", "molecular_formula")
        return paging.top_k(slim, score, ["pubchem_cid"], paging.clamp(limit, 10, 25))

    def call(self, method: str, params: dict) -> DataFrame | tuple[DataFrame, dict]:
        """A tool by name; unknown ones and wrong parameters raise ApiError with the JSON-RPC code as status."""
        tools = {"search": self.search, "negative_evidence": self.negative_evidence, "resolve": self.resolve, "repurposing": self.repurposing, "target_drugs": lambda accession: self.target(accession, ("drugs",))}
        if method not in tools:
            raise ApiError(-32601, f"no tool {method}")
        try:
            return tools[method](**params)
        except TypeError as e:
            raise ApiError(-32602, str(e)) from e

    def health(self) -> dict:
        """Z08."""
        return {"status": "ok", "root": self.root}


def publish(tables: dict[str, DataFrame], root: str, snapshot: str) -> list[dict]:
    """A snapshot's tables, negative evidence bucketed by key, the pointer last."""
    import json

    from .sources import sink

    spark = next(iter(tables.values())).sparkSession
    if "neg_evidence" in tables:
        tables = tables | {"neg_evidence": index.bucketed(tables["neg_evidence"], "subject_id").repartition("bucket").sortWithinPartitions("bucket", "subject_id", "id")}
    manifest = sink.snapshot(tables, f"{root}/snapshots/{snapshot}", [])
    at = f"{root}/latest.json"
    text = json.dumps({"version": 2, "snapshot_id": snapshot, "object_prefix": f"snapshots/{snapshot}/"}, sort_keys=True)
    before = sink.read_text(spark, at)
    if before is None:
        sink.put_once(spark, at, text)
    elif not sink.swap_pointer(spark, at, before, text):
        raise RuntimeError("another publisher moved the pointer")
    return manifest

"""Provenance, merge, gates and audits over programmes, evidence, links and certificates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.functions import text as T

from fundsieve.operators import catalogue as C

PROVEN = ["A", "B"]


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://([^/?#]*)", 1))


def pick_inventory(html: DataFrame, feed: DataFrame, key: str, fields: list[str], expected: int) -> DataFrame:
    """The catalogue with the feed's values where its own are null, if it holds what is expected; else the feed."""
    size = html.agg((F.count(F.lit(1)) >= expected).alias("complete"))
    a = html.select(key, F.lit(True).alias("_h"), *[F.col(c).alias(f"h_{c}") for c in fields])
    b = feed.select(key, F.lit(True).alias("_f"), *[F.col(c).alias(f"f_{c}") for c in fields])
    t = a.join(b, key, "full_outer").crossJoin(F.broadcast(size))  # one row
    kept = t.where(F.when(F.col("complete"), F.col("_h")).otherwise(F.col("_f")))
    return kept.select(key, *[F.when(F.col("complete"), F.coalesce(f"h_{c}", f"f_{c}")).otherwise(F.col(f"f_{c}")).alias(c) for c in fields])


def without_forbidden(programs: DataFrame, evidence: DataFrame, forbidden: list[str]) -> DataFrame:
    """Programmes none of whose urls lies on a forbidden host."""
    bad = evidence.where(host(F.col("source_url")).isin(forbidden)).select("program_id").distinct()
    return programs.where(~F.coalesce(host(F.col("official_page")).isin(forbidden), F.lit(False))).join(bad, "program_id", "left_anti")


def clean_links(links: DataFrame, by: str, url: str, family_rank: Column, pos: list[str], forbidden: list[str]) -> DataFrame:
    """Of each url of a programme the link of the first family, then position; only https off forbidden hosts."""
    ok = links.where(F.col(url).startswith("https://") & ~host(F.col(url)).isin(forbidden))
    return ok.groupBy(by, url).agg(F.min(F.struct(family_rank.alias("family"), *pos)).alias("first")).select(by, url, "first.*")


def first_of(rows: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """One row per key, the first in order; combines before its shuffle, unlike a window."""
    return rows.groupBy(key).agg(F.min(F.struct(*order, *[c for c in keep if c not in order])).alias("first")).select(key, *[F.col(f"first.{c}").alias(c) for c in keep])


def apply_snapshot(before: DataFrame, after: DataFrame, ok: DataFrame, key: str, source: str, fields: list[str]) -> DataFrame:
    """Sources that passed upsert their rows, marked as seen; the others keep their earlier rows untouched."""
    passed = ok.select(source, F.lit(True).alias("_ok"))
    new = after.join(passed, source, "left_semi").select(key, F.lit(True).alias("seen"), *[F.col(c).alias(f"n_{c}") for c in (source, *fields)])
    old = before.select(key, F.lit(True).alias("_old"), *[F.col(c).alias(f"o_{c}") for c in (source, *fields)])
    value = lambda c: F.when(F.col("seen"), F.coalesce(f"n_{c}", f"o_{c}")).otherwise(F.col(f"o_{c}")).alias(c)
    return old.join(new, key, "full_outer").select(key, *[value(c) for c in (source, *fields)], F.coalesce("seen", F.lit(False)).alias("seen"))


def gate_by_source(reasons: DataFrame, least_share: float) -> DataFrame:
    """Per source: rows excluded by lifecycle, by other gates and retained, and whether its new snapshot stands."""
    late = F.col("reason") == "INACTIVE_OR_STALE"
    t = reasons.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("lifecycle_excluded"), F.count_if(F.col("reason").isNotNull() & ~late).alias("gate_excluded"), F.count_if(F.col("reason").isNull()).alias("retained"))
    return t.withColumn("decision", F.when(F.col("retained") >= least_share * F.col("n"), "APPLY").otherwise("RESTORE"))


def rule_hits(rows: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """(key, rule) for every rule that a row breaks."""
    return rows.select(key, F.explode(C.flags(*rules)).alias("rule"))


def counted_samples(hits: DataFrame, by: str, key: str, k: int = 20, salts: int = 32) -> DataFrame:
    """(by, n, samples): counts and the k smallest keys of each rule. A rule that all rows break is dealt over salted groups first, each of which keeps k."""
    w = Window.partitionBy(by, "_salt").orderBy(key)
    t = hits.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    few = t.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).groupBy(by).agg(F.slice(F.sort_array(F.collect_list(key)), 1, k).alias("samples"))
    return hits.groupBy(by).agg(F.count(F.lit(1)).alias("n")).join(few, by)


def completeness(programs: DataFrame, evidence: DataFrame, fields: list[str]) -> DataFrame:
    """Share of sixteen checks that hold, in percent: own columns, a piece of evidence per field, and six pieces at least."""
    has = evidence.groupBy("program_id").agg(F.collect_set("field").alias("fields"), F.count(F.lit(1)).alias("pieces"))
    repaid = ~F.col("instrument").isin("AVANCE_REMBOURSABLE", "PRET_TAUX_ZERO") | F.col("repayment_terms").isNotNull()
    filled = [F.col(c).isNotNull() for c in ("company_categories", "instrument", "themes", "cdc_link", "disbursement_terms")]
    own = [F.coalesce(F.col("title"), F.lit("")) != "", *filled, F.col("closing_date").isNotNull() | F.col("permanent"), repaid, F.col("pieces") >= 6]
    checks = own + [F.array_contains("fields", f) for f in fields]
    hits = reduce(lambda a, b: a + b, [F.coalesce(c.cast("int"), F.lit(0)) for c in checks])
    return programs.join(has, "program_id", "left").select("program_id", F.round(100.0 * hits / len(checks)).cast("long").alias("completeness"))


def criteria_audit(programs: DataFrame, evidence: DataFrame, by: list[str]) -> DataFrame:
    """Per field, overall and by each column: programmes with any evidence and with proven evidence."""
    per = evidence.groupBy("program_id", "field").agg(F.bool_or(F.col("tier").isin(PROVEN)).alias("proven"))
    t = per.join(programs.select("program_id", *by), "program_id")
    facets = F.array(F.struct(F.lit("all").alias("facet"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in by])
    return t.select("field", "proven", F.explode(facets).alias("f")).groupBy("f.facet", "f.value", "field").agg(F.count(F.lit(1)).alias("present"), F.count_if("proven").alias("proven"))


def remediation(programs: DataFrame, evidence: DataFrame, fields: list[str], k: int) -> DataFrame:
    """The k programmes with most to mend: ten a field without proof, one a flag, five without any document."""
    proven = evidence.groupBy("program_id").agg(F.collect_set(F.when(F.col("tier").isin(PROVEN), F.col("field"))).alias("has"), F.bool_or(F.col("tier") == "A").alias("document"))
    t = programs.join(proven, "program_id", "left").join(C.qa_flags(programs, evidence), "program_id")
    missing = F.array_except(F.array(*[F.lit(f) for f in fields]), F.coalesce("has", F.array().cast("array<string>")))
    t = t.withColumn("missing", missing).withColumn("severity", 10 * F.size("missing") + F.col("n_flags") + F.when(F.coalesce("document", F.lit(False)), 0).otherwise(5))
    return t.orderBy(F.desc("severity"), "title", "program_id").limit(k).select("program_id", F.col("severity").cast("long").alias("severity"), F.array_join("missing", "|").alias("missing"))


def certificate_problems(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """(source_id, problem) of each ingesting source, from its latest run."""
    last = runs.groupBy("source_id").agg(F.max(F.struct("checked_at", "cycle_id", "success", "discovered", "imported")).alias("r"))
    t = sources.where("strategy <> 'control-only'").join(last, "source_id", "left")
    problem = C.flags(
        ("MISSING_RUN", F.col("r").isNull()),
        ("FAILED_RUN", ~F.col("r.success")),
        ("IMPORTS_BELOW_MINIMUM", F.col("r.imported") < F.col("min_imported")),
        ("UNEXPLAINED_PAGES", F.col("r.success") & (F.col("r.imported") < F.col("r.discovered"))),
    )
    return t.select("source_id", F.explode(problem).alias("problem"))


def certificates(sources: DataFrame, problems: DataFrame, config: DataFrame, data: DataFrame) -> DataFrame:
    """PASS where nothing is wrong, with the fingerprints that it was given for."""
    n = problems.groupBy("source_id").agg(F.count(F.lit(1)).alias("problems"))
    t = sources.join(n, "source_id", "left").join(config, "source_id", "left").join(data, "source_id", "left")
    return t.select("source_id", F.coalesce("problems", F.lit(0)).alias("problems"), F.when(F.col("problems").isNull(), "PASS").otherwise("FAIL").alias("status"), "config", "data")


def ledger(certs: DataFrame, current: DataFrame) -> DataFrame:
    """Of each source the newest certificate, and why it does not unlock the source; null: it does."""
    newest = certs.groupBy("source_id").agg(F.max(F.struct("issued_at", "status", "config", "data")).alias("c"))
    now = current.select("source_id", F.col("config").alias("now_config"), F.col("data").alias("now_data"))
    reason = (
        F.when(F.col("c").isNull(), "NO_CERTIFICATE")
        .when(F.col("c.status") != "PASS", "NOT_PASSED")
        .when(F.col("c.config").isNull() | F.col("c.data").isNull(), "MISSING_FINGERPRINT")
        .when(~F.col("c.config").eqNullSafe(F.col("now_config")), "CONFIG_CHANGED")
        .when(~F.col("c.data").eqNullSafe(F.col("now_data")), "DATA_CHANGED")
    )
    return now.join(newest, "source_id", "left").select("source_id", reason.alias("reason"))


def watch_feed(changes: DataFrame, business: list[str], limits: dict[str, int]) -> DataFrame:
    """The newest creations, modifications of a business field and exits, each up to its limit."""
    touches = F.arrays_overlap(F.split("fields", r"\|"), F.array(*[F.lit(b) for b in business]))
    wanted = changes.where((F.col("type") != "MODIFICATION") | touches)
    parts = [wanted.where(F.col("type") == kind).orderBy(F.desc("changed_on"), "program_id").limit(k) for kind, k in limits.items()]
    return reduce(DataFrame.union, parts)


def joined_feed(feed: DataFrame, programs: DataFrame, key: str, title: str) -> DataFrame:
    """feed with the programme (programme_id, by) that each change is about: the one of its id, else the first of its normalised title; null where there is none."""
    named = T.norm(F.col(title))
    by_id = programs.select(F.col(key), F.lit(True).alias("_known")).distinct()
    by_title = programs.select(key, named.alias("_title")).where("_title <> ''").groupBy("_title").agg(F.min(key).alias("_other"))
    t = feed.join(by_id, key, "left").withColumn("_title", F.when(F.col("_known").isNull(), named)).join(by_title, "_title", "left")
    by = F.when(F.col("_known"), "id").when(F.col("_other").isNotNull(), "title")
    return t.withColumn("programme_id", F.when(F.col("_known"), F.col(key)).otherwise(F.col("_other"))).withColumn("by", by).drop("_known", "_title", "_other")

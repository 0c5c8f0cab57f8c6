"""Inventory, merge, snapshot, quality, publication and change operators over programme and evidence tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIER_RANK = {"A": 4, "B": 3, "C": 2, "D": 1}
CRITICAL = ["objective", "beneficiaries", "financialTerms", "projectsExpected", "eligibleExpenses", "calendar", "prerequisites", "selectionCriteria"]
TARGET = ["SUBVENTION", "AVANCE_REMBOURSABLE", "PRET_TAUX_ZERO", "APPEL_A_PROJET"]


def tier_rank(c: Column) -> Column:
    out = F.lit(0)
    for t, r in TIER_RANK.items():
        out = F.when(c == t, r).otherwise(out)
    return out


def flags(*rules: tuple[str, Column]) -> Column:
    """Names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))


# Inventory


def unique_links(links: DataFrame, url: str, pos: list[str], fields: list[str]) -> DataFrame:
    """One row per url: of each field the last non-null by position."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*pos))).alias(c) for c in fields]
    return links.groupBy(url).agg(*last, F.count(F.lit(1)).alias("occurrences"))


def first_seen(links: DataFrame, url: str, pos: list[str]) -> DataFrame:
    return links.groupBy(url).agg(F.min(F.struct(*pos)).alias("first")).select(url, "first.*")


def occurrence_counts(links: DataFrame, url: str) -> DataFrame:
    per = links.groupBy(url).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("unique_urls"), (F.sum("n") - F.count(F.lit(1))).alias("duplicate_occurrences"))


def accounting(runs: DataFrame) -> DataFrame:
    failed = F.when(~F.col("success"), F.col("discovered") - F.col("imported")).otherwise(0)
    t = runs.groupBy("source_id").agg(F.sum("discovered").alias("discovered"), F.sum("imported").alias("imported"), F.sum(failed).alias("errors"))
    return t.withColumn("unexplained", F.col("discovered") - F.col("imported") - F.col("errors"))


def calibration(sources: DataFrame) -> DataFrame:
    ok = (F.col("min_expected") > 0) & (F.col("min_imported") > 0) & (F.col("min_import_ratio") > 0) & (F.col("min_import_ratio") <= 1)
    control = F.col("strategy") == "control-only"
    return sources.select("source_id", F.when(control, "CONTROL").otherwise("INGESTION").alias("role"), (control | F.coalesce(ok, F.lit(False))).alias("calibrated"))


# Merge and snapshot


def survivorship(records: DataFrame, key: list[str], seq: list[str], rank: Column, scalars: list[str], at_least: list[str] = ()) -> DataFrame:
    """Fold ordered records into one per key by evidence tier.

    A scalar keeps its first value and takes a later one only from a record of a tier above all before; fields of
    at_least also take one of an equal tier. Closed form of the fold: with the highest tier before each record, the
    result is the last value that would have been taken.
    """
    before = Window.partitionBy(*key).orderBy(*seq).rowsBetween(Window.unboundedPreceding, -1)
    rows = records.withColumn("_rank", rank).withColumn("_most", F.max("_rank").over(before))
    for c in scalars:
        had = F.count(c).over(before) > 0
        rows = rows.withColumn(f"_{c}", F.when(F.col(c).isNotNull() & (~had | (F.col("_rank") > F.col("_most"))), F.struct(*seq, c)))
    for c in at_least:
        rows = rows.withColumn(f"_{c}", F.when(F.col(c).isNotNull() & (F.col("_most").isNull() | (F.col("_rank") >= F.col("_most"))), F.struct(*seq, c)))
    return rows.groupBy(*key).agg(*[F.max(f"_{c}")[c].alias(c) for c in (*scalars, *at_least)], F.max("_rank").alias("tier_rank"), F.count(F.lit(1)).alias("records"))


def assess(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Whether each run is good enough to replace its source's snapshot, with the reasons if not."""
    t = runs.join(sources, "source_id")
    control = F.col("strategy") == "control-only"
    ratio = F.when(F.col("discovered") > 0, F.col("imported") / F.col("discovered")).otherwise(F.when(F.col("imported") > 0, 1.0).otherwise(0.0))
    t = t.withColumn("import_ratio", ratio)
    reasons = flags(
        ("SUSPICIOUS_VOLUME", ~control & (F.col("min_expected") > 0) & (F.col("discovered") < F.col("min_expected"))),
        ("LOW_IMPORTED_COUNT", ~control & (F.col("imported") < F.col("min_imported"))),
        ("LOW_IMPORT_RATIO", ~control & (F.col("discovered") > 0) & (F.col("import_ratio") < F.col("min_import_ratio"))),
        ("EMPTY_INGESTION", ~control & (F.col("imported") == 0)),
    )
    t = t.withColumn("reasons", reasons).withColumn("ok", F.when(control, F.col("success")).otherwise(F.size("reasons") == 0))
    return t.select("cycle_id", "source_id", "import_ratio", F.array_join("reasons", "|").alias("reasons"), "ok", (F.col("ok") & ~control & (F.col("imported") > 0)).alias("lifecycle_safe"))


def reason_counts(assessed: DataFrame, runs: DataFrame) -> DataFrame:
    """(source_id, reason, runs, excluded): runs and rows not imported of each source by reason, and of all its runs (ALL)."""
    named = F.filter(F.split("reasons", r"\|"), lambda r: r != "")
    each = assessed.join(runs.select("cycle_id", "discovered", "imported"), "cycle_id").select("source_id", "discovered", "imported", F.explode(F.concat(F.array(F.lit("ALL")), named)).alias("reason"))
    return each.groupBy("source_id", "reason").agg(F.count(F.lit(1)).alias("runs"), F.sum(F.col("discovered") - F.col("imported")).cast("long").alias("excluded"))


def coverage_state(runs: DataFrame) -> DataFrame:
    """Per source: last success, and failures since then."""
    last = runs.groupBy("source_id").agg(F.max(F.when(F.col("success"), F.struct("checked_at", "cycle_id"))).alias("s"))
    since = F.col("s").isNull() | (F.struct("checked_at", "cycle_id") > F.col("s"))
    return runs.join(last, "source_id").groupBy("source_id").agg(F.max("s.checked_at").alias("last_successful_at"), F.count_if(since).alias("consecutive_failures"))


def row_digest(columns: list[str]) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns]), 256)


def partition_digest(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """An order-free digest of each partition: the sum of its rows' digests' first 15 hex digits."""
    part = F.conv(F.substring(row_digest(columns), 1, 15), 16, 10).cast("decimal(20,0)")
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(part).cast("string").alias("digest"))


def archive(programs: DataFrame, as_of: str) -> DataFrame:
    gone = ~F.coalesce("permanent", F.lit(False)) & (F.col("closing_date") < F.lit(as_of).cast("date")) & (F.col("lifecycle") != "STALE")
    return programs.withColumn("new_lifecycle", F.when(gone, "ARCHIVE").otherwise(F.coalesce("lifecycle", F.lit("ACTIVE"))))


def stale(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of the earlier snapshot that the later one no longer holds."""
    return before.join(after.select(key), key, "left_anti")


def volume_gate(before: DataFrame, after: DataFrame) -> DataFrame:
    """Fails on an empty snapshot and on one under 55 % of a previous one of over 400 rows."""
    a, b = before.agg(F.count(F.lit(1)).alias("previous")), after.agg(F.count(F.lit(1)).alias("current"))
    bad = (F.col("current") == 0) | ((F.col("previous") > 400) & (F.col("current") < 0.55 * F.col("previous")))
    return a.crossJoin(b).select("previous", "current", (~bad).alias("passed"))  # one row each


# Quality


def qa_flags(programs: DataFrame, evidence: DataFrame) -> DataFrame:
    """Missing parts of each programme, in fixed order; fields count as present if any evidence names them."""
    fields = evidence.groupBy("program_id").agg(F.collect_set("field").alias("fields"))
    t = programs.join(fields, "program_id", "left")
    lacks = lambda f: ~F.coalesce(F.array_contains("fields", f), F.lit(False))
    repay = F.col("instrument").isin("AVANCE_REMBOURSABLE", "PRET_TAUX_ZERO")
    out = flags(
        ("MISSING_TITLE", F.coalesce(F.col("title"), F.lit("")) == ""),
        ("MISSING_SOURCE", F.col("official_page").isNull()),
        ("MISSING_OBJECTIVE", lacks("objective")),
        ("MISSING_BENEFICIARIES", lacks("beneficiaries")),
        ("MISSING_AID_TYPE", F.col("instrument").isNull()),
        ("MISSING_DEADLINE", F.col("closing_date").isNull() & ~F.col("permanent")),
        ("MISSING_ELIGIBLE_EXPENSES", lacks("eligibleExpenses")),
        ("MISSING_PREREQUISITES", lacks("prerequisites")),
        ("MISSING_SELECTION_CRITERIA", lacks("selectionCriteria")),
        ("MISSING_CDC", F.col("cdc_link").isNull()),
        ("MISSING_COMPANY_CATEGORY", F.col("company_categories").isNull()),
        ("DATE_INCONSISTENCY", F.col("opening_date") > F.col("closing_date")),
        ("MISSING_FINANCIAL_TERMS", lacks("financialTerms")),
        ("MISSING_DISBURSEMENT_TERMS", F.col("disbursement_terms").isNull()),
        ("MISSING_REPAYMENT_TERMS", repay & F.col("repayment_terms").isNull()),
    )
    return t.select("program_id", F.array_join(out, "|").alias("flags"), F.size(out).cast("long").alias("n_flags"))


def evidence_coverage(evidence: DataFrame, fields: list[str] = CRITICAL) -> DataFrame:
    """The best tier per programme and field, one column a field."""
    return evidence.groupBy("program_id").agg(*[F.min(F.when(F.col("field") == f, F.col("tier"))).alias(f) for f in fields])


def confidence(coverage: DataFrame, fields: list[str] = CRITICAL) -> DataFrame:
    points = reduce(lambda a, b: a + b, [F.when(F.col(f) == "A", 4).when(F.col(f) == "B", 3).when(F.col(f) == "C", 1).otherwise(0) for f in fields])
    return coverage.select("program_id", F.round(100.0 * points / (4 * len(fields))).cast("long").alias("confidence"))


def verification(programs: DataFrame, evidence: DataFrame) -> DataFrame:
    proven = evidence.where(F.col("tier").isin("A", "B") & F.col("field").isin(CRITICAL)).groupBy("program_id").agg(F.countDistinct("field").alias("covered"))
    t = programs.join(proven, "program_id", "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    repaid = ~F.col("instrument").isin("AVANCE_REMBOURSABLE", "PRET_TAUX_ZERO") | F.col("repayment_terms").isNotNull()
    ok = (F.col("covered") == len(CRITICAL)) & (F.col("permanent") | F.col("closing_date").isNotNull()) & F.col("instrument").isNotNull() & F.col("company_categories").isNotNull() & repaid
    return t.select("program_id", F.col("covered").cast("long").alias("covered"), F.when(ok, "VERIFIE").otherwise("A_REVERIFIER").alias("status"))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


REPAYABLE = ["AVANCE_REMBOURSABLE", "PRET_TAUX_ZERO"]


def quality_report(programs: DataFrame, verified: DataFrame, selection: DataFrame) -> DataFrame:
    """One row of counts and whole percentages of the active programmes; verified(program_id, status), selection(program_id) with criteria."""
    t = programs.join(verified.select("program_id", "status"), "program_id", "left").join(selection.withColumn("criteria", F.lit(True)), "program_id", "left")
    active = F.col("lifecycle") == "ACTIVE"
    n = lambda cond: F.count_if(active & cond)
    share = lambda cond: F.floor(100.0 * n(cond) / F.count_if(active) + 0.5).cast("long")
    counts = {"active": F.lit(True), "calls": F.col("kind").rlike("AAP|AMI"), "verified": F.col("status") == "VERIFIE", "advances": F.col("instrument") == "AVANCE_REMBOURSABLE", "zero_loans": F.col("instrument") == "PRET_TAUX_ZERO", "with_repayment": F.col("instrument").isin(REPAYABLE) & F.col("repayment_terms").isNotNull()}
    shares = {"document": F.col("cdc_link").isNotNull(), "deadline": F.col("permanent") | F.col("closing_date").isNotNull(), "selection": F.coalesce("criteria", F.lit(False)), "disbursement": F.col("disbursement_terms").isNotNull()}
    return t.agg(F.count(F.lit(1)).alias("library"), F.count_if(F.col("lifecycle") == "ARCHIVE").alias("archived"), *[n(c).alias(k) for k, c in counts.items()], *[share(c).alias(f"{k}_coverage") for k, c in shares.items()])


def manifest(programs: DataFrame, verified: DataFrame, as_of: str) -> DataFrame:
    """(facet, value, n) over the active programmes, and how many are not; facets without a programme are absent."""
    active = F.col("lifecycle") == "ACTIVE"
    one = lambda facet, cond, value=F.lit(""): F.when(cond, F.struct(F.lit(facet).alias("facet"), value.alias("value")))
    said = [one("active", active), one("archived", ~active), one("next_day", recent_or_active(as_of)), one("kind", active, F.when(F.col("kind").rlike("AAP|AMI"), "CALL").otherwise("AID")), one("verified", active & (F.col("status") == "VERIFIE")), one("with_document", active & F.col("cdc_link").isNotNull()), one("with_deadline", active & (F.col("permanent") | F.col("closing_date").isNotNull())), one("direct_link", active & F.col("official_page").startswith("https://")), one("target", active & F.col("instrument").isin(TARGET)), one("scope", active, F.col("scope")), one("instrument", active, F.col("instrument"))]
    categories = F.when(active & F.col("company_categories").isNotNull(), F.transform(F.split("company_categories", r"\|"), lambda c: F.struct(F.lit("category").alias("facet"), c.alias("value"))))
    t = programs.join(verified.select("program_id", "status"), "program_id", "left")
    facets = F.concat(F.array_compact(F.array(*said)), F.coalesce(categories, F.array().cast("array<struct<facet:string,value:string>>")))
    return t.select(F.explode(facets).alias("f")).groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"))


def source_health(probes: DataFrame) -> DataFrame:
    """Counts of probes(role, state) by role and of ALL; the environment is suspect where of over 20 none is well and over 80 % fail on the network."""
    n = lambda *states: F.count_if(F.col("state").isin(*states))
    total, ok, network = F.count(F.lit(1)), n("OK", "PROTECTED"), n("NETWORK_ERROR", "TIMEOUT")
    g = probes.rollup("role").agg(total.alias("total"), (total - n("UNPROBED")).alias("probed"), n("OK", "PROTECTED", "HTTP_ERROR").alias("conclusive"), ok.alias("ok"), (total - ok - n("UNPROBED")).alias("failed"), n("PROTECTED").alias("protected"), n("TIMEOUT").alias("timeouts"), network.alias("network_errors"), ((total > 20) & (ok == 0) & (network > 0.8 * total)).alias("environment_suspect"))
    return g.withColumn("role", F.coalesce("role", F.lit("ALL")))


def registry_problems(sources: DataFrame, page: Column, strategies: list[str], forbidden: list[str], expected_scopes: list[str]) -> DataFrame:
    """(subject, problem): of each source by id, and of each expected scope that no source has."""
    s = sources.withColumn("page", page)
    ids = duplicates(s, "source_id").select("source_id", F.lit(True).alias("twice"))
    pages = duplicates(s.where("page IS NOT NULL"), "page").select("page", F.lit(True).alias("same"))
    host = F.lower(F.regexp_extract("url", "(?i)^https?://([^/?#]*)", 1))
    found = flags(("MISSING_NAME", F.coalesce("name", F.lit("")) == ""), ("MISSING_URL", F.col("url").isNull()), ("URL_NOT_HTTPS", ~F.col("url").rlike("(?i)^https:")), ("STRATEGY_NOT_ALLOWED", ~F.col("strategy").isin(strategies)), ("DUPLICATE_ID", F.col("twice")), ("DUPLICATE_URL", F.col("same")), ("FORBIDDEN_HOST", host.isin(forbidden)))
    own = s.join(ids, "source_id", "left").join(pages, "page", "left").select(F.col("source_id").cast("string").alias("subject"), F.explode(found).alias("problem"))
    expected = sources.sparkSession.createDataFrame([(x,) for x in expected_scopes], "scope string")
    absent = expected.join(sources.select("scope"), "scope", "left_anti")
    return own.unionByName(absent.select(F.col("scope").alias("subject"), F.lit("SCOPE_ABSENT").alias("problem")))


# Publication


def evidence_predicates(evidence: DataFrame, guichet: str, status: list[str], instrument: str, enterprise: str) -> DataFrame:
    proof = evidence.where(F.col("tier").isin("A", "B") & F.col("source_url").rlike("(?i)^https?://"))
    has = lambda *fs: F.bool_or(F.col("field").isin(*fs))
    return proof.groupBy("program_id").agg(has(guichet).alias("guichet"), has(*status).alias("status"), has(instrument).alias("instrument_proof"), has(enterprise).alias("enterprise"))


def recent_or_active(as_of: str) -> Column:
    next_day = F.date_add(F.lit(as_of).cast("date"), 1)
    return (F.col("lifecycle") == "ACTIVE") & (F.coalesce("permanent", F.lit(False)) | F.col("closing_date").isNull() | (F.col("closing_date") >= next_day))


# Titles of pages that name no programme.
GENERIC_TITLE = r"(?i)^(accueil|home|aides?|dispositif|document|conditions particuli[eè]res( bpifrance)?|page|sans titre|nos aides|toutes nos aides|contact et aide)$"


def publication_reason(programs: DataFrame, proofs: DataFrame, sources: DataFrame, as_of: str, forbidden: list[str]) -> DataFrame:
    """The first gate that a programme fails, in order; null: published."""
    t = programs.join(proofs, "program_id", "left").join(sources.select("source_id", F.lit(True).alias("configured"), "certified"), "source_id", "left")
    call = F.col("kind").rlike("AAP|AMI")
    lacks = lambda c: ~F.coalesce(c, F.lit(False))
    reason = (
        F.when(F.col("program_id").isNull() | F.col("title").isNull(), "INVALID_RECORD")
        .when(lacks("configured"), "SOURCE_NOT_CONFIGURED")
        .when(lacks("certified"), "SOURCE_NOT_CERTIFIED")
        .when(lacks(recent_or_active(as_of)), "INACTIVE_OR_STALE")
        .when(~call & (F.col("instrument").isNull() | (F.col("instrument") == "AUTRE")), "MISSING_INSTRUMENT_EVIDENCE")
        .when(~call & ~F.col("instrument").isin(TARGET), "OUT_OF_TARGET_INSTRUMENT")
        .when(lacks("guichet"), "MISSING_GUICHET_EVIDENCE")
        .when(lacks("status"), "MISSING_STATUS_EVIDENCE")
        .when(lacks("instrument_proof"), "MISSING_INSTRUMENT_EVIDENCE")
        .when(lacks("enterprise"), "MISSING_ENTERPRISE_EVIDENCE")
        .when((F.length(F.trim("title")) < 4) | F.col("title").rlike(GENERIC_TITLE), "GENERIC_TITLE")
        .when(F.coalesce("official_page", F.lit("")) == "", "MISSING_DIRECT_URL")
        .when(~F.col("official_page").rlike("(?i)^https://[^/]"), "INVALID_DIRECT_URL")
        .when(F.lower(F.regexp_extract("official_page", "(?i)^https?://([^/?#]*)", 1)).isin(forbidden), "FORBIDDEN_AGGREGATOR")
    )
    return t.select("program_id", "source_id", reason.alias("reason"))


def quarantine(reasons: DataFrame) -> DataFrame:
    return reasons.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("program_id").alias("first_program"))


# Changes and time


def changes(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """CREATION, MODIFICATION with the fields that differ, SORTIE_PERIMETRE."""
    b = before.select(key, F.lit(True).alias("_b"), *[F.col(c).alias(f"b_{c}") for c in fields])
    a = after.select(key, F.lit(True).alias("_a"), *[F.col(c).alias(f"a_{c}") for c in fields])
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in fields]))
    kind = F.when(F.col("_b").isNull(), "CREATION").when(F.col("_a").isNull(), "SORTIE_PERIMETRE").when(F.size(changed) > 0, "MODIFICATION")
    out = b.join(a, key, "full_outer").select(key, kind.alias("type"), F.when(kind == "MODIFICATION", F.array_join(changed, "|")).otherwise("").alias("fields"))
    return out.where("type IS NOT NULL")


def next_deadline(programs: DataFrame, evidence: DataFrame, as_of: str) -> DataFrame:
    proof = evidence.where((F.col("field") == "calendar") & F.col("tier").isin("A", "B")).select("program_id").distinct().withColumn("proven", F.lit(True))
    day = F.lit(as_of).cast("date")
    reason = F.when(F.col("permanent"), F.when(F.col("proven"), "PERMANENT").otherwise("PERMANENT_UNVERIFIED")).when(F.col("closing_date") >= F.date_add(day, 1), "DEADLINE").when(F.col("closing_date").isNotNull(), "J1").otherwise("DATE_MISSING")
    t = programs.join(proof, "program_id", "left").withColumn("reason", reason)
    return t.select("program_id", F.col("reason").isin("PERMANENT", "DEADLINE").alias("eligible"), F.when(~F.col("permanent"), F.col("closing_date")).alias("deadline"), "reason")


def date_state(programs: DataFrame, as_of: str) -> DataFrame:
    days = F.datediff("closing_date", F.lit(as_of).cast("date"))
    state = F.when(days.isNull(), "unknown").when(days >= 0, "open").when(days >= -60, "recent-closed").otherwise("closed")
    return programs.select("program_id", state.alias("state"), days.cast("long").alias("days"))


def faceted(programs: DataFrame, region: str | None = None, scope: str | None = None, kind: str | None = None, theme: str | None = None, instrument: str | None = None, categories: list[str] | None = None) -> DataFrame:
    """Programmes that have every facet asked for: nationwide ones count for each region, any one of the categories does."""
    t = programs
    if region:
        t = t.where((F.col("region") == region) | (F.col("scope") == "NATIONAL"))
    for column, value in (("scope", scope), ("kind", kind), ("themes", theme), ("instrument", instrument)):
        if value:
            t = t.where(F.col(column) == value)
    if categories:
        t = t.where(F.arrays_overlap(F.split("company_categories", r"\|"), F.array(*[F.lit(c) for c in categories])))
    return t


def by_date_state(programs: DataFrame, as_of: str, states: tuple[str, ...] = ("open", "recent-closed")) -> DataFrame:
    """Adds state; unless asked for, neither long closed nor undated programmes stay."""
    days = F.datediff("closing_date", F.lit(as_of).cast("date"))
    state = F.when(days.isNull(), "unknown").when(days >= 0, "open").when(days >= -60, "recent-closed").otherwise("closed")
    return programs.withColumn("state", state).where(F.col("state").isin(*states))


def by_freshness(programs: DataFrame, as_of: str) -> DataFrame:
    """A row for each view that shows the programme: all, next_day (open on the next day) and missing (no date)."""
    shown = flags(("all", F.lit(True)), ("next_day", recent_or_active(as_of)), ("missing", ~F.col("permanent") & F.col("closing_date").isNull()))
    return programs.withColumn("freshness", F.explode(shown))


def paris_days(events: DataFrame, ts: str) -> DataFrame:
    day = F.to_date(F.from_utc_timestamp(ts, "Europe/Paris"))
    return events.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("next_day", F.date_add("day", 1))


def alias_dedupe(rows: DataFrame, page: Column, title: Column, catalogue_paths: list[str]) -> DataFrame:
    """One row per alias: the page's key, or title, scope and territory where the page is absent or a catalogue's. Of rows of one alias the first that has a value gives it; their sources are listed."""
    own = F.lower(F.regexp_extract("page", "^https?://[^/]*([^?]*)", 1))
    territory = F.when(F.col("scope") == "REGIONAL", F.col("region")).otherwise("FRANCE")
    by_title = F.concat(F.lit("title:"), title, F.lit("|"), "scope", F.lit("|"), territory)
    alias = F.when(F.col("page").isNull() | own.isin(catalogue_paths), by_title).otherwise(F.concat(F.lit("url:"), "page"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("program_id"))).alias(c)
    sources = F.array_join(F.transform(F.sort_array(F.collect_set("source_id")), lambda x: x.cast("string")), "|")
    return rows.withColumn("page", page).groupBy(alias.alias("alias")).agg(F.min("program_id").alias("kept"), F.count(F.lit(1)).alias("records"), F.min_by("name", "program_id").alias("title"), first("closing_date"), sources.alias("sources"))


def report_movements(before: DataFrame, after: DataFrame, key: str, fields: list[str], closed: str) -> DataFrame:
    """(key, movement, reason): new, modified in any field, and obsolete rows, which vanished or became closed. Without an earlier table nothing counts as new."""
    b, a = (t.select(key, F.lit(True).alias(f"_{n}"), *[F.col(c).alias(f"{n}_{c}") for c in fields]) for t, n in ((before, "b"), (after, "a")))
    old, new = F.col("_b").isNotNull(), F.col("_a").isNotNull()
    differs = reduce(lambda x, y: x | y, [~F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}")) for c in fields])
    started = F.broadcast(before.agg((F.count(F.lit(1)) > 0).alias("_started")))  # one row
    ends = F.col("a_lifecycle").rlike(closed) & ~F.col("b_lifecycle").rlike(closed)
    one = lambda cond, m, why: F.when(cond, F.struct(F.lit(m).alias("movement"), F.lit(why).cast("string").alias("reason")))
    moves = F.array_compact(F.array(one(~old & F.col("_started"), "new", None), one(old & new & differs, "modified", None), one(old & ~new, "obsolete", "DISPARU_DE_LA_COLLECTE"), one(old & new & ends, "obsolete", "DEVENU_CLOS_OU_OBSOLETE")))
    return b.join(a, key, "full_outer").crossJoin(started).select(key, F.explode(moves).alias("m")).select(key, "m.*")


def home(programs: DataFrame, runs: DataFrame, verified: DataFrame, as_of: str) -> DataFrame:
    """(metric, name, value): shares by scope, the commonest instruments and regions, the soonest closings and counters."""
    day = F.lit(as_of).cast("date")
    count = F.count(F.lit(1))
    said = lambda t, metric, name, value: t.select(F.lit(metric).alias("metric"), name.alias("name"), value.cast("double").alias("value"))
    none = F.lit("")
    total = programs.agg(count.alias("total"))
    shares = programs.groupBy("scope").agg(count.alias("n")).crossJoin(F.broadcast(total)).select(F.concat(F.lit("share:"), "scope").alias("metric"), none.alias("name"), F.round(100.0 * F.col("n") / F.col("total"), 6).alias("value"))
    top = lambda c, k: said(programs.groupBy(c).agg(count.alias("n")).orderBy(F.desc("n"), c).limit(k), c, F.col(c), F.col("n"))
    soon = programs.where(F.col("closing_date") >= day).orderBy("closing_date", "program_id").limit(6)
    parts = [shares, top("instrument", 6), top("region", 8), said(soon, "closing", F.col("program_id").cast("string"), F.datediff("closing_date", day))]
    parts.append(said(runs.agg(F.round(100.0 * F.count_if("success") / count, 6).alias("n")), "source_success", none, F.col("n")))
    counters = programs.agg(F.count_if(F.col("opening_date") == day).alias("created_today"), F.count_if(F.col("lifecycle") == "ACTIVE").alias("active"))
    parts += [said(counters, c, none, F.col(c)) for c in ("created_today", "active")]
    parts.append(said(verified.agg(F.count_if(F.col("status") == "VERIFIE").alias("n")), "verified", none, F.col("n")))
    return reduce(DataFrame.union, parts)


def reporting(programs: DataFrame, completeness: DataFrame, k: int = 8) -> DataFrame:
    """The sources with most programmes, and the shares of those with a direct link, a document, a date, and nearly all fields."""
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 6)
    t = programs.join(completeness, "program_id", "left")
    g = t.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), share(F.col("official_page").startswith("https://")).alias("direct_share"), share(F.col("cdc_link").isNotNull()).alias("document_share"), share(F.col("closing_date").isNotNull() | F.col("permanent")).alias("dated_share"), share(F.col("completeness") >= 80).alias("complete_share"))
    return g.orderBy(F.desc("n"), "source_id").limit(k)

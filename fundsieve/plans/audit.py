"""Provenance, gates, audits, certification and change feeds bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundsieve.fixtures import AS_OF
from fundsieve.operators import audit as A
from fundsieve.operators import catalogue as C
from fundsieve.operators import extraction as X
from fundsieve.operators import merging as G
from fundsieve.operators import ordering as N
from fundsieve.plans.queries import CATALOGUE_PATHS, CONFIDENCE_SQL, DAY, DEDUPE_URL, FIELDS, FINANCE_SQL, NORM, RANK, REASON_SQL, VERIFIED_SQL, listed, query, reasons
from fundsieve.functions import text as T
from fundsieve.sources import files

FORBIDDEN = ["s3.example.org", "s7.example.org"]
HOST = "lower(regexp_extract({c}, '(?i)^https?://([^/?#]*)', 1))"
ROW_HASH = "('0x' || substring(sha256(concat_ws(chr(1), {c})), 1, 15))::HUGEINT"


def day():
    return F.lit(AS_OF).cast("date")


# D: inventory


@query("WITH k AS (SELECT count(*) >= 1000 AS complete FROM fx_before) SELECT program_id, CASE WHEN complete THEN coalesce(b.lifecycle, a.lifecycle) ELSE a.lifecycle END AS lifecycle, CASE WHEN complete THEN coalesce(b.closing_date, a.closing_date) ELSE a.closing_date END AS closing_date FROM fx_before b FULL JOIN fx_after a USING (program_id), k WHERE CASE WHEN complete THEN b.title IS NOT NULL ELSE a.title IS NOT NULL END")
def d3_inventory_source(t):
    return A.pick_inventory(t("fx_before"), t("fx_after"), "program_id", ["lifecycle", "closing_date"], 1000)


@query("SELECT program_id, title FROM fx_after WHERE program_id NOT IN (SELECT program_id FROM fx_before)")
def d4_feed_gap(t):
    return C.stale(t("fx_after"), t("fx_before"), "program_id").select("program_id", "title")


# E: provenance, merge, snapshot


@query(f"SELECT program_id FROM fx_program WHERE {HOST.format(c='official_page')} NOT IN {listed(FORBIDDEN)} AND program_id NOT IN (SELECT program_id FROM fx_evidence WHERE {HOST.format(c='source_url')} IN {listed(FORBIDDEN)})")
def e1_forbidden_provenance(t):
    return A.without_forbidden(t("fx_program"), t("fx_evidence"), FORBIDDEN).select("program_id")


@query("SELECT program_id FROM fx_program WHERE lifecycle <> 'ARCHIVE' AND starts_with(official_page, 'https://') AND source_id IN (SELECT source_id FROM fx_source WHERE strategy <> 'control-only') AND official_page NOT IN (SELECT source_url FROM fx_evidence WHERE tier = 'D')")
def e2_direct_records(t):
    sources = t("fx_source").where("strategy <> 'control-only'").select("source_id")
    listing = t("fx_evidence").where("tier = 'D'").select(F.col("source_url").alias("official_page")).distinct()
    direct = t("fx_program").where((F.col("lifecycle") != "ARCHIVE") & F.col("official_page").startswith("https://"))
    return direct.join(sources, "source_id", "left_semi").join(listing, "official_page", "left_anti").select("program_id")


FAMILIES = [("cdc", "objective"), ("regulation", "calendar"), ("form", "beneficiaries")]
FAMILY_SQL = "CASE field " + " ".join(f"WHEN '{f}' THEN {i}" for i, (_, f) in enumerate(FAMILIES)) + " ELSE 3 END"


def family():
    rank = F.lit(3)
    for i, (_, f) in enumerate(FAMILIES):
        rank = F.when(F.col("field") == f, i).otherwise(rank)
    return rank


@query(f"SELECT program_id, source_url, family, seq FROM (SELECT *, row_number() OVER (PARTITION BY program_id, source_url ORDER BY family, seq) AS rn FROM (SELECT *, {FAMILY_SQL} AS family FROM fx_evidence WHERE starts_with(source_url, 'https://') AND {HOST.format(c='source_url')} NOT IN {listed(FORBIDDEN)})) WHERE rn = 1")
def e3_link_hygiene(t):
    return A.clean_links(t("fx_evidence"), "program_id", "source_url", family(), ["seq"], FORBIDDEN)


@query("SELECT official_page, min(program_id) AS program_id, arg_min(title, program_id) AS title FROM fx_program WHERE lifecycle <> 'ARCHIVE' GROUP BY 1")
def e4_direct_library(t):
    rows = t("fx_program").where("lifecycle <> 'ARCHIVE'")
    rows = A.first_of(rows, "program_id", ["opening_date", "title"], ["opening_date", "title", "official_page"])
    return A.first_of(rows, "official_page", ["program_id"], ["program_id", "title"])


PASSED = "SELECT source_id FROM (SELECT source_id, arg_max(imported, (checked_at, cycle_id)) AS imported, arg_max(success, (checked_at, cycle_id)) AS success FROM fx_run GROUP BY 1) r JOIN fx_source s USING (source_id) WHERE success AND imported >= min_imported"
REPEATED_SQL = "SELECT program_id, program_id // 64 AS grp, CASE WHEN program_id % 11 = 0 THEN '' ELSE concat('a', program_id // 64, '-', program_id * 7 % 13) END AS ident, CASE WHEN program_id % 13 = 0 THEN NULL ELSE concat('https://s', program_id // 64, '.example.org/', program_id * 5 % 11) END AS page FROM fx_program"


@query(f"""SELECT unnest(list_reduce(list_prepend({{'ids': ['']::VARCHAR[], 'pages': ['']::VARCHAR[], 'kept': []::BIGINT[]}}, rows), (x, z) -> CASE WHEN (len(z.ids[1]) > 0 AND list_contains(x.ids, z.ids[1])) OR (len(z.pages[1]) > 0 AND list_contains(x.pages, z.pages[1])) THEN x ELSE {{'ids': list_concat(x.ids, z.ids), 'pages': list_concat(x.pages, z.pages), 'kept': list_concat(x.kept, z.kept)}} END).kept) AS program_id
FROM (SELECT grp, list({{'ids': [coalesce(ident, '')], 'pages': [coalesce(page, '')], 'kept': [program_id::BIGINT]}} ORDER BY program_id) AS rows FROM ({REPEATED_SQL}) GROUP BY grp)""".replace("(x, z) ->", "lambda x, z:"))
def e4_first_of_either(t):
    n = F.col("program_id")
    group = F.floor(n / 64).cast("string")
    ident = F.when(n % 11 == 0, "").otherwise(F.concat(F.lit("a"), group, F.lit("-"), (n * 7 % 13).cast("string")))
    page = F.when(n % 13 != 0, F.concat(F.lit("https://s"), group, F.lit(".example.org/"), (n * 5 % 11).cast("string")))
    return G.first_of_either(t("fx_program").select("program_id", ident.alias("ident"), page.alias("page")), ["ident", "page"], ["program_id"]).select("program_id")


SCALARS = ["objective", "beneficiaries", "eligible_expenses", "excluded_expenses", "prerequisites", "selection_criteria", "disbursement_terms", "repayment_terms", "state_aid_rules", "application_process", "contact", "closing_date", "final_closing_date", "opening_date", "programme", "operator", "minimum_project_cost", "maximum_project_cost"]
FROM_EQUAL = ["aid_rate", "aid_amount", "aid_split", "permanent"]
UNIONS = ["company_categories", "themes", "regions", "aid_types", "projects_expected", "deadlines", "attention_points", "cdc_links", "source_links", "regulation_links", "form_links", "funder", "source_aliases"]
RECORD_COLUMNS = [
    *[f"CASE (seq * 7 + {i} * 5 + q) % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('{c} ', CAST(q AS VARCHAR(9))) END AS {c}" for i, c in enumerate(SCALARS)],
    *[f"CASE WHEN (seq + {i} + q) % 3 > 0 THEN concat('{c} ', CAST(q AS VARCHAR(9))) END AS {c}" for i, c in enumerate(FROM_EQUAL)],
    *[f"CASE WHEN (seq + {i} + q) % 4 > 0 THEN concat('x', CAST(q % 3 AS VARCHAR(9)), '|', CASE WHEN q % 5 = 0 THEN '' ELSE '{c}' END, '|x', CAST((q + {i}) % 3 AS VARCHAR(9))) END AS {c}" for i, c in enumerate(UNIONS)],
    "CASE (seq + q) % 5 WHEN 0 THEN 'Page introuvable' WHEN 1 THEN NULL WHEN 2 THEN 'abc' ELSE concat('Dispositif ', CAST(q AS VARCHAR(9))) END AS title",
    "CASE (seq * 5 + q) % 7 WHEN 0 THEN NULL WHEN 1 THEN concat(source_url, '.pdf') WHEN 2 THEN 'https://x.example.org/aides/' WHEN 3 THEN 'ftp://x.example.org/' WHEN 4 THEN concat(source_url, '.PDF?v=1') ELSE source_url END AS official_page",
    "CASE q % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'STALE' WHEN 2 THEN 'ARCHIVE' WHEN 3 THEN 'DRAFT' END AS lifecycle",
    "CASE WHEN q % 3 > 0 THEN CAST(checked_on AS VARCHAR(10)) END AS last_seen",
]
RECORDS_SQL = f"SELECT program_id, seq, source_url, checked_on, evidence_text, tier, {', '.join(RECORD_COLUMNS)} FROM (SELECT *, CAST(substring(evidence_text, 7) AS INT) AS q FROM fx_evidence)"
NOTHING = f"(length({NORM.format(c='title')}) < 4 OR regexp_matches({NORM.format(c='title')}, '{G.NO_TITLE}'))"
IS_DOC = "coalesce(regexp_matches(official_page, '(?i)[.](pdf|docx?|xlsx?)($|[?])'), false)"
WORTH = f"CASE WHEN {IS_DOC} THEN 0 ELSE 10 END + CASE WHEN NOT regexp_matches(official_page, '(?i)^https?:') THEN 0 WHEN regexp_replace(regexp_extract(official_page, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') IN ('', '/aides') THEN 1 WHEN {IS_DOC} THEN 2 ELSE 3 END"


@query(f"""WITH r AS (SELECT *, {RANK} AS rk, row_number() OVER (PARTITION BY program_id ORDER BY seq, source_url, checked_on, evidence_text, tier) AS rn FROM ({RECORDS_SQL})),
o AS (SELECT *, max(rk) OVER w AS most, max((NOT {NOTHING})::INT) OVER w AS named, {', '.join(f"count(nullif({c}, '')) OVER w AS had_{c}" for c in SCALARS)} FROM r WINDOW w AS (PARTITION BY program_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT program_id, field, value, min(rn * 100 + pos) AS place FROM (SELECT program_id, rn, e.f AS field, unnest(string_split(e.v, '|')) AS value, generate_subscripts(string_split(e.v, '|'), 1) AS pos FROM (SELECT program_id, rn, unnest([{', '.join(f"{{'f': '{c}', 'v': {c}}}" for c in UNIONS)}]) AS e FROM r)) WHERE value <> '' GROUP BY ALL),
v AS (SELECT program_id, {', '.join(f"string_agg(value, '|' ORDER BY place) FILTER (field = '{c}') AS {c}" for c in UNIONS)} FROM u GROUP BY 1)
SELECT o.program_id, {', '.join(f"coalesce(arg_max({c}, rn) FILTER ({c} <> '' AND (had_{c} = 0 OR rk > most)), first({c} ORDER BY rn)) AS {c}" for c in SCALARS)},
 {', '.join(f"arg_max({c}, rn) FILTER (most IS NULL OR ({c} IS NOT NULL AND rk >= most)) AS {c}" for c in FROM_EQUAL)},
 {', '.join(f"CASE WHEN count(*) = 1 THEN first(o.{c}) ELSE coalesce(first(v.{c}), '') END AS {c}" for c in UNIONS)},
 coalesce(arg_max(title, rn) FILTER (NOT {NOTHING} AND (coalesce(named, 0) = 0 OR (NOT {IS_DOC} AND rk > most))), first(title ORDER BY rn)) AS title,
 arg_max(official_page, ({WORTH}) * 1000 - rn) AS official_page,
 CASE WHEN bool_or(lifecycle = 'ACTIVE') THEN 'ACTIVE' WHEN bool_or(lifecycle = 'STALE') THEN 'STALE' WHEN bool_or(lifecycle = 'ARCHIVE') THEN 'ARCHIVE' ELSE first(lifecycle ORDER BY rn) END AS lifecycle,
 arg_max(last_seen, rn) AS last_seen, arg_max(tier, rk * 1000 - rn) AS tier, max(rk)::INTEGER AS tier_rank, count(*) AS records FROM o LEFT JOIN v USING (program_id) GROUP BY 1""")
def e7_whole_fold(t):
    order = ["seq", "source_url", "checked_on", "evidence_text", "tier"]
    # Dealt and sorted while rows are narrow; the many columns are made behind that.
    rows = t("fx_evidence").select("program_id", *order).repartition("program_id").sortWithinPartitions("program_id", *order)
    rows = rows.withColumn("q", F.expr("CAST(substring(evidence_text, 7) AS INT)")).selectExpr("*", *RECORD_COLUMNS)
    for c in UNIONS:
        rows = rows.withColumn(c, F.split(c, r"\|"))
    merged = G.fold_records(rows, ["program_id"], order, C.tier_rank(F.col("tier")), CATALOGUE_PATHS, SCALARS, FROM_EQUAL, UNIONS)
    return merged.select(*[F.array_join(c, "|").alias(c) if c in UNIONS else c for c in merged.columns])


UPSERT_SQL = "SELECT program_id, title, official_page, lifecycle, closing_date, min_cost, max_cost, repayment_terms, company_categories FROM {n}"
NEWER = "CASE WHEN a.program_id IS NULL OR a.{c} IS NULL THEN b.{c} WHEN b.{c} IS NULL OR a.program_id % 3 = 0 THEN a.{c} ELSE b.{c} END AS {c}"


@query(f"""WITH ok AS ({PASSED} AND strategy <> 'control-only'), a AS (SELECT * FROM ({UPSERT_SQL.format(n='fx_after')}) WHERE program_id % 50 IN (SELECT source_id FROM ok)), b AS ({UPSERT_SQL.format(n='fx_before')})
SELECT coalesce(a.program_id, b.program_id) AS program_id, coalesce(b.title, a.title) AS title, coalesce(b.official_page, a.official_page) AS official_page, CASE WHEN a.program_id IS NOT NULL THEN 'ACTIVE' ELSE b.lifecycle END AS lifecycle,
 {', '.join(NEWER.format(c=c) for c in ('closing_date', 'min_cost', 'max_cost', 'repayment_terms'))},
 array_to_string(list_concat(coalesce(string_split(b.company_categories, '|'), []), list_filter(coalesce(string_split(a.company_categories, '|'), []), x -> NOT list_contains(coalesce(string_split(b.company_categories, '|'), []), x))), '|') AS company_categories, a.program_id IS NOT NULL AS seen
FROM b FULL JOIN a ON a.program_id = b.program_id""")
def e11_upsert_fold(t):
    n = F.col("program_id")
    side = lambda name, seq, tier: t(name).select(n, "title", "official_page", "lifecycle", "closing_date", "min_cost", "max_cost", "repayment_terms", F.split("company_categories", r"\|").alias("company_categories"), F.lit(seq).alias("seq"), tier.alias("tier"), F.lit(None).cast("string").alias("last_seen"))
    new = side("fx_after", 1, F.when(n % 3 == 0, "B").otherwise("C")).join(passed(t), n % 50 == F.col("source_id"), "left_semi")
    rows = side("fx_before", 0, F.lit("C")).unionByName(new)
    merged = G.fold_records(rows, ["program_id"], ["seq"], C.tier_rank(F.col("tier")), CATALOGUE_PATHS, ["closing_date", "min_cost", "max_cost", "repayment_terms"], [], ["company_categories"])
    merged = merged.join(new.select("program_id", F.lit(True).alias("seen")), "program_id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    categories = F.coalesce(F.array_join("company_categories", "|"), F.lit(""))
    return merged.select("program_id", "title", "official_page", F.when(F.col("seen"), "ACTIVE").otherwise(F.col("lifecycle")).alias("lifecycle"), "closing_date", "min_cost", "max_cost", "repayment_terms", categories.alias("company_categories"), "seen")


@query("""WITH b AS (SELECT cycle_id AS build_id, cycle_id + 3 AS cycle, checked_at AS generated_at FROM fx_run WHERE cycle_id % 40 = 0),
n AS (SELECT build_id, source_id, success, imported, row_number() OVER (PARTITION BY build_id, source_id ORDER BY CASE WHEN r.cycle_id = b.cycle THEN 0 ELSE 1 END, CASE WHEN r.cycle_id = b.cycle THEN 0 ELSE abs(epoch_us(r.checked_at) - epoch_us(b.generated_at)) END, r.cycle_id) AS rn
  FROM b JOIN fx_run r ON r.cycle_id = b.cycle OR abs(epoch_us(r.checked_at) - epoch_us(b.generated_at)) <= 6 * 3600 * 1000000::BIGINT)
SELECT build_id, count(*) AS fresh, count(*) FILTER (success) AS successful, sum(imported)::BIGINT AS imported FROM n WHERE rn = 1 GROUP BY 1""")
def f14_fresh_coverage(t):
    builds = t("fx_run").where("cycle_id % 40 = 0").select(F.col("cycle_id").alias("build_id"), (F.col("cycle_id") + 3).alias("cycle"), F.col("checked_at").alias("generated_at"))
    return N.fresh_coverage(builds, t("fx_run"), 6 * 3600)


OWNED_SQL = "SELECT program_id, title, program_id % 50 AS source_id, CASE WHEN program_id % 3 = 0 THEN [(program_id + 7) % 50, (program_id + 11) % 50] END AS aliases FROM fx_before"


@query(f"WITH safe AS ({PASSED} AND strategy <> 'control-only') SELECT program_id, title FROM ({OWNED_SQL}) WHERE (source_id IN (SELECT source_id FROM safe) OR list_has_any(coalesce(aliases, []), (SELECT list(source_id) FROM safe))) AND program_id NOT IN (SELECT program_id FROM fx_after)")
def e12_owned_stale(t):
    n = F.col("program_id")
    before = t("fx_before").select(n, "title", (n % 50).alias("source_id"), F.when(n % 3 == 0, F.array((n + 7) % 50, (n + 11) % 50)).alias("aliases"))
    return G.stale_by_owner(before, t("fx_after"), passed(t), "program_id", "source_id", "aliases").select("program_id", "title")


@query("SELECT program_id, coalesce(arg_min(evidence_text, (seq, source_url, evidence_text)) FILTER (tier = 'A'), arg_min(evidence_text, (seq, source_url, evidence_text)) FILTER (tier = 'B'), any_value(title)) AS value, count(*) FILTER (tier IN ('A', 'B')) + 1 AS records FROM fx_program LEFT JOIN fx_evidence USING (program_id) GROUP BY 1")
def e8_enrichment(t):
    base = t("fx_program").select("program_id", F.lit(0).alias("step"), F.lit(0).alias("seq"), F.lit("").alias("source_url"), F.lit("C").alias("tier"), F.col("title").alias("value"))
    found = t("fx_evidence").where("tier IN ('A', 'B')").join(base.select("program_id"), "program_id", "left_semi")
    found = found.select("program_id", F.when(F.col("tier") == "B", 1).otherwise(2).alias("step"), "seq", "source_url", "tier", F.col("evidence_text").alias("value"))
    merged = C.survivorship(base.union(found).withColumn("tie", F.col("value")), ["program_id"], ["step", "seq", "source_url", "tie"], C.tier_rank(F.col("tier")), ["value"])
    return merged.select("program_id", "value", "records")


SIDES = "SELECT program_id, CAST(program_id % 50 AS INT) AS source_id, lifecycle, closing_date FROM {n}"


def passed(t):
    bad = A.certificate_problems(t("fx_source"), t("fx_run")).where("problem IN ('MISSING_RUN', 'FAILED_RUN', 'IMPORTS_BELOW_MINIMUM')")
    return t("fx_source").where("strategy <> 'control-only'").join(bad, "source_id", "left_anti").select("source_id")


@query(f"WITH ok AS ({PASSED} AND strategy <> 'control-only'), a AS (SELECT * FROM ({SIDES.format(n='fx_after')}) WHERE source_id IN (SELECT source_id FROM ok)), b AS ({SIDES.format(n='fx_before')}) SELECT coalesce(a.program_id, b.program_id) AS program_id, coalesce(a.source_id, b.source_id) AS source_id, coalesce(a.lifecycle, b.lifecycle) AS lifecycle, coalesce(a.closing_date, b.closing_date) AS closing_date, a.program_id IS NOT NULL AS seen FROM b FULL JOIN a ON a.program_id = b.program_id")
def e11_apply_snapshot(t):
    side = lambda n: t(n).select("program_id", (F.col("program_id") % 50).cast("int").alias("source_id"), "lifecycle", "closing_date")
    return A.apply_snapshot(side("fx_before"), side("fx_after"), passed(t), "program_id", "source_id", ["lifecycle", "closing_date"])


@query(f"SELECT source_id, count(*) AS n, count(*) FILTER (reason = 'INACTIVE_OR_STALE') AS lifecycle_excluded, count(*) FILTER (reason <> 'INACTIVE_OR_STALE') AS gate_excluded, count(*) FILTER (reason IS NULL) AS retained, CASE WHEN count(*) FILTER (reason IS NULL) >= 0.02 * count(*) THEN 'APPLY' ELSE 'RESTORE' END AS decision FROM ({REASON_SQL}) GROUP BY 1")
def e18_source_gate(t):
    return A.gate_by_source(reasons(t), 0.02)


@query(f"SELECT count(*) AS total, count(*) FILTER (d) AS direct, count(*) FILTER (d AND s) AS known, count(*) FILTER (d AND s AND g) AS target, count(*) FILTER (d AND s AND g AND reason IS NULL) AS kept FROM (SELECT lifecycle <> 'ARCHIVE' AS d, p.source_id IN (SELECT source_id FROM fx_source WHERE strategy <> 'control-only') AS s, (kind LIKE '%AAP%' OR instrument IN {listed(C.TARGET)}) AS g, reason FROM fx_program p JOIN ({REASON_SQL}) r USING (program_id))")
def e20_stock_purge(t):
    known = t("fx_source").where("strategy <> 'control-only'").select("source_id", F.lit(True).alias("known"))
    rows = t("fx_program").join(reasons(t).select("program_id", "reason"), "program_id").join(known, "source_id", "left")
    d = F.col("lifecycle") != "ARCHIVE"
    s, g = d & F.col("known"), F.col("kind").contains("AAP") | F.col("instrument").isin(C.TARGET)
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(d).alias("direct"), F.count_if(s).alias("known"), F.count_if(s & g).alias("target"), F.count_if(s & g & F.col("reason").isNull()).alias("kept"))


# F: quality and audit


COMPLETE_FIELDS = ["objective", "beneficiaries", "projectsExpected", "eligibleExpenses", "prerequisites", "selectionCriteria", "financialTerms"]
COMPLETE_SQL = f"SELECT program_id, round(100.0 * ((title <> '')::INT + (company_categories IS NOT NULL)::INT + (instrument IS NOT NULL)::INT + (themes IS NOT NULL)::INT + (cdc_link IS NOT NULL)::INT + (disbursement_terms IS NOT NULL)::INT + (closing_date IS NOT NULL OR permanent)::INT + (instrument NOT IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') OR repayment_terms IS NOT NULL)::INT + coalesce(pieces >= 6, FALSE)::INT + len(coalesce(list_intersect(fields, [{', '.join(repr(f) for f in COMPLETE_FIELDS)}]), []))) / 16)::BIGINT AS completeness FROM fx_program LEFT JOIN (SELECT program_id, list(DISTINCT field) AS fields, count(*) AS pieces FROM fx_evidence GROUP BY 1) f USING (program_id)"


@query(COMPLETE_SQL)
def f2_completeness(t):
    return A.completeness(t("fx_program"), t("fx_evidence"), COMPLETE_FIELDS)


@query(f"SELECT program_id, rule FROM (SELECT program_id, unnest(list_filter([CASE WHEN length(title) < 14 THEN 'TITLE_LENGTH' END, CASE WHEN instrument NOT IN {listed(C.TARGET)} THEN 'INSTRUMENT_ENUM' END, CASE WHEN NOT regexp_matches(official_page, '^https://[^/]+/p/[0-9]+$') THEN 'PAGE_FORMAT' END, CASE WHEN min_cost > 300000 THEN 'COST_RANGE' END], x -> x IS NOT NULL)) AS rule FROM fx_program)")
def f6_schema_errors(t):
    rules = [("TITLE_LENGTH", F.length("title") < 14), ("INSTRUMENT_ENUM", ~F.col("instrument").isin(C.TARGET)), ("PAGE_FORMAT", ~F.col("official_page").rlike("^https://[^/]+/p/[0-9]+$")), ("COST_RANGE", F.col("min_cost") > 300000)]
    return A.rule_hits(t("fx_program"), "program_id", rules)


@query("WITH e AS (SELECT program_id, field, bool_or(tier IN ('A', 'B')) AS p FROM fx_evidence GROUP BY 1, 2), j AS (SELECT * FROM e JOIN fx_program USING (program_id)) SELECT facet, value, field, count(*) AS present, count(*) FILTER (p) AS proven FROM (SELECT field, p, 'all' AS facet, '' AS value FROM j UNION ALL SELECT field, p, 'kind', kind FROM j UNION ALL SELECT field, p, 'instrument', instrument FROM j) GROUP BY ALL")
def f7_criteria_audit(t):
    return A.criteria_audit(t("fx_program"), t("fx_evidence"), ["kind", "instrument"])


QA_SQL = """WITH f AS (SELECT program_id, list(DISTINCT field) AS fields, list(DISTINCT field) FILTER (tier IN ('A', 'B')) AS proven, bool_or(tier = 'A') AS document FROM fx_evidence GROUP BY 1),
k AS (SELECT p.*, proven, document, (title = '')::INT + (official_page IS NULL)::INT + (NOT h('objective'))::INT + (NOT h('beneficiaries'))::INT + (instrument IS NULL)::INT + (closing_date IS NULL AND NOT permanent)::INT + (NOT h('eligibleExpenses'))::INT + (NOT h('prerequisites'))::INT + (NOT h('selectionCriteria'))::INT + coalesce((opening_date > closing_date)::INT, 0) + (NOT h('financialTerms'))::INT + (cdc_link IS NULL)::INT + (company_categories IS NULL)::INT + (disbursement_terms IS NULL)::INT + (instrument IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') AND repayment_terms IS NULL)::INT AS n_flags FROM fx_program p LEFT JOIN f USING (program_id))
""".replace("h('", "coalesce(list_contains(fields, '").replace("'))::", "'), FALSE))::")


@query(QA_SQL + f"SELECT program_id, (10 * len(m) + n_flags + CASE WHEN coalesce(document, FALSE) THEN 0 ELSE 5 END)::BIGINT AS severity, array_to_string(m, '|') AS missing FROM (SELECT *, list_filter([{', '.join(repr(f) for f in C.CRITICAL)}], x -> NOT list_contains(coalesce(proven, []), x)) AS m FROM k) ORDER BY severity DESC, title, program_id LIMIT 250")
def f9_remediation_queue(t):
    return A.remediation(t("fx_program"), t("fx_evidence"), C.CRITICAL, 250)


def deep_rules():
    ended = F.col("closing_date") < F.date_sub(day(), 60)
    return [("FORBIDDEN_URL", A.host(F.col("official_page")).isin(FORBIDDEN)), ("OFF_TARGET", ~F.col("instrument").isin(C.TARGET)), ("INACTIVE", F.col("lifecycle") != "ACTIVE"), ("EXPIRED_BUT_ACTIVE", (F.col("lifecycle") == "ACTIVE") & ended), ("DATE_INVERSION", F.col("opening_date") > F.col("closing_date")), ("NO_COST", F.col("min_cost").isNull())]


DEEP_SQL = f"SELECT program_id, unnest(list_filter([CASE WHEN {HOST.format(c='official_page')} IN {listed(FORBIDDEN)} THEN 'FORBIDDEN_URL' END, CASE WHEN instrument NOT IN {listed(C.TARGET)} THEN 'OFF_TARGET' END, CASE WHEN lifecycle <> 'ACTIVE' THEN 'INACTIVE' END, CASE WHEN lifecycle = 'ACTIVE' AND closing_date < {DAY} - 60 THEN 'EXPIRED_BUT_ACTIVE' END, CASE WHEN opening_date > closing_date THEN 'DATE_INVERSION' END, CASE WHEN min_cost IS NULL THEN 'NO_COST' END], x -> x IS NOT NULL)) AS rule FROM fx_program"


@query(f"SELECT rule, count(*) AS n, array_to_string(list_sort(list(program_id))[1:20], ',') AS samples FROM ({DEEP_SQL}) GROUP BY 1")
def f10_deep_audit(t):
    found = A.counted_samples(A.rule_hits(t("fx_program"), "program_id", deep_rules()), "rule", "program_id")
    return found.select("rule", "n", F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples"))


SEVERITY = {"FORBIDDEN_URL": "P0", "EXPIRED_BUT_ACTIVE": "P0", "DATE_INVERSION": "P0", "OFF_TARGET": "P1", "INACTIVE": "P1", "NO_COST": "P2"}


@query(f"SELECT severity, count(*) AS findings, count(DISTINCT rule) AS rules FROM (SELECT rule, CASE rule {' '.join(f'''WHEN '{r}' THEN '{s}' ''' for r, s in SEVERITY.items())} END AS severity FROM ({DEEP_SQL})) GROUP BY 1")
def f12_severity(t):
    severity = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    per = A.rule_hits(t("fx_program"), "program_id", deep_rules()).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(severity[F.col("rule")].alias("severity")).agg(F.sum("n").alias("findings"), F.count(F.lit(1)).alias("rules"))


@query("WITH l AS (SELECT user_id, max(ts) FILTER (event_type <> 'error') AS seen_at FROM events GROUP BY 1) SELECT user_id, date_diff('second', seen_at, TIMESTAMP '2024-02-01') // 3600 AS age_hours, CASE WHEN seen_at IS NULL THEN 'MISSING' WHEN date_diff('second', seen_at, TIMESTAMP '2024-02-01') // 3600 > 72 THEN 'STALE' ELSE 'FRESH' END AS state FROM l")
def f13_certificate_freshness(t):
    last = t("events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") != "error", F.col("ts"))).alias("seen_at"))
    seconds = F.unix_timestamp(F.lit("2024-02-01").cast("timestamp")) - F.floor(F.unix_micros(F.col("seen_at").cast("timestamp")) / 1e6)
    age = F.floor(seconds / 3600)
    return last.select("user_id", age.alias("age_hours"), F.when(F.col("seen_at").isNull(), "MISSING").when(age > 72, "STALE").otherwise("FRESH").alias("state"))


@query(f"SELECT p.program_id FROM fx_program p WHERE lifecycle = 'ACTIVE' AND program_id NOT IN (SELECT program_id FROM fx_evidence WHERE tier IN ('A', 'B') AND starts_with(source_url, 'https://') AND {HOST.format(c='source_url')} NOT IN {listed(FORBIDDEN)})")
def f16_link_audit(t):
    usable = t("fx_evidence").where(F.col("tier").isin(A.PROVEN) & F.col("source_url").startswith("https://") & ~A.host(F.col("source_url")).isin(FORBIDDEN))
    return t("fx_program").where("lifecycle = 'ACTIVE'").join(usable.select("program_id"), "program_id", "left_anti").select("program_id")


MESSAGES = {"MISSING_DEADLINE": "Date limite à vérifier", "MISSING_FINANCIAL_TERMS": "Montants à vérifier", "MISSING_OBJECTIVE": "Objectif à préciser"}


@query("SELECT p.program_id, concat_ws('|', CASE WHEN NOT coalesce(list_contains(fields, 'objective'), FALSE) THEN 'Objectif à préciser' END, CASE WHEN closing_date IS NULL AND NOT permanent THEN 'Date limite à vérifier' END, CASE WHEN NOT coalesce(list_contains(fields, 'financialTerms'), FALSE) THEN 'Montants à vérifier' END) AS points FROM fx_program p LEFT JOIN (SELECT program_id, list(DISTINCT field) AS fields FROM fx_evidence GROUP BY 1) USING (program_id)")
def f17_attention_points(t):
    message = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    said = F.array_compact(F.transform(F.split("flags", r"\|"), lambda f: F.try_element_at(message, f)))
    return C.qa_flags(t("fx_program"), t("fx_evidence")).select("program_id", F.array_join(F.array_distinct(said), "|").alias("points"))


@query(f"SELECT *, fresh AND certified AND evidence AND no_p0 AS passed FROM (SELECT (SELECT count(*) FROM fx_run WHERE success) > 0 AS fresh, (SELECT count(*) FROM ({REASON_SQL}) WHERE reason IS NULL) > 0 AS certified, (SELECT count(*) FROM fx_evidence WHERE evidence_text IS NULL) = 0 AS evidence, (SELECT count(*) FROM ({DEEP_SQL}) WHERE rule IN ('FORBIDDEN_URL', 'EXPIRED_BUT_ACTIVE', 'DATE_INVERSION')) = 0 AS no_p0)")
def f19_data_gates(t):
    severe = A.rule_hits(t("fx_program"), "program_id", deep_rules()).where(F.col("rule").isin([r for r, s in SEVERITY.items() if s == "P0"]))
    gates = [t("fx_run").agg((F.count_if("success") > 0).alias("fresh")), reasons(t).agg((F.count_if(F.col("reason").isNull()) > 0).alias("certified")), t("fx_evidence").agg((F.count_if(F.col("evidence_text").isNull()) == 0).alias("evidence")), severe.agg((F.count(F.lit(1)) == 0).alias("no_p0"))]
    out = gates[0]
    for g in gates[1:]:
        out = out.crossJoin(g)  # one row each
    return out.withColumn("passed", F.col("fresh") & F.col("certified") & F.col("evidence") & F.col("no_p0"))


# G: evidence and certification


@query("SELECT program_id, bool_or(field IN ('beneficiaries', 'prerequisites') OR regexp_matches(evidence_text, '[05]$')) AS enterprise FROM fx_evidence WHERE tier IN ('A', 'B') AND field IN ('beneficiaries', 'prerequisites', 'objective', 'eligibleExpenses') AND regexp_matches(evidence_text, '(?i)value [1-3]') GROUP BY 1")
def g2_enterprise_evidence(t):
    strong = F.col("field").isin("beneficiaries", "prerequisites")
    e = t("fx_evidence").where(F.col("tier").isin(A.PROVEN) & (strong | F.col("field").isin("objective", "eligibleExpenses")) & F.col("evidence_text").rlike("(?i)value [1-3]"))
    return e.groupBy("program_id").agg(F.bool_or(strong | F.col("evidence_text").rlike("[05]$")).alias("enterprise"))


CONFIG_COLS = ["source_id", "name", "strategy", "min_expected", "min_imported"]
CONFIG_ROW = "concat_ws(chr(1), CAST(source_id AS VARCHAR), name, strategy, CAST(min_expected AS VARCHAR), CAST(min_imported AS VARCHAR))"


@query(f"SELECT strategy, count(*) AS n, CAST(sum(('0x' || substring(sha256({CONFIG_ROW}), 1, 15))::HUGEINT) AS VARCHAR) AS digest FROM fx_source GROUP BY 1")
def g7_config_fingerprint(t):
    return C.partition_digest(t("fx_source"), "strategy", CONFIG_COLS)


PROBLEM_SQL = """WITH l AS (SELECT source_id, arg_max(success, (checked_at, cycle_id)) AS success, arg_max(discovered, (checked_at, cycle_id)) AS discovered, arg_max(imported, (checked_at, cycle_id)) AS imported, true AS ran FROM fx_run GROUP BY 1)
SELECT source_id, problem FROM (SELECT source_id, unnest(list_filter([CASE WHEN ran IS NULL THEN 'MISSING_RUN' END, CASE WHEN NOT success THEN 'FAILED_RUN' END, CASE WHEN imported < min_imported THEN 'IMPORTS_BELOW_MINIMUM' END, CASE WHEN success AND imported < discovered THEN 'UNEXPLAINED_PAGES' END], x -> x IS NOT NULL)) AS problem FROM fx_source s LEFT JOIN l USING (source_id) WHERE strategy <> 'control-only')"""


@query(PROBLEM_SQL)
def g10_source_problems(t):
    return A.certificate_problems(t("fx_source"), t("fx_run"))


@query(f"SELECT program_id, problem FROM (SELECT program_id, unnest(list_filter([CASE WHEN length(title) < 14 THEN 'GENERIC_TITLE' END, CASE WHEN instrument NOT IN {listed(C.TARGET)} THEN 'INSTRUMENT_NOT_ALLOWED' END, CASE WHEN {HOST.format(c='official_page')} <> 's' || source_id || '.example.org' THEN 'FOREIGN_HOST' END, CASE WHEN reason IS NOT NULL THEN 'NOT_READY:' || reason END], x -> x IS NOT NULL)) AS problem FROM fx_program p JOIN (SELECT program_id, reason FROM ({REASON_SQL})) r USING (program_id))")
def g11_record_problems(t):
    rows = t("fx_program").join(reasons(t).select("program_id", "reason"), "program_id")
    own = F.concat(F.lit("s"), F.col("source_id").cast("string"), F.lit(".example.org"))
    found = F.concat(C.flags(("GENERIC_TITLE", F.length("title") < 14), ("INSTRUMENT_NOT_ALLOWED", ~F.col("instrument").isin(C.TARGET)), ("FOREIGN_HOST", A.host(F.col("official_page")) != own)), F.array_compact(F.array(F.concat(F.lit("NOT_READY:"), "reason"))))
    return rows.select("program_id", F.explode(found).alias("problem"))


@query(f"SELECT {HOST.format(c='url')} AS host, count(*) AS pages, count(DISTINCT {DEDUPE_URL}) AS urls, count(*) - count(DISTINCT {DEDUPE_URL}) AS duplicates FROM pages GROUP BY 1")
def g12_corpus_checks(t):
    p = t("pages").select(A.host(F.col("url")).alias("host"), T.dedupe_url(F.col("url")).alias("u")).groupBy("host", "u").agg(F.count(F.lit(1)).alias("n"))
    return p.groupBy("host").agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("urls"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


def fingerprints(t, rows):
    config = t("fx_source").select("source_id", F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in CONFIG_COLS]), 256).alias("config"))
    data = C.partition_digest(rows.withColumn("source_id", (F.col("program_id") % 50).cast("long")), "source_id", ["program_id", "title", "lifecycle"]).select("source_id", F.col("digest").alias("data"))
    return config, data


DATA_SQL = "SELECT program_id % 50 AS source_id, CAST(sum(" + ROW_HASH.format(c="CAST(program_id AS VARCHAR), title, lifecycle") + ") AS VARCHAR) AS data FROM {n} GROUP BY 1"
CERT_SQL = f"SELECT s.source_id, coalesce(n, 0) AS problems, CASE WHEN n IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, sha256({CONFIG_ROW.replace('source_id', 's.source_id')}) AS config, data FROM fx_source s LEFT JOIN (SELECT source_id, count(*) AS n FROM ({PROBLEM_SQL}) GROUP BY 1) p ON p.source_id = s.source_id LEFT JOIN ({DATA_SQL}) d ON d.source_id = s.source_id"


@query(CERT_SQL.format(n="fx_before"))
def g13_certificates(t):
    return A.certificates(t("fx_source"), A.certificate_problems(t("fx_source"), t("fx_run")), *fingerprints(t, t("fx_before")))


@query(f"WITH c AS ({CERT_SQL.format(n='fx_before')}), d AS ({DATA_SQL.format(n='fx_after')}) SELECT c.source_id, CASE WHEN status <> 'PASS' THEN 'NOT_PASSED' WHEN c.data IS NULL THEN 'MISSING_FINGERPRINT' WHEN c.data IS DISTINCT FROM d.data THEN 'DATA_CHANGED' END AS reason FROM c LEFT JOIN d ON c.source_id = d.source_id")
def g14_ledger(t):
    certs = A.certificates(t("fx_source"), A.certificate_problems(t("fx_source"), t("fx_run")), *fingerprints(t, t("fx_before"))).withColumn("issued_at", F.lit(AS_OF))
    config, data = fingerprints(t, t("fx_after"))
    return A.ledger(certs, config.join(data, "source_id", "left"))


@query("WITH k AS (SELECT scope, list_sort(list(DISTINCT source_id)) AS ids, list_sort(list(DISTINCT source_id) FILTER (source_id IN (SELECT source_id FROM fx_run WHERE success))) AS active FROM fx_source GROUP BY 1) SELECT scope, len(ids)::BIGINT AS sources, coalesce(ids = active, FALSE) AS matches FROM k")
def g15_certificate_match(t):
    ran = t("fx_run").where("success").select("source_id").distinct().withColumn("ran", F.lit(True))
    k = t("fx_source").join(ran, "source_id", "left").groupBy("scope").agg(F.array_sort(F.collect_set("source_id")).alias("ids"), F.array_sort(F.collect_set(F.when(F.col("ran"), F.col("source_id")))).alias("active"))
    return k.select("scope", F.size("ids").cast("long").alias("sources"), (F.col("ids") == F.col("active")).alias("matches"))


# H: change feeds


CHANGE_SQL = "SELECT * FROM (SELECT coalesce(a.program_id, b.program_id) AS program_id, CASE WHEN b.program_id IS NULL THEN 'CREATION' WHEN a.program_id IS NULL THEN 'SORTIE_PERIMETRE' WHEN " + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in FIELDS) + " THEN 'MODIFICATION' END AS type, CASE WHEN a.program_id IS NULL OR b.program_id IS NULL THEN '' ELSE concat_ws('|', " + ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in FIELDS) + ") END AS fields FROM fx_before b FULL JOIN fx_after a ON a.program_id = b.program_id) JOIN (SELECT program_id, opening_date AS changed_on FROM fx_program) USING (program_id) WHERE type IS NOT NULL"


def dated_changes(t):
    return C.changes(t("fx_before"), t("fx_after"), "program_id", FIELDS).join(t("fx_program").select("program_id", F.col("opening_date").alias("changed_on")), "program_id")


@query(f"SELECT program_id, type, changed_on FROM (SELECT * FROM ({CHANGE_SQL}) ORDER BY changed_on DESC, program_id LIMIT 1200) WHERE program_id IN (SELECT program_id FROM fx_after)")
def h3_change_log(t):
    last = dated_changes(t).orderBy(F.desc("changed_on"), "program_id").limit(1200)
    return last.join(t("fx_after").select("program_id"), "program_id", "left_semi").select("program_id", "type", "changed_on")


@query(f"SELECT program_id, type, fields, changed_on FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY changed_on DESC, program_id) AS r FROM ({CHANGE_SQL}) WHERE type <> 'MODIFICATION' OR contains(fields, 'closing_date')) WHERE r <= CASE type WHEN 'CREATION' THEN 40 WHEN 'MODIFICATION' THEN 30 ELSE 20 END")
def h4_watch_feed(t):
    return A.watch_feed(dated_changes(t), ["closing_date"], {"CREATION": 40, "MODIFICATION": 30, "SORTIE_PERIMETRE": 20}).select("program_id", "type", "fields", "changed_on")


BUSINESS = ["title", "closing_date", "min_cost", "max_cost", "opening_date", "permanent", "scope", "region", "instrument", "company_categories", "cdc_link", "disbursement_terms", "repayment_terms"]
FEED_TITLE = "CASE WHEN program_id % 4 = 0 THEN concat('  PROGRAMME ', CAST(program_id - program_id % 10 + 2 AS VARCHAR(20))) ELSE concat('Programme ', CAST(program_id AS VARCHAR(20))) END"


@query(f"""WITH f AS (SELECT program_id, type, fields, changed_on, {FEED_TITLE} AS title FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY changed_on DESC, program_id) AS r FROM ({CHANGE_SQL}) WHERE type <> 'MODIFICATION' OR list_has_any(string_split(fields, '|'), {BUSINESS})) WHERE r <= CASE type WHEN 'CREATION' THEN 40 WHEN 'MODIFICATION' THEN 30 ELSE 20 END),
p AS (SELECT {NORM.format(c='title')} AS name, min(program_id) AS other FROM fx_after GROUP BY 1)
SELECT f.program_id, type, fields, changed_on, coalesce(a.program_id, other) AS programme_id, CASE WHEN a.program_id IS NOT NULL THEN 'id' WHEN other IS NOT NULL THEN 'title' END AS by FROM f LEFT JOIN fx_after a ON a.program_id = f.program_id LEFT JOIN p ON a.program_id IS NULL AND p.name = {NORM.format(c='f.title')}""")
def h4_joined_feed(t):
    feed = A.watch_feed(dated_changes(t), BUSINESS, {"CREATION": 40, "MODIFICATION": 30, "SORTIE_PERIMETRE": 20})
    n = F.col("program_id")
    named = F.when(n % 4 == 0, F.concat(F.lit("  PROGRAMME "), (n - n % 10 + 2).cast("string"))).otherwise(F.concat(F.lit("Programme "), n.cast("string")))
    return A.joined_feed(feed.withColumn("title", named), t("fx_after"), "program_id", "title").select("program_id", "type", "fields", "changed_on", "programme_id", "by")


# L: reporting


@query(f"SELECT source_id, count(*) AS n, round(100.0 * count(*) FILTER (starts_with(official_page, 'https://')) / count(*), 6)::DOUBLE AS direct_share, round(100.0 * count(cdc_link) / count(*), 6)::DOUBLE AS document_share, round(100.0 * count(*) FILTER (permanent OR closing_date IS NOT NULL) / count(*), 6)::DOUBLE AS dated_share, round(100.0 * count(*) FILTER (completeness >= 80) / count(*), 6)::DOUBLE AS complete_share FROM fx_program LEFT JOIN ({COMPLETE_SQL}) USING (program_id) GROUP BY 1 ORDER BY n DESC, source_id LIMIT 8")
def l2_reporting(t):
    return C.reporting(t("fx_program"), A.completeness(t("fx_program"), t("fx_evidence"), COMPLETE_FIELDS))


# A14, E9: the published file, and the order of checks


# The columns of the published file.
PUBLISHED = "id titre type portee regions financeurs instruments beneficiaires assiette_min assiette_max aide_min aide_max taux_min taux_max cloture permanent page_officielle cdc statut_verification completude confiance".split()
CELLS = ["CAST(p.program_id AS VARCHAR)", "title", "kind", "p.scope", "region", "s.name", "instrument", "replace(company_categories, '|', ' | ')"] + [f"CAST(floor({c})::BIGINT AS VARCHAR)" for c in ("p.min_cost", "p.max_cost", "f.min_amount", "f.max_amount", "f.min_rate", "f.max_rate")] + ["CAST(closing_date AS VARCHAR)", "CASE WHEN permanent THEN 'oui' ELSE 'non' END", "official_page", "cdc_link", "CASE WHEN coalesce(v.verified, FALSE) THEN 'VERIFIE' ELSE 'A_REVERIFIER' END", "CAST(k.completeness AS VARCHAR)", "CAST(c.confidence AS VARCHAR)"]
CSV_FROM = f"fx_program p LEFT JOIN fx_source s ON s.source_id = p.source_id LEFT JOIN ({FINANCE_SQL}) f ON f.program_id = p.program_id LEFT JOIN ({VERIFIED_SQL}) v ON v.program_id = p.program_id LEFT JOIN ({COMPLETE_SQL}) k ON k.program_id = p.program_id LEFT JOIN ({CONFIDENCE_SQL}) c ON c.program_id = p.program_id"


@query("SELECT p.program_id, " + " || ',' || ".join(f"""'"' || coalesce({c}, '') || '"'""" for c in CELLS) + f" AS line FROM {CSV_FROM}")
def a14_csv_lines(t):
    whole = lambda *cs: [F.floor(c).cast("long") for c in cs]
    rows = t("fx_program").join(t("fx_source").select("source_id", "name"), "source_id", "left")
    finance = X.financial_terms(t("fx_terms"), "program_id").drop("min_cost", "max_cost")
    for side in (finance, C.verification(t("fx_program"), t("fx_evidence")).select("program_id", "status"), A.completeness(t("fx_program"), t("fx_evidence"), COMPLETE_FIELDS), C.confidence(C.evidence_coverage(t("fx_evidence")))):
        rows = rows.join(side, "program_id", "left")
    cells = ["program_id", "title", "kind", "scope", "region", "name", "instrument", F.split("company_categories", r"\|"), *whole("min_cost", "max_cost", "min_amount", "max_amount", "min_rate", "max_rate"), "closing_date", F.when(F.col("permanent"), "oui").otherwise("non"), "official_page", "cdc_link", "status", "completeness", "confidence"]
    named = rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(cells, PUBLISHED, strict=True)])
    return files.csv_lines(named, "id").withColumnRenamed("id", "program_id")


@query(f"SELECT p.program_id, k.completeness, e.checked_on FROM fx_program p LEFT JOIN ({VERIFIED_SQL}) v ON v.program_id = p.program_id LEFT JOIN ({COMPLETE_SQL}) k ON k.program_id = p.program_id LEFT JOIN (SELECT program_id, max(checked_on) AS checked_on FROM fx_evidence GROUP BY 1) e ON e.program_id = p.program_id ORDER BY coalesce(v.verified, FALSE), e.checked_on NULLS FIRST, k.completeness DESC, p.program_id LIMIT 80")
def e9_enrichment_priority(t):
    checked = t("fx_evidence").groupBy("program_id").agg(F.max("checked_on").alias("checked_on"))
    rows = C.verification(t("fx_program"), t("fx_evidence")).join(A.completeness(t("fx_program"), t("fx_evidence"), COMPLETE_FIELDS), "program_id", "left").join(checked, "program_id", "left")
    order = [F.when(F.col("status") == "VERIFIE", 1).otherwise(0), F.asc_nulls_first("checked_on"), F.desc("completeness"), "program_id"]
    return rows.orderBy(*order).limit(80).select("program_id", "completeness", "checked_on")


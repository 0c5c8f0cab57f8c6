"""Library search, matching and shortlists bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundsieve.fixtures import AS_OF
from fundsieve.functions import text as T
from fundsieve.operators import catalogue as C
from fundsieve.operators import extraction as X
from fundsieve.operators import matching as M
from fundsieve.operators import scoring as S
from fundsieve.operators import search as L
from fundsieve.plans.queries import CONCEPT_RULES, CONCEPTS, DAY, MATCHING, NORM, OVERLAP_SQL, TERMS, listed, query


def day():
    return F.lit(AS_OF).cast("date")


# J: library search


SINGULAR = "list_distinct(list_transform({w}, x -> CASE WHEN length(x) > 4 AND ends_with(x, 's') THEN left(x, length(x)::INT - 1) ELSE x END))"


@query(f"WITH q AS (SELECT item_id, {SINGULAR.format(w=TERMS.format(c='text'))} AS w FROM benchmark), d AS (SELECT doc_id, {SINGULAR.format(w=TERMS.format(c='text'))} AS w FROM documents) SELECT item_id, doc_id FROM q, d WHERE len(q.w) > 0 AND len(list_intersect(q.w, d.w)) = len(q.w)")
def j1_all_terms_search(t):
    return S.all_terms(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"))


NINE = ["title", "kind", "instrument", "scope", "region", "company_categories", "themes", "lifecycle", "funder"]
NINE_SQL = "SELECT *, CASE source_id % 3 WHEN 0 THEN 'Bpifrance' WHEN 1 THEN 'BPI  France' ELSE 'Région' END AS funder FROM fx_program"
ASKED_SQL = "SELECT company_id AS item_id, concat(region, ' les ', CASE WHEN company_id % 200 = 0 THEN 'bpi france ' ELSE '' END, lower(category), CASE WHEN company_id % 300 = 0 THEN ' programmes ' ELSE ' ' END, CAST(company_id % 97 AS VARCHAR(5))) AS text FROM fx_company WHERE company_id % 100 = 0"
RENAMED = "regexp_replace({c}, '\\bbpi france\\b', 'bpifrance', 'g')"


@query(f"""WITH d AS (SELECT program_id, {NORM.format(c="concat_ws(' ', " + ", ".join(NINE) + ")")} AS plain FROM ({NINE_SQL})), h AS (SELECT program_id, {RENAMED.format(c="plain")} || CASE WHEN contains(plain, 'bpifrance') THEN ' bpi' ELSE '' END AS held FROM d),
q AS (SELECT item_id, list_filter(string_split({RENAMED.format(c=NORM.format(c="text"))}, ' '), x -> length(x) > 1 AND x NOT IN ('de', 'du', 'des', 'aux', 'les', 'le', 'la', 'en', 'et')) AS terms FROM ({ASKED_SQL}))
SELECT item_id, program_id FROM q, h WHERE len(terms) > 0 AND len(list_filter(terms, x -> contains(held, x) OR (length(x) > 4 AND ends_with(x, 's') AND contains(held, left(x, length(x)::INT - 1))))) = len(terms)""")
def j1_substring_search(t):
    funder = F.when(F.col("source_id") % 3 == 0, "Bpifrance").when(F.col("source_id") % 3 == 1, "BPI  France").otherwise("Région")
    docs = t("fx_program").withColumn("funder", funder).withColumn("doc_id", F.col("program_id"))
    c = F.col("company_id")
    text = F.concat("region", F.lit(" les "), F.when(c % 200 == 0, "bpi france ").otherwise(""), F.lower("category"), F.when(c % 300 == 0, " programmes ").otherwise(" "), (c % 97).cast("string"))
    asked = t("fx_company").where(c % 100 == 0).select(c.alias("item_id"), text.alias("text"))
    found = L.contains_all(docs, asked, NINE, {"bpi france": "bpifrance"}, {"bpifrance": "bpi"})
    return found.select("item_id", F.col("doc_id").alias("program_id"))


OPEN_SQL = f"instrument IN {listed(C.TARGET)} AND (permanent OR closing_date IS NULL OR closing_date >= {DAY} - 60) AND length(title) >= 4"


@query(f"SELECT program_id, (lifecycle = 'ACTIVE' AND (permanent OR closing_date IS NULL OR closing_date > {DAY})) AS usable FROM fx_program WHERE {OPEN_SQL}")
def j2_library(t):
    p = t("fx_program").where(F.col("instrument").isin(C.TARGET) & (F.col("permanent") | F.col("closing_date").isNull() | (F.col("closing_date") >= F.date_sub(day(), 60))) & (F.length("title") >= 4))
    return p.select("program_id", C.recent_or_active(AS_OF).alias("usable"))


@query(f"SELECT program_id, hits, state, closing_date FROM (SELECT program_id, (contains(title, '1'))::INT + (contains(title, '7'))::INT AS hits, CASE WHEN closing_date IS NULL THEN 2 WHEN closing_date >= {DAY} THEN 0 WHEN closing_date >= {DAY} - 60 THEN 1 ELSE 3 END AS state, closing_date FROM fx_program) ORDER BY hits DESC, state, closing_date NULLS LAST, program_id LIMIT 50 OFFSET 50")
def j4_library_ranking(t):
    hits = F.col("title").contains("1").cast("int") + F.col("title").contains("7").cast("int")
    state = F.when(F.col("closing_date").isNull(), 2).when(F.col("closing_date") >= day(), 0).when(F.col("closing_date") >= F.date_sub(day(), 60), 1).otherwise(3)
    p = t("fx_program").select("program_id", hits.alias("hits"), state.alias("state"), "closing_date")
    return p.orderBy(F.desc("hits"), "state", F.asc_nulls_last("closing_date"), "program_id").offset(50).limit(50)


@query(f"""WITH a AS (SELECT * FROM fx_program WHERE lifecycle <> 'ARCHIVE' AND scope = 'NATIONAL' AND instrument = 'PRET' AND kind = 'AIDE' AND contains(company_categories, 'GE') AND contains(lower(concat_ws(' ', title, kind, instrument, scope, region, official_page)), 'europe'))
SELECT 'all' AS freshness, program_id FROM a UNION ALL SELECT 'next_day', program_id FROM a WHERE lifecycle = 'ACTIVE' AND (permanent OR closing_date IS NULL OR closing_date > {DAY}) UNION ALL SELECT 'missing', program_id FROM a WHERE NOT permanent AND closing_date IS NULL""")
def j6_public_page(t):
    shown = C.faceted(t("fx_program"), scope="NATIONAL", instrument="PRET", kind="AIDE", categories=["GE"])
    found = shown.where((F.col("lifecycle") != "ARCHIVE") & F.lower(F.to_json(F.struct("title", "kind", "instrument", "scope", "region", "official_page"))).contains("europe"))
    return C.by_freshness(found, AS_OF).select("freshness", "program_id")


COUNTERS = [("BPIFRANCE", r"//s[0-4]\."), ("ADEME", r"//s[5-9]\."), ("REGION", r"//s1[0-9]\.")]


@query("SELECT program_id, coalesce(nullif(concat_ws('|', " + ", ".join(f"CASE WHEN regexp_matches(official_page, '{p}') THEN '{n}' END" for n, p in COUNTERS) + ", CASE WHEN scope = 'NATIONAL' THEN 'ETAT' END), ''), 'AUTRE') AS labels FROM fx_program")
def j7_counter_labels(t):
    found = C.flags(*[(n, F.col("official_page").rlike(p)) for n, p in COUNTERS], ("ETAT", F.col("scope") == "NATIONAL"))
    return t("fx_program").select("program_id", F.coalesce(F.nullif(F.array_join(found, "|"), F.lit("")), F.lit("AUTRE")).alias("labels"))


@query("SELECT href, count(*) AS n, min(page_id) AS page_id, bool_or(regexp_matches(lower(href || ' ' || label), 'the|and|der')) AS document FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2)) AS label FROM pages) GROUP BY 1")
def j8_link_selection(t):
    a = X.anchors(t("pages"), ["page_id"], "html")
    return a.groupBy("href").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("page_id"), F.bool_or(F.lower(F.concat_ws(" ", "href", "label")).rlike("the|and|der")).alias("document"))


# K: matching


@query("SELECT company_id, concat_ws(' ', category, region, CAST(CAST(floor(budget) AS BIGINT) AS VARCHAR)) AS context, CASE WHEN category = 'PME' THEN 'batiment construction' WHEN category = 'ETI' THEN 'machine industrie' ELSE '' END AS activity FROM fx_company WHERE category <> 'À préciser'")
def k1_project_contexts(t):
    c = t("fx_company").where("category <> 'À préciser'")
    activity = F.when(F.col("category") == "PME", "batiment construction").when(F.col("category") == "ETI", "machine industrie").otherwise("")
    return c.select("company_id", F.concat_ws(" ", "category", "region", F.floor("budget").cast("string")).alias("context"), activity.alias("activity"))


DISTINCT_TERMS = "(SELECT list_transform(list_filter(list_zip(w, generate_series(1, len(w))), z -> list_position(w, z[1]) = z[2]), z -> z[1]) FROM (SELECT {w} AS w))"


@query(f"SELECT doc_id, len(w)::BIGINT AS tokens, md5(array_to_string(list_transform(generate_series(1, len(w) - 1), x -> w[x] || ' ' || w[x + 1]), '|')) AS bigrams FROM (SELECT doc_id, {DISTINCT_TERMS.format(w=TERMS.format(c='text'))} AS w FROM documents)")
def k2_bigrams(t):
    d = t("documents").select("doc_id", F.array_distinct(T.terms(F.col("text"))).alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("tokens"), F.md5(F.array_join(S.bigrams(F.col("w")), "|")).alias("bigrams"))


@query("SELECT doc_id, concept FROM (SELECT doc_id, unnest(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({MATCHING.format(c='text')}, '(^|[^a-z0-9])({p})($|[^a-z0-9])') THEN '{n}' END" for n, p in CONCEPTS) + "], x -> x IS NOT NULL)) AS concept FROM documents)")
def k3_concepts(t):
    m = T.matching_norm(F.col("text"))
    return t("documents").select("doc_id", F.explode(T.labels(m, [(n, f"(^|[^a-z0-9])({p})($|[^a-z0-9])") for n, p in CONCEPTS])).alias("concept"))


@query(f"SELECT program_id, CASE WHEN contains(n, 's1.') THEN 'BPIFRANCE' WHEN contains(n, 's2.') THEN 'ADEME' WHEN contains(n, 's3.') THEN 'EUROPE' WHEN contains(n, 's4.') THEN 'CHAMBRE' WHEN scope = 'REGIONAL' THEN 'REGIONAL' ELSE 'GENERAL' END AS family FROM (SELECT *, {NORM.format(c='official_page')} AS n FROM fx_program)")
def k6_funder_family(t):
    n = T.norm(F.col("official_page"))
    rules = [("BPIFRANCE", n.contains("s1.")), ("ADEME", n.contains("s2.")), ("EUROPE", n.contains("s3.")), ("CHAMBRE", n.contains("s4.")), ("REGIONAL", F.col("scope") == "REGIONAL")]
    return t("fx_program").select("program_id", X.first_case(rules, "GENERAL").alias("family"))


# The projects asked for (companies with an id divisible by 100) meet every programme of their territory.
PAIR_SQL = "SELECT c.company_id, c.category, c.budget, c.region AS company_region, p.* FROM fx_company c JOIN fx_program p ON p.scope = 'NATIONAL' OR c.region = p.region WHERE c.company_id % 100 = 0"
FITS_SQL = f"""SELECT *, 0.58::DOUBLE * territory + 0.42::DOUBLE * calendar AS access FROM (SELECT *, CASE WHEN permanent THEN 1.0 WHEN closing_date IS NULL THEN 0.55 WHEN closing_date >= {DAY} THEN 1.0 ELSE 0.0 END::DOUBLE AS calendar,
CASE WHEN budget = 0 THEN CASE WHEN instrument IN {listed(C.TARGET)} THEN 0.65 ELSE 0.5 END WHEN coalesce(budget < min_cost, FALSE) OR coalesce(budget > max_cost, FALSE) THEN 0.0 WHEN min_cost IS NOT NULL OR max_cost IS NOT NULL OR instrument IN {listed(C.TARGET)} THEN 1.0 ELSE 0.65 END::DOUBLE AS finance,
CASE WHEN scope = 'NATIONAL' OR region = company_region THEN 1.0 ELSE 0.0 END::DOUBLE AS territory, CASE WHEN category = 'À préciser' OR company_categories IS NULL THEN 0.55 WHEN list_contains(string_split(company_categories, '|'), category) THEN 1.0 ELSE 0.0 END::DOUBLE AS size FROM ({PAIR_SQL}))"""


def projects(t):
    return t("fx_company").where("company_id % 100 = 0").withColumnRenamed("region", "company_region")


def programs(t):
    return t("fx_program").select("program_id", "permanent", "closing_date", "min_cost", "max_cost", "instrument", "scope", "region", "company_categories")


def has_terms():
    return F.col("instrument").isin(C.TARGET)


def fits(t, digits=None):
    return S.fit_scores(projects(t), programs(t), day(), has_terms(), digits)


@query(f"SELECT company_id, program_id, calendar, finance, territory, size, round(access, 6) AS access FROM ({FITS_SQL})")
def k5_fit_scores(t):
    return fits(t, 6).select("company_id", "program_id", "calendar", "finance", "territory", "size", "access")


SCORE_SQL = f"""SELECT company_id, program_id, (k1 + k2 + k3 + 2)::BIGINT AS documented, floor(100.0::DOUBLE * (k1 * finance + k2 * calendar + k3 * size + territory + access) / (k1 + k2 + k3 + 2) + 0.5)::BIGINT AS score FROM
(SELECT *, (min_cost IS NOT NULL OR max_cost IS NOT NULL)::INT AS k1, (closing_date IS NOT NULL OR permanent)::INT AS k2, (category <> 'À préciser' AND company_categories IS NOT NULL)::INT AS k3 FROM ({FITS_SQL}))"""


def scored(pairs):
    dims = {
        "finance": (F.col("min_cost").isNotNull() | F.col("max_cost").isNotNull(), F.col("finance")),
        "calendar": (F.col("closing_date").isNotNull() | F.col("permanent"), F.col("calendar")),
        "beneficiary": ((F.col("category") != "À préciser") & F.col("company_categories").isNotNull(), F.col("size")),
        "territory": (F.lit(True), F.col("territory")),
        "access": (F.lit(True), F.col("access")),
    }
    return S.relevance(pairs, ["company_id", "program_id"], dims)


@query(SCORE_SQL)
def k7_relevance(t):
    return scored(fits(t))


ELIGIBLE_SQL = f"""WITH e AS (SELECT program_id, list(DISTINCT field) AS f FROM fx_evidence WHERE tier IN ('A', 'B') GROUP BY 1), k AS (SELECT company_id, p.program_id, [CASE WHEN coalesce(instrument NOT IN {listed(C.TARGET)}, FALSE) THEN CASE WHEN coalesce(list_contains(f, 'financialTerms'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN coalesce(closing_date <= {DAY} AND NOT permanent, FALSE) THEN CASE WHEN coalesce(list_contains(f, 'calendar'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN coalesce(budget < min_cost, FALSE) THEN CASE WHEN coalesce(list_contains(f, 'financialTerms'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN coalesce(category <> 'À préciser' AND NOT list_contains(string_split(company_categories, '|'), category), FALSE) THEN CASE WHEN coalesce(list_contains(f, 'beneficiaries'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN lifecycle <> 'ACTIVE' THEN CASE WHEN coalesce(list_contains(f, 'calendar'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN coalesce(budget > max_cost, FALSE) THEN CASE WHEN coalesce(list_contains(f, 'eligibleExpenses'), FALSE) THEN 2 ELSE 1 END ELSE 0 END, CASE WHEN coalesce(list_contains(f, 'prerequisites'), FALSE) THEN 0 ELSE 1 END, CASE WHEN coalesce(list_contains(f, 'selectionCriteria'), FALSE) THEN 0 ELSE 1 END] AS s FROM ({PAIR_SQL}) p LEFT JOIN e ON e.program_id = p.program_id),
n AS (SELECT company_id, program_id, list_zip(s, ['instrument', 'calendar', 'budget', 'size', 'status', 'expenses', 'prerequisites', 'selection']) AS c FROM k),
r AS (SELECT company_id, program_id, list_transform(list_filter(c, z -> z[1] = 2), z -> z[2]) AS bad, list_transform(list_filter(c, z -> z[1] = 1), z -> z[2]) AS open FROM n)
SELECT company_id, program_id, CASE WHEN len(bad) > 0 THEN 'NON CONFORME' WHEN len(open) > 0 THEN 'À VÉRIFIER' ELSE 'CONFORME' END AS status, array_to_string(bad, '|') AS blocking, array_to_string(open, '|') AS to_check FROM r"""


def judged(t):
    criteria = [
        ("instrument", "financialTerms", ~F.col("instrument").isin(C.TARGET)),
        ("calendar", "calendar", (F.col("closing_date") <= day()) & ~F.col("permanent")),
        ("budget", "financialTerms", F.col("budget") < F.col("min_cost")),
        ("size", "beneficiaries", (F.col("category") != "À préciser") & ~F.array_contains("sizes", F.col("category"))),
        ("status", "calendar", F.col("lifecycle") != "ACTIVE"),
        ("expenses", "eligibleExpenses", F.col("budget") > F.col("max_cost")),
        ("prerequisites", "prerequisites", None),
        ("selection", "selectionCriteria", None),
    ]
    rules = t("fx_program").select("program_id", "instrument", "closing_date", "permanent", "min_cost", "max_cost", F.split("company_categories", r"\|").alias("sizes"), "lifecycle", "scope", "region")
    return S.eligibility(projects(t), rules, t("fx_evidence"), ["company_id", "program_id"], criteria, ["budget", "size", "expenses"])


@query(ELIGIBLE_SQL)
def k8_eligibility(t):
    return judged(t).select("company_id", "program_id", "status", "blocking", "to_check")


CUES = "(^|[^a-z])(not|nicht|sauf|no)($|[^a-z])"


@query(f"""WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(text, '([.;:])\\s+', '\\1' || chr(10), 'g'), chr(10)), x -> trim(x)), x -> length(x) >= 4)) AS s FROM documents), w AS (SELECT DISTINCT doc_id, unnest({TERMS.format(c='s')}) AS term FROM s WHERE regexp_matches({NORM.format(c='s')}, '{CUES}')), q AS (SELECT DISTINCT item_id, unnest({TERMS.format(c='text')}) AS term FROM benchmark)
SELECT item_id, doc_id, count(*) AS words FROM w JOIN q USING (term) GROUP BY 1, 2""")
def k9_excluded_sectors(t):
    return S.excluded_sectors(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"), CUES)


DOMAINS = {"culture": ["tion", "ment", "ung", "que"], "agri": ["zz", "der", "und", "eau"], "health": ["with", "was", "which", "that"], "aero": ["ère", "por", "los", "del"]}
DOMAIN_SQL = "list_filter([" + ", ".join("CASE WHEN " + " + ".join(f"contains({{c}}, '{w.replace('è', 'e')}')::INT" for w in words) + f" >= {{least}} THEN '{d}' END" for d, words in DOMAINS.items()) + "], x -> x IS NOT NULL)"


@query("WITH " + OVERLAP_SQL + f""", top AS (SELECT item_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ratio DESC, doc_id) AS rank FROM ov) WHERE rank <= 10),
d AS (SELECT doc_id, unnest({DOMAIN_SQL.format(c='plain', least=3)}) AS domain FROM (SELECT doc_id, {NORM.format(c='text')} AS plain FROM documents)), q AS (SELECT item_id, unnest({DOMAIN_SQL.format(c='plain', least=1)}) AS domain FROM (SELECT item_id, {NORM.format(c='text')} AS plain FROM benchmark))
SELECT DISTINCT item_id, doc_id, domain FROM top JOIN d USING (doc_id) WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.item_id = top.item_id AND q.domain = d.domain)""")
def k9_specialised_mismatch(t):
    docs, items = t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text")
    best = M.top_overlap(docs, items, CONCEPT_RULES, 10)
    return S.specialised_mismatch(best, docs, items, {d: [w.replace("è", "e") for w in words] for d, words in DOMAINS.items()})


def kinds():
    """What of a programme its score depends on, but for its bounds."""
    calendar = F.when(F.col("permanent"), 2).when(F.col("closing_date") >= day(), 1).when(F.col("closing_date").isNotNull(), 0)
    return [calendar, has_terms(), F.col("company_categories"), F.when(F.col("scope") == "NATIONAL", "NATIONAL").otherwise(F.concat(F.lit("in "), "region")), F.col("min_cost").isNull(), F.col("max_cost").isNull()]


@query(f"""WITH s AS ({SCORE_SQL}), a AS (SELECT *, CASE WHEN score >= 90 AND documented >= 4 THEN row_number() OVER (PARTITION BY company_id, score >= 90 AND documented >= 4 ORDER BY score DESC, program_id) END AS r FROM s),
b AS (SELECT *, CASE WHEN r <= 2 THEN 'PRIORITY' END AS t1, (r IS NULL OR r > 2) AND score >= 70 AND documented >= 3 AS q FROM a), c AS (SELECT *, CASE WHEN q THEN row_number() OVER (PARTITION BY company_id, q ORDER BY score DESC, program_id) END AS r2 FROM b),
d AS (SELECT *, CASE WHEN t1 IS NOT NULL THEN t1 WHEN r2 <= 3 THEN 'LEAD' END AS t2 FROM c), e AS (SELECT *, CASE WHEN t2 IS NULL THEN row_number() OVER (PARTITION BY company_id, t2 IS NULL ORDER BY score DESC, program_id) END AS r3 FROM d)
SELECT company_id, program_id, score, coalesce(t2, 'POTENTIAL') AS tier FROM e WHERE t2 IS NOT NULL OR r3 <= 2""")
def k12_shortlist(t):
    tiers = [("PRIORITY", (F.col("score") >= 90) & (F.col("documented") >= 4), 2), ("LEAD", (F.col("score") >= 70) & (F.col("documented") >= 3), 3), ("POTENTIAL", F.lit(True), 2)]
    score = lambda p, q, pair: scored(S.fit_scores(p, q, day(), has_terms(), pair=pair))
    leading = S.leading_pairs(projects(t), programs(t), score, "company_id", "program_id", kinds(), "min_cost", "max_cost", tiers)
    return S.shortlist(leading, "company_id", "program_id", [F.desc("score"), "program_id"], tiers).select("company_id", "program_id", "score", "tier")


@query("WITH r AS (SELECT lpad(CAST(s_suppkey * 7 AS VARCHAR), 9, '0') AS id, s_name FROM supplier) SELECT c_custkey AS company_id, CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS registry_id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE s_name END AS name FROM customer LEFT JOIN r ON c_custkey % 5 <> 0 AND r.id = lpad(CAST(c_custkey AS VARCHAR), 9, '0')")
def k13_company_enrichment(t):
    siren = F.when(F.col("c_custkey") % 5 == 0, "12 34").when(F.col("c_custkey") % 2 == 0, F.concat(F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit(" 00012"))).otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    companies = t("customer").select(F.col("c_custkey").alias("company_id"), siren.alias("siren"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"))
    registry = t("supplier").select(F.lpad((F.col("s_suppkey") * 7).cast("string"), 9, "0").alias("registry_id"), F.col("s_name").alias("name"))
    return S.enrich(companies, registry, ["name"])


@query(f"SELECT company_id, program_id, array_to_string(list_transform(string_split(to_check, '|'), x -> 'Vérifier : ' || x)[1:10], ' ; ') AS points FROM ({ELIGIBLE_SQL}) WHERE to_check <> ''")
def k14_points_to_secure(t):
    return judged(t).where("to_check <> ''").select("company_id", "program_id", "points")

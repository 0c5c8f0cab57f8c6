"""Each catalogue operator bound to the driver's tables: name -> (function(spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.fixtures import AS_OF, table, with_views
from fundsieve.functions import text as T
from fundsieve.operators import catalogue as C
from fundsieve.operators import extraction as X
from fundsieve.operators import matching as M

REGISTRY: dict[str, tuple[Callable, str | None]] = {}
DAY = f"DATE '{AS_OF}'"
BOOSTS = {"title": 3.2, "objective": 2.4}


def query(sql: str | None = None):
    """Register f(t), where t(name) is a table, under f's name."""

    def keep(f):
        oracle = re.sub(r"\b([xz]) -> ", r"lambda \1: ", with_views(sql)) if sql else None
        REGISTRY[f.__name__] = (lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name)), oracle)
        return f

    return keep


def listed(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


NORM = "trim(regexp_replace(replace(strip_accents(lower(coalesce({c}, ''))), '’', ''''), '\\s+', ' ', 'g'))"
MATCHING = "trim(regexp_replace(regexp_replace(" + NORM + ", '[^a-z0-9%€+\\- /]', ' ', 'g'), '\\s+', ' ', 'g'))"
TERMS = "list_filter(string_split(" + MATCHING + ", ' '), x -> length(x) > 2 AND x NOT IN " + listed(T.STOPWORDS) + ")"
ORIGIN = "lower(regexp_extract(url, '(?i)^(https?://[^/?#]*)', 1))"
PATH = "regexp_extract(url, '(?i)^https?://[^/?#]*([^?#]*)', 1)"


def kept_params(dropped: str) -> str:
    return f"list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), x -> x <> '' AND NOT regexp_matches(x, '{dropped}'))"


def joined_url(path: str, params: str) -> str:
    return f"{ORIGIN} || {path} || CASE WHEN len({params}) > 0 THEN '?' || array_to_string({params}, '&') ELSE '' END"


PAGE_DROPS = "(?i)^(utm_|pk_|fbclid(=|$))"
DEDUPE_DROPS = "(?i)^utm_|^(fbclid|gclid|mc_cid|mc_eid)(=|$)"
PAGE_URL = joined_url(f"regexp_replace({PATH}, '/$', '')", kept_params(PAGE_DROPS))
DEDUPE_URL = "CASE WHEN regexp_matches(url, '(?i)^https?:') THEN " + joined_url(f"CASE WHEN regexp_replace({PATH}, '/+$', '') = '' THEN '/' ELSE regexp_replace({PATH}, '/+$', '') END", f"list_sort({kept_params(DEDUPE_DROPS)})") + " END"
LINK_URL = "regexp_replace(" + joined_url(f"regexp_replace({PATH}, '/+$', '')", kept_params(PAGE_DROPS)) + ", '/$', '')"
RANK = "CASE tier WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 ELSE 0 END"


# A: scans


REGISTRY_ROWS = "SELECT source_id, name, scope, strategy, CASE WHEN source_id % 11 = 0 THEN NULL ELSE concat(CASE WHEN source_id % 13 = 0 THEN 'http' ELSE 'https' END, '://S', CAST(source_id % 40 AS VARCHAR(5)), '.example.org/aides/', CASE WHEN source_id % 2 = 0 THEN '?utm_source=x' ELSE '' END) END AS url FROM fx_source"
STRATEGIES = ["catalog-html", "open-data", "rss"]
EXPECTED_SCOPES = ["FRANCE", "GERMANY", "Corse", "Mayotte"]


@query(f"""WITH r AS ({REGISTRY_ROWS}), k AS (SELECT *, {DEDUPE_URL} AS page, count(*) OVER (PARTITION BY source_id) AS ids FROM r), m AS (SELECT *, CASE WHEN page IS NOT NULL THEN count(*) OVER (PARTITION BY page) END AS pages FROM k)
SELECT CAST(source_id AS VARCHAR) AS subject, unnest(list_filter([CASE WHEN coalesce(name, '') = '' THEN 'MISSING_NAME' END, CASE WHEN url IS NULL THEN 'MISSING_URL' END, CASE WHEN starts_with(url, 'http:') THEN 'URL_NOT_HTTPS' END, CASE WHEN strategy NOT IN {listed(STRATEGIES)} THEN 'STRATEGY_NOT_ALLOWED' END, CASE WHEN ids > 1 THEN 'DUPLICATE_ID' END, CASE WHEN pages > 1 THEN 'DUPLICATE_URL' END, CASE WHEN source_id % 40 = 3 AND url IS NOT NULL THEN 'FORBIDDEN_HOST' END], x -> x IS NOT NULL)) AS problem FROM m
UNION ALL SELECT e, 'SCOPE_ABSENT' FROM (SELECT unnest([{", ".join(repr(x) for x in EXPECTED_SCOPES)}]) AS e) WHERE e NOT IN (SELECT scope FROM r)""")
def a1_source_registry_problems(t):
    n = F.col("source_id")
    url = F.concat(F.when(n % 13 == 0, "http").otherwise("https"), F.lit("://S"), (n % 40).cast("string"), F.lit(".example.org/aides/"), F.when(n % 2 == 0, "?utm_source=x").otherwise(""))
    return C.registry_problems(t("fx_source").withColumn("url", F.when(n % 11 != 0, url)), T.dedupe_url(F.col("url")), STRATEGIES, ["s3.example.org"], EXPECTED_SCOPES)


@query("SELECT page_id, url, length(html)::BIGINT AS html_chars FROM pages")
def a2_page_scan(t):
    return t("pages").select("page_id", "url", F.length("html").cast("long").alias("html_chars"))


@query(f"SELECT split_part({PATH}, '/', 2) AS section, count(*) AS n, count(DISTINCT url) AS urls FROM pages GROUP BY 1")
def a7_sitemap_sections(t):
    p = t("pages").select("url", F.split(T.url_path(F.col("url")), "/").getItem(1).alias("section"))
    return p.groupBy(F.coalesce("section", F.lit("")).alias("section")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))


@query("""SELECT page_id, pos, href, CASE WHEN regexp_matches(href, '^https?:') THEN href WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || href ELSE url END AS absolute, label
FROM (SELECT page_id, url, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS href, unnest(b) AS label FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS a, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS b FROM pages))""")
def a8_anchors(t):
    rx = '<a href="([^"]*)">([^<]*)</a>'
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(rx), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(rx), F.lit(2)).alias("label"))
    a = t("pages").select("page_id", "url", F.posexplode(both)).select("page_id", "url", F.col("pos").cast("long").alias("pos"), "col.href", "col.label")
    origin = F.regexp_extract("url", "^(https?://[^/?#]*)", 1)
    absolute = F.when(F.col("href").rlike("^https?:"), F.col("href")).when(F.col("href").startswith("//"), F.concat(F.lit("https:"), "href")).when(F.col("href").startswith("/"), F.concat(origin, "href")).otherwise(F.col("url"))
    return a.select("page_id", "pos", "href", absolute.alias("absolute"), "label")


@query("SELECT page_id, regexp_matches(lower(url), '[?&](page|p)=[0-9]+|[?&][a-z_]*(currentpage|pageindex|pagenumber)[a-z_]*=') AS paginated, regexp_matches(lower(url), 'utm_') AS tracked FROM pages")
def a9_pagination_links(t):
    u = F.lower("url")
    return t("pages").select("page_id", u.rlike("[?&](page|p)=[0-9]+|[?&][a-z_]*(currentpage|pageindex|pagenumber)[a-z_]*=").alias("paginated"), u.rlike("utm_").alias("tracked"))


LISTING_LINKS = """SELECT page_id, pos, label, CASE pos % 4 WHEN 0 THEN href WHEN 1 THEN concat(href, '?cur%72entPage=', CAST(pos AS VARCHAR)) WHEN 2 THEN concat(href, '?p=', CAST(page_id AS VARCHAR), '&x=1') ELSE concat(href, '/Aides-%C3%A0-tous?q=p=1') END AS url
 FROM (SELECT page_id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS href, unnest(b) AS label FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS a, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS b FROM pages))"""


@query(f"SELECT page_id, pos, contains(url, '/en/') OR regexp_matches(url, '(?i)PAGE[0-9]') OR regexp_matches({NORM.format(c="label || ' ' || url")}, '{X.PROGRAMME_WORDS}') AS relevant, regexp_matches({NORM.format(c='label')}, '{X.PAGER_LABEL}') OR regexp_matches(lower(url_decode(url)), '{X.PAGER_PARAMETER}') AS paginated FROM ({LISTING_LINKS})")
def a9_link_filter(t):
    rows = X.anchors(t("pages"), ["page_id"], "html")
    page, pos = F.col("page_id").cast("string"), F.col("pos").cast("string")
    url = F.when(F.col("pos") % 4 == 0, F.col("href")).when(F.col("pos") % 4 == 1, F.concat("href", F.lit("?cur%72entPage="), pos)).when(F.col("pos") % 4 == 2, F.concat("href", F.lit("?p="), page, F.lit("&x=1"))).otherwise(F.concat("href", F.lit("/Aides-%C3%A0-tous?q=p=1")))
    rows = rows.withColumn("url", url)
    return rows.select("page_id", "pos", X.relevant_link(F.col("label"), F.col("url"), "/en/", "PAGE[0-9]").alias("relevant"), X.pagination_link(F.col("label"), F.col("url")).alias("paginated"))


@query(f"SELECT doc_id, array_to_string(list_distinct_in_order[1:160], ' ') AS tokens FROM (SELECT doc_id, list_transform(list_filter(list_zip(w, generate_series(1, len(w))), z -> list_position(w, z[1]) = z[2]), z -> z[1]) AS list_distinct_in_order FROM (SELECT doc_id, {TERMS.format(c='text')} AS w FROM documents))")
def a16_search_index(t):
    return t("documents").select("doc_id", F.array_join(F.slice(F.array_distinct(T.terms(F.col("text"))), 1, 160), " ").alias("tokens"))


# B: normalisation


@query(f"SELECT doc_id, md5({NORM.format(c='text')}) AS digest, length({NORM.format(c='text')})::BIGINT AS n FROM documents")
def b1_norm(t):
    return t("documents").select("doc_id", F.md5(T.norm(F.col("text"))).alias("digest"), F.length(T.norm(F.col("text"))).cast("long").alias("n"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script.*?</script>', ' ', 'gis'), '<style.*?</style>', ' ', 'gis'), '<br\s*/?>', chr(10), 'gi'), '</p>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi'), '&quot;', '"', 'gi'), '&#39;', ''''), '\s+', ' ', 'g')) AS text FROM pages""")
def b2_html_to_text(t):
    return t("pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query(f"SELECT page_id, {PAGE_URL} AS url_key FROM pages")
def b3_page_url(t):
    return t("pages").select("page_id", T.page_url(F.col("url")).alias("url_key"))


@query(f"SELECT page_id, {DEDUPE_URL} AS url_key FROM pages")
def b4_dedupe_url(t):
    return t("pages").select("page_id", T.dedupe_url(F.col("url")).alias("url_key"))


@query(f"SELECT page_id, {LINK_URL} AS url_key FROM pages")
def b5_link_url(t):
    return t("pages").select("page_id", T.link_url(F.col("url")).alias("url_key"))


@query("SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/index\\.php/node/', '/node/') AS alias FROM pages")
def b6_portal_alias(t):
    return t("pages").select("page_id", F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), r"/index\.php/node/", "/node/").alias("alias"))


@query(f"SELECT page_id, 'web_' || sha256({PAGE_URL}) AS id, substring(sha256(html), 1, 24) AS content FROM pages")
def b7_page_ids(t):
    return t("pages").select("page_id", F.concat(F.lit("web_"), F.sha2(T.page_url(F.col("url")), 256)).alias("id"), F.substring(F.sha2("html", 256), 1, 24).alias("content"))


# Words that a title's core leaves out.
GENERIC_WORDS = "(^|[^a-z0-9])(france 2030|appel a projets?|appel a manifestation d interet|aap|ami|dispositif|aide)($|[^a-z0-9])"
TITLE_CORE = "trim(regexp_replace(regexp_replace(" + NORM.format(c="split_part(text, chr(10), 1)") + f", '{GENERIC_WORDS}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def title_core(c):
    return F.trim(F.regexp_replace(F.regexp_replace(T.norm(c), GENERIC_WORDS, " "), "[^a-z0-9]+", " "))


def first_line(c: str = "text"):
    return F.split(c, "\n").getItem(0)


@query(f"SELECT doc_id, 'title:' || {TITLE_CORE} || '|' || lang || '|FRANCE' AS title_key FROM documents")
def b8_title_key(t):
    return t("documents").select("doc_id", F.concat(F.lit("title:"), title_core(first_line()), F.lit("|"), "lang", F.lit("|FRANCE")).alias("title_key"))


SENTENCES = "list_filter(list_transform(string_split(regexp_replace({c}, '([.;:])\\s+', '\\1' || chr(10), 'g'), chr(10)), x -> trim(x)), x -> length(x) >= 4)"


@query(f"SELECT doc_id, len({SENTENCES.format(c='text')})::BIGINT AS n, md5(array_to_string({SENTENCES.format(c='text')}, '|')) AS digest FROM documents")
def b9_sentences(t):
    s = T.sentences(F.col("text"))
    return t("documents").select("doc_id", F.size(s).cast("long").alias("n"), F.md5(F.array_join(s, "|")).alias("digest"))


# Wording of titles that name no programme, without accents.
GENERIC = "(document officiel|conditions particulieres|page introuvable|page non trouvee|erreur 404|404 not found|access denied|forbidden|service indisponible|site en maintenance)"


@query(f"SELECT doc_id, (length({NORM.format(c='split_part(text, chr(10), 1)')}) < 4 OR regexp_matches({NORM.format(c='split_part(text, chr(10), 1)')}, '{GENERIC}')) AS generic FROM documents")
def b10_generic_titles(t):
    title = T.norm(first_line())
    return t("documents").select("doc_id", ((F.length(title) < 4) | title.rlike(GENERIC)).alias("generic"))


# Wording with which a site's own matter begins.
BOILERPLATE = [
    "Cette page vise à vous guider dans l’utilisation du site",
    "Cette page vise à vous guider dans l'utilisation du site",
    "Pour connaître le niveau d’accessibilité de ce site",
    "Pour connaître le niveau d'accessibilité de ce site",
    "L’initiative internationale pour l’accessibilité du Web",
    "L'initiative internationale pour l'accessibilité du Web",
    "Gestion des cookies",
    "Gérer mes cookies",
    "Politique de confidentialité",
    "Inscrivez-vous à notre newsletter",
    "Suivez-nous sur les réseaux sociaux",
]
MARKERS = [m.lower() for m in BOILERPLATE] + ["all rights reserved", "licensed under", "subscribe"]


@query("SELECT doc_id, CASE WHEN cut IS NULL THEN length(text) ELSE cut - 1 END::BIGINT AS kept FROM (SELECT doc_id, text, list_min(list_filter([" + ", ".join("strpos(lower(text), '" + m.replace("'", "''") + "')" for m in MARKERS) + "], x -> x > 0)) AS cut FROM documents)")
def b12_boilerplate_cut(t):
    cut = F.array_min(F.filter(F.array(*[F.instr(F.lower("text"), m) for m in MARKERS]), lambda x: x > 0))
    return t("documents").select("doc_id", F.coalesce(cut - 1, F.length("text")).cast("long").alias("kept"))


# C: extraction


DATE_SQL = "list_sort(list_distinct(list_transform(regexp_extract_all(text, '\\b(20[0-9][0-9])[-/.](0?[1-9]|1[0-2])[-/.](0?[1-9]|[12][0-9]|3[01])\\b'), x -> split_part(replace(replace(x, '/', '-'), '.', '-'), '-', 1) || '-' || lpad(split_part(replace(replace(x, '/', '-'), '.', '-'), '-', 2), 2, '0') || '-' || lpad(split_part(replace(replace(x, '/', '-'), '.', '-'), '-', 3), 2, '0'))))"


@query(f"SELECT program_id, seq, array_to_string({DATE_SQL}, '|') AS dates FROM fx_clause")
def c4_dates(t):
    return t("fx_clause").select("program_id", "seq", F.array_join(T.dates(F.col("text")), "|").alias("dates"))


@query("SELECT program_id, seq, list_sum(r)::DOUBLE AS total, len(r)::BIGINT AS n FROM (SELECT program_id, seq, list_filter(list_transform(regexp_extract_all(text, '([0-9]{1,3}(?:[.,][0-9]+)?)\\s*%', 1), x -> replace(x, ',', '.')::DOUBLE), x -> x BETWEEN 0 AND 100) AS r FROM fx_clause)")
def c5_rates(t):
    r = T.rates(F.col("text"))
    return t("fx_clause").select("program_id", "seq", F.when(F.size(r) > 0, F.aggregate(r, F.lit(0.0), lambda a, x: a + x)).alias("total"), F.size(r).cast("long").alias("n"))


# The SQL of the next five takes what each clause of fx_terms says from the columns that it was written from, not from its text.
TERM_ROWS = "SELECT l_orderkey AS program_id, l_linenumber AS seq, (l_orderkey + l_linenumber) % 5 AS s, round(l_discount * 100)::INT::DOUBLE AS r, l_quantity::INT::DOUBLE AS q, strftime(l_shipdate::DATE + INTERVAL 9132 DAY, '%Y-%m-%d') AS d FROM lineitem"


@query(f"SELECT program_id, seq, CASE s WHEN 1 THEN 3 WHEN 3 THEN 0 ELSE 1 END::BIGINT AS n, CASE s WHEN 0 THEN q * 1000 WHEN 1 THEN q * 1000 WHEN 2 THEN (q + 0.5) * 1000000 WHEN 4 THEN q END::DOUBLE AS lowest, CASE s WHEN 0 THEN q * 1000 WHEN 1 THEN (q + 1) * 100000 WHEN 2 THEN (q + 0.5) * 1000000 WHEN 4 THEN q END::DOUBLE AS highest FROM ({TERM_ROWS})")
def c6_amounts(t):
    c = t("fx_terms").select("program_id", "seq", T.amounts(F.col("text")).alias("a"))
    return c.select("program_id", "seq", F.size("a").cast("long").alias("n"), F.array_min("a").alias("lowest"), F.array_max("a").alias("highest"))


AID_SQL = "CASE s WHEN 0 THEN q * 1000 WHEN 1 THEN q * 1000 WHEN 2 THEN (q + 0.5) * 1000000 END::DOUBLE"


FINANCE_SQL = f"SELECT program_id, coalesce(min({AID_SQL}), min(q) FILTER (s = 4)) AS min_amount, coalesce(max({AID_SQL}), max(q) FILTER (s = 4)) AS max_amount, coalesce(min(r) FILTER (s = 0), min(r) FILTER (s = 1)) AS min_rate, coalesce(max(r) FILTER (s = 0), max(r) FILTER (s = 1)) AS max_rate, min(q * 100000::DOUBLE) FILTER (s = 1) AS min_cost, max((q + 1) * 100000::DOUBLE) FILTER (s = 1) AS max_cost FROM ({TERM_ROWS}) GROUP BY 1"


@query(FINANCE_SQL)
def c7_financial_terms(t):
    return X.financial_terms(t("fx_terms"), "program_id")


@query(f"SELECT program_id, seq, unnest(CASE s WHEN 0 THEN ['PME'] WHEN 1 THEN ['PME', 'ETI'] WHEN 3 THEN ['STARTUP', 'GE'] ELSE [] END) AS category, CASE WHEN s < 2 THEN r END AS rate_min, CASE WHEN s < 2 THEN r END AS rate_max, CASE WHEN s = 1 THEN q * 1000 END AS amount_min, CASE WHEN s = 1 THEN q * 1000 END AS amount_max FROM ({TERM_ROWS})")
def c8_terms_by_size(t):
    return X.terms_by_size(t("fx_terms"), ["program_id", "seq"])


@query(f"SELECT program_id, min(d) FILTER (s = 2) AS opening, coalesce(max(d) FILTER (s = 0), max(d) FILTER (s IN (1, 4))) AS closing, count(DISTINCT d) FILTER (s IN (0, 1, 4)) AS deadlines, bool_or(s = 3) AS permanent FROM ({TERM_ROWS}) GROUP BY 1")
def c10_calendar(t):
    return X.calendar(t("fx_terms"), "program_id")


@query(f"SELECT program_id, seq, CASE s WHEN 0 THEN 'PME' WHEN 1 THEN 'PME|ETI' WHEN 2 THEN 'PME|ETI|GE' WHEN 3 THEN 'STARTUP|GE' ELSE '' END AS categories, CASE s WHEN 0 THEN 'SUBVENTION' WHEN 1 THEN 'AVANCE_REMBOURSABLE' WHEN 2 THEN 'PRET_TAUX_ZERO' WHEN 3 THEN 'SUBVENTION' ELSE '' END AS instruments FROM ({TERM_ROWS})")
def c11_c12_categories_and_instruments(t):
    c = t("fx_terms").select("program_id", "seq", T.norm(F.col("text")).alias("n"))
    return c.select("program_id", "seq", F.array_join(T.labels(F.col("n"), T.CATEGORY_RULES), "|").alias("categories"), F.array_join(T.labels(F.col("n"), T.INSTRUMENT_RULES), "|").alias("instruments"))


THEMES = [("english", "the|and|with"), ("french", "les|des|dans"), ("german", "der|und|die"), ("spanish", "los|del|para")]


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({NORM.format(c='text')}, '(^|[^a-z0-9])({p})($|[^a-z0-9])') THEN '{n}' END" for n, p in THEMES) + "], x -> x IS NOT NULL), '|') AS themes FROM documents")
def c13_themes(t):
    return t("documents").select("doc_id", F.array_join(T.labels(T.norm(F.col("text")), [(n, f"(^|[^a-z0-9])({p})($|[^a-z0-9])") for n, p in THEMES]), "|").alias("themes"))


@query(f"SELECT program_id, CASE WHEN permanent THEN 'PERMANENT' WHEN closing_date IS NULL THEN CASE WHEN lifecycle = 'ACTIVE' THEN 'OPEN_UNDATED' ELSE 'UNKNOWN' END WHEN closing_date >= {DAY} THEN CASE WHEN lifecycle = 'ARCHIVE' THEN 'STATUS_CONFLICT' ELSE 'OPEN' END WHEN date_diff('day', {DAY}, closing_date) >= -60 THEN 'RECENTLY_CLOSED' ELSE 'CLOSED_OLD' END AS status FROM fx_program")
def c22_status_proof(t):
    days = F.datediff("closing_date", F.lit(AS_OF).cast("date"))
    dated = F.when(days >= 0, F.when(F.col("lifecycle") == "ARCHIVE", "STATUS_CONFLICT").otherwise("OPEN")).when(days >= -60, "RECENTLY_CLOSED").otherwise("CLOSED_OLD")
    return t("fx_program").select("program_id", F.when(F.col("permanent"), "PERMANENT").when(F.col("closing_date").isNull(), F.when(F.col("lifecycle") == "ACTIVE", "OPEN_UNDATED").otherwise("UNKNOWN")).otherwise(dated).alias("status"))


# D: inventory


LINK_SQL = """SELECT page_id, url, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS href FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages)"""


def links(t):
    return t("pages").select("page_id", F.col("url"), F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("pos", "href")).withColumn("pos", F.col("pos").cast("long"))


@query(f"SELECT href, arg_max(url, page_id * 1000 + pos) AS url, count(*) AS occurrences FROM ({LINK_SQL}) GROUP BY 1")
def d1_unique_links(t):
    return C.unique_links(links(t), "href", ["page_id", "pos"], ["url"])


@query(f"SELECT href, page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM ({LINK_SQL})) WHERE rn = 1")
def d2_first_seen_links(t):
    return C.first_seen(links(t), "href", ["page_id", "pos"])


@query(f"SELECT program_id FROM fx_program WHERE closing_date IS NULL OR closing_date >= {DAY}")
def d5_active_listing(t):
    return t("fx_program").where(F.col("closing_date").isNull() | (F.col("closing_date") >= F.lit(AS_OF).cast("date"))).select("program_id")


@query("SELECT source_id, sum(discovered)::BIGINT AS discovered, sum(imported)::BIGINT AS imported, sum(CASE WHEN NOT success THEN discovered - imported ELSE 0 END)::BIGINT AS errors, (sum(discovered) - sum(imported) - sum(CASE WHEN NOT success THEN discovered - imported ELSE 0 END))::BIGINT AS unexplained FROM fx_run GROUP BY 1")
def d6_accounting(t):
    return C.accounting(t("fx_run"))


@query("""WITH j AS (SELECT r.*, s.strategy = 'control-only' AS control, min_expected, min_imported, min_import_ratio, CASE WHEN discovered > 0 THEN imported::DOUBLE / discovered WHEN imported > 0 THEN 1.0 ELSE 0.0 END AS ratio FROM fx_run r JOIN fx_source s USING (source_id)),
k AS (SELECT source_id, discovered, imported, unnest(['ALL'] || list_filter([CASE WHEN NOT control AND min_expected > 0 AND discovered < min_expected THEN 'SUSPICIOUS_VOLUME' END, CASE WHEN NOT control AND imported < min_imported THEN 'LOW_IMPORTED_COUNT' END, CASE WHEN NOT control AND discovered > 0 AND ratio < min_import_ratio THEN 'LOW_IMPORT_RATIO' END, CASE WHEN NOT control AND imported = 0 THEN 'EMPTY_INGESTION' END], x -> x IS NOT NULL)) AS reason FROM j)
SELECT source_id, reason, count(*) AS runs, sum(discovered - imported)::BIGINT AS excluded FROM k GROUP BY 1, 2""")
def d6_reasons(t):
    return C.reason_counts(C.assess(t("fx_run"), t("fx_source")), t("fx_run"))


@query(f"SELECT count(*) AS occurrences, count(DISTINCT href) AS unique_urls, count(*) - count(DISTINCT href) AS duplicate_occurrences FROM ({LINK_SQL})")
def d7_occurrences(t):
    return C.occurrence_counts(links(t), "href")


@query("SELECT p.program_id, p.source_id FROM fx_program p WHERE p.source_id IN (SELECT source_id FROM fx_source WHERE strategy <> 'control-only')")
def d8_selected_records(t):
    return t("fx_program").join(t("fx_source").where("strategy <> 'control-only'").select("source_id"), "source_id", "left_semi").select("program_id", "source_id")


@query("SELECT source_id, CASE WHEN strategy = 'control-only' THEN 'CONTROL' ELSE 'INGESTION' END AS role, (strategy = 'control-only' OR (min_expected > 0 AND min_imported > 0 AND min_import_ratio > 0 AND min_import_ratio <= 1)) AS calibrated FROM fx_source")
def d9_calibration(t):
    return C.calibration(t("fx_source"))


# E: merge and snapshot


@query("SELECT program_id, CAST(source_id AS VARCHAR) || ':' || CAST(program_id AS VARCHAR) AS canonical_key FROM fx_program")
def e5_canonical_key(t):
    return t("fx_program").select("program_id", F.concat_ws(":", F.col("source_id").cast("string"), F.col("program_id").cast("string")).alias("canonical_key"))


# Paths of catalogue pages, which stand for no single programme.
CATALOGUE_PATHS = ["", "/", "/stock", "/catalogue", "/aides", "/les-aides", "/vos-aides", "/appels", "/fr/appels", "/les-aides-et-appels-a-projets", "/aides-financieres/catalogue"]
ALIAS_ROWS = """SELECT *, CASE WHEN program_id % 50 = 0 THEN NULL WHEN program_id % 50 = 1 THEN concat('https://s', CAST(source_id AS VARCHAR(5)), '.example.org/aides/') WHEN program_id % 3 = 0 THEN concat(official_page, '/?utm_source=x') ELSE official_page END AS url,
 CASE WHEN program_id % 100 < 50 THEN 'Appel à projets Énergie' ELSE title END AS name FROM fx_program"""
ALIAS_TITLE = "'title:' || trim(regexp_replace(regexp_replace(" + NORM.format(c="name") + f", '{GENERIC_WORDS}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) || '|' || scope || '|' || CASE WHEN scope = 'REGIONAL' THEN region ELSE 'FRANCE' END"


@query(f"""WITH r AS ({ALIAS_ROWS}), k AS (SELECT *, {DEDUPE_URL} AS page FROM r), g AS (SELECT *, CASE WHEN page IS NULL OR lower(regexp_extract(page, '^https?://[^/]*([^?]*)', 1)) IN {listed(CATALOGUE_PATHS)} THEN {ALIAS_TITLE} ELSE 'url:' || page END AS alias FROM k)
SELECT alias, min(program_id) AS kept, count(*) AS records, arg_min(name, program_id) AS title, arg_min(closing_date, program_id) FILTER (closing_date IS NOT NULL) AS closing_date, array_to_string(list_sort(list(DISTINCT source_id)), '|') AS sources FROM g GROUP BY 1""")
def e6_alias_dedupe(t):
    n = F.col("program_id") % 50
    page = F.when(n == 0, None).when(n == 1, F.concat(F.lit("https://s"), F.col("source_id").cast("string"), F.lit(".example.org/aides/"))).when(F.col("program_id") % 3 == 0, F.concat("official_page", F.lit("/?utm_source=x"))).otherwise(F.col("official_page"))
    name = F.when(F.col("program_id") % 100 < 50, "Appel à projets Énergie").otherwise(F.col("title"))
    return C.alias_dedupe(t("fx_program").withColumn("url", page).withColumn("name", name), T.dedupe_url(F.col("url")), title_core(F.col("name")), CATALOGUE_PATHS)


@query(f"""WITH ranked AS (SELECT program_id, seq, source_url, checked_on, evidence_text, tier, CASE WHEN seq % 3 = 0 THEN NULL ELSE evidence_text END AS v, {RANK} AS rk FROM fx_evidence),
folded AS (SELECT *, max(rk) OVER w AS most, count(v) OVER w AS had FROM ranked WINDOW w AS (PARTITION BY program_id ORDER BY seq, source_url, checked_on, evidence_text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT program_id, max(CASE WHEN v IS NOT NULL AND (coalesce(had, 0) = 0 OR rk > most) THEN struct_pack(s := seq, t := source_url, u := checked_on, w := evidence_text, v := v) END).v AS value, max(CASE WHEN v IS NOT NULL AND (most IS NULL OR rk >= most) THEN struct_pack(s := seq, t := source_url, u := checked_on, w := evidence_text, v := v) END).v AS terms, max(rk)::BIGINT AS tier_rank, count(*) AS records FROM folded GROUP BY 1""")
def e7_survivorship(t):
    e = t("fx_evidence").withColumn("value", F.when(F.col("seq") % 3 != 0, F.col("evidence_text"))).withColumn("terms", F.col("value"))
    return C.survivorship(e, ["program_id"], ["seq", "source_url", "checked_on", "evidence_text"], C.tier_rank(F.col("tier")), ["value"], ["terms"]).withColumn("tier_rank", F.col("tier_rank").cast("long"))


@query("""WITH j AS (SELECT r.*, s.strategy, s.min_expected, s.min_imported, s.min_import_ratio, s.strategy = 'control-only' AS control, CASE WHEN discovered > 0 THEN imported::DOUBLE / discovered WHEN imported > 0 THEN 1.0 ELSE 0.0 END AS ratio FROM fx_run r JOIN fx_source s USING (source_id)),
k AS (SELECT *, list_filter([CASE WHEN NOT control AND min_expected > 0 AND discovered < min_expected THEN 'SUSPICIOUS_VOLUME' END, CASE WHEN NOT control AND imported < min_imported THEN 'LOW_IMPORTED_COUNT' END, CASE WHEN NOT control AND discovered > 0 AND ratio < min_import_ratio THEN 'LOW_IMPORT_RATIO' END, CASE WHEN NOT control AND imported = 0 THEN 'EMPTY_INGESTION' END], x -> x IS NOT NULL) AS reasons FROM j)
SELECT cycle_id, source_id, round(ratio, 6)::DOUBLE AS import_ratio, array_to_string(reasons, '|') AS reasons, CASE WHEN control THEN success ELSE len(reasons) = 0 END AS ok, (CASE WHEN control THEN success ELSE len(reasons) = 0 END AND NOT control AND imported > 0) AS lifecycle_safe FROM k""")
def e10_collection_assessment(t):
    return C.assess(t("fx_run"), t("fx_source")).withColumn("import_ratio", F.round("import_ratio", 6))


@query("SELECT program_id, title, lifecycle FROM fx_before WHERE program_id NOT IN (SELECT program_id FROM fx_after)")
def e12_stale(t):
    return C.stale(t("fx_before"), t("fx_after"), "program_id").select("program_id", "title", "lifecycle")


@query("""WITH l AS (SELECT source_id, max(checked_at) FILTER (success) AS last_at, arg_max(cycle_id, (checked_at, cycle_id)) FILTER (success) AS last_cycle FROM fx_run GROUP BY 1)
SELECT r.source_id, any_value(l.last_at) AS last_successful_at, count(*) FILTER (l.last_at IS NULL OR (r.checked_at, r.cycle_id) > (l.last_at, l.last_cycle)) AS consecutive_failures FROM fx_run r JOIN l USING (source_id) GROUP BY 1""")
def e13_coverage_state(t):
    return C.coverage_state(t("fx_run"))


@query("""WITH l AS (SELECT source_id, max(checked_at) FILTER (success) AS last_at, arg_max(cycle_id, (checked_at, cycle_id)) FILTER (success) AS last_cycle FROM fx_run GROUP BY 1)
SELECT s.source_id, any_value(l.last_at) AS last_successful_at, count(r.cycle_id) FILTER (l.last_at IS NULL OR (r.checked_at, r.cycle_id) > (l.last_at, l.last_cycle)) AS consecutive_failures, count(r.cycle_id) AS runs FROM fx_source s LEFT JOIN fx_run r USING (source_id) LEFT JOIN l USING (source_id) GROUP BY 1""")
def e13_all_sources(t):
    runs = t("fx_run").groupBy("source_id").agg(F.count(F.lit(1)).alias("runs"))
    rows = t("fx_source").select("source_id").join(C.coverage_state(t("fx_run")), "source_id", "left").join(runs, "source_id", "left")
    return rows.na.fill(0, ["consecutive_failures", "runs"])


@query("SELECT program_id, CASE WHEN instrument IN ('SUBVENTION','AVANCE_REMBOURSABLE','PRET_TAUX_ZERO','APPEL_A_PROJET') THEN instrument ELSE 'AUTRE' END AS instrument FROM fx_program WHERE scope IN ('NATIONAL', 'REGIONAL') AND length(title) >= 4")
def e14_scope_and_instruments(t):
    return t("fx_program").where(F.col("scope").isin("NATIONAL", "REGIONAL") & (F.length("title") >= 4)).select("program_id", F.when(F.col("instrument").isin(C.TARGET), F.col("instrument")).otherwise("AUTRE").alias("instrument"))


@query("""WITH d AS (SELECT program_id % 10 AS part, sum(('0x' || substring(sha256(concat_ws(chr(1), CAST(program_id AS VARCHAR), title, lifecycle)), 1, 15))::HUGEINT) AS digest, count(*) AS n, 'b' AS side FROM fx_before GROUP BY 1
UNION ALL SELECT program_id % 10, sum(('0x' || substring(sha256(concat_ws(chr(1), CAST(program_id AS VARCHAR), title, lifecycle)), 1, 15))::HUGEINT), count(*), 'a' FROM fx_after GROUP BY 1)
SELECT part, max(n) FILTER (side = 'b') AS n_before, max(n) FILTER (side = 'a') AS n_after, coalesce(max(digest) FILTER (side = 'b') = max(digest) FILTER (side = 'a'), FALSE) AS frozen FROM d GROUP BY 1""")
def e15_frozen_partitions(t):
    side = lambda n: C.partition_digest(t(n).withColumn("part", F.col("program_id") % 10), "part", ["program_id", "title", "lifecycle"])
    b, a = side("fx_before").toDF("part", "n_before", "db"), side("fx_after").toDF("part", "n_after", "da")
    return b.join(a, "part", "full_outer").select("part", "n_before", "n_after", F.coalesce(F.col("db") == F.col("da"), F.lit(False)).alias("frozen"))


@query(f"SELECT program_id, CASE WHEN NOT permanent AND closing_date < {DAY} AND lifecycle <> 'STALE' THEN 'ARCHIVE' ELSE lifecycle END AS new_lifecycle FROM fx_program")
def e16_archive(t):
    return C.archive(t("fx_program"), AS_OF).select("program_id", "new_lifecycle")


@query("SELECT program_id, sha256(concat_ws(chr(1), CAST(program_id AS VARCHAR), title, kind, lifecycle, coalesce(CAST(closing_date AS VARCHAR), chr(2)))) AS hash FROM fx_program")
def e17_content_hash(t):
    return t("fx_program").select("program_id", C.row_digest(["program_id", "title", "kind", "lifecycle", "closing_date"]).alias("hash"))


@query("SELECT a.n AS previous, b.n AS current, NOT (b.n = 0 OR (a.n > 400 AND b.n < 0.55 * a.n)) AS passed FROM (SELECT count(*) AS n FROM fx_before) a, (SELECT count(*) AS n FROM fx_after) b")
def e19_volume_gate(t):
    return C.volume_gate(t("fx_before"), t("fx_after"))


# F: quality


@query("""WITH f AS (SELECT program_id, list(DISTINCT field) AS fields FROM fx_evidence GROUP BY 1),
k AS (SELECT p.program_id, list_filter([CASE WHEN title = '' THEN 'MISSING_TITLE' END, CASE WHEN official_page IS NULL THEN 'MISSING_SOURCE' END, CASE WHEN NOT h('objective') THEN 'MISSING_OBJECTIVE' END, CASE WHEN NOT h('beneficiaries') THEN 'MISSING_BENEFICIARIES' END, CASE WHEN instrument IS NULL THEN 'MISSING_AID_TYPE' END, CASE WHEN closing_date IS NULL AND NOT permanent THEN 'MISSING_DEADLINE' END, CASE WHEN NOT h('eligibleExpenses') THEN 'MISSING_ELIGIBLE_EXPENSES' END, CASE WHEN NOT h('prerequisites') THEN 'MISSING_PREREQUISITES' END, CASE WHEN NOT h('selectionCriteria') THEN 'MISSING_SELECTION_CRITERIA' END, CASE WHEN cdc_link IS NULL THEN 'MISSING_CDC' END, CASE WHEN company_categories IS NULL THEN 'MISSING_COMPANY_CATEGORY' END, CASE WHEN opening_date > closing_date THEN 'DATE_INCONSISTENCY' END, CASE WHEN NOT h('financialTerms') THEN 'MISSING_FINANCIAL_TERMS' END, CASE WHEN disbursement_terms IS NULL THEN 'MISSING_DISBURSEMENT_TERMS' END, CASE WHEN instrument IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') AND repayment_terms IS NULL THEN 'MISSING_REPAYMENT_TERMS' END], x -> x IS NOT NULL) AS flags FROM fx_program p LEFT JOIN f USING (program_id))
SELECT program_id, array_to_string(flags, '|') AS flags, len(flags)::BIGINT AS n_flags FROM k""".replace("h('", "coalesce(list_contains(fields, '").replace("') THEN", "'), FALSE) THEN"))
def f1_qa_flags(t):
    return C.qa_flags(t("fx_program"), t("fx_evidence"))


COVER_SQL = "SELECT program_id, " + ", ".join(f"min(tier) FILTER (field = '{f}') AS \"{f}\"" for f in C.CRITICAL) + " FROM fx_evidence GROUP BY 1"


@query(COVER_SQL)
def f3_evidence_coverage(t):
    return C.evidence_coverage(t("fx_evidence"))


CONFIDENCE_SQL = f"SELECT program_id, round(100.0 * ({' + '.join(f'''CASE \"{f}\" WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 1 ELSE 0 END''' for f in C.CRITICAL)}) / 32)::BIGINT AS confidence FROM ({COVER_SQL})"


@query(CONFIDENCE_SQL)
def f4_confidence(t):
    return C.confidence(C.evidence_coverage(t("fx_evidence")))


@query(f"""SELECT p.program_id, coalesce(covered, 0)::BIGINT AS covered, CASE WHEN covered = 8 AND (permanent OR closing_date IS NOT NULL) AND company_categories IS NOT NULL AND (instrument NOT IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') OR repayment_terms IS NOT NULL) THEN 'VERIFIE' ELSE 'A_REVERIFIER' END AS status
FROM fx_program p LEFT JOIN (SELECT program_id, count(DISTINCT field) AS covered FROM fx_evidence WHERE tier IN ('A', 'B') AND field IN {listed(C.CRITICAL)} GROUP BY 1) e USING (program_id)""")
def f5_verification(t):
    return C.verification(t("fx_program"), t("fx_evidence"))


VERIFIED_SQL = f"""SELECT p.program_id, covered = 8 AND (permanent OR closing_date IS NOT NULL) AND company_categories IS NOT NULL AND (instrument NOT IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') OR repayment_terms IS NOT NULL) AS verified FROM fx_program p JOIN (SELECT program_id, count(DISTINCT field) AS covered FROM fx_evidence WHERE tier IN ('A', 'B') AND field IN {listed(C.CRITICAL)} GROUP BY 1) e USING (program_id)"""
SELECTION_SQL = "SELECT DISTINCT program_id FROM fx_evidence WHERE field = 'selectionCriteria'"
REPAID = "instrument IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO')"


@query(f"""WITH a AS (SELECT p.*, program_id IN ({SELECTION_SQL}) AS crit, program_id IN (SELECT program_id FROM ({VERIFIED_SQL}) WHERE verified) AS ok FROM fx_program p)
SELECT count(*) AS library, count(*) FILTER (lifecycle = 'ACTIVE') AS active, count(*) FILTER (lifecycle = 'ARCHIVE') AS archived, count(*) FILTER (lifecycle = 'ACTIVE' AND contains(kind, 'AAP')) AS calls, count(*) FILTER (lifecycle = 'ACTIVE' AND ok) AS verified, count(*) FILTER (lifecycle = 'ACTIVE' AND instrument = 'AVANCE_REMBOURSABLE') AS advances, count(*) FILTER (lifecycle = 'ACTIVE' AND instrument = 'PRET_TAUX_ZERO') AS zero_loans,
count(*) FILTER (lifecycle = 'ACTIVE' AND {REPAID} AND repayment_terms IS NOT NULL) AS with_repayment, floor(100.0 * count(*) FILTER (lifecycle = 'ACTIVE' AND cdc_link IS NOT NULL) / count(*) FILTER (lifecycle = 'ACTIVE') + 0.5)::BIGINT AS document_coverage, floor(100.0 * count(*) FILTER (lifecycle = 'ACTIVE' AND (permanent OR closing_date IS NOT NULL)) / count(*) FILTER (lifecycle = 'ACTIVE') + 0.5)::BIGINT AS deadline_coverage,
floor(100.0 * count(*) FILTER (lifecycle = 'ACTIVE' AND crit) / count(*) FILTER (lifecycle = 'ACTIVE') + 0.5)::BIGINT AS selection_coverage, floor(100.0 * count(*) FILTER (lifecycle = 'ACTIVE' AND disbursement_terms IS NOT NULL) / count(*) FILTER (lifecycle = 'ACTIVE') + 0.5)::BIGINT AS disbursement_coverage FROM a""")
def f8_quality_report(t):
    selection = t("fx_evidence").where("field = 'selectionCriteria'").select("program_id").distinct()
    return C.quality_report(t("fx_program"), C.verification(t("fx_program"), t("fx_evidence")), selection)


@query(f"SELECT url_key, count(*) AS n FROM (SELECT {DEDUPE_URL} AS url_key FROM pages) GROUP BY 1 HAVING count(*) > 1")
def f11_duplicate_urls(t):
    return C.duplicates(t("pages").select(T.dedupe_url(F.col("url")).alias("url_key")), "url_key")


@query("SELECT strategy, count(*) AS sources, count(*) FILTER (source_id NOT IN (SELECT source_id FROM fx_run)) AS uncovered FROM fx_source GROUP BY 1")
def f14_ingestion_audit(t):
    seen = t("fx_run").select("source_id").distinct().withColumn("seen", F.lit(True))
    return t("fx_source").join(seen, "source_id", "left").groupBy("strategy").agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("seen").isNull()).alias("uncovered"))


@query(f"""WITH a AS (SELECT * FROM fx_program WHERE lifecycle = 'ACTIVE'), v AS (SELECT program_id FROM ({VERIFIED_SQL}) WHERE verified), u AS (
SELECT 'active' AS facet, '' AS value, count(*) AS n FROM a UNION ALL SELECT 'archived', '', count(*) FROM fx_program WHERE lifecycle <> 'ACTIVE' UNION ALL SELECT 'next_day', '', count(*) FROM a WHERE permanent OR closing_date IS NULL OR closing_date > {DAY}
UNION ALL SELECT 'kind', CASE WHEN contains(kind, 'AAP') THEN 'CALL' ELSE 'AID' END, count(*) FROM a GROUP BY 2 UNION ALL SELECT 'verified', '', count(*) FROM a WHERE program_id IN (SELECT program_id FROM v) UNION ALL SELECT 'with_document', '', count(cdc_link) FROM a
UNION ALL SELECT 'with_deadline', '', count(*) FROM a WHERE permanent OR closing_date IS NOT NULL UNION ALL SELECT 'direct_link', '', count(*) FROM a WHERE starts_with(official_page, 'https://') UNION ALL SELECT 'target', '', count(*) FROM a WHERE instrument IN {listed(C.TARGET)}
UNION ALL SELECT 'scope', scope, count(*) FROM a GROUP BY 2 UNION ALL SELECT 'instrument', instrument, count(*) FROM a GROUP BY 2 UNION ALL SELECT 'category', c, count(*) FROM (SELECT unnest(string_split(company_categories, '|')) AS c FROM a) GROUP BY 2) SELECT * FROM u WHERE n > 0""")
def f15_manifest(t):
    return C.manifest(t("fx_program"), C.verification(t("fx_program"), t("fx_evidence")), AS_OF)


PROBE_SQL = "SELECT CASE WHEN user_id % 3 = 0 THEN 'CONTROL' ELSE 'INGESTION' END AS role, CASE WHEN event_type = 'error' THEN 'NETWORK_ERROR' WHEN value < 5 THEN 'TIMEOUT' WHEN value < 10 THEN 'HTTP_ERROR' WHEN value < 15 THEN 'PROTECTED' WHEN value < 17 THEN 'UNPROBED' ELSE 'OK' END AS state FROM events"


@query(f"""SELECT coalesce(role, 'ALL') AS role, count(*) AS total, count(*) FILTER (state <> 'UNPROBED') AS probed, count(*) FILTER (state IN ('OK', 'PROTECTED', 'HTTP_ERROR')) AS conclusive, count(*) FILTER (state IN ('OK', 'PROTECTED')) AS ok, count(*) FILTER (state NOT IN ('OK', 'PROTECTED', 'UNPROBED')) AS failed, count(*) FILTER (state = 'PROTECTED') AS protected, count(*) FILTER (state = 'TIMEOUT') AS timeouts, count(*) FILTER (state IN ('NETWORK_ERROR', 'TIMEOUT')) AS network_errors,
count(*) > 20 AND count(*) FILTER (state IN ('OK', 'PROTECTED')) = 0 AND count(*) FILTER (state IN ('NETWORK_ERROR', 'TIMEOUT')) > 0.8 * count(*) AS environment_suspect FROM ({PROBE_SQL}) GROUP BY ROLLUP (role)""")
def f18_source_health(t):
    v = F.col("value")
    state = F.when(F.col("event_type") == "error", "NETWORK_ERROR").when(v < 5, "TIMEOUT").when(v < 10, "HTTP_ERROR").when(v < 15, "PROTECTED").when(v < 17, "UNPROBED").otherwise("OK")
    return C.source_health(t("events").select(F.when(F.col("user_id") % 3 == 0, "CONTROL").otherwise("INGESTION").alias("role"), state.alias("state")))


# G: publication


AGGREGATORS = ["s3.example.org", "s7.example.org"]
PROOF_SQL = "SELECT program_id, bool_or(field = 'objective') AS guichet, bool_or(field = 'calendar') AS status, bool_or(field = 'financialTerms') AS instrument_proof, bool_or(field = 'beneficiaries') AS enterprise FROM fx_evidence WHERE tier IN ('A', 'B') AND regexp_matches(source_url, '(?i)^https?://') GROUP BY 1"
REASON_SQL = f"""SELECT p.program_id, p.source_id, CASE WHEN title IS NULL THEN 'INVALID_RECORD' WHEN p.source_id NOT IN (SELECT source_id FROM fx_source) THEN 'SOURCE_NOT_CONFIGURED' WHEN p.source_id NOT IN (SELECT source_id FROM fx_source WHERE strategy <> 'control-only') THEN 'SOURCE_NOT_CERTIFIED' WHEN lifecycle <> 'ACTIVE' OR NOT (permanent OR closing_date IS NULL OR closing_date > {DAY}) THEN 'INACTIVE_OR_STALE'
 WHEN kind = 'AIDE' AND instrument = 'AUTRE' THEN 'MISSING_INSTRUMENT_EVIDENCE' WHEN kind = 'AIDE' AND instrument NOT IN {listed(C.TARGET)} THEN 'OUT_OF_TARGET_INSTRUMENT' WHEN NOT coalesce(guichet, FALSE) THEN 'MISSING_GUICHET_EVIDENCE' WHEN NOT coalesce(status, FALSE) THEN 'MISSING_STATUS_EVIDENCE'
 WHEN NOT coalesce(instrument_proof, FALSE) THEN 'MISSING_INSTRUMENT_EVIDENCE' WHEN NOT coalesce(enterprise, FALSE) THEN 'MISSING_ENTERPRISE_EVIDENCE' WHEN length(title) < 4 THEN 'GENERIC_TITLE' WHEN coalesce(official_page, '') = '' THEN 'MISSING_DIRECT_URL' WHEN NOT starts_with(official_page, 'https://') THEN 'INVALID_DIRECT_URL' WHEN regexp_extract(official_page, 'https://([^/]*)', 1) IN {listed(AGGREGATORS)} THEN 'FORBIDDEN_AGGREGATOR' END AS reason FROM fx_program p LEFT JOIN ({PROOF_SQL}) e USING (program_id)"""


def proofs(t):
    return C.evidence_predicates(t("fx_evidence"), "objective", ["calendar"], "financialTerms", "beneficiaries")


def reasons(t):
    return C.publication_reason(t("fx_program"), proofs(t), t("fx_source").select("source_id", (F.col("strategy") != "control-only").alias("certified")), AS_OF, AGGREGATORS)


@query(PROOF_SQL)
def g1_evidence_predicates(t):
    return proofs(t)


@query(f"SELECT program_id, (kind LIKE '%AAP%' OR kind LIKE '%AMI%' OR instrument IN {listed(C.TARGET)}) AS target FROM fx_program")
def g3_target_funding(t):
    return t("fx_program").select("program_id", (F.col("kind").rlike("AAP|AMI") | F.col("instrument").isin(C.TARGET)).alias("target"))


@query(f"SELECT program_id FROM fx_program WHERE lifecycle = 'ACTIVE' AND (permanent OR closing_date IS NULL OR closing_date > {DAY})")
def g4_recent_or_active(t):
    return t("fx_program").where(C.recent_or_active(AS_OF)).select("program_id")


@query(REASON_SQL)
def g5_publication_reason(t):
    return reasons(t)


@query(f"SELECT reason, count(*) AS n, min(program_id) AS first_program FROM ({REASON_SQL}) WHERE reason IS NOT NULL GROUP BY 1")
def g6_quarantine(t):
    return C.quarantine(reasons(t))


@query("SELECT source_id, count(*) AS n, CAST(sum(('0x' || substring(sha256(concat_ws(chr(1), CAST(program_id AS VARCHAR), title, kind, lifecycle, official_page)), 1, 15))::HUGEINT) AS VARCHAR) AS digest FROM fx_program GROUP BY 1")
def g8_data_fingerprint(t):
    return C.partition_digest(t("fx_program"), "source_id", ["program_id", "title", "kind", "lifecycle", "official_page"])


@query(f"SELECT p.program_id, p.title FROM fx_program p JOIN ({REASON_SQL}) r USING (program_id) WHERE r.reason IS NULL")
def g16_publish(t):
    return t("fx_program").join(reasons(t).where("reason IS NULL").select("program_id"), "program_id", "left_semi").select("program_id", "title")


# H: changes


FIELDS = "title lifecycle closing_date min_cost opening_date permanent kind scope region themes instrument max_cost official_page company_categories cdc_link disbursement_terms repayment_terms".split()


@query("SELECT * FROM (SELECT coalesce(a.program_id, b.program_id) AS program_id, CASE WHEN b.program_id IS NULL THEN 'CREATION' WHEN a.program_id IS NULL THEN 'SORTIE_PERIMETRE' WHEN " + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in FIELDS) + " THEN 'MODIFICATION' END AS type, CASE WHEN a.program_id IS NULL OR b.program_id IS NULL THEN '' ELSE concat_ws('|', " + ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in FIELDS) + ") END AS fields FROM fx_before b FULL JOIN fx_after a ON a.program_id = b.program_id) WHERE type IS NOT NULL")
def h1_changes(t):
    return C.changes(t("fx_before"), t("fx_after"), "program_id", FIELDS)


CLOSED = "ARCHIVE|STALE|CLOS|CLOSED|EXPIRED|OBSOLETE"


@query("""WITH j AS (SELECT coalesce(a.program_id, b.program_id) AS program_id, a.program_id IS NULL AS gone, b.program_id IS NULL AS fresh, a.lifecycle AS la, b.lifecycle AS lb, """ + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in FIELDS) + f""" AS differs FROM fx_before b FULL JOIN fx_after a ON a.program_id = b.program_id)
SELECT program_id, 'new' AS movement, NULL::VARCHAR AS reason FROM j WHERE fresh AND (SELECT count(*) FROM fx_before) > 0 UNION ALL SELECT program_id, 'modified', NULL FROM j WHERE NOT fresh AND NOT gone AND differs UNION ALL SELECT program_id, 'obsolete', 'DISPARU_DE_LA_COLLECTE' FROM j WHERE gone
UNION ALL SELECT program_id, 'obsolete', 'DEVENU_CLOS_OU_OBSOLETE' FROM j WHERE NOT fresh AND NOT gone AND regexp_matches(la, '{CLOSED}') AND NOT regexp_matches(lb, '{CLOSED}')""")
def h2_report_diff(t):
    return C.report_movements(t("fx_before"), t("fx_after"), "program_id", FIELDS, CLOSED)


# I: time


SUNDAY = "(make_date(year(ts), {m}, 31) - CAST(isodow(make_date(year(ts), {m}, 31)) % 7 AS INTEGER))::TIMESTAMP + INTERVAL 1 HOUR"


@query(f"SELECT day, n, CAST(day + 1 AS DATE) AS next_day FROM (SELECT CAST(ts + CASE WHEN ts >= {SUNDAY.format(m=3)} AND ts < {SUNDAY.format(m=10)} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)")
def i1_business_days(t):
    return C.paris_days(t("events"), "ts")


@query(f"SELECT program_id, closing_date, (lifecycle = 'ACTIVE' AND (permanent OR closing_date IS NULL OR closing_date > {DAY})) AS active FROM fx_program")
def i2_active_next_day(t):
    return t("fx_program").select("program_id", "closing_date", C.recent_or_active(AS_OF).alias("active"))


@query(f"""WITH k AS (SELECT p.program_id, permanent, closing_date, CASE WHEN permanent THEN CASE WHEN p.program_id IN (SELECT program_id FROM fx_evidence WHERE field = 'calendar' AND tier IN ('A', 'B')) THEN 'PERMANENT' ELSE 'PERMANENT_UNVERIFIED' END WHEN closing_date > {DAY} THEN 'DEADLINE' WHEN closing_date IS NOT NULL THEN 'J1' ELSE 'DATE_MISSING' END AS reason FROM fx_program p)
SELECT program_id, reason IN ('PERMANENT', 'DEADLINE') AS eligible, CASE WHEN NOT permanent THEN closing_date END AS deadline, reason FROM k""")
def i3_next_deadline(t):
    return C.next_deadline(t("fx_program"), t("fx_evidence"), AS_OF)


@query(f"SELECT program_id, CASE WHEN closing_date IS NULL THEN 'unknown' WHEN date_diff('day', {DAY}, closing_date) >= 0 THEN 'open' WHEN date_diff('day', {DAY}, closing_date) >= -60 THEN 'recent-closed' ELSE 'closed' END AS state, date_diff('day', {DAY}, closing_date)::BIGINT AS days FROM fx_program")
def i4_date_state(t):
    return C.date_state(t("fx_program"), AS_OF)


# J, K, L: search, matching, dashboards


@query(f"SELECT program_id, CASE WHEN closing_date >= {DAY} THEN 'open' ELSE 'recent-closed' END AS state FROM fx_program WHERE (region = 'EUROPE' OR scope = 'NATIONAL') AND kind = 'AIDE' AND themes = '2-HIGH' AND instrument = 'SUBVENTION' AND regexp_matches(official_page, '//s1?[0-9][.]') AND closing_date >= {DAY} - 60 AND (contains(company_categories, 'PME') OR contains(company_categories, 'ETI'))")
def j3_faceted_filter(t):
    rows = C.faceted(t("fx_program"), region="EUROPE", kind="AIDE", theme="2-HIGH", instrument="SUBVENTION", categories=["PME", "ETI"]).where(F.col("official_page").rlike("//s1?[0-9][.]"))
    return C.by_date_state(rows, AS_OF).select("program_id", "state")


@query("SELECT facet, value, count(*) AS n FROM (SELECT unnest(['region', 'kind', 'instrument', 'lifecycle']) AS facet, unnest([region, kind, instrument, lifecycle]) AS value FROM fx_program) GROUP BY 1, 2")
def j5_facets(t):
    cols = ["region", "kind", "instrument", "lifecycle"]
    e = t("fx_program").select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in cols])).alias("e")).select("e.*")
    return e.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


# The fields of a programme and what their terms weigh.
EIGHT = {"title": 3.2, "themes": 2.8, "objective": 2.4, "projects_expected": 2.2, "selection_criteria": 2.0, "eligible_expenses": 1.8, "prerequisites": 1.6, "beneficiaries": 1.2}
LINES = {"title": 1, "projects_expected": 2, "selection_criteria": 3, "eligible_expenses": 4, "prerequisites": 5}
FIELD_SQL = {f: f"split_part(text, chr(10), {n})" for f, n in LINES.items()} | {"objective": "text", "themes": "source", "beneficiaries": "lang"}
BM25_TAIL = """,
avgs AS (SELECT field, greatest(1, avg(len(w))) AS al FROM f GROUP BY 1), q AS (SELECT DISTINCT item_id, unnest({asked}) AS term FROM benchmark),
tf AS (SELECT doc_id, field, boost, len(w) AS l, unnest(w) AS term FROM f), post AS (SELECT doc_id, field, boost, l, term, count(*) AS tf FROM tf WHERE term IN (SELECT term FROM q) GROUP BY ALL),
per AS (SELECT doc_id, term, sum(boost * tf * 2.2 / (tf + 1.2 * (1 - 0.72 + 0.72 * l / al))) AS w FROM post JOIN avgs USING (field) GROUP BY 1, 2),
idf AS (SELECT term, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM per GROUP BY 1),
s AS (SELECT item_id, doc_id, sum(w * idf) AS bm25 FROM per JOIN idf USING (term) JOIN q USING (term) GROUP BY 1, 2)
"""


def bm25_sql(boosts: dict[str, float]) -> str:
    return "WITH f AS (" + " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {w} AS boost, {TERMS.format(c=FIELD_SQL[f])} AS w FROM documents" for f, w in boosts.items()) + ")" + BM25_TAIL.replace("{asked}", TERMS.format(c="text"))


BM25_SQL = bm25_sql(BOOSTS)



def titled(t):
    return t("documents").select("doc_id", first_line().alias("title"), F.col("text").alias("objective"))


def bm25(t):
    return M.bm25f(titled(t), t("benchmark"), BOOSTS)


@query(BM25_SQL + "SELECT item_id, doc_id, round(bm25, 4)::DOUBLE AS bm25, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(bm25, 6) DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def k10_bm25f_ranking(t):
    ranked = M.top_bm25f(titled(t), t("benchmark"), BOOSTS, 5)
    return ranked.select("item_id", "doc_id", F.round("bm25", 4).alias("bm25"), "rank")


@query(bm25_sql(EIGHT) + "SELECT item_id, doc_id, round(bm25, 4)::DOUBLE AS bm25, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(bm25, 6) DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def k10_eight_fields(t):
    line = {f: F.get(F.split("text", "\n"), n - 1).alias(f) for f, n in LINES.items()}
    docs = t("documents").select("doc_id", *line.values(), F.col("text").alias("objective"), F.col("source").alias("themes"), F.col("lang").alias("beneficiaries"))
    return M.top_bm25f(docs, t("benchmark"), EIGHT, 5).select("item_id", "doc_id", F.round("bm25", 4).alias("bm25"), "rank")


CONCEPTS = [("ia", "ia|data|the"), ("energie", "energie|und"), ("export", "export|les")]
CONCEPT_RULES = [(n, f"(^|[^a-z0-9])({p})($|[^a-z0-9])") for n, p in CONCEPTS]
CONCEPT_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({MATCHING.format(c='text')}, '{p}') THEN '{n}' END" for n, p in CONCEPT_RULES) + "], x -> x IS NOT NULL)"
IN_ORDER = "list_transform(list_filter(list_zip(w, generate_series(1, len(w))), z -> list_position(w, z[1]) = z[2]), z -> z[1])"
PAIRED = "list_distinct(list_transform(generate_series(1, len(w) - 1), x -> w[x] || ' ' || w[x + 1]))"
SIDE_SQL = "SELECT {key}, w, {pairs} AS b, c FROM (SELECT {key}, {order} AS w, c FROM (SELECT {key}, {terms} AS w, {concepts} AS c FROM {table}))"
OVERLAP_SQL = "ov AS (SELECT item_id, doc_id, hits, bigram_hits, concept_hits, round(least(1.0, greatest(least(1.0, 0.52 * cov + 0.16 * prec + 0.14 * big + 0.18 * least(1.0, con)), least(1.0, 0.68 * con + 0.32 * cov)) + CASE WHEN hits >= 4 THEN 0.07 ELSE 0 END + CASE WHEN concept_hits >= 2 THEN 0.07 ELSE 0 END), 6)::DOUBLE AS ratio FROM (SELECT *, hits::DOUBLE / least(qn, 16) AS cov, hits::DOUBLE / least(n, 20) AS prec, CASE WHEN qb > 0 THEN bigram_hits::DOUBLE / least(qb, 8) ELSE 0 END AS big, CASE WHEN qc > 0 THEN concept_hits::DOUBLE / greatest(1, ceil(0.55 * qc)) ELSE 0 END AS con FROM (SELECT item_id, doc_id, len(list_intersect(d.w, q.w))::BIGINT AS hits, len(list_intersect(d.b, q.b))::BIGINT AS bigram_hits, len(list_intersect(d.c, q.c))::BIGINT AS concept_hits, len(d.w) AS n, len(q.w) AS qn, len(q.b) AS qb, len(q.c) AS qc FROM (" + SIDE_SQL.format(key="doc_id", table="documents", pairs=PAIRED, order=IN_ORDER, terms=TERMS.format(c="text"), concepts=CONCEPT_SQL) + ") d, (" + SIDE_SQL.format(key="item_id", table="benchmark", pairs=PAIRED, order=IN_ORDER, terms=TERMS.format(c="text"), concepts=CONCEPT_SQL) + ") q) WHERE hits > 0))"


def overlaps(t):
    return M.overlap(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"), CONCEPT_RULES).where("hits > 0")


@query("WITH " + OVERLAP_SQL + " SELECT * FROM ov")
def k4_overlap_hits(t):
    return overlaps(t)


@query(BM25_SQL + ", " + OVERLAP_SQL + " SELECT item_id, doc_id, round(1.0 / (60 + row_number() OVER (PARTITION BY item_id ORDER BY ratio DESC, doc_id)) + 1.0 / (60 + row_number() OVER (PARTITION BY item_id ORDER BY round(bm25, 6) DESC, ratio DESC, doc_id)), 8)::DOUBLE AS rrf FROM s JOIN ov USING (item_id, doc_id)")
def k11_rank_fusion(t):
    s = bm25(t).withColumn("score", F.round("bm25", 6)).join(overlaps(t), ["item_id", "doc_id"])
    return M.reciprocal_rank_fusion(s, "item_id", [[F.desc("ratio"), "doc_id"], [F.desc("score"), F.desc("ratio"), "doc_id"]]).select("item_id", "doc_id", F.round("rrf", 8).alias("rrf"))


@query("WITH " + OVERLAP_SQL + " SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ratio DESC, doc_id) AS rank FROM ov) WHERE rank <= 10")
def k4_top_overlap(t):
    return M.top_overlap(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"), CONCEPT_RULES, 10)


@query(BM25_SQL + ", " + OVERLAP_SQL + """, r AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY ratio DESC, doc_id) AS rank FROM ov UNION ALL SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(bm25, 6) DESC, doc_id) FROM s)
SELECT item_id, doc_id, round(sum(1.0 / (60 + rank)), 8)::DOUBLE AS rrf FROM r WHERE rank <= 20 GROUP BY 1, 2""")
def k11_fused_top(t):
    structured = M.top_overlap(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"), CONCEPT_RULES, 20)
    lexical = M.top_bm25f(titled(t), t("benchmark"), BOOSTS, 20)
    return M.fuse([structured, lexical]).withColumn("rrf", F.round("rrf", 8))


@query(f"""WITH p AS (SELECT * FROM fx_program), i AS (SELECT instrument AS k, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, k LIMIT 6), r AS (SELECT region AS k, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, k LIMIT 8), c AS (SELECT CAST(program_id AS VARCHAR) AS k, date_diff('day', {DAY}, closing_date) AS n FROM p WHERE closing_date >= {DAY} ORDER BY closing_date, program_id LIMIT 6)
SELECT 'share:' || scope AS metric, '' AS name, round(100.0 * count(*) / (SELECT count(*) FROM p), 6)::DOUBLE AS value FROM p GROUP BY scope UNION ALL SELECT 'instrument', k, n::DOUBLE FROM i UNION ALL SELECT 'region', k, n::DOUBLE FROM r UNION ALL SELECT 'closing', k, n::DOUBLE FROM c
UNION ALL SELECT 'source_success', '', round(100.0 * count(*) FILTER (success) / count(*), 6)::DOUBLE FROM fx_run UNION ALL SELECT 'created_today', '', count(*)::DOUBLE FROM p WHERE opening_date = {DAY} UNION ALL SELECT 'active', '', count(*)::DOUBLE FROM p WHERE lifecycle = 'ACTIVE'
UNION ALL SELECT 'verified', '', count(*)::DOUBLE FROM (SELECT program_id FROM fx_evidence WHERE tier IN ('A', 'B') AND field IN {listed(C.CRITICAL)} GROUP BY 1 HAVING count(DISTINCT field) = 8) e JOIN p USING (program_id) WHERE (permanent OR closing_date IS NOT NULL) AND company_categories IS NOT NULL AND (instrument NOT IN ('AVANCE_REMBOURSABLE', 'PRET_TAUX_ZERO') OR repayment_terms IS NOT NULL)""")
def l1_home(t):
    return C.home(t("fx_program"), t("fx_run"), C.verification(t("fx_program"), t("fx_evidence")), AS_OF)


@query("SELECT s.source_id, s.name, max(r.checked_at) AS last_sync, count(r.cycle_id) AS runs FROM fx_source s LEFT JOIN fx_run r USING (source_id) GROUP BY 1, 2")
def l3_source_table(t):
    latest = t("fx_run").groupBy("source_id").agg(F.max("checked_at").alias("last_sync"), F.count(F.lit(1)).alias("runs"))
    return t("fx_source").join(latest, "source_id", "left").select("source_id", "name", "last_sync", F.coalesce("runs", F.lit(0)).alias("runs"))


def queries() -> dict[str, Callable[..., DataFrame]]:
    return {k: f for k, (f, _) in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql}

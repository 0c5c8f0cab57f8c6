"""Sources and extraction operators bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundsieve.fixtures import AS_OF
from fundsieve.functions import text as T
from fundsieve.operators import cards as W
from fundsieve.operators import extraction as X
from fundsieve.operators import locate as O
from fundsieve.operators import ordering as N
from fundsieve.plans.queries import DAY, GENERIC, NORM, SENTENCES, query
from fundsieve.sources import files

LEXICON = [("objective", ["the", "and"]), ("beneficiaries", ["der", "und"]), ("calendar", ["los", "que"]), ("financialTerms", ["les", "des"])]
FALLBACK = {"objective": "(?i)with|that", "beneficiaries": "(?i)sch|ung"}
HTML_TEXT = r"""trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '<script.*?</script>', ' ', 'gis'), '<style.*?</style>', ' ', 'gis'), '<br\s*/?>', chr(10), 'gi'), '</p>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi'), '&quot;', '"', 'gi'), '&#39;', ''''), '\s+', ' ', 'g'))"""
BLOCK_SQL = f"""SELECT page_id, pos, lower(tag) AS tag, {HTML_TEXT.format(c='body')} AS text FROM (SELECT page_id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS tag, unnest(b) AS body FROM
(SELECT page_id, regexp_extract_all(k, '{X.BLOCK}', 1) AS a, regexp_extract_all(k, '{X.BLOCK}', 2) AS b FROM (SELECT page_id, regexp_replace(html, '{X.NO_TEXT}', ' ', 'g') AS k FROM pages)))"""


def class_sql(c: str) -> str:
    n = NORM.format(c=c)
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'''contains({n}, '{p}')''' for p in phrases)} THEN '{name}'" for name, phrases in LEXICON) + " END"


SECTION_SQL = f"""SELECT page_id, section, string_agg(text, ' ' || chr(10) || ' ' ORDER BY pos) AS text, count(*) AS blocks FROM
(SELECT *, coalesce(last_value(CASE WHEN tag LIKE 'h%' THEN {class_sql('text')} END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos), 'objective') AS section FROM ({BLOCK_SQL}))
WHERE tag NOT LIKE 'h%' AND length(text) < 9000 AND text <> '' GROUP BY 1, 2"""
ORDERED = "list_transform(list_filter(list_zip(w, generate_series(1, len(w))), z -> list_position(w, z[1]) = z[2]), z -> z[1])"


# A: scans and sinks


@query("SELECT 'part' AS origin, trim(p_name) AS title, p_type AS aid, CAST(p_retailprice AS VARCHAR) AS amount FROM part UNION ALL SELECT 'supplier', s_name, NULL, NULL FROM supplier")
def a3_aliased_rows(t):
    names = {"title": ["titre", "name"], "aid": ["dispositif", "type"], "amount": ["montant", "price"]}
    rows = lambda n: X.aliased(t(n), names).select(F.lit(n).alias("origin"), "title", "aid", "amount")
    return rows("part").union(rows("supplier"))


@query("SELECT p_brand AS catalogue, arg_min(p_name, p_partkey) FILTER (regexp_matches(p_name || ' ' || p_type, '(?i)bolt|promo')) AS dataset, count(*) AS discovered FROM part GROUP BY 1")
def a4_dataset_pick(t):
    wanted = F.concat_ws(" ", "p_name", "p_type").rlike("(?i)bolt|promo")
    return t("part").groupBy(F.col("p_brand").alias("catalogue")).agg(F.min_by("p_name", F.when(wanted, F.col("p_partkey"))).alias("dataset"), F.count(F.lit(1)).alias("discovered"))


@query("SELECT page_id, url AS link, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages WHERE regexp_matches(lower(url), '/en/|/fr/')")
def a5_feed_items(t):
    safe = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    xml = F.concat(F.lit("<item><link>"), safe(F.col("url")), F.lit("</link><title>"), safe(title), F.lit("</title></item>"))
    items = files.feed_items(t("pages").select("page_id", xml.alias("xml")), "xml")
    return items.where(F.lower("item.link").rlike("/en/|/fr/")).select("page_id", "item.link", F.coalesce("item.title", F.lit("")).alias("title"))


LISTED_DATES = "SELECT program_id, list_sort(list(DISTINCT regexp_extract(text, '(20[0-9-]+)', 1))) AS d, md5(substring(string_agg(text, ' ' ORDER BY seq, text), 1, 1200)) AS evidence FROM fx_clause GROUP BY 1"


@query(f"SELECT program_id, CASE WHEN len(d) > 1 THEN d[1] END AS opening, d[len(d)] AS closing, (d[len(d)] >= '2023-06-30' AND (len(d) = 1 OR d[1] <= '2023-06-30')) AS active FROM ({LISTED_DATES})")
def a6_active_window(t):
    found = t("fx_clause").select("program_id", F.explode(T.dates(F.col("text"))).alias("d")).groupBy("program_id").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    opening = F.when(F.col("lo") < F.col("hi"), F.col("lo"))
    return found.select("program_id", opening.alias("opening"), F.col("hi").alias("closing"), ((F.col("hi") >= "2023-06-30") & (opening.isNull() | (opening <= "2023-06-30"))).alias("active"))


@query(f"SELECT program_id, d[1] AS opening, d[len(d)] AS closing, evidence FROM ({LISTED_DATES}) WHERE len(d) >= 2")
def a10_listing_cards(t):
    parts = F.transform(F.sort_array(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"])
    card = t("fx_clause").groupBy("program_id").agg(F.array_join(parts, " ").alias("text")).withColumn("d", T.dates(F.col("text")))
    return card.where(F.size("d") >= 2).select("program_id", F.col("d")[0].alias("opening"), F.element_at("d", -1).alias("closing"), F.md5(F.substring("text", 1, 1200)).alias("evidence"))


@query(r"""WITH c AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->', '', 'g'), '<[^<>]*>|[^<>]+') AS tokens FROM fx_listing),
t AS (SELECT page_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM c),
k AS (SELECT *, lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS name, starts_with(token, '</') AS closing FROM t),
g AS (SELECT *, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) + CASE WHEN closing THEN 1 ELSE 0 END AS level FROM k WHERE name <> '' AND starts_with(token, '<') AND NOT (NOT closing AND (ends_with(token, '/>') OR name IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr')))),
e AS (SELECT page_id, pos AS node, last, name, regexp_extract(token, '(?i)^<a\s[^>]*?href\s*=\s*["'']([^"'']*)', 1) AS href FROM (SELECT *, lead(pos) OVER w AS last, lead(closing) OVER w AS next FROM g WINDOW w AS (PARTITION BY page_id, name, level ORDER BY pos)) WHERE NOT closing AND next),
x AS (SELECT page_id, pos, trim(regexp_replace(token, '[\s\x{00A0}]+', ' ', 'g')) AS text FROM k WHERE NOT starts_with(token, '<')),
s AS (SELECT e.page_id, e.node, string_agg(text, ' ' ORDER BY pos) AS raw FROM e JOIN x ON x.page_id = e.page_id AND x.pos > e.node AND x.pos < e.last WHERE text <> '' GROUP BY ALL),
r AS (SELECT l.page_id, l.node, l.href, a.node AS at, row_number() OVER (PARTITION BY l.page_id, l.node ORDER BY a.node DESC) AS up FROM e l LEFT JOIN e a ON a.page_id = l.page_id AND a.node < l.node AND a.last > l.last WHERE l.name = 'a' AND l.href <> ''),
f AS (SELECT r.*, raw, regexp_extract_all(raw, '\b((?:0?[1-9]|[12][0-9]|3[01])/(?:0?[1-9]|1[0-2])/20[0-9]{2})\b', 1) AS days FROM r LEFT JOIN s ON s.page_id = r.page_id AND s.node = r.at),
b AS (SELECT page_id, node, arg_min(struct_pack(a := days[1], z := days[len(days)], raw := raw), up) FILTER (up <= 8 AND len(days) >= 2 AND length(raw) <= 2500) AS v, any_value(href) AS href FROM f GROUP BY ALL)
SELECT page_id, (node - 1)::INTEGER AS node, href, strftime(strptime(v.a, '%d/%m/%Y'), '%Y-%m-%d') AS opening, strftime(strptime(v.z, '%d/%m/%Y'), '%Y-%m-%d') AS closing, md5(left(v.raw, 1200)) AS evidence FROM b""")
def a10_nearest_cards(t):
    return W.listing_cards(t("fx_listing")).withColumn("evidence", F.md5("evidence"))


@query("SELECT split_part(split_part(url, '://', 2), '/', 1) AS host, arg_min(n, page_id) FILTER (n IS NOT NULL) AS counter FROM (SELECT url, page_id, try_cast(regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS BIGINT) AS n FROM pages) GROUP BY 1")
def a11_result_counter(t):
    n = F.nullif(F.regexp_extract("html", r"track\(([0-9]+)\)", 1), F.lit("")).try_cast("long")
    host = F.split(F.split("url", "://")[1], "/")[0]
    return t("pages").select(host.alias("host"), "page_id", n.alias("n")).groupBy("host").agg(F.min_by("n", F.when(F.col("n").isNotNull(), F.col("page_id"))).alias("counter"))


@query("SELECT lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)) AS host, arg_min(page_id, page_id) FILTER (page_id % 4 < 3) AS results, count(*) AS pages FROM pages GROUP BY 1")
def a11_result_counters(t):
    n, m = F.col("page_id").cast("string"), F.col("page_id") % 4
    said = F.when(m == 0, F.concat(n, F.lit(" dispositifs d’aide correspondent"))).when(m == 1, F.concat(F.lit("<b>"), n, F.lit(" Résultat(s)</b>"))).when(m == 2, F.concat(n, F.lit(" aide(s) & service(s)"))).otherwise("aucun")
    p = t("pages").select("page_id", F.lower(F.regexp_extract("url", "(?i)^https?://([^/?#]*)", 1)).alias("host"), X.result_counter(F.concat(said, F.lit(" "), "html")).alias("n"))
    return p.groupBy("host").agg(F.min_by("n", F.when(F.col("n").isNotNull(), F.col("page_id"))).alias("results"), F.count(F.lit(1)).alias("pages"))


HEAD_OR_LINK = r'<(title|h[1-5])(?:\s[^>]*)?>([^<]*)</|<a href="([^"]*)"'


@query(f"""WITH k AS (SELECT page_id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS tag, unnest(b) AS head, unnest(c) AS href FROM (SELECT page_id, {', '.join(f"regexp_extract_all(html, '{HEAD_OR_LINK}', {g}) AS {n}" for g, n in ((1, 'a'), (2, 'b'), (3, 'c')))} FROM pages)),
h AS (SELECT page_id, pos, contains({NORM.format(c='head')}, 'the') AS hit, CASE WHEN tag = 'title' THEN 1 ELSE substring(tag, 2, 1)::INT END AS level FROM k WHERE tag <> ''),
o AS (SELECT page_id, pos AS start, (SELECT min(e.pos) FROM h e WHERE e.page_id = h.page_id AND e.pos > h.pos AND e.level <= h.level) AS stop FROM h WHERE hit)
SELECT DISTINCT k.page_id, k.pos, k.href FROM k JOIN o ON k.page_id = o.page_id AND k.pos > start AND (stop IS NULL OR k.pos < stop) WHERE coalesce(tag, '') = ''""")
def a12_links_under_heading(t):
    return X.links_under(t("pages"), "page_id", "html", "the")


CSV_SQL = "SELECT program_id, '\"' || program_id || '\",\"' || title || '\",\"' || kind || ' | ' || instrument || '\",\"' || coalesce(CAST(closing_date AS VARCHAR), '') || '\"' AS line FROM fx_program"


def published(t):
    return files.flat(t("fx_program").select("program_id", "title", F.array("kind", "instrument").alias("labels"), F.coalesce(F.col("closing_date").cast("string"), F.lit("")).alias("closing_date")))


@query("SELECT program_id, title, kind || ' | ' || instrument AS labels, coalesce(CAST(closing_date AS VARCHAR), '') AS closing_date FROM fx_program")
def a13_csv_rows(t):
    line = F.to_csv(F.struct("program_id", "title", "labels", "closing_date"), {"quoteAll": "true", "escape": '"'})
    read = F.from_csv(line, F.lit("program_id long, title string, labels string, closing_date string"), {"escape": '"'})
    return published(t).select(read.alias("r")).select("r.program_id", "r.title", "r.labels", F.coalesce("r.closing_date", F.lit("")).alias("closing_date"))


@query("""WITH j AS (SELECT program_id, program_id // 1000 AS range, length('{"program_id":' || program_id || ',"title":"' || title || '","kind":"' || kind || '"}') AS chars FROM fx_program),
p AS (SELECT *, coalesce(sum(chars) OVER (PARTITION BY range ORDER BY program_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 4000 AS part FROM j)
SELECT range, part, count(*) AS n, sum(chars)::BIGINT AS chars, min(program_id) AS first_key, max(program_id) AS last_key FROM p GROUP BY 1, 2""")
def a15_json_parts(t):
    return X.size_parts(t("fx_program").select("program_id", "title", "kind"), "program_id", 1000, 4000)


@query("""WITH j AS (SELECT program_id, length('{"program_id":' || program_id || ',"title":"' || title || '","kind":"' || kind || '"}') AS chars FROM fx_program),
p AS (SELECT *, coalesce(sum(chars) OVER (ORDER BY program_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 4000 AS part FROM j)
SELECT part, count(*) AS n, sum(chars)::BIGINT AS chars, min(program_id) AS first_key, max(program_id) AS last_key FROM p GROUP BY 1""")
def a15_packed_parts(t):
    rows = t("fx_program").select("program_id", "title", "kind")
    return N.packed(rows, "program_id", F.to_json(F.struct("program_id", "title", "kind")), 4000)


@query("""WITH RECURSIVE m AS (SELECT url, regexp_matches(xml, '(?i)<sitemapindex') AS is_index, list_filter(list_transform(regexp_extract_all(xml, '(?i)<loc>([^<]+)</loc>', 1), x -> trim(replace(x, '&amp;', '&'))), x -> x <> '') AS locs FROM fx_sitemap),
reach(source_id, url) AS (SELECT s, 'https://s' || s || '.example.org/map' || k || '.xml' FROM (SELECT unnest(range(0, 7)) AS s), (SELECT unnest([0, 4]) AS k) UNION SELECT r.source_id, unnest(m.locs) FROM reach r JOIN m ON m.url = r.url WHERE m.is_index)
SELECT DISTINCT source_id, unnest(m.locs) AS url FROM reach JOIN m ON m.url = reach.url WHERE NOT m.is_index""")
def a7_sitemap_closure(t):
    maps = t("fx_sitemap")
    first = maps.select(F.regexp_extract("url", "^https://s([0-9]+)", 1).cast("long").alias("source_id")).distinct()
    starts = first.select("source_id", F.explode(F.array(*[F.concat(F.lit("https://s"), F.col("source_id").cast("string"), F.lit(f".example.org/map{k}.xml")) for k in (0, 4)])).alias("url"))
    return N.sitemap_pages(maps, starts)


@query("SELECT doc_id, coalesce(list_filter(list_transform(string_split(text, chr(10))[1:3], x -> regexp_replace(trim(x), '(?i)^(the|der|die|la|les)\\s+', '')), x -> length(x) BETWEEN 12 AND 190)[1], trim(substring(text, 1, 120))) AS title FROM documents")
def b11_title_repair(t):
    tried = F.transform(F.slice(F.split("text", "\n"), 1, 3), lambda x: F.regexp_replace(F.trim(x), r"(?i)^(the|der|die|la|les)\s+", ""))
    return t("documents").select("doc_id", F.coalesce(F.try_element_at(F.filter(tried, lambda x: F.length(x).between(12, 190)), F.lit(1)), F.trim(F.substring("text", 1, 120))).alias("title"))


# C: extraction


@query(f"SELECT page_id, section, md5(text) AS digest, blocks FROM ({SECTION_SQL})")
def c1_sections(t):
    return X.sections(t("pages"), "page_id", "html", LEXICON).select("page_id", "section", F.md5("text").alias("digest"), "blocks")


@query(f"SELECT page_id, pos, {class_sql('text')} AS class FROM ({BLOCK_SQL}) WHERE tag LIKE 'h%'")
def c2_heading_class(t):
    b = X.blocks(t("pages"), "page_id", "html").where(F.col("tag").startswith("h"))
    return b.select("page_id", F.col("pos").cast("long").alias("pos"), X.first_class(T.norm(F.col("text")), LEXICON).alias("class"))


LINK_TYPES = [("PDF", r"\.pdf($|[?#])"), ("REGLEMENT", r"(^|[^a-z])(the|la)($|[^a-z])"), ("FAQ", "and|und"), ("GRILLE", "en|es")]
ANCHOR_SQL = f"SELECT page_id, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS href, unnest(b) AS label FROM (SELECT page_id, regexp_extract_all(html, '{X.ANCHOR}', 1) AS a, regexp_extract_all(html, '{X.ANCHOR}', 2) AS b FROM pages)"


@query(f"SELECT page_id, pos, href, CASE {' '.join(f'''WHEN regexp_matches(n, '{p}') THEN '{k}' ''' for k, p in LINK_TYPES)} ELSE 'DOCUMENT' END AS type FROM (SELECT *, {NORM.format(c='''label || ' ' || href''')} AS n FROM ({ANCHOR_SQL}))")
def c3_document_links(t):
    n = T.norm(F.concat_ws(" ", "label", "href"))
    return X.anchors(t("pages"), ["page_id"], "html").select("page_id", "pos", "href", X.first_case([(k, n.rlike(p)) for k, p in LINK_TYPES], "DOCUMENT").alias("type"))


# How a rate is written.
RATE_BEFORE = r"([0-9]{1,3}(?:[.,][0-9]+)?)\s*%[^.;]{0,45}"


@query("SELECT program_id, seq, regexp_extract(text, '([0-9]+) % pour les PME', 1)::DOUBLE AS grant_rate, NULL::DOUBLE AS advance_rate FROM fx_clause")
def c9_split_rates(t):
    rate = lambda word: F.nullif(F.regexp_extract(T.norm(F.col("text")), RATE_BEFORE + word, 1), F.lit("")).cast("double")
    return t("fx_clause").select("program_id", "seq", rate("pme").alias("grant_rate"), rate("avance").alias("advance_rate"))


REGULATORY = {"objective": ("(?i)the|und", 4), "contact": ("(?i)que|les", 2)}


@query("SELECT doc_id, " + ", ".join(f"md5(CASE WHEN len({f}) > 0 THEN array_to_string({f}[1:{k}], ' ') END) AS {f}" for f, (_, k) in REGULATORY.items()) + " FROM (SELECT doc_id, " + ", ".join(f"(SELECT {ORDERED} FROM (SELECT list_filter(s, x -> regexp_matches(x, '{p}') AND length(x) >= 12) AS w)) AS {f}" for f, (p, _) in REGULATORY.items()) + f" FROM (SELECT doc_id, {SENTENCES.format(c='text')} AS s FROM documents))")
def c14_regulatory_fallback(t):
    d = t("documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", *[F.md5(X.distinct_matches(F.col("s"), p, k)).alias(f) for f, (p, k) in REGULATORY.items()])


ROLES = "(?i)(the|der|les|los) [a-zé]+ (of|und|de)"


@query(f"SELECT doc_id, substring(list_filter({SENTENCES.format(c='text')}, x -> regexp_matches(x, '{ROLES}'))[1], 1, 850) AS evidence FROM documents")
def c15_operator_evidence(t):
    return t("documents").select("doc_id", F.substring(T.first_matching(T.sentences(F.col("text")), ROLES), 1, 850).alias("evidence"))


@query(f"""WITH s AS ({SECTION_SQL}), p AS (SELECT page_id, {SENTENCES.format(c='k')} AS w FROM (SELECT page_id, {HTML_TEXT.format(c='html')} AS k FROM pages)) SELECT page_id, field, md5(substring(v, 1, 850)) AS digest, locator FROM (""" + " UNION ALL ".join(f"SELECT p.page_id, '{f}' AS field, coalesce(s.text, " + (f"list_filter(w, x -> regexp_matches(x, '{FALLBACK[f]}'))[1]" if f in FALLBACK else "NULL") + f") AS v, CASE WHEN s.text IS NOT NULL THEN 'section:{f}' ELSE 'page-text-match:{f}' END AS locator FROM p LEFT JOIN s ON s.page_id = p.page_id AND section = '{f}'" for f, _ in LEXICON) + ") WHERE v IS NOT NULL")
def c16_evidence(t):
    return X.emit_evidence(t("pages"), "page_id", "html", LEXICON, FALLBACK).select("page_id", "field", F.md5("value").alias("digest"), "locator")


@query(f"""SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)), ''), trim(regexp_extract(html, '<title>([^<]*)</title>', 1))) AS title, md5(k) AS digest, len({SENTENCES.format(c='k')})::BIGINT AS sentences, len(regexp_extract_all(html, '<a href="'))::BIGINT AS links, CASE WHEN contains(url, '/en/') THEN 'EN' ELSE 'Toutes les Régions' END AS regions FROM (SELECT *, {HTML_TEXT.format(c='html')} AS k FROM pages)""")
def c17_page_record(t):
    text = T.html_to_text(F.col("html"))
    grab = lambda rx: F.trim(F.regexp_extract("html", rx, 1))
    title = F.coalesce(F.nullif(grab("<h1[^>]*>([^<]*)</h1>"), F.lit("")), grab("<title>([^<]*)</title>"))
    return t("pages").select("page_id", title.alias("title"), F.md5(text).alias("digest"), F.size(T.sentences(text)).cast("long").alias("sentences"), F.size(F.regexp_extract_all("html", F.lit('<a href="'), F.lit(0))).cast("long").alias("links"), F.when(F.col("url").contains("/en/"), "EN").otherwise("Toutes les Régions").alias("regions"))


@query(f"""SELECT doc_id, coalesce(list_filter(w, x -> length(x) <= 190 AND length(regexp_replace(x, '[^A-Za-zÀ-ÿ]', '', 'g')) >= 12 AND length(regexp_replace(x, '[^A-ZÀ-Ý]', '', 'g')) > 0.65 * length(regexp_replace(x, '[^A-Za-zÀ-ÿ]', '', 'g')))[1], list_filter(w, x -> length(x) BETWEEN 18 AND 150)[1]) AS title
FROM (SELECT doc_id, list_filter(string_split(text, chr(10))[1:120], x -> NOT regexp_matches({NORM.format(c='x')}, '{GENERIC}')) AS w FROM documents)""")
def c18_document_title(t):
    return t("documents").select("doc_id", X.inferred_title(F.col("text"), GENERIC).alias("title"))


@query(f"""WITH p AS (SELECT doc_id, k::INTEGER AS page, substring(text, k * 1000 + 1, 1000) AS text FROM (SELECT doc_id, text, unnest(range(0, 1 + (length(text) - 1) // 1000)) AS k FROM documents)),
s AS (SELECT doc_id, unnest(s) AS piece, (generate_subscripts(s, 1) - 1)::INTEGER AS piece_id FROM (SELECT doc_id, {SENTENCES.format(c='text')} AS s FROM documents))
SELECT s.doc_id, piece_id, min(page) AS page FROM s LEFT JOIN p ON p.doc_id = s.doc_id AND contains(p.text, left(piece, 70)) GROUP BY 1, 2""")
def c18_page_locator(t):
    docs = t("documents").select("doc_id", "text")
    last = F.floor((F.length("text") - 1) / 1000).cast("int")
    pages = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("page")).select("doc_id", "page", F.substring("text", F.col("page") * 1000 + 1, F.lit(1000)).alias("text"))
    pieces = docs.select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("piece_id", "piece"))
    return O.first_pages(pages, pieces)


COMPANY, CUE = "(?i)the|der|les", "(?i)and|und|pour"


@query(f"SELECT doc_id, md5(CASE WHEN p > 0 THEN substring(text, greatest(1, p - 180), p - greatest(1, p - 180) + 300) END) AS snippet, md5(list_filter({SENTENCES.format(c='text')}, x -> regexp_matches(x, '{COMPANY}') AND regexp_matches(x, '{CUE}'))[1]) AS eligible FROM (SELECT *, strpos(lower(text), 'licensed under') AS p FROM documents)")
def c19_official_page(t):
    hit = F.try_element_at(F.filter(T.sentences(F.col("text")), lambda s: T.found(s, COMPANY) & T.found(s, CUE)), F.lit(1))
    return t("documents").select("doc_id", F.md5(X.around(F.col("text"), F.instr(T.lower(F.col("text")), "licensed under"), 180, 300)).alias("snippet"), F.md5(hit).alias("eligible"))


EXCLUDED, TYPED, ELSE = [("LICENSED", "licensed under"), ("COOKIES", "cookies")], [("SUBVENTION", "the"), ("AVANCE_REMBOURSABLE", "und"), ("PRET_TAUX_ZERO", "los")], [("FRENCH_ONLY", "les|des")]


def cases(rules, c="n", last="NULL"):
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{k}'" for k, p in rules) + f" ELSE {last} END"


@query(f"SELECT doc_id, CASE WHEN x IS NULL THEN concat_ws('|', {', '.join(cases([r]) for r in TYPED)}) ELSE '' END AS types, coalesce(x, CASE WHEN {' OR '.join(f'''regexp_matches(n, '{p}')''' for _, p in TYPED)} THEN 'TYPED' ELSE {cases(ELSE, last=chr(39) + 'UNKNOWN' + chr(39))} END) AS reason FROM (SELECT doc_id, n, {cases(EXCLUDED)} AS x FROM (SELECT doc_id, {NORM.format(c='text')} AS n FROM documents))")
def c20_instrument_rules(t):
    n = F.col("n")
    out = X.first_case([(k, n.rlike(p)) for k, p in EXCLUDED])
    d = t("documents").select("doc_id", T.norm(F.col("text")).alias("n")).select("doc_id", "n", out.alias("x"), T.labels(n, TYPED).alias("types"))
    rest = X.first_case([("TYPED", F.size("types") > 0), *[(k, n.rlike(p)) for k, p in ELSE]], "UNKNOWN")
    return d.select("doc_id", F.when(F.col("x").isNull(), F.array_join("types", "|")).otherwise("").alias("types"), F.coalesce("x", rest).alias("reason"))


@query(f"SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'cookies|subscribe') THEN NULL ELSE coalesce(CASE WHEN p > 0 THEN md5(substring(text, greatest(1, p - 180), p - greatest(1, p - 180) + 260)) END, md5(list_filter({SENTENCES.format(c='text')}, x -> regexp_matches(x, '{COMPANY}') AND regexp_matches(x, '{CUE}'))[1])) END AS evidence FROM (SELECT *, strpos(lower(text), ' und ') AS p FROM documents)")
def c21_enterprise_evidence(t):
    low = T.lower(F.col("text"))
    hit = F.try_element_at(F.filter(T.sentences(F.col("text")), lambda s: T.found(s, COMPANY) & T.found(s, CUE)), F.lit(1))
    return t("documents").select("doc_id", F.when(~low.rlike("cookies|subscribe"), F.coalesce(F.md5(X.around(F.col("text"), F.instr(low, " und "), 180, 260)), F.md5(hit))).alias("evidence"))


REGIONS = [("BRETAGNE", "(^|[^a-z])(the|of)($|[^a-z])"), ("CORSE", "(^|[^a-z])(und|die)($|[^a-z])"), ("NORMANDIE", "(^|[^a-z])(les|des)($|[^a-z])")]


@query(f"SELECT doc_id, CASE WHEN contains(n, 'all rights reserved') THEN 'NATIONAL' ELSE concat_ws('|', {', '.join(cases([r]) for r in REGIONS)}) END AS regions FROM (SELECT doc_id, {NORM.format(c='text')} AS n FROM documents)")
def c23_regions(t):
    n = T.norm(F.col("text"))
    return t("documents").select("doc_id", F.when(n.contains("all rights reserved"), "NATIONAL").otherwise(F.array_join(T.labels(n, REGIONS), "|")).alias("regions"))


@query(f"SELECT page_id, by_url, by_title, CASE WHEN by_url <> by_title THEN 'CONFLICT' ELSE coalesce(by_url, by_title, 'AIDE') END AS kind FROM (SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'AAP' WHEN contains(url, '/fr/') THEN 'AMI' END AS by_url, {cases([('AAP', 'the|and'), ('AMI', 'les|des')])} AS by_title FROM (SELECT *, {NORM.format(c='''regexp_extract(html, '<title>([^<]*)</title>', 1)''')} AS n FROM pages))")
def c24_kind(t):
    n = T.norm(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    p = t("pages").select("page_id", X.first_case([("AAP", F.col("url").contains("/en/")), ("AMI", F.col("url").contains("/fr/"))]).alias("by_url"), X.first_case([("AAP", n.rlike("the|and")), ("AMI", n.rlike("les|des"))]).alias("by_title"))
    return p.select("page_id", "by_url", "by_title", F.when(F.col("by_url") != F.col("by_title"), "CONFLICT").otherwise(F.coalesce("by_url", "by_title", F.lit("AIDE"))).alias("kind"))


@query(f"SELECT page_id, CASE WHEN contains(html, 'captcha') THEN 'CHALLENGE' WHEN length(k) < 500 THEN 'SHORT_TEXT' WHEN NOT contains(html, '<h1') THEN 'NO_DETAIL' END AS reason FROM (SELECT *, {HTML_TEXT.format(c='html')} AS k FROM pages)")
def c25_unusable_pages(t):
    short = F.length(T.html_to_text(F.col("html"))) < 500
    return t("pages").select("page_id", X.first_case([("CHALLENGE", F.col("html").contains("captcha")), ("SHORT_TEXT", short), ("NO_DETAIL", ~F.col("html").contains("<h1"))]).alias("reason"))


@query(f"SELECT doc_id, regexp_extract(n, '(^|[^a-z0-9])(feder|interreg|licensed|subscribe)($|[^a-z0-9])', 2) AS token FROM (SELECT doc_id, {NORM.format(c='text')} AS n FROM documents) WHERE regexp_matches(n, '(^|[^a-z0-9])(feder|interreg|licensed|subscribe)($|[^a-z0-9])')")
def c26_dedicated_cycles(t):
    d = t("documents").select("doc_id", F.regexp_extract(T.norm(F.col("text")), "(^|[^a-z0-9])(feder|interreg|licensed|subscribe)($|[^a-z0-9])", 2).alias("token"))
    return d.where("token <> ''")


@query("SELECT page_id, CASE WHEN regexp_replace(url, '[?#].*$', '') <> url THEN 'REDIRECTED' END AS reason FROM pages")
def c27_redirect_guard(t):
    return t("pages").select("page_id", F.when(F.regexp_replace("url", "[?#].*$", "") != F.col("url"), "REDIRECTED").alias("reason"))


POLICIES = f"SELECT source_id, CASE WHEN source_id % 2 = 0 THEN 'NATIONAL' ELSE 'REGIONAL' END AS scope, {DAY} - CAST(source_id * 10 AS INT) AS policy_on, 90 AS max_age FROM fx_source"


@query(f"SELECT program_id, (kind = 'AIDE' AND y.policy_on IS NOT NULL AND date_diff('day', policy_on, {DAY}) BETWEEN 0 AND max_age) AS applies, CASE WHEN kind = 'AIDE' AND y.policy_on IS NOT NULL AND date_diff('day', policy_on, {DAY}) BETWEEN 0 AND max_age THEN 'SUBVENTION' ELSE instrument END AS instrument FROM fx_program p LEFT JOIN ({POLICIES}) y ON p.source_id = y.source_id AND p.scope = y.scope")
def c28_policy_evidence(t):
    s = t("fx_source")
    policies = s.select("source_id", F.when(F.col("source_id") % 2 == 0, "NATIONAL").otherwise("REGIONAL").alias("scope"), F.date_sub(F.lit(AS_OF).cast("date"), (F.col("source_id") * 10).cast("int")).alias("policy_on"), F.lit(90).alias("max_age"))
    return X.with_policy(t("fx_program"), policies, AS_OF)

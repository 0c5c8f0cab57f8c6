"""The driver's tables, and views that give them the shape of a funding catalogue (FIXTURES.md)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fundsieve.sources.scratch import dealt

AS_OF = "1998-06-30"

VIEWS = {
    "fx_program": """SELECT o_orderkey AS program_id, CAST(o_custkey % 20 AS INT) AS source_id, concat('Programme ', CAST(o_orderkey AS VARCHAR(20))) AS title,
 CASE WHEN o_orderpriority='1-URGENT' THEN 'AAP / AMI' ELSE 'AIDE' END AS kind,
 CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'STALE' ELSE 'ARCHIVE' END AS lifecycle,
 CASE o_orderpriority WHEN '2-HIGH' THEN 'SUBVENTION' WHEN '3-MEDIUM' THEN 'AVANCE_REMBOURSABLE' WHEN '4-NOT SPECIFIED' THEN 'PRET_TAUX_ZERO' WHEN '5-LOW' THEN 'PRET' ELSE 'APPEL_A_PROJET' END AS instrument,
 CASE WHEN o_custkey % 2 = 0 THEN 'NATIONAL' ELSE 'REGIONAL' END AS scope, r_name AS region,
 CAST(o_orderdate AS DATE) AS opening_date, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate + INTERVAL 90 DAY AS DATE) END AS closing_date,
 (o_orderkey % 11 = 0) AS permanent, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS min_cost, o_totalprice * 4 AS max_cost,
 concat('https://s', CAST(o_custkey % 20 AS VARCHAR(5)), '.example.org/p/', CAST(o_orderkey % 14000 AS VARCHAR(20))) AS official_page,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'PME' WHEN 2 THEN 'PME|ETI' WHEN 3 THEN 'ETI|GE' WHEN 4 THEN 'STARTUP|PME' ELSE 'PME|ETI|GE' END AS company_categories,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS themes,
 CASE WHEN o_orderkey % 5 = 0 THEN concat('https://s', CAST(o_custkey % 20 AS VARCHAR(5)), '.example.org/cdc/', CAST(o_orderkey AS VARCHAR(20)), '.pdf') END AS cdc_link,
 CASE WHEN o_orderkey % 3 = 1 THEN 'versement au solde' END AS disbursement_terms, CASE WHEN o_orderkey % 7 < 3 THEN 'remboursement sur 5 ans' END AS repayment_terms
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "fx_evidence": """SELECT l_orderkey AS program_id, l_linenumber AS seq,
 CASE CAST(l_partkey % 8 AS INT) WHEN 0 THEN 'objective' WHEN 1 THEN 'beneficiaries' WHEN 2 THEN 'financialTerms' WHEN 3 THEN 'projectsExpected' WHEN 4 THEN 'eligibleExpenses' WHEN 5 THEN 'calendar' WHEN 6 THEN 'prerequisites' ELSE 'selectionCriteria' END AS field,
 CASE WHEN l_returnflag='A' THEN 'A' WHEN l_returnflag='N' THEN 'B' WHEN l_linestatus='F' THEN 'C' ELSE 'D' END AS tier,
 concat('https://s', CAST(l_suppkey AS VARCHAR(10)), '.example.org/p/', CAST(l_partkey AS VARCHAR(10))) AS source_url,
 concat('value ', CAST(l_quantity AS INT)) AS evidence_text, CAST(l_shipdate AS DATE) AS checked_on FROM lineitem""",
    "fx_clause": """SELECT l_orderkey AS program_id, l_linenumber AS seq,
 concat('Subvention au taux de ', CAST(CAST(round(l_discount*100) AS INT) AS VARCHAR(5)), ' % pour les PME. Montant de l''aide plafond ', CAST(CAST(l_quantity AS INT) AS VARCHAR(5)), ' k€. Date limite de dépôt : ', substring(CAST(CAST(l_shipdate AS DATE) + INTERVAL 9132 DAY AS VARCHAR(30)),1,10), '.') AS text FROM lineitem""",
    "fx_terms": """SELECT l_orderkey AS program_id, l_linenumber AS seq, CASE (l_orderkey + l_linenumber) % 5
 WHEN 0 THEN concat('Subvention au taux de ', r, ' % pour les PME. Montant de l''aide plafond ', q, ' k€. Date limite de dépôt : ', d, '.')
 WHEN 1 THEN concat('Avance remboursable de ', r, ' %, ', q, ' 000 € au plus, pour les PME et les ETI. Coût total du projet compris entre ', q, '00 000 € et ', q1, '00 000 €. Relève le ', d, '.')
 WHEN 2 THEN concat('Prêt à taux zéro pour toutes les entreprises. Aide maximum de ', q, ',5 M€. Ouverture le ', d, '.')
 WHEN 3 THEN 'Dotation pour les grandes entreprises et les start-up. Dépôt au fil de l''eau.'
 ELSE concat('Accompagnement gratuit, valeur ', q, ' euros. Candidature le ', d, '.') END AS text
 FROM (SELECT *, CAST(CAST(round(l_discount*100) AS INT) AS VARCHAR(5)) AS r, CAST(CAST(l_quantity AS INT) AS VARCHAR(5)) AS q, CAST(CAST(l_quantity AS INT) + 1 AS VARCHAR(5)) AS q1, substring(CAST(CAST(l_shipdate AS DATE) + INTERVAL 9132 DAY AS VARCHAR(30)),1,10) AS d FROM lineitem)""",
    "fx_source": """SELECT s_suppkey AS source_id, s_name AS name, n_name AS scope, CASE WHEN s_suppkey % 7 = 0 THEN 'control-only' ELSE 'catalog-html' END AS strategy,
 CAST(5 + s_suppkey % 10 AS INT) AS min_expected, CAST(2 + s_suppkey % 5 AS INT) AS min_imported, 0.3 AS min_import_ratio FROM supplier JOIN nation ON s_nationkey=n_nationkey""",
    "fx_run": """SELECT event_id AS cycle_id, user_id AS source_id, ts AS checked_at, (event_type<>'error') AS success, CAST(floor(value) AS INT) AS discovered,
 CAST(floor(value * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.5 ELSE 0.8 END) AS INT) AS imported FROM events""",
    "fx_sitemap": """SELECT concat('https://s', CAST(page_id % 7 AS VARCHAR(5)), '.example.org/map', CAST(k AS VARCHAR(20)), '.xml') AS url,
 CASE WHEN k % 3 < 2 THEN concat('<?xml version="1.0"?><SitemapIndex><sitemap><loc>', m, CAST(2 * k + 1 AS VARCHAR(20)), '.xml</loc></sitemap><sitemap><loc> ', m, CAST(2 * k + 2 AS VARCHAR(20)), '.xml </loc></sitemap><loc>', m, CAST(k - k % 2 AS VARCHAR(20)), '.xml</loc></SitemapIndex>')
 ELSE concat('<urlset><url><loc>', url, '?a=1&amp;b=', CAST(page_id % 5 AS VARCHAR(5)), '</loc></url><url><LOC>', url, '</LOC></url><loc> </loc></urlset>') END AS xml
 FROM (SELECT page_id, url, CAST((page_id - page_id % 7) / 7 AS BIGINT) AS k, concat('https://s', CAST(page_id % 7 AS VARCHAR(5)), '.example.org/map') AS m FROM pages)""",
    "fx_listing": """SELECT page_id, replace(html, '<li>', concat('<li>', d, '/', CAST(1 + page_id % 12 AS VARCHAR(5)), '/2026 ', CASE WHEN page_id % 2 = 1 THEN concat('au ', d, '/0', CAST(1 + page_id % 9 AS VARCHAR(5)), '/2027 ') ELSE '' END)) AS html
 FROM (SELECT page_id, html, CAST(1 + page_id % 28 AS VARCHAR(5)) AS d FROM pages)""",
    "fx_company": """SELECT c_custkey AS company_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'PME' WHEN 'MACHINERY' THEN 'ETI' WHEN 'AUTOMOBILE' THEN 'GE' WHEN 'HOUSEHOLD' THEN 'STARTUP' ELSE 'À préciser' END AS category,
 r_name AS region, abs(c_acctbal) * 50 AS budget FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "fx_before": "SELECT program_id, title, lifecycle, closing_date, min_cost, opening_date, permanent, kind, scope, region, themes, instrument, max_cost, official_page, company_categories, cdc_link, disbursement_terms, repayment_terms FROM fx_program WHERE program_id % 10 <> 0",
    "fx_after": """SELECT program_id, title, CASE WHEN program_id % 13 = 0 THEN 'ARCHIVE' ELSE lifecycle END AS lifecycle,
 CASE WHEN program_id % 7 = 0 THEN CAST(closing_date + INTERVAL 30 DAY AS DATE) ELSE closing_date END AS closing_date, min_cost, opening_date, permanent, kind, scope, region, themes, instrument, CASE WHEN program_id % 17 = 0 THEN max_cost + 1 ELSE max_cost END AS max_cost, official_page, CASE WHEN program_id % 29 = 0 THEN 'PME' ELSE company_categories END AS company_categories,
 CASE WHEN program_id % 19 = 0 THEN NULL ELSE cdc_link END AS cdc_link, disbursement_terms, CASE WHEN program_id % 23 = 0 THEN 'remboursement sur 7 ans' ELSE repayment_terms END AS repayment_terms FROM fx_program WHERE program_id % 10 <> 1""",
}
TEXTS = ("documents", "pages", "fx_clause", "fx_listing", "fx_terms")  # rows that take long to work on: over all cores, also from one small file
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view over them."""
    if name in TABLES:
        t = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return dealt(t) if name in TEXTS else t
    sql = VIEWS[name]
    frames = {t: table(spark, sf_dir, t) for t in re.findall(r"(?:FROM|JOIN) (\w+)", sql)}
    if name in TEXTS:
        frames = {n: dealt(t) for n, t in frames.items()}
    return spark.sql(re.sub(r"(FROM|JOIN) (\w+)", r"\1 {\2}", sql), **frames)


def with_views(sql: str) -> str:
    """sql with a WITH clause for the views that it names."""
    need, out = set(re.findall(r"\bfx_\w+", sql)), []
    if need & {"fx_before", "fx_after"}:
        need.add("fx_program")
    for name, view in VIEWS.items():
        if name in need:
            out.append(f"{name} AS ({view})")
    if not out:
        return sql
    recursive = "WITH RECURSIVE "
    if sql.lstrip().startswith(recursive):
        return recursive + ", ".join(out) + ", " + sql.lstrip()[len(recursive) :]
    head = "WITH " + ", ".join(out)
    return head + ", " + sql.lstrip()[4:] if sql.lstrip()[:5].upper() == "WITH " else f"{head} {sql}"

"""Every catalogue query against its oracle on the smallest tables, and golden rows."""

import random

import oracle
import pytest
from pyspark.sql import functions as F

from fundsieve.functions import text as T
from fundsieve.operators import catalogue as C
from fundsieve.operators import extraction as X
from fundsieve.operators import scoring as S
from fundsieve.plans import queries as Q
from fundsieve.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_equals_oracle(spark, con, name):
    f, sql = Q.REGISTRY[name]
    assert oracle.differ(spark, con, f, sql, SF) is None


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


def test_golden_extraction(spark):
    assert one(spark, "Relève le 15 novembre 2026 puis le 15 janvier 2027", T.dates) == ["2026-11-15", "2027-01-15"]
    assert one(spark, "PME 45 %, ETI 35%", T.rates) == [45.0, 35.0]
    assert one(spark, "12500 € puis 1,5 M€ et 150 000 euros, 30 k€", T.amounts) == [12500.0, 1.5e6, 150000.0, 30000.0]
    label = lambda rules: lambda c: T.labels(T.norm(c), rules)
    assert one(spark, "subvention et avance remboursable", label(T.INSTRUMENT_RULES)) == ["SUBVENTION", "AVANCE_REMBOURSABLE"]
    assert one(spark, "Prêt bancaire à 3,8 %", label(T.INSTRUMENT_RULES)) == []
    assert one(spark, "PME, ETI et grandes entreprises", label(T.CATEGORY_RULES)) == ["PME", "ETI", "GE"]


def test_survivorship_equals_a_fold(spark):
    r = random.Random(1)
    rows = [(k, s, r.randint(0, 4), r.choice([None, f"v{s}"]), r.choice([None, f"t{s}"])) for k in range(300) for s in range(r.randint(1, 7))]
    want = {}
    for k, _, rank, v, t in rows:
        value, terms, most = want.get(k, (None, None, None))
        if v is not None and (value is None or rank > most):
            value = v
        if t is not None and (most is None or rank >= most):
            terms = t
        want[k] = (value, terms, rank if most is None else max(most, rank))
    df = spark.createDataFrame(rows, "k int, s int, r int, v string, t string")
    got = {x.k: (x.v, x.t, x.tier_rank) for x in C.survivorship(df, ["k"], ["s"], F.col("r"), ["v"], ["t"]).collect()}
    assert got == want


def test_calibration_and_assessment(spark):
    sources = spark.createDataFrame([(1, "catalog-html", 200, 180, 0.8), (2, "control-only", 0, 0, 0.0), (3, "catalog-html", 5, 1, 1.5)], "source_id int, strategy string, min_expected int, min_imported int, min_import_ratio double")
    assert {r.source_id: r.calibrated for r in C.calibration(sources).collect()} == {1: True, 2: True, 3: False}
    runs = spark.createDataFrame([(1, 1, True, 226, 36), (2, 1, True, 226, 226), (3, 1, True, 226, 0), (4, 2, True, 0, 0)], "cycle_id int, source_id int, success boolean, discovered int, imported int")
    assert {r.cycle_id: r.ok for r in C.assess(runs, sources).collect()} == {1: False, 2: True, 3: False, 4: True}


def test_golden_accents_and_mixed_dates(spark):
    assert one(spark, "Ça VA : Été Šíř ñandú l’Œuvre x", T.norm) == "ca va : ete sir nandu l'œuvre x"
    assert one(spark, "Clôture le 1er juillet, puis 2/3/2027, 2027-03-02 et 5 août 2026.", T.dates) == ["2026-08-05", "2027-03-02"]
    assert one(spark, "aucune date en 1998", T.dates) == [] and one(spark, None, T.dates) == []
    assert one(spark, "rien", T.amounts) == [] and one(spark, "1.500,50 EUROS", T.amounts) == [1500.5]


def test_report_movements_and_aliases(spark):
    schema = "id int, lifecycle string, title string"
    before = spark.createDataFrame([(1, "ACTIVE", "a"), (2, "ACTIVE", "b"), (3, "ACTIVE", "c"), (4, "ARCHIVE", "d")], schema)
    after = spark.createDataFrame([(1, "ACTIVE", "a"), (2, "CLOS", "b"), (4, "ARCHIVE", "d2"), (5, "ACTIVE", "e")], schema)
    moves = lambda b: {(r.id, r.movement, r.reason) for r in C.report_movements(b, after, "id", ["lifecycle", "title"], Q.CLOSED).collect()}
    assert moves(before) == {(2, "modified", None), (2, "obsolete", "DEVENU_CLOS_OU_OBSOLETE"), (3, "obsolete", "DISPARU_DE_LA_COLLECTE"), (4, "modified", None), (5, "new", None)}
    assert moves(before.limit(0)) == set()
    rows = [(1, 9, "https://A.org/x/?utm_source=q", "Un", None), (2, 8, "https://a.org/x", "Deux", "2027-01-01"), (3, 8, "https://a.org/aides/", "Appel à projet Vert", None), (4, 8, None, "AAP vert", None), (5, 8, "mailto:x", "Autre", None)]
    df = spark.createDataFrame([(*r, "NATIONAL", "R") for r in rows], "program_id int, source_id int, url string, name string, closing_date string, scope string, region string")
    got = {r.kept: (r.alias, r.records, r.title, r.closing_date, r.sources) for r in C.alias_dedupe(df, T.dedupe_url(F.col("url")), Q.title_core(F.col("name")), Q.CATALOGUE_PATHS).collect()}
    assert got[1] == ("url:https://a.org/x", 2, "Un", "2027-01-01", "8|9") and got[3][:3] == ("title:vert|NATIONAL|FRANCE", 2, "Appel à projet Vert") and got[5][0] == "title:autre|NATIONAL|FRANCE"


def test_fit_scores(spark):
    from fundsieve.operators import scoring as S

    rows = [(1, "PME", "R1", 10.0, "NATIONAL", "R2", True, None, 5.0, None, "PME|ETI"), (2, "GE", "R1", 1.0, "REGIONAL", "R1", False, "2020-01-01", 5.0, None, "PME"), (3, "À préciser", "R1", 0.0, "REGIONAL", "R2", False, None, None, None, "PME")]
    df = spark.createDataFrame(rows, "id int, category string, company_region string, budget double, scope string, region string, permanent boolean, closing_date string, min_cost double, max_cost double, company_categories string")
    got = {r.id: (r.calendar, r.finance, r.territory, r.size, round(r.access, 3)) for r in S.fit_scores(df, F.lit("2026-01-01"), F.lit(False)).collect()}
    assert got == {1: (1.0, 1.0, 1.0, 1.0, 1.0), 2: (0.0, 0.0, 1.0, 0.0, 0.58), 3: (0.55, 0.5, 0.0, 0.55, 0.231)}


def test_finance_and_calendar_sentences(spark):
    texts = [
        (1, "Montant de l'aide : au plus 20 k€. Dépenses éligibles minimum de 50 000 €. Intensité jusqu'à 30 %."),
        (2, "Coût total supérieur à 10 000 €, valeur 45 %."),
        (3, "Date limite de dépôt : 2026-03-01. Relève le 15 janvier 2027. Ouverture le 2025-12-01. Session du 2026-01-05."),
        (4, "Dépôt au fil de l'eau. Rapport du 2026-02-02."),
    ]
    df = spark.createDataFrame(texts, "k int, text string")
    got = {r.k: tuple(r)[1:] for r in X.financial_terms(df, "k").collect()}
    # no sentence of 1 joins the amount to its heading, so the aid falls back on all amounts; one cost makes no maximum
    assert got[1] == (20000.0, 50000.0, 30.0, 30.0, 50000.0, None)
    assert got[2] == (10000.0, 10000.0, 45.0, 45.0, 10000.0, None)
    dates = {r.k: tuple(r)[1:] for r in X.calendar(df, "k").collect()}
    assert dates[3] == ("2025-12-01", "2026-03-01", 3, False)
    assert dates[4] == (None, None, 0, True)
    sizes = spark.createDataFrame([(1, "PME : 45 % et 10 k€, ETI : 35 %."), (2, "Pour toutes.")], "k int, text string")
    # a colon ends a sentence, so what stands before "ETI :" is said of ETI
    assert {(r.category, r.rate_min, r.amount_max) for r in X.terms_by_size(sizes, ["k"]).collect()} == {("PME", None, None), ("ETI", 45.0, 10000.0)}


def test_listing_links_and_counters(spark):
    rows = [("Suivant", "/a", True), ("Page 3", "/a", True), ("12", "/a", True), ("Les 12", "/a", False), ("x", "/a?x=1&P=2", True), ("x", "/a?my%43urrentPage=4", True), ("x", "/a?p=z", False), ("x", "/a?p=%zz", False)]
    df = spark.createDataFrame(rows, "label string, url string, want boolean")
    assert df.where(X.pagination_link(F.col("label"), F.col("url")) != F.col("want")).count() == 0
    told = [("Avance remboursable", "/x", True), ("Contact", "/subventions/1", True), ("Contact", "/x", False), ("lami", "/x", False)]
    assert spark.createDataFrame(told, "label string, url string, want boolean").where(X.relevant_link(F.col("label"), F.col("url")) != F.col("want")).count() == 0
    assert one(spark, "<b>175</b> puis 175 Résultat(s)", X.result_counter) == 175
    assert one(spark, "326 aide(s) & service(s)", X.result_counter) == 326
    assert one(spark, "aucun", X.result_counter) is None


def test_environment_is_suspect_when_nothing_answers(spark):
    probes = spark.createDataFrame([("INGESTION", "TIMEOUT")] * 21 + [("CONTROL", "HTTP_ERROR")] * 3, "role string, state string")
    got = {r.role: r for r in C.source_health(probes).collect()}
    assert got["ALL"].environment_suspect and got["INGESTION"].environment_suspect and not got["CONTROL"].environment_suspect
    assert (got["ALL"].total, got["ALL"].conclusive, got["ALL"].failed) == (24, 3, 24)


def test_parts_are_held_against_their_manifest(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "id % 7 AS part")
    files.write_parts(rows, str(tmp_path / "a"), ["part"])
    assert files.read_parts(spark, str(tmp_path / "a"), "id long, part long", ["part"]).count() == 100
    rows.where("id = 3").write.mode("append").partitionBy("part").json(str(tmp_path / "a" / "parts"))
    with pytest.raises(ValueError):
        files.read_parts(spark, str(tmp_path / "a"), "id long, part long", ["part"])


def test_all_terms_search_with_common_and_absent_words(spark):
    docs = spark.createDataFrame([(1, "alpha beta gammas"), (2, "alpha beta"), (3, None), (4, "alpha alpha gamma beta")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "beta gamma alpha"), (2, "alpha omega"), (3, ""), (4, "alphas")], "item_id long, text string")
    got = {(r.item_id, r.doc_id) for r in S.all_terms(docs, queries).collect()}
    assert got == {(1, 1), (1, 4), (4, 1), (4, 2), (4, 4)}

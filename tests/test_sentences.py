"""Sentences and what is picked from them against the SQL, on odd texts."""

import shutil
from pathlib import Path

import pytest
from oracle import connect, differ
from pyspark.sql import functions as F

import __spark_entry__
from fundsieve.functions import text as T

GIVEN = Path("/root/testdata/sf0.001")
ODD = [
    None,
    "",
    "Null. 156 the first. 2 und 2\n  28.68.191.238 the und.  \n3 and 3 der.",  # digits that equal a sentence's number
    "\u00a0The\u3000 and der.\u2003\nabc\u00a0\n \u00a0 los und \u202f; x",
    "Ein Satz.\x0bUnd the same: \x0cund nicht;\x1c the and",
    "Un texte. LES ÉANÉ DE la, LOS Éan und.\nThe Éan de aiê la.",
    "Dıe leſ and the. THE \u212aIT und DER PoUr lei. Thİ les, and QUE QuE.",
    "İİİİ Licensed UNDER the and. İ und der, cookıes. " * 3,
    "x" * 200 + "İ Licensed under the der and " + "y" * 400,
    "aaaa. bbbb the; aaaa. bbbb the. und dddd",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    for p in GIVEN.iterdir():
        (d / p.name).symlink_to(p)
    docs = [(i, t, "fr", "s", len(t or "")) for i, t in enumerate(ODD)]
    pages = [(i, "https://x.example.org/en/1", None if t is None else f"<h1>{t}</h1><p>\u00a0{t}\u00a0</p><br\x0b/>{t} <p>with</p>") for i, t in enumerate(ODD)]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("pages", pages, "page_id long, url string, html string")):
        (d / f"{name}.parquet").unlink()
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}")
        shutil.copy(next((d / name).glob("part-*")), d / f"{name}.parquet")
    return str(d)


def test_sentences_lose_spaces_only(spark):
    row = spark.createDataFrame([("a b c. 1 then. 2",)], "t string").select(T.sentences(F.lit(" none:  first 1. 1,2,3 ;\t 2 two 2\n 33.3 ")).alias("s")).first()
    assert row.s == ["none:", "first 1.", "1,2,3 ;", "2 two 2", "33.3"]


@pytest.mark.parametrize("name", ["b9_sentences", "c14_regulatory_fallback", "c15_operator_evidence", "c16_evidence", "c19_official_page", "c21_enterprise_evidence"])
def test_odd_texts_equal_the_sql(spark, odd, name):
    assert differ(spark, connect(odd), __spark_entry__.queries()[name], __spark_entry__.oracle_sql()[name], odd) is None

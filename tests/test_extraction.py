"""Golden rows of the extraction, file and scoring operators."""

from pyspark.sql import functions as F

from fundsieve.operators import audit as A
from fundsieve.operators import extraction as X
from fundsieve.operators import scoring as S
from fundsieve.sources import files


def test_sections_and_fallback(spark):
    html = "<nav><p>menu</p></nav><h1>Titre</h1><p>Objet du texte.</p><h2>Calendrier</h2><p>Avant mars.</p><h3>Autre</h3><p>Suite.</p>"
    rows = X.sections(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html", [("calendar", ["calendrier"])]).collect()
    assert {(r.id, r.section, r.text) for r in rows} == {(1, "objective", "Objet du texte."), (1, "calendar", "Avant mars. \n Suite.")}


def test_feed_and_csv(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("<rss><channel><item><link>https://a.org/1</link><title>Un &amp; deux</title></item><item><link>https://a.org/2</link></item></channel></rss>")
    assert [(r.link, r.title) for r in files.read_feed(spark, str(tmp_path / "feed.xml")).orderBy("link").collect()] == [("https://a.org/1", "Un & deux"), ("https://a.org/2", None)]
    rows = spark.createDataFrame([(1, 'dit "oui", puis', ["a", "b"]), (2, "deux\nlignes", ["c"])], "id int, t string, l array<string>")
    files.write_csv(rows, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), "id int, t string, l string")
    assert sorted(map(tuple, back.collect())) == [(1, 'dit "oui", puis', "a | b"), (2, "deux\nlignes", "c")]


def test_samples_and_shortlist(spark):
    hits = spark.range(1000).select(F.col("id"), F.lit("r").alias("rule"))
    row = A.counted_samples(hits, "rule", "id", 5).first()
    assert (row.n, row.samples) == (1000, [0, 1, 2, 3, 4])
    scored = spark.createDataFrame([(1, i, 100 - i) for i in range(10)], "c int, p int, score int")
    got = S.shortlist(scored, "c", "p", [F.desc("score"), "p"], [("A", F.col("score") > 95, 2), ("B", F.col("score") > 90, 3)]).collect()
    assert {(r.p, r.tier) for r in got} == {(0, "A"), (1, "A"), (2, "B"), (3, "B"), (4, "B")}

"""Running totals, rows near in time, sitemap closures and domain counts against plain loops."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fundsieve.operators import ordering as N
from fundsieve.operators import scoring as S


def test_running_total_equals_a_loop(spark):
    r = random.Random(1)
    rows = [(k, r.randrange(0, 90)) for k in r.sample(range(10**6), 400)]
    df = spark.createDataFrame(rows, "k long, size int").repartition(3)
    want, at = {}, 0
    for k, size in sorted(rows):
        want[k], at = at, at + size
    for parts in (1, 7, 600):
        assert {x.k: x.at for x in N.running_total(df, "k", F.col("size"), "at", parts).collect()} == want
    assert N.running_total(df.limit(0), "k", F.col("size"), "at", 4).count() == 0


def test_packed_parts_equal_a_cumulative_floor(spark):
    r = random.Random(2)
    rows = [(k, "x" * r.randrange(1, 50)) for k in range(300)]
    want, at = {}, 0
    for k, text in rows:
        part = want.setdefault(at // 100, [0, 0, k, k])
        part[0], part[1], part[3], at = part[0] + 1, part[1] + len(text), k, at + len(text)
    got = {x.part: [x.n, x.chars, x.first_key, x.last_key] for x in N.packed(spark.createDataFrame(rows, "k long, text string"), "k", F.col("text"), 100, 5).collect()}
    assert got == want


def test_fresh_coverage_equals_a_theta_join(spark):
    r = random.Random(3)
    day = dt.datetime(2026, 3, 29)
    when = lambda: day + dt.timedelta(seconds=r.randrange(-90000, 90000)) if r.random() > 0.05 else None
    runs = [(i, r.randrange(5), when(), r.random() < 0.7, r.randrange(9)) for i in range(150)]
    builds = [(1000 + i, r.choice([None, i * 7]), when()) for i in range(20)] + [(2000, None, runs[0][2] and runs[0][2] + dt.timedelta(hours=6))]
    want = {}
    for build, cycle, at in builds:
        best = {}
        for c, source, checked, success, imported in runs:
            if c == cycle:
                rank = (0, 0, c)
            elif at and checked and abs(at - checked) <= dt.timedelta(hours=6):
                rank = (1, abs(at - checked), c)
            else:
                continue
            if source not in best or (rank[0], rank[1] if rank[0] else dt.timedelta(0), c) < best[source][0]:
                best[source] = ((rank[0], rank[1] if rank[0] else dt.timedelta(0), c), success, imported)
        if best:
            want[build] = (len(best), sum(b[1] for b in best.values()), sum(b[2] for b in best.values()))
    b = spark.createDataFrame(builds, "build_id long, cycle long, generated_at timestamp")
    t = spark.createDataFrame(runs, "cycle_id long, source_id long, checked_at timestamp, success boolean, imported long")
    assert {x.build_id: (x.fresh, x.successful, x.imported) for x in N.fresh_coverage(b, t, 6 * 3600).collect()} == want


def test_sitemap_closure_ends_in_cycles(spark):
    index = lambda *urls: "<SITEMAPINDEX>" + "".join(f"<loc> {u} </loc>" for u in urls) + "</SITEMAPINDEX>"
    maps = [("a", index("b", "c", "a", "gone")), ("b", index("a", "d")), ("c", "<urlset><loc>p1</loc><LOC>p2&amp;x</LOC><loc> </loc></urlset>"), ("d", "<urlset><loc>p1</loc><loc>p3</loc></urlset>"), ("e", "<urlset><loc>p9</loc></urlset>"), ("f", None)]
    starts = [(1, "a"), (1, "a"), (2, "d"), (3, "missing"), (4, "b"), (5, "f")]
    m, s = spark.createDataFrame(maps, "url string, xml string"), spark.createDataFrame(starts, "source_id long, url string")
    every = {"p1", "p2&x", "p3"}
    found = lambda **k: {(x.source_id, x.url) for x in N.sitemap_pages(m, s, **k).collect()}
    assert found() == {(1, u) for u in every} | {(2, "p1"), (2, "p3")} | {(4, u) for u in every}
    assert found(most_maps=3) == {(1, "p1"), (1, "p2&x"), (2, "p1"), (2, "p3"), (4, "p1"), (4, "p3")}


def test_specialised_mismatch(spark):
    lexicon = {"sea": ["port", "ship", "sail"], "farm": ["cow", "field", "corn"]}
    docs = spark.createDataFrame([(1, "Ports and ships sail"), (2, "a port, a ship"), (3, "cow field corn port ship sail"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a sailing boat"), (2, "wheat"), (3, None)], "item_id long, text string")
    pairs = spark.createDataFrame([(i, d) for i in (1, 2, 3) for d in (1, 2, 3, 4)], "item_id long, doc_id long")
    got = {(x.item_id, x.doc_id, x.domain) for x in S.specialised_mismatch(pairs, docs, items, lexicon).collect()}
    assert got == {(1, 3, "farm"), (2, 1, "sea"), (2, 3, "sea"), (2, 3, "farm"), (3, 1, "sea"), (3, 3, "sea"), (3, 3, "farm")}


def test_first_pages_equal_contains(spark):
    from fundsieve.operators import locate

    r = random.Random(9)
    pages, pieces = [], []
    for d in range(12):
        texts = ["".join(r.choice("abé ") for _ in range(r.randrange(0, 260))) for _ in range(4)]
        texts += texts[:1] + [None]
        pages += [(d, n, t) for n, t in enumerate(texts)]
        for i in range(30):
            t = r.choice([x for x in texts if x is not None])
            at = r.randrange(0, max(1, len(t)))
            piece = t[at : at + r.choice([5, 69, 70, 71, 120])]
            pieces.append((d, i, r.choice([piece, piece, piece, piece + "zz", piece[:40] + "q" * 40, None, ""])))
    docs = {d: [(n, t or "") for e, n, t in pages if e == d] for d in range(12)}
    want = {(d, i): min((n for n, t in docs[d] if p and p[:70] in t), default=None) for d, i, p in pieces}
    got = locate.first_pages(spark.createDataFrame(pages, "doc_id long, page int, text string"), spark.createDataFrame(pieces, "doc_id long, piece_id int, piece string"))
    assert {(x.doc_id, x.piece_id): x.page for x in got.collect()} == want
    assert sum(v is not None for v in want.values()) > 100

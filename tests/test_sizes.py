"""Plans that do not write or shuffle pairs of all with all, held against loops."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from fundsieve.operators import locate
from fundsieve.operators import merging as G
from fundsieve.operators import ordering as N
from fundsieve.operators import scoring as S
from fundsieve.operators import search as L
from fundsieve.plans import search as P


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_substring_search_shuffles_no_pairs(spark):
    r = random.Random(8)
    docs = [(i, f"Programme {r.randrange(10**6)} " + " ".join(r.sample(["europe", "asia", "pme", "eti"], 2))) for i in range(300)]
    asked = [(i, f"{r.choice(['europe', 'asi', 'pm'])} {r.choice(['eti', 'pme', 'programmes'])} {i % 100} {r.choice(['rog 1', 'a', 'nothere', '', 'e eu o pr am'])}") for i in range(80)]
    got = L.contains_all(spark.createDataFrame(docs, "doc_id long, t string"), spark.createDataFrame(asked, "item_id long, text string"), ["t"], {}, {}, levels=2, frequent=20)
    assert not re.search(r"Exchange hashpartitioning\([^)]*item_id", plan(got))
    terms = lambda q: {w[:-1] if len(w) > 4 and w.endswith("s") else w for w in q.split() if len(w) > 1}
    want = [(q, d) for q, asks in asked for d, text in docs if terms(asks) and all(w in text.lower() for w in terms(asks))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_coverage_by_running_sums_equals_pairs(spark):
    r = random.Random(11)
    when = lambda: None if r.random() < 0.05 else datetime(1969, 12, 31, 22) + timedelta(seconds=r.randrange(0, 9000, 300), microseconds=r.randrange(3))
    runs = [(r.choice([None, *range(40)]), r.choice([None, 1, 2, 3]), when(), r.choice([None, True, False]), r.choice([None, 1, 5])) for _ in range(120)]
    builds = [(r.choice([None, *range(30)]), r.choice([None, *range(40)]), when()) for _ in range(40)]
    builds += builds[:5]
    b, t = spark.createDataFrame(builds, "build_id long, cycle long, generated_at timestamp"), spark.createDataFrame(runs, "cycle_id long, source_id long, checked_at timestamp, success boolean, imported int")
    for seconds in (600, 1):
        pairs = N.best_by_pairs(b, t, seconds).collect()
        want = {}
        for x in pairs:
            n, ok, got = want.get(x.build_id, (0, 0, None))
            want[x.build_id] = (n + 1, ok + bool(x.f.success), got if x.f.imported is None else (got or 0) + x.f.imported)
        assert {x.build_id: (x.fresh, x.successful, x.imported) for x in N.fresh_coverage(b, t, seconds).collect()} == want
        # Each microsecond belongs to one run of a source at most.
        last = {}
        for x in N.reigns(t, seconds).orderBy("source_id", "first").collect():
            assert last.get(x.source_id, x.first - 1) < x.first <= x.last
            last[x.source_id] = x.last


def test_fold_moves_dealt_records_once_and_keeps_null_keys(spark):
    r = random.Random(5)
    rows = [(r.choice([None, 1, 2, 3]), i, r.choice(["A", "B", None]), r.choice([None, "", "x y z", "abcd"]), r.choice([None, ["a", "", "b"], ["c", "a"], []]), r.choice([None, ["p", ""], ["p"]])) for i in range(60)] + [(9, 100, "C", "t", ["", "z"], None)]
    t = spark.createDataFrame(rows, "k long, seq int, tier string, v string, u array<string>, chain array<string>")
    t = t.repartition("k").sortWithinPartitions("k", "seq")
    nothing = {c: F.lit(None).cast("string") for c in ("title", "official_page", "lifecycle", "last_seen")}
    got = G.fold_records(t.withColumns(nothing), ["k"], ["seq"], F.when(F.col("tier") == "A", 2).when(F.col("tier") == "B", 1), [], ["v"], [], ["u"], ["chain"], together=3)
    dealt = re.findall(r"Exchange hashpartitioning\((k#\d+L), \d+\), (\w+)", plan(got))
    assert dealt and all(how == "REPARTITION_BY_COL" for _, how in dealt)
    want = {}
    for k, _, _, _, u, chain in sorted(rows, key=lambda x: x[1]):
        us, cs = want.setdefault(k, ([], []))
        us += [x for x in u or [] if x and x not in us]
        cs += chain or []
    want[9] = (["", "z"], [])  # a lone record's list stays as it is
    assert {x.k: (x.u, x.chain) for x in got.collect()} == want


@pytest.mark.parametrize("name", ["k8_eligibility", "k14_points_to_secure", "k7_relevance", "k5_fit_scores"])
def test_pairs_are_made_where_programmes_lie(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(__spark_entry__.queries()[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [territory_key" in text and "SortMergeJoin [territory_key" not in text
    # Nothing behind the pairs is shuffled.
    assert not re.search(r"Exchange (?!Broadcast)[^\n]*company_id", text.split("BroadcastHashJoin [territory_key")[0])


def test_shortlist_of_leading_pairs_equals_that_of_all(spark):
    r = random.Random(2)
    day = datetime(1998, 6, 30)
    programs = [(i, r.choice([None, True, False]), r.choice([None, (day + timedelta(days=r.randrange(-3, 3))).date()]), r.choice([None, *range(0, 90, 10)]), r.choice([None, *range(10, 200, 10)]), r.choice(["PRET", "OTHER"]), r.choice(["NATIONAL", "REGIONAL"]), r.choice(["ASIA", "EUROPE", None]), r.choice([None, "PME", "PME|GE"])) for i in range(700)]
    asked = [(i, r.choice(["PME", "GE", "À préciser"]), r.choice([None, 0, 5, 30, 60, 1000]), r.choice(["ASIA", "EUROPE", "AFRICA", None])) for i in range(60)]
    q = spark.createDataFrame(programs, "program_id long, permanent boolean, closing_date date, min_cost int, max_cost int, instrument string, scope string, region string, company_categories string").withColumns({c: F.col(c).cast("double") for c in ("min_cost", "max_cost")})
    p = spark.createDataFrame(asked, "company_id long, category string, budget int, company_region string").withColumn("budget", F.col("budget").cast("double"))
    score = lambda p, q, pair: P.scored(S.fit_scores(p, q, P.day(), P.has_terms(), pair=pair))
    tiers = [("A", (F.col("score") >= 90) & (F.col("documented") >= 4), 2), ("B", (F.col("score") >= 70) & (F.col("documented") >= 3), 3), ("C", F.lit(True), 2)]
    order = [F.desc("score"), "program_id"]
    want = S.shortlist(score(p, q, S.by_territory), "company_id", "program_id", order, tiers)
    leading = S.leading_pairs(p, q, score, "company_id", "program_id", P.kinds(), "min_cost", "max_cost", tiers, first=2, growth=3)
    got = S.shortlist(leading, "company_id", "program_id", order, tiers)
    rows = lambda t: sorted((x.company_id, x.program_id, x.score, x.tier) for x in t.collect())
    assert rows(got) == rows(want) and leading.count() < score(p, q, S.by_territory).count() / 4


def test_pieces_and_pages_pick_the_same_runs(spark):
    r = random.Random(6)
    for letters in ("abé \U0001f642", "a"):
        text = "".join(r.choice(letters) for _ in range(400))
        at, numbers = locate.picks(text, 70)
        page = dict(zip(at.tolist(), numbers.tolist(), strict=True))
        for i in range(len(text) - 69):
            inside, number = locate.picks(text[i : i + 70], 70)
            assert page[i + int(inside[0])] == int(number[0])
    pages = spark.createDataFrame([(1, 0, text)], "doc_id long, page int, text string")
    # No text goes with the runs that pages and pieces meet by.
    assert [f.name for f in locate.picked(pages, ["doc_id", "page"], "text", 70, False).schema] == ["doc_id", "page", "at", "hash"]

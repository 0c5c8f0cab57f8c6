"""Retrieval by bounds, substring search, folds and first rows against plain loops on random small tables."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from fundsieve.operators import catalogue as C
from fundsieve.operators import matching as M
from fundsieve.operators import merging as G
from fundsieve.operators import search as L
from fundsieve.plans import audit as P

CONCEPTS = [("a", "(^|[^a-z0-9])(w1|w2)($|[^a-z0-9])"), ("b", "(^|[^a-z0-9])w3($|[^a-z0-9])"), ("c", "(^|[^a-z0-9])rare7($|[^a-z0-9])")]


def texts(spark, seed, n, size, key):
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.7)) % 40}" if r.random() < 0.8 else f"rare{r.randrange(300)}"
    rows = [(i, " ".join(word() for _ in range(r.randrange(size)))) for i in range(n)] + [(n, None), (n + 1, "")]
    return spark.createDataFrame(rows, f"{key} long, text string")


@pytest.mark.parametrize("k", [1, 4, 1000])
def test_top_by_bounds_equals_full_scoring(spark, k):
    docs, items = texts(spark, 1, 250, 60, "doc_id"), texts(spark, 2, 25, 30, "item_id")
    fields = docs.select("doc_id", F.substring("text", 1, 20).alias("title"), F.col("text").alias("objective"))
    boosts = {"title": 3.2, "objective": 2.4}
    full = M.top(M.bm25f(fields, items, boosts).withColumn("s", F.round("bm25", 6)), "item_id", "s", "doc_id", k)
    best = M.top_bm25f(fields, items, boosts, k).withColumn("s", F.round("bm25", 6))
    rows = lambda t, *c: sorted(tuple(x[y] for y in c) for x in t.collect())
    assert rows(best, "item_id", "rank", "doc_id", "s") == rows(full, "item_id", "rank", "doc_id", "s")
    full = M.top(M.overlap(docs, items, CONCEPTS).where("hits > 0"), "item_id", "ratio", "doc_id", k)
    names = ("item_id", "rank", "doc_id", "ratio", "hits", "bigram_hits", "concept_hits")
    assert rows(M.top_overlap(docs, items, CONCEPTS, k, seeds=2), *names) == rows(full, *names)


def test_light_terms_make_no_candidates(spark):
    docs = spark.createDataFrame([(i, "common " + ("needle exact" if i < 3 else f"other{i}")) for i in range(60)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "common needle exact")], "item_id long, text string")
    got = M.top_bm25f(docs, items, {"text": 1.0}, 3)
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2]
    assert M.top_bm25f(docs.limit(0), items, {"text": 1.0}, 3).count() == 0
    assert M.top_overlap(docs, items.limit(0), CONCEPTS, 3).count() == 0


def plain_norm(text):
    text = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", text.replace("’", "'")).strip()


def test_substring_search_equals_contains(spark):
    r = random.Random(4)
    bits = ["bpi", "france", "Bpifrance", "énergie", "aides", "x", "les", "solaire", "sol", "ère", "n°7", "programmes", "%"]
    docs = [(i, *[r.choice([None, " ".join(r.choices(bits, k=r.randrange(4)))]) for _ in range(3)]) for i in range(200)]
    asked = [(i, " ".join(r.choices([*bits, "sola", "ergi", "programm", "en", "7", "pif"], k=r.randrange(4)))) for i in range(60)] + [(98, None), (99, "")]
    got = L.contains_all(spark.createDataFrame(docs, "doc_id long, a string, b string, c string"), spark.createDataFrame(asked, "item_id long, text string"), ["a", "b", "c"], {"bpi france": "bpifrance"}, {"bpifrance": "bpi"})
    want = []
    for q, text in asked:
        terms = [w for w in re.sub(r"\bbpi france\b", "bpifrance", plain_norm(text or "")).split(" ") if len(w) > 1 and w not in L.PASSED_OVER]
        for d, *fields in docs:
            raw = plain_norm(" ".join(f for f in fields if f is not None))
            held = re.sub(r"\bbpi france\b", "bpifrance", raw) + (" bpi" if "bpifrance" in raw else "")
            if terms and all(t in held or len(t) > 4 and t.endswith("s") and t[:-1] in held for t in terms):
                want.append((q, d))
    assert sorted((x.item_id, x.doc_id) for x in got.collect()) == sorted(want) and len(want) > 50


def test_first_of_either_equals_a_loop(spark):
    r = random.Random(5)
    pick = lambda n: r.choice([None, "", *[f"k{r.randrange(n)}" for _ in range(6)]])
    rows = [(s, pick(25), pick(25), "x") for s in range(150)] + [(200 + i, f"c{(i + 1) // 2}", f"d{i // 2}", "chain") for i in range(12)]
    ids, pages, want = set(), set(), []
    for s, a, b, _ in rows:
        if (a and a in ids) or (b and b in pages):
            continue
        ids.add(a), pages.add(b), want.append(s)
    df = spark.createDataFrame(rows, "seq long, id string, page string, other string").repartition(5)
    assert sorted(x.seq for x in G.first_of_either(df, ["id", "page"], ["seq"]).collect()) == want
    assert G.first_of_either(df.limit(0), ["id", "page"], ["seq"]).count() == 0


def plain_fold(rows, order):
    """The records of one key, folded one by one."""
    rank = {"A": 4, "B": 3, "C": 2, "D": 1}
    nothing = lambda t: len(plain_norm(t or "")) < 4 or bool(re.search(G.NO_TITLE, plain_norm(t or "")))
    doc = lambda p: bool(re.search(G.DOCUMENT, p or ""))

    def worth(p):
        if not re.match("(?i)https?:", p or ""):
            return 0
        path = re.sub("/+$", "", re.match(r"(?i)https?://[^/?#]*([^?#]*)", p)[1]).lower() or "/"
        return 1 if path in ("/", "/aides") else 2 if doc(path) else 3

    rows = sorted(rows, key=lambda x: x["seq"])
    out = dict(rows[0], records=1)
    most = rank.get(out["tier"], 0)
    for b in rows[1:]:
        rb, out["records"] = rank.get(b["tier"], 0), out["records"] + 1
        for c in P.SCALARS:
            if b[c] and (not out[c] or rb > most):
                out[c] = b[c]
        for c in P.FROM_EQUAL:
            if b[c] is not None and rb >= most:
                out[c] = b[c]
        for c in P.UNIONS:
            out[c] = list(dict.fromkeys(x for x in [*(out[c] or []), *(b[c] or [])] if x))
        if not (doc(b["official_page"]) and not nothing(out["title"])) and not nothing(b["title"]) and (nothing(out["title"]) or rb > most):
            out["title"] = b["title"]
        x, y = out["official_page"], b["official_page"]
        if not (x and not doc(x) and doc(y)):
            out["official_page"] = y if y and not doc(y) and doc(x) or worth(y) > worth(x) else x or y or None
        out["lifecycle"] = next((s for s in G.LIFECYCLE if s in (out["lifecycle"], b["lifecycle"])), out["lifecycle"])
        out["last_seen"] = b["last_seen"] or out["last_seen"]
        out["chain"] = (out["chain"] or []) + (b["chain"] or [])
        out["tier"] = b["tier"] if rb > most else out["tier"]
        most = max(most, rb)
    return {**out, "tier_rank": most, "chain": out["chain"] or []}


def test_fold_equals_a_loop(spark):
    r = random.Random(6)
    pages = [None, "https://a.org/p", "https://a.org/q", "https://a.org/x.pdf", "https://a.org/y.DOCX?v=1", "https://a.org/aides/", "http://a.org", "ftp://a.org/z", "HTTPS://A.org/Aides"]
    titles = [None, "", "abc", "Page introuvable", "Désolé, offre plus disponible", "Aide au vélo", "Prêt vert", "Fonds"]
    one = lambda k, s: {"k": k, "seq": s, "tier": r.choice(["A", "B", "C", "D", "?"]), "title": r.choice(titles), "official_page": r.choice(pages), "lifecycle": r.choice([*G.LIFECYCLE, "DRAFT", None]), "last_seen": r.choice([None, f"t{s}"]), "chain": r.choice([None, [], [f"e{s}"]]), **{c: r.choice([None, "", f"v{s}"]) for c in P.SCALARS}, **{c: r.choice([None, f"t{s}"]) for c in P.FROM_EQUAL}, **{c: r.choice([None, [], ["", "x"], ["x", "y", "x"], [f"u{s}"]]) for c in P.UNIONS}}
    rows = [one(k, s) for k in range(80) for s in range(r.randint(1, 6))]
    kinds = {c: "array<string>" for c in (*P.UNIONS, "chain")} | {"k": "int", "seq": "int"}
    df = spark.createDataFrame([tuple(x.values()) for x in rows], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in rows[0]))
    got = {x.k: x.asDict() for x in G.fold_records(df, ["k"], ["seq"], C.tier_rank(F.col("tier")), ["/", "/aides"], P.SCALARS, P.FROM_EQUAL, P.UNIONS, ["chain"]).collect()}
    for k in range(80):
        want = plain_fold([x for x in rows if x["k"] == k], "seq")
        assert got[k] == {c: v for c, v in want.items() if c != "seq"}


def test_stale_only_by_a_safe_owner_and_unseen(spark):
    before = spark.createDataFrame([(1, 1, None), (2, 2, [1, 3]), (3, 2, None), (4, 1, []), (5, 9, [None, 1]), (6, None, None)], "k int, s int, al array<int>")
    seen, safe = spark.createDataFrame([(4,), (8,)], "k int"), spark.createDataFrame([(1,), (1,)], "s int")
    assert sorted(x.k for x in G.stale_by_owner(before, seen, safe, "k", "s", "al").collect()) == [1, 2, 5]


def test_feed_joins_by_id_else_title(spark):
    from fundsieve.operators import audit as A

    programs = spark.createDataFrame([(1, "Aide au vélo"), (2, "Prêt vert"), (3, "prêt  vert"), (4, None)], "k long, title string")
    feed = spark.createDataFrame([(1, "other"), (9, "PRET VERT"), (8, "unknown"), (7, None)], "k long, title string")
    got = {x.k: (x.programme_id, x.by) for x in A.joined_feed(feed, programs, "k", "title").collect()}
    assert got == {1: (1, "id"), 9: (2, "title"), 8: (None, None), 7: (None, None)}

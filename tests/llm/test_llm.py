"""The training-data operators against brute force, exact round trips and held-out accuracy, on small tables and odd rows."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from fundsieve.llm import bpe, decontam, hostrank, imatch, langid, licenses, neardup, pagediff, queries, toxicity, warc
from fundsieve.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
ODD = [(1, None, None), (2, "", "en"), (3, "one", "en"), (4, "a b c d e f g h", "en"), (4, "a b c d e f g h", "en"), (None, "a b c d e f g h", "en"), (6, "x " * 30000, "fr"), (7, "日本語 テキスト ÀÉ", None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, value string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "s", 0, 0.5, 9, "v") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_word_hashes_tell_words_apart():
    texts = ["Ab c\n ab", None, "", "c", "é É"]
    h, at = word_hashes(pa.array(texts), "space")
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    assert at.tolist() == [0, 3, 3, 3, 4, 6]
    assert [h.tolist().index(x) for x in h.tolist()] == [words.index(w) for w in words]


def test_near_duplicates_equal_brute_force(spark, docs):
    rows = {r.doc_id: r for r in neardup.near_duplicates(docs, 3, 85, hot=2).collect()}
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets[r.doc_id] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    assert {i: rows[i].component_id for i in sets} == comp
    assert all(rows[i].n_shingles == len(sets[i]) and rows[i].kept == (comp[i] == i) for i in sets)


def test_near_duplicates_odd(odd, empty):
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (None, 4, None), (6, 6, True), (7, 7, True)], key=str)
    assert neardup.near_duplicates(empty).count() == 0
    assert sorted((r.doc_id for r in neardup.one_of_each(odd).collect()), key=str) == [1, 2, 3, 4, 6, 7, None]


def test_near_duplicates_of_repeated_ids(spark):
    text = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    rows = [(1, text(0, 60)), (2, text(1, 60)), (3, text(0, 59)), (3, text(100, 160)), (4, text(101, 160)), (5, text(200, 260)), (6, None), (6, text(201, 260)), (7, ""), (None, text(100, 160))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 48):
        got = sorted(((r.doc_id, r.component_id) for r in neardup.near_duplicates(docs, hot=hot).collect()), key=str)
        assert got == sorted([(1, 1), (2, 1), (3, 1), (3, 1), (4, 1), (5, 5), (6, 5), (6, 5), (7, 7), (None, 1)], key=str)
    two = spark.createDataFrame([(3, text(0, 60)), (3, text(100, 160)), (3, text(0, 60)), (4, text(1, 60))], "doc_id long, text string")
    assert sorted(r.text for r in neardup.one_of_each(two).collect()) == sorted([text(0, 60), text(100, 160)])


def test_near_duplicates_in_hot_lists_equal_brute_force(spark):
    """Copies with few and many edits around one text, and texts that share one passage: every list is hot."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False).tolist():
            words[at] = f"e{i}_{at}"
        rows.append((i, " ".join(words)))
    for i in range(150, 260):
        rows.append((i, " ".join([f"o{i}_{k}" for k in range(rng.integers(3, 40))] + base[:30] + [f"p{i}_{k}" for k in range(rng.integers(0, 3))])))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, hot=3).collect()}
    assert got == comp and len(set(comp.values())) > 50


def test_bpe_equals_tiktoken(spark, docs, odd):
    path = public_tokenizers.path(queries.BPE_RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    both = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    want = sorted((len(i := enc.encode_ordinary(t := r.text or "")), sha(",".join(map(str, i)).encode()), sha(t.encode())) for r in both.collect())
    assert sorted(tuple(r)[1:] for r in bpe.round_trip(both, path, public_tokenizers.PATTERN).collect()) == want
    few = spark.createDataFrame([(1, "Héllo 🙂 日本"), (2, None)], "doc_id long, text string")
    tokens = bpe.encode(few, path, public_tokenizers.PATTERN, offsets=True)
    assert tokens.where("doc_id = 1").first().ends[-1] == len("Héllo 🙂 日本")
    assert {r.doc_id: r.text for r in bpe.decode(tokens, path, public_tokenizers.PATTERN).collect()} == {1: "Héllo 🙂 日本", 2: ""}


def test_leaks(spark, docs, odd, empty):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    norm = lambda s: " " + " ".join(re.findall(r"[^\W_]+", s.lower())) + " "
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if norm(i.text) in norm(d.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.leaks(docs, items).collect()}
    assert want <= set(got) and all(got[k] == 0 for k in want)
    item = items.first()
    words = item.text.split()
    words[3], words[7:7] = "zzz", ["yyy"]
    near = spark.createDataFrame([(1, "some words before " + " ".join(words) + " and after"), (2, "nothing here")], "doc_id long, text string")
    hit = decontam.leaks(near, items).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in hit] == [(1, item.item_id, 2)]
    assert decontam.leaks(odd, items).count() == 0 and decontam.leaks(empty, items).count() == 0
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert [r.doc_id for r in decontam.without_leaks(near, items).collect()] == [2]


def test_leaks_near_the_limit_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(400)]
    items, rows, want = [], [], {}
    for i in range(120):
        n = int(rng.integers(5, 41))
        words = rng.choice(vocabulary, n).tolist()
        items.append((i, " ".join(words)))
        for e in sorted({1, max(1, int(n * 0.2)), int(n * 0.2) + 3}):
            part = list(words)
            for _ in range(e):
                at = int(rng.integers(0, len(part)))
                part[at : at + int(rng.integers(0, 2))] = [f"x{rng.integers(1 << 30)}"]
            text = rng.choice(vocabulary, 30).tolist() + part + rng.choice(vocabulary, 30).tolist()
            rows.append((len(rows), " ".join(text)))
    item_words, row_words = [t.split() for _, t in items], [t.split() for _, t in rows]
    for d, text in enumerate(row_words):
        for i, words in enumerate(item_words):
            if len(set(words) & set(text)) >= len(set(words)) * 0.4:
                distance = decontam.edit_distance_within(words, text)[0]
                if distance <= int(len(words) * 0.2 + 1e-9):
                    want[d, i] = distance
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4096, 40):
        got = {(r.doc_id, r.item_id): r.distance for r in decontam.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), block=block).collect()}
        assert set(got) <= set(want) and len(got) >= 0.9 * len(want) and sum(got[k] == want[k] for k in got) >= 0.95 * len(got)


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 8)).tolist(), rng.integers(0, 4, rng.integers(0, 12)).tolist()
        row = [0] * (len(b) + 1)
        for i in range(len(a)):
            new = [i + 1]
            for j in range(len(b)):
                new.append(min(row[j] + (a[i] != b[j]), row[j + 1] + 1, new[j] + 1))
            row = new
        assert decontam.edit_distance_within(a, b)[0] == min(row)


def test_language(docs, odd, empty):
    model = langid.learn(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    held = [r for r in docs.select("doc_id", "lang", langid.held_out().alias("h")).collect() if r.h]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    preds = langid.identify(odd, model).collect()
    assert {r.doc_id: r.lang_pred for r in preds if r.doc_id in (1, 2)} == {1: "und", 2: "und"} and len(preds) == len(ODD)
    assert langid.identify(empty, langid.learn(empty)).count() == 0
    assert langid.with_language(odd, model).columns == odd.columns


def test_language_of_short_and_long_texts(spark, docs):
    """The end of a segment ends a piece in every language alike: length alone decides nothing."""
    model = langid.learn(docs)
    rows = [r for r in docs.select("text", "lang").collect() if r.lang and len(r.text) > 1000]
    short, long = (sum(p == r.lang for p, r in zip(model.predict(pa.array([f(r.text) for r in rows]))[0], rows, strict=True)) for f in (lambda t: t[:250], lambda t: " ".join([t] * 20)))
    assert short >= 0.9 * len(rows) and long >= 0.95 * len(rows)
    copies = spark.createDataFrame([(None, "aaa bbb " * 9, "xx")] * 40 + [(None, f"ccc ddd {i} " * 9, "yy") for i in range(400)], "doc_id long, text string, lang string")
    assert langid.learn(copies).languages == ["xx", "yy"]


def test_automaton_parse_is_greedy():
    model = langid.Model({"x": ["abracadabra"], "y": ["zzz"]})
    want = 0
    text, i = "abrazcadab", 0
    while i < len(text):
        n = 1
        while i + n <= len(text) and text[i : i + n + 1] in "abracadabra" and i + n < len(text):
            n += 1
        want, i = want + 1, i + n
    points = model.symbol[[ord(c) for c in text]].astype(np.int32)[:, None]
    assert model.pieces(points, np.ones_like(points, bool))[0, 0] == want


def test_no_letter_of_a_learned_language_is_folded():
    letters = lambda lo, n: "".join(map(chr, range(lo, lo + n)))
    model = langid.Model({"el": [letters(0x3B1, 17) * 9], "ru": [letters(0x430, 32) * 9], "en": [letters(97, 26) * 9], "hy": [letters(0x561, 30)], "ka": [letters(0x10D0, 30)]})
    assert model.predict(pa.array([letters(0x10D0, 12), letters(0x561, 12)]))[0] == ["ka", "hy"]
    text = letters(0x4E00, 400)
    model = langid.Model({"ja": [text[:390:2] + text[:300]], "zh": [text]})
    assert model.tables[1].table is None and model.predict(pa.array([text[50:90], text[100:200:2]]))[0] == ["zh", "ja"]


def test_toxicity(spark, docs, labels, odd, empty):
    index = toxicity.learn(docs, labels)
    got = toxicity.classify(docs, index).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.score < 0.5 for r in toxicity.classify(odd, index).collect() if r.doc_id == 1} == {1: True}
    assert toxicity.classify(empty, toxicity.learn(empty, labels.limit(0))).count() == 0
    assert {r.score for r in toxicity.classify(docs, toxicity.learn(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.without_toxic(odd, index).columns == odd.columns


def test_toxicity_of_held_out_rows_is_right_and_calibrated(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.classify(docs, toxicity.learn(docs, labels)).join(labels.where(langid.held_out() & labels.toxic.isNotNull()).select("doc_id", "toxic"), "doc_id").collect()
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert (score[toxic == 1] >= 0.5).mean() >= 0.75 and (score[toxic == 0] >= 0.5).mean() <= 0.01
    assert ((score - toxic) ** 2).mean() < 0.3 * toxic.mean() * (1 - toxic.mean())
    for lo, hi in ((0, 0.2), (0.2, 0.6), (0.6, 1.01)):  # scores mean what they say, to within a fifth
        on = (score >= lo) & (score < hi)
        assert on.sum() < 10 or abs(score[on].mean() - toxic[on].mean()) <= 0.25, (lo, score[on].mean(), toxic[on].mean())
    assert all(r.evidence for r in rows if r.score >= 0.5)


def test_ids_are_no_input_of_a_score(spark, docs, labels):
    index = toxicity.learn(docs, labels)
    moved = toxicity.Index(index.terms.keys, index.weight, [], index.base)
    moved.__dict__.update({**index.__dict__, "ids": [7 * i + 1000 for i in reversed(index.ids)]})
    texts = pa.array([r.text for r in docs.select("text").collect()])
    assert index.score(texts)[0] == moved.score(texts)[0]


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    vectors = {}
    for e in range(700):
        t = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        vectors[t.tobytes()] = (e, t, rng.integers(1, 4, len(t)), 2.0, 1.0)
    index = toxicity.Index(np.arange(30, dtype=np.uint64), np.linspace(1, 3, 30), list(vectors.values()), 0.1)
    dense = np.zeros((len(vectors), 30))
    by_id = {v[0]: v for v in vectors.values()}
    for row, i in zip(dense, index.ids, strict=True):
        row[by_id[i][1]] = index.unit(*by_id[i][1:3]).astype(np.float32)
    for _ in range(200):
        t = np.sort(rng.choice(30, 4, replace=False))
        q = np.zeros(30)
        q[t] = index.unit(t, np.ones(4, int))
        s = np.round(dense @ q, 7)
        e, found = index.nearest(t, np.ones(4, int))
        assert np.allclose(found, np.sort(s[s > 0])[::-1][: toxicity.NEIGHBOURS], atol=2e-7) and np.allclose(s[e], found, atol=2e-7)


def test_fingerprints(spark, docs, odd, empty):
    rows = imatch.edited_fingerprints(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(text, reverse=True)
    for k, i in enumerate(ids):
        t, n = text[i], text[ids[(k + 1) % len(ids)]]
        text[i] = (t, hashlib.sha256((t[: len(t) - len(t) // 2] + (n if isinstance(n, str) else n[0])[: len(t) // 2]).encode()).hexdigest())
    assert {r.doc_id: r.edited_sha256 for r in rows} == {i: v[1] for i, v in text.items()}
    prints = {}
    for r in rows:
        assert prints.setdefault(text[r.doc_id][0], r.fingerprint) == r.fingerprint and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert imatch.edited_fingerprints(odd).count() == len(ODD) and imatch.edited_fingerprints(empty).count() == 0


def test_fingerprints_equal_brute_force(spark, docs):
    """Fingerprints and likenesses recomputed from the texts; Spark gives the hashes of single strings only."""
    from pyspark.sql import functions as F

    rows = {r.doc_id: r for r in imatch.edited_fingerprints(docs).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(text, reverse=True)
    following = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}
    edited = {i: t[: len(t) - len(t) // 2] + text[following[i]][: len(t) // 2] for i, t in text.items()}
    terms = lambda t: set(re.findall(r"[^\W_]+", t.lower()))
    df: dict = {}
    for t in text.values():
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    band = sorted(w for w, n in df.items() if 0.002 * len(text) <= n <= max(1.0, 0.25 * len(text)))
    subsets = {r.t: r.s for r in spark.createDataFrame([(w,) for w in band], "t string").select("t", imatch.subsets_of(F.col("t")).alias("s")).collect()}
    parts = {}
    for own in (*text.values(), *edited.values()):
        in_band = sorted(terms(own) & set(band), key=lambda w: w.encode())
        parts[own] = [" ".join(w for w in in_band if subsets[w] >> k & 1) for k in range(imatch.SUBSETS)]
    joined = sorted({j for p in parts.values() for j in p if j})
    hashed = {r.j: r.h for r in spark.createDataFrame([(j,) for j in joined], "j string").select("j", F.lower(F.hex(F.xxhash64("j"))).alias("h")).collect()}
    prints = {own: [hashed[j].rjust(imatch.PART, "0")[-imatch.PART :] if j else imatch.EMPTY for j in p] if any(p) else None for own, p in parts.items()}
    like = lambda a, b: 1.0 if a == b else sum(x == y != imatch.EMPTY for x, y in zip(a, b, strict=True)) / sum(x != imatch.EMPTY or y != imatch.EMPTY for x, y in zip(a, b, strict=True)) if a and b else 0.0
    checked = 0
    for i, t in text.items():
        if prints[t] and prints[edited[i]] and prints[text[following[i]]]:
            checked += 1
            assert (rows[i].fingerprint, rows[i].edited_fingerprint) == ("".join(prints[t]), "".join(prints[edited[i]]))
            assert abs(rows[i].near_edited - like(prints[t], prints[edited[i]])) < 1e-9 and abs(rows[i].near_next - like(prints[t], prints[text[following[i]]])) < 1e-9
    assert checked > 0.9 * len(text)
    near = [r.near_edited for r in rows.values()]
    assert sum(near) / len(near) > 3 * sum(r.near_next for r in rows.values()) / len(near)  # half a text in common shows


def test_a_shuffled_lexicon_gives_the_same_fingerprints(odd, docs):
    for df in (odd, docs):
        a, b = (sorted(map(str, imatch.edited_fingerprints(df, broadcast_terms=n).collect())) for n in (0, 500_000))
        assert a == b


def test_fingerprints_use_the_whole_band(spark):
    few = spark.createDataFrame([(i, f"word{i}") for i in range(200)], "doc_id long, text string")
    prints = [r.fingerprint for r in imatch.edited_fingerprints(few).collect()]
    assert not any(p.startswith("t") for p in prints) and len(set(prints)) == 200


PAGE = '<html><head><title>T</title></head><body><header>Head</header><nav><a href="/x">Menu</a></nav>{}<div class="comments">No</div><footer>Foot</footer></body></html>'


def test_page_text(spark):
    rows = [
        (1, "http://a.b/x/1", PAGE.format("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>four<aside>not</aside></article>")),
        (2, "http://c.d/1", PAGE.format("<div>Same line</div><div>Own 1 is much longer than the rest</div>")),
        (3, "http://c.d/2", PAGE.format("<div>Same line</div><div>Own 2 is much longer than the rest</div>")),
        (4, None, None),
        (5, "http://c.d/2", PAGE.format("<div>Same line</div><div>Own 2 is much longer than the rest</div>")),
    ]
    got = {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "A & B\none two three\nfour" and got[2] == "Own 1 is much longer than the rest" and got[4] == ""
    assert got[3] == "Own 2 is much longer than the rest"
    assert pagediff.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_shared_lines_inside_the_article_go(spark):
    article = lambda own, extra="": PAGE.format(f"<article><p>Follow us on the net</p><p>{own}</p></article>{extra}")
    rows = [
        (1, "http://a.b/1", article("Own 1 is much longer than the rest")),
        (2, "http://a.b/2", article("Own 2 is much longer than the rest")),
        (3, "http://c.d/1", article("Copied text is kept on both pages")),
        (4, "http://c.d/2", article("Copied text is kept on both pages", "<div>" + "other words " * 40 + "</div>")),
    ]
    got = {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    copied = "Follow us on the net\nCopied text is kept on both pages"
    # A shared paragraph stays among others of its place; a box of its own goes.
    follow = "Follow us on the net\n"
    assert got == {1: follow + "Own 1 is much longer than the rest", 2: follow + "Own 2 is much longer than the rest", 3: copied, 4: copied}
    boxed = lambda own: PAGE.format(f"<article><h1>Title</h1><p>{own}</p><div class='tip'>Follow us on the net</div></article>")
    rows = [(i, f"http://e.f/{i}", boxed(f"Own {i} is much longer than the rest")) for i in (1, 2)]
    got = {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title\nOwn {i} is much longer than the rest" for i in (1, 2)}


def test_alignment_equals_brute_force_on_whole_hosts(spark):
    """Unmarked pages of two hosts: what is left equals a quadratic longest common subsequence with the pages beside."""
    rng = np.random.default_rng(11)
    pages, lines = [], {}
    for i in range(60):
        frame = [f"frame line {k}" for k in range(6) if rng.random() < 0.8]
        own = [f"page {i} has its own text number {k} of some length" for k in range(rng.integers(2, 6))]
        cut_at = int(rng.integers(0, len(frame) + 1))
        lines[i] = frame[:cut_at] + own + frame[cut_at:]
        pages.append((i, f"http://h{i % 2}.net/{i:03d}", "<body>" + "".join(f"<div>{t}</div>" for t in lines[i]) + "</body>"))

    def lcs(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a) - 1, -1, -1):
            for y in range(len(b) - 1, -1, -1):
                best[x][y] = 1 + best[x + 1][y + 1] if a[x] == b[y] else max(best[x + 1][y], best[x][y + 1])
        return best[0][0]

    got = {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    changed = 0
    for i, text in got.items():
        beside = [j for j in (i - 4, i - 2, i + 2, i + 4) if j in lines]
        left = text.split("\n")
        gone = [pagediff.shared_lines(lines[i], lines[j]) for j in beside]
        assert all(len(g) == lcs(lines[i], lines[j]) for g, j in zip(gone, beside, strict=True))
        assert left == [t for k, t in enumerate(lines[i]) if sum(k in g for g in gone) < 2] and all(t in left for t in lines[i] if t.startswith("page"))
        changed += text != "\n".join(lines[i])
    assert changed >= 55  # without the alignment these pages would keep frame lines


def test_parsing_is_linear():
    import time

    begin = time.time()
    for html in ("<a " * 300_000, "<div>" * 100_000, "<p>x" * 100_000, "<svg>" * 100_000, '<a "' * 200_000, "<!" * 300_000, "</div>" * 100_000, "<a '\"" * 100_000):
        pagediff.blocks(html)
    assert time.time() - begin < 40


def test_pages_with_odd_rows(spark):
    rows = [(None, None, None, "a", 1), (1, "http://a.b/1", "", "b", 2), (1, "http://a.b/1", "<p>x</p>", "c", 3), (1, "http://a.b/1", "<p>x</p>", "c", 3), (2, "no url", "<article>" + "<p>word</p>" * 20000 + "</article>", "d", 4)]
    got = pagediff.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, part int")).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 0), ("1", 1), ("1", 1), ("2", 99999), ("None", 0)]


def test_host_verdicts(spark):
    link = '<a href="http://{}/">x</a>'
    rows = [(1, "http://good.org/a", link.format("friend.net")), (2, "http://friend.net/", ""), (3, "http://x.com/de/1", ""), (4, "http://spam.net/", link.format("x.com")), (5, None, None), (6, "nope", None), (7, "HTTP://Sub.Example.ORG/en/12?q", None), (8, "http://notorg/", None)]
    got = {r.page_id: r for r in hostrank.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), queries.URL_RULES).collect()}
    assert {k: v.verdict for k, v in got.items()} == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow"}
    assert (got[7].host, got[7].path, got[7].rule) == ("sub.example.org", "/en/12", "example.org/en/1") and got[5].host == "" and got[8].rule is None
    assert got[2].trust > 0 and got[4].distrust > 0


def test_ranks_equal_a_dense_page_rank(spark):
    rng = np.random.default_rng(8)
    n = 40
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, n, (160, 2)) if a != b} | {(0, k) for k in range(1, n)})
    seeds = {1: 0.25, 5: 0.75}
    share = np.zeros((n, n))
    for a, b in edges:
        share[b, a] = 1 / sum(x == a for x, _ in edges)
    start = np.array([seeds.get(i, 0.0) for i in range(n)])
    rank = np.linalg.solve(np.eye(n) - 0.85 * share, 0.15 * start)
    rank /= rank.sum()
    df = spark.createDataFrame([("trust", f"h{a}", f"h{b}") for a, b in edges], "kind string, src string, dst string")
    start = spark.createDataFrame([("trust", f"h{i}", s) for i, s in seeds.items()], "kind string, host string, seed double")
    got = {int(r.host[1:]): r["rank"] for r in hostrank.propagate(df, start, 0.85, 1e-9, 1000).collect()}
    assert all(abs(got.get(i, 0.0) - rank[i]) < 1e-6 for i in range(n))


def test_host_verdicts_of_odd_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, host string, rank double")
    assert hostrank.judge(empty, queries.URL_RULES).count() == 0
    rows = [(1, "http://a.net/x", None, "clash", 1.0)] * 3 + [(None, "://", "<a href='//b.net/'>", "clash", 2.0), (2, "http://b.net" + "/long" * 100_000, "<a href=" * 50_000, "clash", 3.0)]
    got = hostrank.judge(spark.createDataFrame(rows, "page_id long, url string, html string, host string, rank double"), queries.URL_RULES).collect()
    assert len(got) == 5 and {r.verdict for r in got} == {"allow"}


def test_host_verdicts_reach_the_end_of_a_long_chain(spark):
    link = '<a href="http://{}/">x</a>'
    rows = [(0, "http://x.com/de/1", "")] + [(i, f"http://n{i}.net/", link.format(f"n{i - 1}.net" if i > 1 else "x.com")) for i in range(1, 26)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in hostrank.judge(pages, queries.URL_RULES).collect()}
    assert all(r.verdict == "block" and r.distrust > 0 for r in got.values())
    with pytest.raises(RuntimeError):
        hostrank.judge(pages, queries.URL_RULES, rounds=3)


def test_licenses(spark, docs, odd, empty):
    names = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = sorted((d.doc_id, n) for d in docs.collect() for t, n in names.items() for _ in range(d.text.count(t)))
    assert sorted((r.doc_id, r.license) for r in licenses.scan(docs).collect()) == want
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0
    assert licenses.patience([1, 2, 3, 4], [9, 1, 2, 9, 4]) == [(0, 1), (1, 2), (3, 4)]


def test_licenses_are_told_apart(spark):
    notices = {"Licensed under CC BY 4.0": "CC-BY-4.0", "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Licensed under CC BY-NC-SA 3.0": "CC-BY-NC-SA-3.0", "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0", "This program is released under the GNU Lesser General Public License, version 3": "LGPL-3.0", "Released under the GNU Affero General Public License, version 3": "AGPL-3.0", "Released under the GNU General Public License, version 2": "GPL-2.0", "Released under the ISC License": "ISC", "Released under the BSD 3-Clause License": "BSD-3-Clause"}
    rows = [(i, f"some words before. {t}. and {'more ' * i}after", want) for i, (t, want) in enumerate(notices.items())]
    rng = np.random.default_rng(2)
    for k, (name, text) in enumerate(licenses.texts()):
        words = text.split()
        for at in rng.choice(len(words), len(words) // 20, replace=False).tolist():
            words[at] = f"x{at}"
        rows += [(100 + k, f"file head {text} file tail", name), (200 + k, " ".join(words), name), (300 + k, " ".join(words[: len(words) // 2]), None)]
    rows += [(400, "the license of the general public is under the work licensed version", None), (401, "Released under the FOO License", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {}
    for r in licenses.scan(df).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert got == {i: [want] for i, _, want in rows if want}


def test_patience_alignment():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 9, rng.integers(0, 12)).tolist(), rng.integers(0, 9, rng.integers(0, 12)).tolist()
        got = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
    for _ in range(200):  # where every word is unique, the alignment is a longest common subsequence
        a, b = rng.permutation(12)[: rng.integers(0, 12)].tolist(), rng.permutation(12)[: rng.integers(0, 12)].tolist()
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert len(licenses.patience(a, b)) == row[-1]


def test_warc_round_trip(spark):
    big = "x" * 100
    rows = [(5, "http://a/1", big), (3, "http://a/2\n", big), (9, None, None), (7, "u", "é" * 50), (8, "u", "é" * 50), (2, "s", "short"), (1, "s", "short"), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write(pages)
    got = {r.page_id: r for r in warc.read(index).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {5: ("revisit", 3), 3: ("response", None), 9: ("response", None), 7: ("response", None), 8: ("revisit", 7), 2: ("response", None), 1: ("response", None), None: ("response", None)}
    for page_id, _, html in rows:
        body = (html or "").encode()
        assert (got[page_id].payload_bytes, got[page_id].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    assert warc.read(index.where("page_id IN (2, 3)")).count() == 2
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_warc_keeps_every_payload_of_repeated_ids(spark):
    a, b, c = ("A" * 100, "B" * 150, "C" * 200)
    rows = [(1, a), (2, b), (5, a), (5, c), (6, a), (6, b)]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h, "clash", 7) for i, h in rows], "page_id long, url string, html string, key string, first long")
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload, r.payload_digest) for r in warc.read(warc.write(pages)).collect())
    sha = lambda h: hashlib.sha256(h.encode()).hexdigest()
    assert sorted(got, key=str) == sorted([(1, "response", None, a, sha(a)), (2, "response", None, b, sha(b)), (5, "revisit", 1, None, sha(a)), (5, "response", None, c, sha(c)), (6, "revisit", 1, None, sha(a)), (6, "revisit", 2, None, sha(b))], key=str)
    long = "é" * 3_000_000
    got = warc.read(warc.write(spark.createDataFrame([(i, None, long) for i in range(3)], "page_id long, url string, html string"))).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes) for r in got) == [(0, "response", 6_000_000), (1, "revisit", 6_000_000), (2, "revisit", 6_000_000)]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_oracle(spark, name):
    import oracle

    sf = "/root/testdata/sf0.01"
    assert oracle.differ(spark, oracle.connect(sf), queries.QUERIES[name], queries.ORACLES[name], sf) is None


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
    assert 0 < corpus_pipeline.run(spark, SF).count() <= docs.count()


def test_pipeline_equals_its_operators_on_a_table_of_known_rows(spark, tmp_path):
    """Which rows each stage must drop is known: no letters, toxic, near copies, benchmark passages; the rest stays and is counted."""
    import corpus_pipeline

    docs, items, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "labels"))
    rows = docs.collect()
    base = max(rows, key=lambda r: r.n_chars).text.split()
    rng = np.random.default_rng(6)
    fresh = lambda n: " ".join(rng.choice(base, n).tolist())
    own = fresh(300)
    more = [(10_001, own), (10_002, own + " one more"), (10_003, own), (10_004, fresh(60) + " " + items.first().text + " " + fresh(60)), (10_005, "12 34 !"), (10_006, ""), (10_007, None), (None, fresh(200)), (10_008, fresh(20_000))]
    for table in (items, labels):
        table.write.parquet(str(tmp_path / ("benchmark.parquet" if table is items else "labels.parquet")))
    docs.unionByName(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in more], docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r.doc_id for r in out}
    assert {10_001, 10_008, None} <= got and not got & {10_002, 10_003, 10_004, 10_005, 10_006, 10_007}
    assert len(out) == len({r.doc_id for r in out})
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_with_odd_rows(spark, odd):
    import corpus_pipeline

    kept = {name: [r.doc_id for r in stage(spark, odd, SF).collect()] for name, stage in corpus_pipeline.STAGES}
    assert sorted(kept["near_duplicates"], key=str) == sorted([1, 2, 3, 4, 6, 7, None], key=str)
    assert sorted(kept["decontaminate"], key=str) == sorted(kept["tokens"], key=str) == sorted((r[0] for r in ODD), key=str)
    assert not {1, 2} & set(kept["language"])

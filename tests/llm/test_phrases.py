"""Operators 11 to 13 against plain Python: collocations, divergence of sources, chat formatting."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fundsieve.llm import automata, chat, collocations, divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string, score double, rank int, n long, phrase string, value string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, 1, "p", "v") for r in rows], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n, words=12):
    rng = random.Random(seed)
    vocabulary = ["of", "The", "a", "b", "é", "\x01x", "\x00", "日本"] + [f"w{i}" for i in range(words)]
    return "".join(rng.choices(vocabulary, [9, 9, 4, 4, 2, 2, 1, 1] + [1] * words)[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(n))


ROWS = [(1, None, None, None), (2, "", "en", ""), (3, prose(1, 900), "en", "a"), (3, prose(1, 900), "en", "a"), (None, prose(2, 700), "en", None), (4, prose(3, 800), "fr", "b"), (5, prose(4, 300), None, "b"), (6, prose(5, 4000), "en", "c"), (7, "...", "de", "a"), (8, "x y", "", "a"), (9, prose(6, 500), "a\x00b", "a")]


def grams_of(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    return f, n


def plain_collocations(rows, least, inside, top):
    out = []
    f, n = grams_of(rows)
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        own = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(own)[:top])]
    return out


@pytest.mark.parametrize("entries,ranges,coarse", [(1, 40, 2), (3_000_000, 3, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, entries, ranges, coarse):
    monkeypatch.setattr(collocations, "STRIDE", 97)
    got = collocations.collocations(frame(spark, ROWS), least=3, per_range=1, ranges=(ranges, ranges), coarse=coarse, entries=entries, top=50)
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect()) == sorted(plain_collocations(ROWS, 3, 50, 50))


def test_collocations_without_words(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, ROWS[:2])).count() == 0


def test_scores_beyond_64_bits():
    a, left, right = np.array([3_000_001, 10, 4 * 10**12]), np.array([3_000_002, 20, 5 * 10**12]), np.array([4_000_000, 30, 6 * 10**12])
    assert collocations.scores(a, left, right).tolist() == [10**6 * x * x // (y * z) for x, y, z in zip(a.tolist(), left.tolist(), right.tolist(), strict=True)]


def some_grams(seed, n=500, words=9):
    rng = np.random.default_rng(seed)
    names = sorted({bytes([97 + rng.integers(26)]) * rng.integers(1, 4) for _ in range(words)})
    cols = [rng.integers(1, len(names) + 1, n).astype(np.int32)] + [rng.integers(0, len(names) + 1, n).astype(np.int32) for _ in range(2)]
    cols[2][cols[1] == 0] = 0
    return automata.summed(pa.array(names, pa.binary()), cols, rng.integers(1, 4, n))


def paths(g):
    words = [None, *g.words.to_pylist()]
    return {tuple(words[x] for x in run if x): w for run, w in zip(zip(*(c.tolist() for c in g.cols), strict=True), g.weight.tolist(), strict=True)}


def test_automata_keep_their_paths():
    for seed in range(8):
        g = some_grams(seed)
        small = automata.Automaton.of(g, block=7)
        assert paths(automata.Automaton.read(small.write()).paths()) == paths(g)
        assert len(small.first[1]) - 1 <= len({tuple(x) for x in np.stack(g.cols[:2], 1)[g.cols[1] > 0]})
        h = some_grams(seed + 100)
        assert paths(automata.union([g, h])) == Counter(paths(g)) + Counter(paths(h))
        both = {p: w for p, w in paths(g).items() if p in paths(h)}
        assert paths(automata.compose(g, h)) == both


def test_automata_share_states():
    g = collocations.count_grams(b"a x z. b x z. c x z. d x z. a y. b y. c y. d y")
    a = automata.Automaton.of(g)
    assert len(a.first[1]) - 1 == 2  # after two words: z once, or nothing
    assert len(a.first[0]) - 1 == 3  # after one word: x and y, z, or nothing


def test_equal_signs_of_unequal_states(monkeypatch):
    monkeypatch.setattr(automata, "mix", lambda x: x & np.uint64(1))
    g = some_grams(5, 300)
    assert paths(automata.Automaton.read(automata.Automaton.of(g, block=11).write()).paths()) == paths(g)


def test_more_words_than_a_packed_key_holds(monkeypatch):
    g = some_grams(3)
    monkeypatch.setattr(automata, "BITS", 1)
    assert paths(automata.union([g, g])) == {p: 2 * w for p, w in paths(g).items()}
    assert paths(automata.compose(g, some_grams(4))) == {p: w for p, w in paths(g).items() if p in paths(some_grams(4))}


def plain_divergence(rows, least, top):
    rows = [tuple(x or "" for x in (lang, source, text)) for _, text, lang, source in rows]
    words = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [(s, w) for x, s, w in words if x == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = [t for t, n in df.items() if n >= least]
        count = defaultdict(Counter)
        for s, w in own:
            count[s].update(t for t in w if df[t] >= least)
            count[None].update(t for t in w if df[t] >= least)
        p = lambda s, t: 1 + 10**9 * (count[s][t] + 1) // (sum(count[s].values()) + len(kept))
        f = lambda x, y: (x - y) * (x - y) // y
        sources = {s for s, _ in own}
        for s in sources:
            pairs = [(-sum(f(p(s, t), p(o, t)) for t in kept), o.encode()) for o in sources - {s}]
            terms = [(-f(p(s, t), p(None, t)), t.encode()) for t in kept if count[s][t] and p(s, t) > p(None, t)]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(found))]
    return out


@pytest.mark.parametrize("entries", [10, 1_000_000])
def test_divergence_equals_brute_force(spark, entries):
    more = [*ROWS, (20, prose(9, 300), "en", "d"), (21, "alpha beta alpha gamma", "en", "é"), (22, "alpha delta", "en", "d"), (23, "alpha beta", "en", ""), (24, prose(8, 400), "fr", "a"), (25, prose(7, 100), "fr", "c")]
    got = divergence.divergence(frame(spark, more), top=5, shards=3, entries=entries)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == sorted(plain_divergence(more, 3, 5))
    assert divergence.divergence(frame(spark, [])).count() == 0


def test_runs_merge_by_heap():
    rng = random.Random(3)
    blocks, total = [], defaultdict(Counter)
    for _ in range(30):
        keys = sorted({f"k{rng.randrange(40):02}".encode() for _ in range(rng.randrange(1, 12))})
        posts = [[(rng.choice("abc"), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 4))] for _ in keys]
        for k, own in zip(keys, posts, strict=True):
            for s, c in own:
                total[k][s] += c
        names = ["a", "b", "c"]
        flat = list(itertools.chain(*posts))
        blocks.append((keys, [len(x) for x in posts], names, [names.index(s) for s, _ in flat], [c for _, c in flat], [1] * len(flat)))
    got = list(divergence.merged(sorted(blocks, key=lambda b: b[0][0]), 1))
    assert [k for k, _ in got] == sorted(total) and {k: dict(v) for k, v in got} == {k: dict(v) for k, v in total.items()}


def test_corrections_are_exact(spark):
    big = 10**9
    rows = [("l", [("a", big, 1), ("b", 1, big), ("c", 7, 3)])] * 50
    got = {(r.source, r.item): int(r.value) for r in divergence.corrections(spark.createDataFrame(rows, "lang string, of array<struct<source:string,p:long,p0:long>>").coalesce(1), pairs=7).collect()}
    f = lambda x, y: (x - y) * (x - y) // y
    for (s, p, p0), (o, q, q0) in itertools.permutations(rows[0][1], 2):
        assert got[s, o] == 50 * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))


TEXTS = ["</s>[INST] ok [/INST]", "plain", "", None, "back\\slash \\[INST] \\\\", "[ INST]", "<s>[SYS] x [/SYS]", " [/INST]", "[IMAGE 0][AUDIO 3]", "ends in \\", "é 日本 ]", "<</s>", "[TURN a] b [/TURN]", "</s>"]


def test_escape_is_reversible():
    rng = random.Random(1)
    pieces = ["\\", "[", "]", "INST", "/", " ", "<", "s>", "</s>", "[/INST]", "x", "SYS"]
    for text in [t for t in TEXTS if t] + ["".join(rng.choices(pieces, k=12)) for _ in range(3000)]:
        assert chat.unescape(chat.escape(text)) == text
        assert not re.search(r"</?s>|\[/?(INST|SYS|TURN|IMAGE|AUDIO|DOCUMENT)[ \]]", chat.escape(text))


def test_stream_cut_anywhere():
    rng = random.Random(2)
    turns = [(r, t or "") for r in ("user", "assistant", "system", "tool", "", "a]b%5D") for t in TEXTS]
    rng.shuffle(turns)
    whole = "".join(chat.wrap(r, chat.escape(t))[0] for r, t in turns)
    for size in (1, 7, 100, len(whole)):
        got = [(r, chat.unescape(e), whole[a:b] == e) for r, e, a, b in chat.parse(whole[i : i + size] for i in range(0, len(whole), size))]
        assert got == [(r, t, True) for r, t in turns]


def test_chat_equals_plain_python(spark):
    rows = [(c, t, r, TEXTS[(c + t) % len(TEXTS)], "x", 3) for c in range(14) for t, r in enumerate(["system", "user", "assistant", "tool", "assistant", None])]
    rows += [(20, 0, "user", "same", "x", 3), (20, 0, "user", "same", "x", 3), (20, None, "assistant", "first", "x", 3), (None, 1, "assistant", "y", "x", 3)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chars string, n_turns long")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(chat.of_texts(docs))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len(chat.wrap(r, chat.escape(t))[0]) for _, r, t in own)
    assert chat.digests(chat.format_turns(chat.of_texts(docs.limit(0)))).count() == 0


def test_parts_become_placeholders(spark):
    import public_tokenizers

    parts = [{"type": "text", "text": "look [IMAGE 0] "}, {"type": "image", "ref": "i1", "width": 56, "height": 29}, {"type": "audio", "ref": "a1", "seconds": 1.0}, {"type": "text", "text": "and"}, {"type": "document", "ref": "d1", "pages": 2}, {"type": None, "text": None}]
    full = [{k: p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages")} for p in parts]
    turns = spark.createDataFrame([(1, 0, "user", full), (1, 1, "assistant", full[:1]), (1, 2, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = chat.format_turns(turns, (public_tokenizers.path(queries.BPE_RANKS), public_tokenizers.PATTERN)).orderBy("turn").collect()
    assert rows[0].fragment == "<s>[INST] look [\\IMAGE 0] [IMAGE 0][AUDIO 1]and[DOCUMENT 2] [/INST]"
    assert [tuple(a) for a in rows[0].attachments] == [("image", "i1", 0, 4), ("audio", "a1", 1, 13), ("document", "d1", 2, 1200)]
    assert rows[0].tokens > 1217 and rows[2].fragment == " </s>"
    back = chat.content(rows[0].fragment[rows[0].content_at : rows[0].content_at + rows[0].content_chars], rows[0].attachments)
    assert [(p["type"], p.get("text") or p.get("ref")) for p in back] == [("text", "look [IMAGE 0] "), ("image", "i1"), ("audio", "a1"), ("text", "and"), ("document", "d1")]
    spans = chat.loss_spans(chat.format_turns(turns)).orderBy("start").collect()
    whole = "".join(r.fragment for r in rows)
    assert [whole[s.start : s.end] for s in spans] == ["look [\\IMAGE 0] ", ""]
    with pytest.raises(ValueError):
        chat.Flatten().visit({"type": "video"})


@pytest.mark.parametrize("name", ["op11_collocations", "op12_divergence", "op13_chat"])
def test_queries_equal_sql(spark, name):
    from oracle import connect, differ

    sf = "/root/testdata/sf0.001"
    assert differ(spark, connect(sf), queries.QUERIES[name], queries.ORACLES[name], sf) is None

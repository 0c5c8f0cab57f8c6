"""Phrase collocations of each language by weighted acyclic automata.

A task turns its slice of text, a shard, into the sorted runs of one to three words of each language and builds a count
automaton from them. The automaton is cut at prefix ranges (word runs in order, so a hot word's runs fall into several
ranges); each range unites the shards' automata and sums their weights, then keeps what occurs often enough to be a
candidate or a part of one. Each range asks the ranges that hold them for the counts of its candidates' parts, by an
automaton of the distinct parts, which is composed with the count automaton there. Candidates get the score of their
weakest cut; those inside a longer candidate that is half as frequent go.

Phrases have two or three words. Ranges are cut by a bounded sample of word runs, which steers the balance of tasks and
no result. A task holds a shard of `entries` runs, or one range: some 16 MB of the text, as long as there are no more
than `most` ranges.

Cases: null and empty texts have no words; a null lang is `und`; words are compared by their bytes, with A-Z lowered;
each row is a text of its own, so repeated rows count each time; doc_id and other columns are not read; ties are ranked
by the phrase's bytes; a language without candidates, or an empty table, gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.llm.automata import Grams, compose, locate, over_one_alphabet, own_alphabet, read, summed, union, write
from fundsieve.llm.tables import cut, small_batches
from fundsieve.llm.words import LOWER, distinct_words, slices, utf8

STOPS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
STOP = np.isin(np.arange(256), list(STOPS))
GAP = STOP | np.isin(np.arange(256), list(BLANKS))
SLICE = 4 << 20  # bytes of text that become one sorted run
STRIDE = 1 << 16  # bytes of text for each sampled word run


def count_grams(text: bytes) -> Grams:
    """All runs of one to three words inside the pieces of a text, with their counts."""
    raw = np.frombuffer(text, np.uint8)
    word = ~GAP[raw]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(STOP[raw], dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
    words, ids = distinct_words(raw, word, start, end)
    cols = [ids + 1]
    for k in (1, 2):
        later = np.zeros(len(ids), np.int32)
        later[:-k] = np.where(piece[k:] == piece[:-k], ids[k:] + 1, 0)
        cols.append(later)
    g = summed(words, cols, np.ones(len(ids), np.int64))
    zero, parts = np.zeros(len(g), np.int32), [(g.cols[0], *[np.zeros(len(g), np.int32)] * 2, g.weight)]
    for depth in (1, 2):
        more = g.cols[depth] > 0
        parts.append((*[g.cols[k][more] if k <= depth else zero[more] for k in range(3)], g.weight[more]))
    *cols, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    return summed(words, cols, weight)


def by_language(b: pa.RecordBatch):
    """(lang, text) of a batch of (lang, text): the texts of a language in one, a line feed between them."""
    coded = b.column(0).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    for k, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, "\n".join(b.column(1).take(pa.array(np.flatnonzero(code == k))).to_pylist()).encode()


def runs_at(raw: np.ndarray, at: np.ndarray, every: int) -> list[tuple[int, list[bytes]]]:
    """(text, words) of the run of up to three words behind a place in every `every` bytes."""
    out = []
    for pos in range(int(np.random.default_rng(len(raw)).integers(every)), len(raw), every):
        text = int(np.searchsorted(at, pos, "right")) - 1
        near = raw[pos : min(int(at[text + 1]), pos + 400)]
        gap = np.flatnonzero(GAP[near])
        piece = LOWER[near[gap[0] :]].tobytes().lstrip(STOPS + BLANKS) if len(gap) else b""
        piece = piece[: min([piece.find(bytes([s])) % (len(piece) + 1) for s in STOPS])]
        words = piece.replace(b"\t", b" ").split(b" ")
        if words := [w for w in words if w][:3]:
            out.append((text, words))
    return out


def prefix_cuts(texts: DataFrame, per_range: int, least: int, most: int) -> dict[str, list[tuple[bytes, ...]]]:
    """The first word runs of each language's ranges but its first, from a bounded sample."""

    def run(batches):
        for b in slices(batches):
            langs = b.column(0).to_pylist()
            found = runs_at(*utf8(b.column(1)), STRIDE)
            yield pa.RecordBatch.from_arrays([pa.array([langs[t] for t, _ in found], pa.string()), pa.array([w for _, w in found], pa.list_(pa.binary()))], ["lang", "run"])

    sample = cut(texts.mapInArrow(run, "lang string, run array<binary>"))
    ranges = min(most, max(least, sample.count() * STRIDE // per_range))
    picked = sample.orderBy(F.xxhash64("lang", "run")).limit(16 * ranges)
    by_lang: dict[str, list[tuple[bytes, ...]]] = {}
    for lang, words in picked.collect():
        by_lang.setdefault(lang, []).append(tuple(map(bytes, words)))
    total = sum(map(len, by_lang.values()))
    cuts = {}
    for lang, own in by_lang.items():
        own.sort()
        n = max(1, round(len(own) * ranges / total))
        cuts[lang] = sorted({own[i * len(own) // n] for i in range(1, n)})
    return cuts


def split(g: Grams, cuts: list[tuple[bytes, ...]]):
    """(range, its grams) of each range that has some."""
    words = g.words.to_pylist()
    keys = []
    for run in cuts:
        key = [0, 0, 0]
        for k, w in enumerate(run):
            i = bisect_left(words, w)
            key[k] = i + 1
            if i == len(words) or words[i] != w:
                break
        keys.append(key)
    asked = [np.array([k[i] for k in keys], np.int32) for i in range(3)]
    upto = [0, *np.searchsorted(rows_as_keys(g.cols), rows_as_keys(asked)).tolist(), len(g)]
    for r, (lo, hi) in enumerate(zip(upto[:-1], upto[1:], strict=True)):
        if lo < hi:
            yield r, g.at(slice(lo, hi))


def rows_as_keys(cols: list[np.ndarray]) -> np.ndarray:
    """Big-endian bytes of each row: they sort like the rows."""
    return np.ascontiguousarray(np.stack(cols, 1).astype(">u4")).view("S12").ravel() if len(cols[0]) else np.zeros(0, "S12")


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


BLOBS = pa.schema([("lang", pa.string()), ("to", pa.int32()), ("frm", pa.int32()), ("blob", pa.binary())])
BLOBS_SQL = "lang string, to int, frm int, blob binary"
COUNTED = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("blob", pa.binary())])
SCORED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("l", pa.int64()), ("r", pa.int64()), ("score", pa.int64()), ("drops", pa.bool_())])


def shard_automata(texts: DataFrame, cuts, entries: int) -> DataFrame:
    """(lang, part, blob): count automata of the shards, cut at the ranges."""

    def emit(have):
        for lang, parts in have.items():
            rows = []
            for r, own in split(union(parts) if len(parts) > 1 else parts[0], cuts.value.get(lang, [])):
                rows.append((lang, r, write(own)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.binary()), strict=True)], ["lang", "part", "blob"])

    def run(batches):
        have: dict[str, list[Grams]] = {}
        size = 0
        for b in slices(batches, 1, SLICE):
            for lang, text in by_language(b):
                g = count_grams(text)
                if len(g):
                    have.setdefault(lang, []).append(g)
                    size += len(g)
            if size > entries:
                yield from emit(have)
                have, size = {}, 0
        yield from emit(have)

    return texts.mapInArrow(run, "lang string, part int, blob binary")


def range_counts(shards: DataFrame, least: int, pending: int = 1 << 20) -> DataFrame:
    """(lang, part, n, blob): the united automaton of each range, of runs that occur `least` times; n: all words."""

    def run(batches):
        key, have = None, []

        def done():
            g = union(have)
            n = int(g.weight[g.cols[1] == 0].sum())
            return batch([(*key, n, write(g.at(g.weight >= least)))], COUNTED)

        for b in batches:
            for lang, part, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (lang, part) != key:
                    if have:
                        yield done()
                    key, have = (lang, part), []
                have.append(read(blob))
                if len(have) > 1 and sum(map(len, have[1:])) > max(pending, len(have[0])):
                    have = [union(have)]
        if have:
            yield done()

    return shards.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(run, "lang string, part int, n long, blob binary")


def candidates(g: Grams, least: int) -> Grams:
    return g.at((g.cols[1] > 0) & (g.weight >= least))


def parts_of(g: Grams, k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The first k words of each run and the rest."""
    zero = np.zeros(len(g), np.int32)
    return [c if i < k else zero for i, c in enumerate(g.cols)], [*g.cols[k:], *[zero] * k]


def ask(counted: DataFrame, cuts, least: int, coarse: int) -> DataFrame:
    """Requests (lang, to, frm, blob): the distinct parts of each range's candidates, for the coarse ranges that count them."""

    def run(batches):
        for b in batches:
            for lang, part, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                g = candidates(read(blob), least)
                if not len(g):
                    continue
                longer = g.at(g.cols[2] > 0)
                cols = [np.concatenate(x) for x in zip(*parts_of(g, 1), *parts_of(longer, 2), strict=True)]
                asked = summed(g.words, cols, np.ones(len(cols[0]), np.int64))
                edges = cuts.value.get(lang, [])[coarse - 1 :: coarse]
                yield batch([(lang, to, part // coarse, write(own)) for to, own in split(asked, edges)], BLOBS)

    return counted.select("lang", "part", "blob").mapInArrow(run, BLOBS_SQL)


def answer(counted: DataFrame, asked: DataFrame) -> DataFrame:
    """Replies (lang, to, frm, blob) to the requests: each asked part with its count, back to where it was asked."""

    def run(batches):
        for (lang, to), rows in streamed(batches):
            counts = None
            have: list[Grams] = []
            for frm, blob in rows:
                if frm is None:
                    have.append(read(blob))
                    continue
                counts = counts or union(have)
                yield batch([(lang, frm, to, write(compose(counts, read(blob))))], BLOBS)

    return both_sides(counted, asked).mapInArrow(run, BLOBS_SQL)


def both_sides(counted: DataFrame, other: DataFrame) -> DataFrame:
    """Count automata and requests or replies of each coarse range, the counts first."""
    return counted.union(other).repartition("lang", "to").sortWithinPartitions("lang", "to", F.col("frm").asc_nulls_first())


def streamed(batches):
    """(key, iterator of the rest) of runs of equal (lang, to); each is read as it comes."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, own in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2:] for r in own)


def scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """floor(1000000 a a / (left right)), exactly."""
    if len(a) and (int(a.max()) > 3_000_000 or int(left.max()) * int(right.max()) >= 1 << 63):
        a, left, right = (x.astype(object) for x in (a, left, right))
    return (1_000_000 * a * a // (left * right)).astype(np.int64)


def score(counted: DataFrame, replies: DataFrame, least: int, inside: int) -> DataFrame:
    """Candidates with their weakest cut, and the shorter ones that each longer one drops (drops: true)."""

    def names(words: pa.Array, cols: list[np.ndarray]) -> list[str]:
        text = [w.decode() for w in words.to_pylist()]
        return [" ".join(text[x - 1] for x in run if x) for run in zip(*(c.tolist() for c in cols), strict=True)]

    def run(batches):
        for (lang, _), rows in streamed(batches):
            counts, known = [], []
            for frm, blob in rows:
                (counts if frm is None else known).append(read(blob))
            if not known:
                continue
            g = own_alphabet(candidates(union(counts), least))
            heard = union(known, np.maximum)  # ranges under one coarse range may have asked for the same part
            words, (cols, parts) = over_one_alphabet([g, heard])
            f = heard.weight
            g = Grams(words, cols, g.weight)
            best = [np.zeros(len(g), np.int64) for _ in range(3)]
            drops = []
            for k in (1, 2):
                rows_k = np.flatnonzero(g.cols[k] > 0)
                if not len(rows_k):
                    continue
                h = g.at(rows_k)
                first, rest = parts_of(h, k)
                left, right = f[locate(parts, first)], f[locate(parts, rest)]
                s = scores(h.weight, left, right)
                better = np.ones(len(s), bool) if k == 1 else s < best[2][rows_k]
                for have, new in zip(best, (left, right, s), strict=True):
                    have[rows_k[better]] = new[better]
                three = h.cols[2] > 0
                side, n = (first, left) if k == 2 else (rest, right)
                gone = three & (100 * h.weight.astype(object) >= inside * n.astype(object)) if len(n) else three
                drops.append([c[gone] for c in side])
            yield table(lang, names(words, g.cols), g.weight, *best, False)
            cols = [np.concatenate(x) for x in zip(*drops, strict=True)]
            gone = names(words, summed(words, cols, np.ones(len(cols[0]), np.int64)).cols)
            yield table(lang, gone, *[np.zeros(len(gone), np.int64)] * 4, True)

    def table(lang, phrases, a, left, right, s, drop):
        n = len(phrases)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(phrases, pa.string()), *map(pa.array, (a, left, right, s)), pa.array([drop] * n, pa.bool_())], schema=SCORED)

    return both_sides(counted, replies).mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long, drops boolean")


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, top: int = 2000, per_range: int = 16 << 20, ranges: tuple[int, int] = (64, 1 << 16), coarse: int = 16, entries: int = 3_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of two or three words.

    A phrase occurs at least `least` times; it is dropped inside a longer one that has `inside` per cent of its count.
    """
    texts = small_batches(docs).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = docs.sparkSession.sparkContext.broadcast(prefix_cuts(texts, per_range, *ranges))
    counted = cut(range_counts(shard_automata(texts, cuts, entries), least))
    sides = counted.select("lang", F.floor(F.col("part") / coarse).cast("int").alias("to"), F.lit(None).cast("int").alias("frm"), "blob")
    scored = cut(score(sides, answer(sides, ask(counted, cuts, least, coarse)), least, inside))
    kept = scored.where("NOT drops").join(scored.where("drops").select("lang", "phrase").distinct(), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

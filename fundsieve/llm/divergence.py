"""How the sources of each language differ in their terms, by single-pass in-memory indexing.

A task keeps postings (term, source, occurrences, documents) of its texts in memory until `entries` of them have come
together, then spills them as a run: by hash shard and in the order of the terms. Each shard merges the runs' blocks with
a heap as they stream in, one open block a run, and puts out each kept term's frequencies. Shares, scores and ranks of
terms are DataFrame work on these. A pair of sources adds up over all kept terms; terms that neither has add the same
each, terms of one side are added by histogram of their shares, and only what terms of both sides change on that
(corrections) is streamed term by term and added up inside the task.

Cases: null text, lang and source count as ''; each row is a document, so repeated rows count each time; texts without
terms still give their group; a language without kept terms gives its pairs the value 0; ties go by item in the order of
bytes; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from decimal import Decimal
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.llm.automata import spread
from fundsieve.llm.tables import cut, small_batches
from fundsieve.llm.words import distinct_words, slices, utf8

LETTER = np.array([65 <= (b & 0xDF) <= 90 or b >= 128 for b in range(256)])
SLICE = 2 << 20
RUNS = "shard int, first binary, keys array<binary>, sizes array<int>, names array<string>, sources array<int>, counts array<long>, docs array<long>"


class Block:
    """Postings in memory. Languages and sources have numbers in the order in which they come."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.sources: dict[str, int] = {}
        self.parts: list[tuple] = []  # words; language, word and source of each posting, its occurrences and documents
        self.size = 0

    def numbers(self, column: pa.Array, known: dict[str, int]) -> np.ndarray:
        coded = column.dictionary_encode()
        return np.array([known.setdefault(x, len(known)) for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def add(self, b: pa.RecordBatch) -> None:
        """The texts of a batch of (lang, source, text)."""
        raw, at = utf8(b.column(2))
        word = LETTER[raw]
        before, after = np.append(False, word[:-1]), np.append(word[1:], False)
        inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
        before[inner], after[inner - 1] = False, False
        start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        if not len(start):
            return
        words, ids = distinct_words(raw, word, start, end)
        doc = np.searchsorted(at, start, "right") - 1
        key, count = np.unique(doc << 32 | ids, return_counts=True)
        doc, term = key >> 32, key & 0xFFFFFFFF
        lang, source = self.numbers(b.column(0), self.langs)[doc], self.numbers(b.column(1), self.sources)[doc]
        self.put(words, lang, term, source, count.astype(np.int64), np.ones(len(doc), np.int64))

    def put(self, words, *cols) -> None:
        order = np.lexsort(cols[2::-1])
        lang, term, source, count, docs = (c[order] for c in cols)
        new = np.append(True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1]) | (source[1:] != source[:-1]))[: len(lang)]
        first = np.flatnonzero(new)
        self.parts.append((words, lang[first], term[first], source[first], *[np.add.reduceat(x, first) for x in (count, docs)]))
        self.size += len(first)

    def compact(self) -> None:
        """Adds up the parts."""
        if len(self.parts) > 1:
            words = pa.chunked_array([p[0] for p in self.parts]).unique()
            words = words.take(pc.array_sort_indices(words))
            numbers = [pc.index_in(p[0], value_set=words).to_numpy(zero_copy_only=False).astype(np.int64) for p in self.parts]
            lang, _, source, count, docs = (np.concatenate(x) for x in list(zip(*self.parts, strict=True))[1:])
            term = np.concatenate([n[p[2]] for n, p in zip(numbers, self.parts, strict=True)])
            self.parts, self.size = [], 0
            self.put(words, lang, term, source, count, docs)

    def runs(self, shards: int, terms: int):
        """The postings as blocks of one run: by shard, each in the order of its keys (language, a zero byte, term)."""
        self.compact()
        if not self.parts:
            return
        words, lang, term, source, count, docs = self.parts[0]
        heads = {k: x.encode().replace(b"\0", b"\0\xff") + b"\0" for x, k in self.langs.items()}
        letters, names = words.to_pylist(), list(self.sources)
        first = np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])))
        size = np.diff(np.append(first, len(lang)))
        mixed = np.array([crc32(w) for w in letters], np.int64)[term[first]] ^ np.array([crc32(heads[k]) for k in range(len(heads))], np.int64)[lang[first]]
        shard, rank = mixed % shards, np.empty(len(heads), np.int64)
        rank[sorted(heads, key=heads.__getitem__)] = np.arange(len(heads))
        order = np.lexsort((term[first], rank[lang[first]], shard))
        shard = shard[order]
        edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
            for lo in range(a, z, terms):
                rows = order[lo : min(z, lo + terms)]
                keys = [heads[k] + letters[t] for k, t in zip(lang[first[rows]].tolist(), term[first[rows]].tolist(), strict=True)]
                at = spread(first[rows], size[rows])
                used, own = np.unique(source[at], return_inverse=True)
                yield int(shard[lo]), keys[0], keys, size[rows].tolist(), [names[i] for i in used.tolist()], own.tolist(), count[at].tolist(), docs[at].tolist()


def spimi(rows: DataFrame, shards: int, entries: int, terms: int = 512) -> DataFrame:
    """Term-sorted runs of rows(lang, source, text), in blocks."""
    schema = pa.schema([("shard", pa.int32()), ("first", pa.binary()), ("keys", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("names", pa.list_(pa.string())), ("sources", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])

    def spilled(block):
        rows = []
        for r in block.runs(shards, terms):
            rows.append(r)
            if len(rows) == 64:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches):
        block = Block()
        for b in slices(batches, 2, SLICE):
            block.add(b)
            if block.size > entries:
                block.compact()
            if block.size > entries // 2 and len(block.parts) == 1:
                yield from spilled(block)
                block = Block()
        yield from spilled(block)

    return rows.mapInArrow(run, RUNS)


def merged(blocks, least: int):
    """(key, occurrences by source) of each key in at least `least` documents, from blocks (keys, sizes, names, sources, counts, docs) in the order of their first keys."""
    heap: list[tuple] = []

    def until(limit):
        while heap and (limit is None or heap[0][0] < limit):
            key, seen, got = heap[0][0], 0, defaultdict(int)
            while heap and heap[0][0] == key:
                _, n, k, at, block = heap[0]
                keys, sizes, names, sources, counts, docs = block
                upto = at + sizes[k]
                for i in range(at, upto):
                    got[names[sources[i]]] += counts[i]
                    seen += docs[i]
                if k + 1 < len(keys):
                    heapq.heapreplace(heap, (keys[k + 1], n, k + 1, upto, block))
                else:
                    heapq.heappop(heap)
            if seen >= least:
                yield key, got

    for n, block in enumerate(blocks):
        yield from until(block[0][0])
        heapq.heappush(heap, (block[0][0], n, 0, 0, block))
    yield from until(None)


def frequencies(runs: DataFrame, least: int) -> DataFrame:
    """(lang, term, sources, counts) of the terms in at least `least` documents of their language."""

    def shards_of(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held = next(rows, None)
        while held is not None:
            now = held[0]

            def blocks():
                nonlocal held
                while held is not None and held[0] == now:
                    block = held[2:]
                    held = next(rows, None)
                    yield block

            yield from merged(blocks(), least)

    def run(batches):
        out = []

        def put():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())), strict=True)], ["lang", "term", "sources", "counts"])

        for key, got in shards_of(batches):
            lang, _, term = key.rpartition(b"\0")
            out.append((lang.replace(b"\0\xff", b"\0").decode(), term.decode(), list(got), list(got.values())))
            if len(out) == 5000:
                yield put()
                out.clear()
        if out:
            yield put()

    dealt = runs.repartition("shard").sortWithinPartitions("shard", "first")
    return dealt.mapInArrow(run, "lang string, term string, sources array<string>, counts array<long>")


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(1000000000 (count + 1) / (total + terms)), exactly; without terms, 1."""
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + F.lit(1)).cast("decimal(19,0)")
    whole = F.call_function("div", top, (F.col(total) + F.col(terms)).cast("decimal(19,0)"))
    return F.when(F.col(terms) > 0, whole + 1).otherwise(F.lit(1)).cast("long")


def gap(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q)."""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def corrections(terms: DataFrame, pairs: int = 1 << 20, held: int = 1 << 20) -> DataFrame:
    """(lang, source, item, value): for each pair of sources the sum over the terms of both, of what a term's value is more than those of its one-sided parts."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.decimal128(38, 0))])

    def floors(p, q):
        return (p - q) * (p - q) // q

    def run(batches):
        total: dict[tuple, int] = defaultdict(int)

        def put():
            rows = [(*k, Decimal(v)) for k, v in total.items()]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

        for b in batches:
            langs, lists = b.column(0).dictionary_encode(), b.column(1)
            size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            flat = lists.flatten()
            coded = flat.field("source").dictionary_encode()
            names, source = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            p, p0 = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("p", "p0"))
            lang, lang_names = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), langs.dictionary.to_pylist()
            begin = np.cumsum(size) - size
            # Each posting meets the others of its term; postings are taken so many at a time that the pairs stay few.
            owner = np.repeat(np.arange(len(size)), size)
            upto = np.cumsum(size[owner])
            lo = 0
            while lo < len(owner):
                done = upto[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(upto, done + pairs, "right")))
                mine = owner[lo:hi]
                i, j = np.repeat(np.arange(lo, hi), size[mine]), spread(begin[mine], size[mine])
                i, j = i[i != j], j[i != j]
                more = floors(p[i], p[j]) - floors(p[i], p0[j]) - floors(p0[i], p[j]) + floors(p0[i], p0[j])
                code = (lang[owner[i]] * len(names) + source[i]) * len(names) + source[j]
                order = np.argsort(code, kind="stable")
                code, more = code[order], more[order]
                first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
                if len(first):
                    high, low = np.add.reduceat(more >> 32, first), np.add.reduceat(more & 0xFFFFFFFF, first)
                    for c, x, y in zip(code[first].tolist(), high.tolist(), low.tolist(), strict=True):
                        c, item = divmod(c, len(names))
                        c, own = divmod(c, len(names))
                        total[lang_names[c], names[own], names[item]] += (x << 32) + y
                lo = hi
                if len(total) > held:
                    yield put()
        if total:
            yield put()

    return terms.mapInArrow(run, "lang string, source string, item string, value decimal(38,0)")


def divergence(docs: DataFrame, least: int = 3, top: int = 200, shards: int = 256, entries: int = 1_000_000) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows against each other source of the language, and `term` rows, the first `top` terms that a source has more of than its language."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = small_batches(docs).select(text("lang"), text("source"), text("text"))
    freq = cut(frequencies(spimi(rows, shards, entries), least))
    posts = freq.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", "term", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    vocab = cut(freq.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("lang_total")))
    totals = posts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(vocab, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = cut(groups.withColumn("p0", share(F.lit(0), "total", "terms")))

    known = posts.join(groups.select("lang", "source", "total", "terms", "p0"), ["lang", "source"])
    known = cut(known.select("lang", "term", "source", share(F.col("count"), "total", "terms").alias("p"), "p0"))
    q = freq.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("all")).join(vocab, "lang")
    q = q.select("lang", "term", share(F.col("all"), "lang_total", "terms").alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = known.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    wide = "decimal(38,0)"
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    steps = known.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("m")).join(other, "lang").where("source <> item")
    one = steps.select("lang", "source", "item", (F.col("m") * (gap("p", "q0") - gap("p0", "q0")).cast("decimal(19,0)")).cast(wide).alias("value"))
    back = steps.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("m") * (gap("q0", "p") - gap("q0", "p0")).cast("decimal(19,0)")).cast(wide).alias("value"))
    both = corrections(known.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("of")).select("lang", "of"))
    base = groups.join(other, "lang").where("source <> item").select("lang", "source", "item", (F.col("terms").cast("decimal(19,0)") * gap("p0", "q0").cast("decimal(19,0)")).cast(wide).alias("value"))
    pairs = base.union(one).union(back).union(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.union(terms)

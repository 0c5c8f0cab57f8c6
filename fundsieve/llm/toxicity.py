"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are the words of the examples that at least two of them hold. A term weighs (1 + log times) * idf * relevance:
document frequencies are counted over all documents; relevance is the absolute log-odds of the labels, lowered where a
chi-square shows them by chance and at least FLOOR, so that every term counts. Examples are a bounded sample of labelled
rows (`sample_rows` of each label); equal vectors are one, with their label counts. A block-max inverted index finds a
text's nearest examples exactly: the blocks of highest bound come first, then all whose bound reaches the last of the
nearest found. Votes are weighted by the squared cosine and by class size, so the smoothed share of toxic votes is a
probability; the neighbours are its evidence.

Cases: a text that shares no term with an example (null and empty ones too) gets the rate of toxic rows, and so does
every text if there are no labels; ties among neighbours go by their terms, never by an id; repeated rows repeat; a null
id is never learnt from and is not held out; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.langid import held_out
from fundsieve.llm.tables import small_batches
from fundsieve.llm.words import slices, word_hashes

SAMPLE_ROWS, NEIGHBOURS, BLOCK, FLOOR, SEEN_BITS = 2000, 25, 128, 0.02, 22


def word_terms(column) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), "alnum")


def counted(row: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times), sorted by row and term."""
    pair, times = np.unique(row.astype(np.int64) * max(1, width) + term, return_counts=True)
    return pair // max(1, width), pair % max(1, width), times


def ranges(lo: np.ndarray, many: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... (many[0] of them), lo[1], ..."""
    return np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())


class Terms:
    """Finds the terms of a lexicon in texts; a term is its place among the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.keys = np.sort(hashes)
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[(self.keys & np.uint64((1 << SEEN_BITS) - 1)).astype(np.int64)] = True

    def find(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, at = word_terms(column)
        pos = np.flatnonzero(self.seen[(h & np.uint64((1 << SEEN_BITS) - 1)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.keys, h[pos]), max(0, len(self.keys) - 1))
        hit = self.keys[k] == h[pos] if len(self.keys) else np.zeros(len(pos), bool)
        return counted(np.searchsorted(at, pos[hit], "right") - 1, k[hit], len(self.keys))


class Index:
    """Block-max inverted index over examples' unit vectors."""

    def __init__(self, hashes: np.ndarray, weight: np.ndarray, vectors: list[tuple], base: float):
        """vectors: (a doc_id, terms, times, weight of all rows, weight of toxic rows)"""
        self.terms, self.weight, self.base = Terms(hashes), weight, base
        units = [self.unit(v[1], v[2]) for v in vectors]
        # Examples with the same strongest term share blocks.
        order = sorted(range(len(vectors)), key=lambda k: (int(vectors[k][1][np.argmax(units[k])]), vectors[k][1].tobytes(), vectors[k][2].tobytes()))
        vectors, units = [vectors[k] for k in order], [units[k] for k in order]
        self.ids = [v[0] for v in vectors]
        self.all, self.toxic = (np.array([v[j] for v in vectors], float) for j in (3, 4))
        self.blocks = -(-len(vectors) // BLOCK)
        example = np.repeat(np.arange(len(vectors)), [len(v[1]) for v in vectors])
        term = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0, np.int64)
        unit = np.concatenate(units) if vectors else np.zeros(0)
        by = np.argsort(term, kind="stable")
        term, self.example, self.value = term[by], example[by], unit[by].astype(np.float32)
        # Postings lie by term and example; a cell is the part of a term's list that lies in one block.
        cell = term * max(1, self.blocks) + self.example // BLOCK
        _, first = np.unique(cell, return_index=True)
        self.posting_at = np.append(first, len(term)).astype(np.int32)
        self.cell_block = self.example[first] // BLOCK
        self.cell_most = np.maximum.reduceat(self.value, first) if len(first) else np.zeros(0, np.float32)
        self.cell_at = np.searchsorted(term[first], np.arange(len(hashes) + 1)).astype(np.int32)

    def unit(self, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        w = (1 + np.log(times)) * self.weight[term]
        return w / max(1e-12, float(np.sqrt((w * w).sum())))

    def nearest(self, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the nearest with a positive cosine, nearest first."""
        weight = self.unit(term, times)
        many = self.cell_at[term + 1] - self.cell_at[term]
        cell, weight = ranges(self.cell_at[term], many), np.repeat(weight, many)
        block = self.cell_block[cell]
        bound = np.bincount(block, weight * self.cell_most[cell], self.blocks)
        best_e, best_s, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        done = bound <= 0
        visit = np.zeros(self.blocks, bool)
        visit[np.argsort(-bound, kind="stable")[:8]] = True
        while (visit := visit & ~done).any():
            done |= visit
            on = visit[block]
            own, many = cell[on], self.posting_at[cell[on] + 1] - self.posting_at[cell[on]]
            posting = ranges(self.posting_at[own], many)
            score = np.round(np.bincount(self.example[posting], np.repeat(weight[on], many) * self.value[posting], len(self.ids)), 7)
            hit = np.flatnonzero(score > 0)
            best_e, best_s = np.concatenate([best_e, hit]), np.concatenate([best_s, score[hit]])
            keep = np.lexsort((best_e, -best_s))[:NEIGHBOURS]
            best_e, best_s = best_e[keep], best_s[keep]
            least = best_s[-1] if len(best_s) == NEIGHBOURS else 0.0
            visit = bound >= least - 1e-6
        return best_e, best_s

    def score(self, column) -> tuple[list[float], list[list]]:
        row, term, times = self.terms.find(column)
        scores, evidence = [self.base] * len(column), [[] for _ in range(len(column))]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        known: dict = {}
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(row))[: len(starts)].tolist(), strict=True):
            key = (term[a:b].tobytes(), times[a:b].tobytes())
            if key not in known:
                e, s = self.nearest(term[a:b], times[a:b])
                w = s * s
                known[key] = (float((w @ self.toxic[e] + 0.5 * self.base) / (w @ self.all[e] + 0.5)), [self.ids[k] for k in e[:5].tolist()])
            scores[row[a]], evidence[row[a]] = known[key]
        return scores, evidence


def relevance(n: np.ndarray, n_toxic: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """Of each term in n examples, n_toxic of them toxic: the size of its log-odds, lowered below the chi-square that some ten terms would reach by chance, at least FLOOR."""
    clean, n_clean = rows - toxic, n - n_toxic
    if not toxic or not clean:
        return np.ones(len(n))
    chi = (n_toxic * clean - n_clean * toxic).astype(float) ** 2 / (toxic * clean) * rows / (n * (rows - n) + 1.0)
    odds = np.abs(np.log((n_toxic + 0.5) / (toxic + 1)) - np.log((n_clean + 0.5) / (clean + 1)))
    by_chance = max(8.0, 2 * math.log(2 + len(n)) - 4)
    return np.maximum(FLOOR, odds / 4 * np.minimum(1, chi / by_chance))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Index:
    """Fit on at most sample_rows labelled rows of each label outside the held-out fifth; document frequencies cover all documents."""
    spark = docs.sparkSession
    marked = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    size = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = marked.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        picked = part if picked is None else picked.union(part)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")

    def vectors(batches):
        for b in slices(batches, 2):
            h, at = word_terms(b.column(2))
            keys, term = np.unique(h, return_inverse=True)
            row, term, times = counted(np.repeat(np.arange(b.num_rows), np.diff(at)), term, len(keys))
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            parts = [(keys[term[lo:hi]].tobytes(), times[lo:hi].astype(np.int32).tobytes()) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array([p[j] for p in parts], pa.binary()) for j in (0, 1)]], ["doc_id", "toxic", "terms", "times"])

    found = rows.mapInArrow(vectors, "doc_id long, toxic int, terms binary, times binary").collect()
    found = [(r.doc_id, r.toxic, np.frombuffer(r.terms, np.uint64), np.frombuffer(r.times, np.int32)) for r in found]
    every = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.uint64)
    of_toxic = np.repeat(np.array([f[1] for f in found], np.int64), [len(f[2]) for f in found]) if found else np.zeros(0, np.int64)
    keys, at_key, n = np.unique(every, return_inverse=True, return_counts=True)
    n_toxic = np.bincount(at_key, of_toxic, len(keys)).astype(np.int64)
    several = n >= 2
    keys, n, n_toxic = keys[several], n[several], n_toxic[several]
    finder = spark.sparkContext.broadcast(Terms(keys))

    def frequency(batches):
        total, seen = 0, np.zeros(len(finder.value.keys), np.int64)
        for b in slices(batches, 0):
            total += b.num_rows
            seen += np.bincount(finder.value.find(b.column(0))[1], minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], total))], ["term", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(frequency, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(len(keys)), 0
    for r in counts:
        if r.term < 0:
            total = r.n
        else:
            df[r.term] = r.n
    weight = (np.log((1 + total) / (1 + df)) + 1) * relevance(n, n_toxic, len(found), sum(f[1] for f in found))
    share = {y: size.get(y, 0) / max(1, min(sample_rows, size.get(y, 0))) for y in (0, 1)}
    alike: dict[tuple, list] = {}
    for doc_id, toxic, terms, times in sorted(found, key=lambda f: (f[0], f[1])):
        at = np.minimum(np.searchsorted(keys, terms), max(0, len(keys) - 1))
        on = keys[at] == terms if len(keys) else np.zeros(len(terms), bool)
        if on.any():
            own = alike.setdefault((at[on].tobytes(), times[on].tobytes()), [doc_id, at[on], times[on], 0.0, 0.0])
            own[3] += share[toxic]
            own[4] += share[toxic] * toxic
    return Index(keys, weight, [tuple(v) for v in alike.values()], size.get(1, 0) / max(1, sum(size.values())))


def classify(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, score, evidence) of every row; evidence: the nearest examples' ids."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in slices(batches):
            score, evidence = shared.value.score(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, evidence array<long>")


def without_toxic(docs: DataFrame, index: Index, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index("text")

    def run(batches):
        for b in slices(batches, at):
            score, _ = shared.value.score(b.column(at).cast(pa.string()))
            yield b.filter(pa.array([s < threshold for s in score], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)

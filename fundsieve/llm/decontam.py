"""Benchmark passages in documents, within an edit distance, by CGK embeddings and bit-sampling LSH.

Texts become words (lower case, ASCII punctuation ends words). A window at a word position is embedded by the CGK random
walk: at each step it emits the word under its pointer and moves on by a random bit of that word, so sequences at a
small edit distance get embeddings at a small Hamming distance. A window is as long as the item it may hold. Each repetition draws a new walk and samples few
positions; windows and items that agree on a repetition's sample are compared exactly (bit-parallel edit distance,
free ends in the document). Repetitions follow from the target recall.

Windows begin only where enough word grams agree with some item to allow the threshold (n - q + 1 - q * edits of them,
the q-gram lemma), which loses nothing. Items are taken in blocks, one after the other, so that what
each task and the driver hold has a bound.

Cases: null or empty texts have no match; items without words match nothing; items of fewer than five words must occur
exactly; repeated rows each give their matches; null ids pass through; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.tables import cut
from fundsieve.llm.words import gram_hashes, mix, slices, word_hashes

SAMPLED = 3
WALK_SEED = 20240611
WINDOWS = 4096  # embedded at once


def repetitions(recall: float, agree: float = 0.5) -> int:
    """Repetitions for `recall` when the share `agree` of embedded positions is equal."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree**SAMPLED))


def gram_size(n: int, edits: int) -> int:
    return max(1, min(3, (n - edits) // (edits + 1)))


def lowered_words(column) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), "alnum")


def walk_steps(n: int) -> int:
    """Steps of the walk for items of n words: by size class, so that windows need one embedding for each class."""
    return 2 * max(1, int(1.3 ** math.floor(math.log(n, 1.3))))


def embed(words: np.ndarray, start: np.ndarray, end: np.ndarray, steps: int, reps: int) -> np.ndarray:
    """The sampled parts of the CGK embeddings of windows [start, end), as one key for each window and repetition.

    All repetitions walk together: one step moves every pointer of every repetition that still has a position to sample.
    """
    rng = np.random.default_rng(WALK_SEED + steps)
    seeds = rng.integers(1, 1 << 63, (reps, steps), dtype=np.uint64)
    sampled = np.zeros((reps, steps), bool)
    for rep in range(reps):
        sampled[rep, rng.choice(steps, min(SAMPLED, steps), replace=False)] = True
    last = steps - 1 - np.argmax(sampled[:, ::-1], axis=1)
    order = np.argsort(-last, kind="stable")
    seeds, sampled, last = seeds[order], sampled[order], last[order]
    live = np.searchsorted(-last, -np.arange(steps), "right")  # repetitions still walking at each step
    out = np.zeros((len(start), reps), np.uint64)
    for lo in range(0, len(start), WINDOWS):
        begin, stop = start[lo : lo + WINDOWS], end[lo : lo + WINDOWS]
        where = np.repeat(begin[None, :], reps, axis=0)
        key = np.repeat((order + 1).astype(np.uint64)[:, None], len(begin), axis=1)
        for j in range(int(last[0]) + 1):
            on = int(live[j])
            at = where[:on]
            here = np.where(at < stop, words[np.minimum(at, len(words) - 1)], np.uint64(0))
            rows = np.flatnonzero(sampled[:on, j])
            key[rows] = mix(key[rows] ^ (here[rows] + np.uint64(j)))
            where[:on] += (mix(here ^ seeds[:on, j, None]) & np.uint64(1)).astype(np.int64)
        out[lo : lo + WINDOWS, order] = key.T
    return out


def edit_distance_within(item: list, text: list) -> tuple[int, int]:
    """(least edit distance of item to any part of text, where that part ends): Myers' bit-parallel recurrence on whole words."""
    n = len(item)
    masks: dict = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | (1 << i)
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, (n, 0)
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(x | up)), up & x
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        y = eq | down
        up, down = minus | (full & ~(y | plus)), plus & y
        best = min(best, (score, j + 1))
    return best


class Index:
    """Word grams and embedded keys of a block of items."""

    def __init__(self, ids: list, texts: list, similarity: float, recall: float):
        words, at = lowered_words(pa.array(texts, pa.string()))
        self.reps = repetitions(recall)
        self.items = [(i, words[lo:hi]) for i, lo, hi in zip(ids, at[:-1], at[1:], strict=True) if hi > lo]
        self.n = np.array([len(w) for _, w in self.items], np.int64)
        self.edits = np.floor(self.n * (1 - similarity) + 1e-9).astype(np.int64)
        grams: dict[int, list] = {}
        self.least = np.zeros(len(self.items), np.int64)
        for k, (_, w) in enumerate(self.items):
            q = gram_size(len(w), int(self.edits[k]))
            self.least[k] = max(1, len(w) - q + 1 - q * int(self.edits[k]))
            grams.setdefault(q, []).extend((int(h), k, o) for o, h in enumerate(gram_hashes(w, q).tolist()))
        self.grams = {}
        for q, rows in grams.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.grams[q] = (h, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), seen)
        self.keys: dict[int, dict] = {}
        self.steps = np.array([walk_steps(len(w)) for _, w in self.items], np.int64)
        self.walk = np.zeros(int(self.n.max(initial=0)) + 1, np.int64)
        self.walk[self.n] = self.steps
        ends = np.cumsum(self.n)
        every = np.concatenate([w for _, w in self.items]) if self.items else np.zeros(0, np.uint64)
        for steps in np.unique(self.steps).tolist():
            own = np.flatnonzero(self.steps == steps)
            table = self.keys.setdefault(steps, {})
            for k, keys in zip(own.tolist(), embed(every, ends[own] - self.n[own], ends[own], steps, self.reps).tolist(), strict=True):
                for key in keys:
                    table.setdefault(key, set()).add(k)

    def matches(self, column) -> list[tuple]:
        """(row, item_id, distance, words up to its end, words of the item) of each item found in each text."""
        words, at = lowered_words(column)
        found: dict[tuple, tuple] = {}
        starts = []
        for q, (h, item, offset, seen) in self.grams.items():
            g = gram_hashes(words, q)
            pos = np.flatnonzero(seen[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(h, g[pos], "left"), np.searchsorted(h, g[pos], "right")
            pos, lo, many = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            doc = np.searchsorted(at, pos, "right") - 1
            inside = pos + q <= at[doc + 1]
            pos, lo, many, doc = pos[inside], lo[inside], many[inside], doc[inside]
            if not len(pos):
                continue
            entry = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            pos, doc = np.repeat(pos, many), np.repeat(doc, many)
            k, begin = item[entry], pos - offset[entry]
            wide = np.int64(len(words) + 2 * self.n.max() + 2)
            line = (doc * len(self.items) + k) * (2 * wide) + begin + wide
            order = np.argsort(line, kind="stable")
            line, k, begin, doc = line[order], k[order], begin[order], doc[order]
            e = self.edits[k]
            hits = np.searchsorted(line, line + e, "right") - np.searchsorted(line, line - e, "left")
            ok = hits >= self.least[k]
            starts.append(np.unique(np.stack([doc[ok], self.n[k[ok]], np.clip(begin[ok], at[doc[ok]], None)]), axis=1))
        if not starts:
            return []
        starts = np.unique(np.concatenate(starts, axis=1), axis=1)
        walk = self.walk[starts[1]]
        for steps in np.unique(walk).tolist():
            doc, size, begin = starts[:, walk == steps]
            keys = embed(words, begin, np.minimum(begin + size, at[doc + 1]), steps, self.reps)
            table = self.keys.get(steps, {})
            for d, s, row in zip(doc.tolist(), begin.tolist(), keys.tolist(), strict=True):
                for k in set().union(*(table[key] for key in row if key in table)):
                    if found.get((d, k), (1,))[0] == 0:
                        continue
                    n, e = int(self.n[k]), int(self.edits[k])
                    lo, hi = max(int(at[d]), s - e), min(int(at[d + 1]), s + n + 2 * e)
                    distance, end = edit_distance_within(self.items[k][1].tolist(), words[lo:hi].tolist())
                    if distance <= e and ((d, k) not in found or (distance, lo + end) < found[d, k][:2]):
                        found[d, k] = (distance, lo + end)
        return [(d, self.items[k][0], dist, end - int(at[d]), int(self.n[k])) for (d, k), (dist, end) in sorted(found.items())]


def leaks(docs: DataFrame, items: DataFrame, similarity: float = 0.8, recall: float = 0.9999, block: int = 4096) -> DataFrame:
    """(doc_id, item_id, distance, similarity, end_word) for each item within the distance of some part of a document; end_word counts the words up to its end."""
    spark = docs.sparkSession
    some = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    total = some.count()
    blocks = max(1, math.ceil(total / block))
    some = cut(some) if blocks > 1 else some
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for i in range(blocks):
        rows = some.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()
        rows = sorted((r.item_id is None, r.item_id or 0, r.text) for r in rows)
        index = spark.sparkContext.broadcast(Index([None if none else i for none, i, _ in rows], [t for *_, t in rows], similarity, recall))

        def run(batches, index=index):
            for b in slices(batches):
                if len(index.value.items):
                    hits = index.value.matches(b.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([h[0] for h in hits], pa.int64())), pa.array([h[1] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int64()), pa.array([1 - h[2] / h[4] for h in hits], pa.float64()), pa.array([h[3] for h in hits], pa.int64())],
                        ["doc_id", "item_id", "distance", "similarity", "end_word"],
                    )

        part = texts.mapInArrow(run, "doc_id long, item_id long, distance long, similarity double, end_word long")
        if blocks > 1:  # one block's index at a time in memory
            part = cut(part)
            index.destroy()
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents that hold no benchmark item, unchanged; rows with a null id stay."""
    return docs.join(leaks(docs, items, similarity).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)

"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text: runs of SAMPLE_CHARS characters,
each from a place of its own in one of about SAMPLE_DOCS texts. A text is cut greedily into the
longest pieces that occur in a language's sample; the language that needs the fewest pieces, normalised by the text's
length and the sample's, wins. Every letter of the samples is a symbol of its own. All automata run over all texts of a batch in lockstep: the whole text is dealt into
segments of SEGMENT symbols, and each step moves every segment on by one symbol. A segment's end also ends a piece, for
all languages alike: at most one piece more for each SEGMENT symbols, in short texts none.

Cases: null texts and texts without letters are `und` with score 0, and so is every text if nothing was learnt; ties go
to the first language by name; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.tables import small_batches
from fundsieve.llm.words import slices

SEGMENT = 256
DENSE = 256  # symbols of a language, up to which its transitions are a full table
SAMPLE_DOCS, SAMPLE_CHARS = 120, 200


class Automaton:
    """Transitions of the suffix automaton of a sequence of symbols below `width`: a full table, or sorted keys where there are many symbols; 0 means none, as nothing leads back to the start."""

    def __init__(self, symbols: list[int], width: int, dense: int = DENSE):
        nxt, self.width = self.build(symbols), width
        kind = np.uint16 if len(nxt) < 1 << 16 else np.int32
        self.table = self.keys = None
        if width <= dense:
            self.table = np.zeros((len(nxt), width), kind)
            for s, row in enumerate(nxt):
                for c, t in row.items():
                    self.table[s, c] = t
            self.table = self.table.ravel()
        else:
            self.keys = np.array([s * width + c for s, row in enumerate(nxt) for c in sorted(row)] or [-1], np.int64)
            self.to = np.array([row[c] for row in nxt for c in sorted(row)] or [0], kind)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = state.astype(np.int64) * self.width + symbol
        if self.table is not None:
            return self.table[at].astype(np.int32)
        k = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[k] == at, self.to[k], 0).astype(np.int32)

    @staticmethod
    def build(symbols: list[int]) -> list[dict]:
        nxt: list[dict] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        return nxt


_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(column) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts and their n + 1 offsets."""
    column = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    size = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(size)])


class Model:
    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        joined = {k: "\n".join(texts[k]).lower() for k in self.languages}
        seen = Counter(c for t in joined.values() for c in t if c.isalpha())
        self.rare, self.pad = len(seen) + 1, len(seen) + 2  # letters of no sample; beyond the end of a text
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[is_letter()] = self.rare
        for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))):
            self.symbol[ord(c)] = k + 1
        self.tables, self.own, self.scale = [], [], []
        for k in self.languages:
            symbols = self.symbol[np.frombuffer(joined[k].encode("utf-32-le"), np.uint32)]
            used = np.unique(symbols[symbols > 0])
            own = np.full(len(seen) + 3, len(used) + 1, np.int32)  # the last one leads nowhere
            own[0], own[used] = 0, np.arange(1, len(used) + 1)
            self.tables.append(Automaton(own[symbols].tolist(), len(used) + 2))
            self.own.append(own)
            self.scale.append(math.log2(len(symbols) + 2))

    def pieces(self, grid: np.ndarray, live: np.ndarray) -> np.ndarray:
        """For each language, the number of pieces that each column of grid needs."""
        out = np.zeros((len(self.tables), grid.shape[1]), np.int32)
        for k, table in enumerate(self.tables):
            start = np.zeros(grid.shape[1], np.int32)
            state = np.zeros(grid.shape[1], np.int32)
            count = out[k]
            for row, on in zip(self.own[k][grid], live, strict=True):
                to = table.step(state, row)
                new = (to == 0) | (state == 0)
                count += new & on
                state = np.where(to == 0, table.step(start, row), to)
        return out

    def predict(self, column) -> tuple[list, list]:
        points, at = code_points(column)
        n = len(at) - 1
        symbols = self.symbol[points]
        size = np.diff(at)
        total = np.concatenate([[0], np.cumsum(symbols > 0)])
        letters = total[at[1:]] - total[at[:-1]]
        segments = -(-size // SEGMENT)
        doc = np.repeat(np.arange(n), segments)
        first = np.repeat(at[:-1] - (np.cumsum(segments) - segments) * SEGMENT, segments) + np.arange(len(doc)) * SEGMENT
        cost = np.zeros((len(self.tables), n))
        for k in range(0, len(doc), 8192):
            where = first[k : k + 8192, None] + np.arange(SEGMENT)
            live = where < at[doc[k : k + 8192] + 1][:, None]
            grid = np.where(live, symbols[np.minimum(where, len(symbols) - 1)], self.pad).astype(np.int32)
            got = self.pieces(np.ascontiguousarray(grid.T), np.ascontiguousarray(live.T))
            for i, row in enumerate(got):
                cost[i] += np.bincount(doc[k : k + 8192], row, n)
        if not self.languages:
            return ["und"] * n, [0.0] * n
        rate = cost * np.array(self.scale)[:, None] / np.maximum(size, 1)
        best = np.argmin(rate, axis=0)
        low = rate[best, np.arange(n)]
        second = np.sort(rate, axis=0)[1] if len(self.languages) > 1 else np.full(n, np.inf)
        score = np.where(letters > 0, 1 / (1 + (low / second) ** 8), 0.0)
        return [self.languages[b] if m else "und" for b, m in zip(best.tolist(), letters.tolist(), strict=True)], score.tolist()


def held_out(column: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)) == 0, F.lit(False))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on about sample_docs labelled texts of each language outside the held-out fifth, each with a run of sample_chars characters from a place of its own."""
    train = docs.where(~held_out() & F.col("lang").isNotNull() & (F.char_length("text") > 0))
    counts = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model({})
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, sample_docs / n))])[F.col("lang")]
    digest = F.xxhash64("text")  # copies are in together or out together, and count once
    picked = train.where(F.pmod(digest, F.lit(1_000_000)) < share * 1_000_000)
    start = F.pmod(F.xxhash64(digest), F.greatest(F.lit(1), F.char_length("text") - sample_chars + 1)) + 1
    rows = picked.select("lang", F.substring(F.col("text"), start.cast("int"), F.lit(sample_chars)).alias("text"), digest.alias("h")).distinct().collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.h, r.text)):
        texts.setdefault(r.lang, []).append(r.text)
    return Model(texts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches):
            lang, score = shared.value.predict(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text has a language, with all their columns."""
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    at = names.index("text")

    def run(batches):
        for part in slices(batches, at):
            lang, _ = shared.value.predict(part.column(at).cast(pa.string()))
            yield part.filter(pa.array([x != "und" for x in lang], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)

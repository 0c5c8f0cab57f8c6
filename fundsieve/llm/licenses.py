"""License texts and notices in documents by patience alignment.

Words unique to both a template and a part of a document are anchors; the longest increasing run of their places is
kept and the gaps between them are aligned the same way, with common beginnings and ends first. Of the matched words the
stretch counts that gains most, a word between them that the template lacks costing as much as a matched one gains.
Coverage is the share of matched words among the template's and those extra ones. Of templates that overlap in a
document the one that covers best wins, then the one with more matched words.

A template is the whole text of a license or a notice: a phrase that releases something and the license's name. Of a
notice the name is found first, in full and without words between, so that versions and variants are told apart; then the
phrases are aligned with the words before it, once for all places with the same words, and more than half of one must
stand there, so that a license that is only named is none. A name that is an everyday word or an identifier needs the
whole phrase right before it. Names joined to a notice's by words like "and" or "or" belong to it as well, and a name
that fills a line is a heading. A part of a document is tried for a whole text where a fifth of its runs of three words
agree with it on about the same diagonal. Tasks hold the templates, whose number is fixed.

Cases: null and empty texts hold no license; every place of a license in a text is a row; repeated rows repeat; other
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from importlib import resources

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.decontam import lowered_words
from fundsieve.llm.words import gram_hashes, slices

# Names of public licenses as notices write them, and the phrases before the names.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "0BSD License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons Zero 1.0", "CC0 1.0 Universal"],
    "EPL-2.0": ["Eclipse Public License 2.0", "EPL-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
CC_VARIANTS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ("2.0", "3.0", "4.0")
PHRASES = ["Licensed under", "Licensed under the", "Released under the", "Distributed under the terms of the", "This work is licensed under", "This work is licensed under the", "Available under the", "SPDX-License-Identifier:"]
JOINING = "and or the a an either both license licenses licence under at your option terms of with later any version".split()
BEFORE, BETWEEN = 12, 5  # words before a name that a phrase is looked for in, and between joined names


def names() -> list[tuple[str, str, bool]]:
    """(license, name, whether the name needs a whole phrase right before it)."""
    own = {k: list(v) for k, v in NAMES.items()}
    for short, full in CC_VARIANTS.items():
        for version in CC_VERSIONS:
            tail = " International License" if version == "4.0" else " License"
            own[f"CC-{short}-{version}"] = [f"CC {short} {version}", f"Creative Commons {full} {version}{tail}"]
    out = [(k, n, " " not in n and "-" not in n) for k, v in sorted(own.items()) for n in v]
    known = {(k, n.lower()) for k, n, _ in out}
    return out + [(k, k, True) for k in sorted(own) if (k, k.lower()) not in known]


def texts() -> list[tuple[str, str]]:
    """(license, whole text) of the licenses packaged with this module."""
    folder = resources.files(__package__) / "license_texts"
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of equal words of a and b, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {a[i]: i for i in range(a0, a1) if in_a[a[i]] == 1}
        ends: list[int] = []
        last: list[tuple] = []
        for j in range(b0, b1):
            if in_b[b[j]] == 1 and b[j] in place:
                i = place[b[j]]
                k = bisect_left(ends, i)
                node = (i, j, last[k - 1] if k else None)
                ends[k : k + 1], last[k : k + 1] = [i], [node]
        node = last[-1] if last else None
        if node is None:
            continue
        while node:
            i, j, node = node
            out.append((i, j))
            todo.append((i + 1, a1, j + 1, b1))
            a1, b1 = i, j
        todo.append((a0, a1, b0, b1))
    return sorted(out)


def best_stretch(pairs: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(first, last, extra) of the stretch of pairs that gains most; extra: words of b between them that match nothing."""
    best, start, gain, extra = (0, 0, 0, 0), 0, 0, 0
    for k in range(len(pairs)):
        between = pairs[k][1] - pairs[k - 1][1] - 1 if k else 0
        if gain - between <= 0:
            start, gain, extra = k, 0, 0
        else:
            gain, extra = gain - between, extra + between
        gain += 1
        if gain > best[0]:
            best = (gain, start, k, extra)
    return best[1:]


class Templates:
    """Whole texts by runs of three words, and notices by their names' words."""

    def __init__(self, whole: list[tuple[str, str]], named: list[tuple[str, str, bool]]):
        split = lambda texts: [w.tolist() for w in np.split(*self.words_at(texts))]
        self.ids, self.words = [k for k, _ in whole], split([t for _, t in whole])
        self.phrases, self.joining = split(PHRASES), {w for own in split(JOINING) for w in own}
        self.named = [(k, w, strict) for (k, _, strict), w in zip(named, split([n for _, n, _ in named]), strict=True)]
        grams = sorted((h, k, o) for k, w in enumerate(self.words) for o, h in enumerate(gram_hashes(np.array(w, np.uint64), 3).tolist()))
        self.grams = (np.array([g[0] for g in grams], np.uint64), np.array([g[1] for g in grams], np.int64), np.array([g[2] for g in grams], np.int64))
        sizes: dict[int, dict[int, int]] = {}
        for k, (_, w, _) in enumerate(self.named):
            sizes.setdefault(len(w), {}).setdefault(gram_hashes(np.array(w, np.uint64), len(w)).tolist()[0], k)
        self.by_size = {n: (np.array(sorted(own), np.uint64), own) for n, own in sizes.items()}
        self.seen: dict[tuple, tuple[float, int]] = {}

    @staticmethod
    def words_at(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, at = lowered_words(pa.array(texts, pa.string()))
        return words, at[1:-1]

    def hits(self, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, text, first and last diagonal) of each part to try."""
        h, template, offset = self.grams
        g = gram_hashes(words, 3)
        pos = np.flatnonzero(np.isin(g, h))
        doc = np.searchsorted(at, pos, "right") - 1
        inside = pos + 3 <= at[doc + 1]
        pos, doc = pos[inside], doc[inside]
        lo, hi = np.searchsorted(h, g[pos], "left"), np.searchsorted(h, g[pos], "right")
        many = hi - lo
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(pos) else np.zeros(0, np.int64)
        k, diagonal, doc = template[entry], np.repeat(pos, many) - offset[entry], np.repeat(doc, many)
        order = np.lexsort((diagonal, k, doc))
        k, diagonal, doc = k[order], diagonal[order], doc[order]
        size = np.array([len(w) for w in self.words])[k] if len(k) else k
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (doc[1:] != doc[:-1]) | (diagonal[1:] - diagonal[:-1] > np.maximum(2, size[1:] // 4))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(k))[: len(first)] - 1
        enough = last - first + 1 >= np.array([max(1, (len(w) - 2) // 5) for w in self.words])[k[first]] if len(first) else np.zeros(0, bool)
        return [(int(doc[a]), int(k[a]), int(diagonal[a]), int(diagonal[b])) for a, b in zip(first[enough], last[enough], strict=True)]

    def places(self, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, first word, words, name) of each name, in order."""
        out = []
        for n, (known, which) in self.by_size.items():
            g = gram_hashes(words, n)
            pos = np.flatnonzero(np.isin(g, known))
            doc = np.searchsorted(at, pos, "right") - 1
            inside = pos + n <= at[doc + 1]
            out += [(d, p, n, which[h]) for d, p, h in zip(doc[inside].tolist(), pos[inside].tolist(), g[pos[inside]].tolist(), strict=True)]
        return sorted(out)

    def phrase(self, before: list[int], n: int) -> tuple[float, int]:
        """(coverage, words from the phrase's first to the name) of the phrase that covers best, for a name of n words behind these."""
        key = (n, *before)
        if key not in self.seen:
            best = (0.0, 0)
            for phrase in self.phrases:
                window = before[max(0, len(before) - len(phrase) - max(2, (len(phrase) + n) // 4)) :]
                pairs = patience(phrase, window)
                pairs += [(len(phrase) + i, len(window) + i) for i in range(n)]
                a, b, extra = best_stretch(pairs)
                head = len(pairs) - n - a
                if b == len(pairs) - 1 and 2 * head > len(phrase):
                    best = max(best, ((b - a + 1) / (len(phrase) + n + extra), len(window) - pairs[a][1]))
            if len(self.seen) >= 1 << 16:
                self.seen.clear()
            self.seen[key] = best
        return self.seen[key]

    def notices(self, words: np.ndarray, at: np.ndarray, lines: np.ndarray, least: float) -> list[tuple]:
        """(document, coverage, words, license, first word, last word, kind) of notices, names joined to them, and headings."""
        out = []
        joined_to, cover_before, end = -1, 0.0, 0  # the document, coverage and end of the notice before
        starts = set(lines.tolist())
        for d, p, n, k in self.places(words, at):
            name, _, strict = self.named[k]
            before = words[max(int(at[d]), p - BEFORE) : p].tolist()
            cover, back = self.phrase(before, n)
            ways = [(cover, p - back, "notice")] if cover >= (1.0 if strict else least) else []
            if joined_to == d and p <= end + BETWEEN and all(w in self.joining for w in words[end:p].tolist()):
                ways.append((cover_before, p, "notice"))
            if not strict and p in starts and p + n in starts:
                ways.append((1.0, p, "heading"))
            out += [(d, c, p + n - first, name, first, p + n - 1, kind) for c, first, kind in ways]  # the best of them is taken
            notices = [c for c, _, kind in ways if kind == "notice"]
            if notices:
                end = max(end, p + n) if joined_to == d else p + n
                joined_to, cover_before = d, max(notices)
        return out

    def find(self, column, least: float) -> list[tuple]:
        """(row, license, kind, coverage, first word, last word) of each license of each text."""
        parted = pc.split_pattern(column.cast(pa.large_string()).fill_null(""), "\n")
        words, line_at = lowered_words(parted.flatten())
        at = line_at[np.asarray(parted.offsets) - int(parted.offsets[0].as_py())]
        found = [(d, -cover, -n, name, a, b, kind) for d, cover, n, name, a, b, kind in self.notices(words, at, line_at, least)]
        for d, k, first, last in self.hits(words, at):
            n = len(self.words[k])
            slack = max(2, n // 4)
            lo, hi = max(int(at[d]), first - slack), min(int(at[d + 1]), last + n + slack)
            pairs = patience(self.words[k], words[lo:hi].tolist())
            if not pairs:
                continue
            a, b, extra = best_stretch(pairs)
            cover = (b - a + 1) / (n + extra)
            if cover >= least:
                found.append((d, -cover, -(b - a + 1), self.ids[k], lo + pairs[a][1], lo + pairs[b][1], "text"))
        out: list[tuple] = []
        taken: dict[int, tuple[list[int], list[int]]] = {}  # first and last words of what a text's finds have taken, in order
        for d, cover, _, name, a, b, kind in sorted(found):
            firsts, lasts = taken.setdefault(d, ([], []))
            i = bisect_left(firsts, a)
            if (i == 0 or lasts[i - 1] < a) and (i == len(firsts) or firsts[i] > b):
                firsts.insert(i, a)
                lasts.insert(i, b)
                out.append((d, name, kind, -cover, a - int(at[d]), b - int(at[d])))
        return sorted(out, key=lambda r: (r[0], r[4]))


def scan(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, license, kind, coverage, first_word, last_word) of each license found in a text; kind: text, notice or heading."""
    shared = docs.sparkSession.sparkContext.broadcast(Templates(texts(), names()))

    def run(batches):
        for b in slices(batches):
            hits = shared.value.find(b.column(1), least)
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([h[0] for h in hits], pa.int64())), *[pa.array([h[i + 1] for h in hits], t) for i, t in enumerate(kinds)]], ["doc_id", "license", "kind", "coverage", "first_word", "last_word"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, license string, kind string, coverage double, first_word long, last_word long")

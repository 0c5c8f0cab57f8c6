"""Weighted acyclic automata over sorted runs of up to three words, as arrays.

Grams are the automaton's paths in order: three columns of word numbers (0: no more words) with a weight each. The
builder takes them in sorted blocks and freezes what is complete: all paths but those of the last first word. A frozen
state goes to the register of its depth, so states with the same outgoing arcs (word, weight, target) are one; most runs
of two words go on with one word once, so they share few states. The weight of a run stands on its last arc.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fundsieve.llm.words import U, mix

DEPTH = 3
BITS = 21


@dataclass
class Grams:
    words: pa.Array  # distinct, in the order of their bytes
    cols: list[np.ndarray]  # 1 + number of each word, 0 where the run has ended
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.weight)

    def at(self, rows: np.ndarray | slice) -> Grams:
        return Grams(self.words, [c[rows] for c in self.cols], self.weight[rows])


def ordered(cols: list[np.ndarray]) -> np.ndarray:
    """The order of the rows by their columns."""
    if all(len(c) == 0 or c.max() < 1 << BITS for c in cols):
        key = np.zeros(len(cols[0]), np.int64)
        for c in cols:
            key = (key << BITS) | c
        return np.argsort(key, kind="stable")
    return np.lexsort(cols[::-1])


def changes(cols: list[np.ndarray]) -> np.ndarray:
    """Whether each row differs from the one before."""
    new = np.ones(len(cols[0]), bool)
    if len(new):
        new[1:] = False
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
    return new


def summed(words: pa.Array, cols: list[np.ndarray], weight: np.ndarray, fold=np.add) -> Grams:
    """The distinct rows in order, with their weights' sums (or another fold of them)."""
    order = ordered(cols)
    cols = [c[order] for c in cols]
    first = np.flatnonzero(changes(cols))
    return Grams(words, [c[first] for c in cols], fold.reduceat(weight[order], first) if len(first) else weight[:0])


def over_one_alphabet(parts: list[Grams]) -> tuple[pa.Array, list[list[np.ndarray]]]:
    """The words of all parts in order, and each part's columns by them."""
    words = pa.chunked_array([p.words for p in parts], pa.binary()).unique()
    words = words.take(pc.array_sort_indices(words))
    out = []
    for p in parts:
        to = np.concatenate([[0], pc.index_in(p.words, value_set=words).to_numpy(zero_copy_only=False) + 1]).astype(np.int32)
        out.append([to[c] for c in p.cols])
    return words, out


def union(parts: list[Grams], fold=np.add) -> Grams:
    """All paths of the parts, with the sums (or another fold) of their weights."""
    words, cols = over_one_alphabet(parts)
    return summed(words, [np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate([p.weight for p in parts]), fold)


def compose(counts: Grams, asked: Grams) -> Grams:
    """The asked paths that counts holds, with its weights."""
    words, (have, want) = over_one_alphabet([counts, asked])
    where = locate(have, want)
    found = where >= 0
    return Grams(words, [c[found] for c in want], counts.weight[where[found]])


def locate(have: list[np.ndarray], want: list[np.ndarray]) -> np.ndarray:
    """The row of `have` (distinct rows) that equals each row of `want`, else -1."""
    cols = [np.concatenate(c) for c in zip(have, want, strict=True)]
    order = ordered(cols)
    run = np.cumsum(changes([c[order] for c in cols])) - 1
    known = order < len(have[0])
    row = np.full(len(order), -1, np.int64)
    row[run[known]] = order[known]
    out = np.empty(len(want[0]), np.int64)
    out[order[~known] - len(have[0])] = row[run[~known]]
    return out


def own_alphabet(g: Grams) -> Grams:
    """The same paths over the words that occur in them."""
    used = np.zeros(len(g.words) + 1, bool)
    for c in g.cols:
        used[c] = True
    used[0] = False
    to = np.cumsum(used).astype(np.int32)
    to[0] = 0
    return Grams(g.words.take(pa.array(np.flatnonzero(used) - 1)), [to[c] for c in g.cols], g.weight)


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, … of each row, count of them, one row after another."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class States:
    """The register of one depth: arcs of the distinct states, one state after another."""

    def __init__(self) -> None:
        self.first = np.zeros(1, np.int64)
        self.arcs = [np.zeros(0, np.int64) for _ in range(3)]  # label, weight, target
        self.known = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def register(self, label: np.ndarray, weight: np.ndarray, target: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The number of each state given by its arcs; a state that is not there yet is added."""
        arcs = [np.concatenate([a, b]) for a, b in zip(self.arcs, (label, weight, target), strict=True)]
        begin, size = first[:-1] + len(self.arcs[0]), np.diff(first)
        with np.errstate(over="ignore"):
            h = mix(mix(mix(label.astype(U)) + weight.astype(U)) + target.astype(U))
            total = np.concatenate([np.zeros(1, U), np.cumsum(h)])
            sign = mix(total[first[1:]] - total[first[:-1]] + size.astype(U))
        old_begin, old_size = self.first[:-1], np.diff(self.first)

        def same(rows: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            """Whether the arcs of each of these new states are those that stand at `begins`."""
            out = size[rows] == sizes
            there = np.flatnonzero(out)
            n = size[rows[there]]
            x, y = spread(begin[rows[there]], n), spread(begins[there], n)
            differs = np.zeros(len(x), np.int64)
            for a in arcs:
                differs |= a[x] != a[y]
            upto = np.concatenate([[0], np.cumsum(differs)])
            end = np.cumsum(n)
            out[there] = upto[end] == upto[end - n]
            return out

        ids = np.full(len(size), -1, np.int64)
        signs, numbers = self.known
        if len(signs):
            at = np.minimum(np.searchsorted(signs, sign), len(signs) - 1)
            rows = np.flatnonzero(signs[at] == sign)
            number = numbers[at[rows]]
            good = same(rows, old_begin[number], old_size[number])
            ids[rows[good]] = number[good]
        rest = np.flatnonzero(ids < 0)
        _, lead, which = np.unique(sign[rest], return_index=True, return_inverse=True)
        lead = rest[lead][which]
        merged = same(rest, begin[lead], size[lead])
        own = rest[~merged | (rest == lead)]  # equal signs of unequal states: each stays by itself
        ids[own] = len(old_size) + np.arange(len(own))
        ids[rest[merged]] = ids[lead[merged]]
        self.arcs = [np.concatenate([a, x[spread(begin[own], size[own])]]) for a, x in zip(self.arcs, arcs, strict=True)]
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size[own])])
        fresh = own[np.unique(sign[own], return_index=True)[1]] if len(own) else own
        fresh = fresh[~np.isin(sign[fresh], signs)] if len(signs) else fresh
        order = np.argsort(np.concatenate([signs, sign[fresh]]), kind="stable")
        self.known = (np.concatenate([signs, sign[fresh]])[order], np.concatenate([numbers, ids[fresh]])[order])
        return ids


class Builder:
    """Incremental construction from sorted blocks of paths over one alphabet."""

    def __init__(self, words: pa.Array):
        self.words, self.open = words, None
        self.root: list[list[np.ndarray]] = [[], [], []]
        self.one, self.two = States(), States()

    def add(self, cols: list[np.ndarray], weight: np.ndarray) -> None:
        if self.open:
            cols, weight = [np.concatenate(c) for c in zip(self.open[0], cols, strict=True)], np.concatenate([self.open[1], weight])
        if len(weight):
            k = int(np.searchsorted(cols[0], cols[0][-1]))
            self.freeze([c[:k] for c in cols], weight[:k])
            self.open = ([c[k:] for c in cols], weight[k:])

    def freeze(self, cols: list[np.ndarray], weight: np.ndarray) -> None:
        a, b, c = cols
        if not len(a):
            return
        third = np.flatnonzero(c > 0)
        pair = np.flatnonzero((b > 0) & changes([a, b]))
        one = np.flatnonzero(changes([a]))
        own = lambda rows, ended: np.where(ended[rows] == 0, weight[rows], 0)  # noqa: E731 (a path whose prefix is not here)
        two = self.two.register(c[third].astype(np.int64), weight[third], np.zeros(len(third), np.int64), np.searchsorted(third, np.append(pair, len(a))))
        ones = self.one.register(b[pair].astype(np.int64), own(pair, c), two, np.searchsorted(pair, np.append(one, len(a))))
        for have, new in zip(self.root, (a[one].astype(np.int64), own(one, b), ones), strict=True):
            have.append(new)

    def finish(self) -> Automaton:
        if self.open:
            self.freeze(*self.open)
        root = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in self.root]
        return Automaton(self.words, [root, self.one.arcs, self.two.arcs], [self.one.first, self.two.first])


@dataclass
class Automaton:
    words: pa.Array
    arcs: list[list[np.ndarray]]  # by depth: label, weight, target
    first: list[np.ndarray]  # where each state's arcs begin, for the states after one and after two words

    @classmethod
    def of(cls, g: Grams, block: int = 1 << 18) -> Automaton:
        build = Builder(g.words)
        for lo in range(0, len(g), block):
            build.add([c[lo : lo + block] for c in g.cols], g.weight[lo : lo + block])
        return build.finish()

    def paths(self) -> Grams:
        """All paths with a weight, in order."""
        a, wa, t = self.arcs[0]
        n = np.diff(self.first[0])[t]
        at = spread(self.first[0][t], n)
        a2, (b, wb, t2) = np.repeat(a, n), [x[at] for x in self.arcs[1]]
        n = np.diff(self.first[1])[t2]
        at = spread(self.first[1][t2], n)
        c, wc = (x[at] for x in self.arcs[2][:2])
        zero = lambda x: np.zeros(len(x), np.int64)
        cols = [np.concatenate(x).astype(np.int32) for x in ((a, a2, np.repeat(a2, n)), (zero(a), b, np.repeat(b, n)), (zero(a), zero(b), c))]
        weight = np.concatenate([wa, wb, wc])
        order = ordered(cols)
        order = order[weight[order] > 0]
        return Grams(self.words, [x[order] for x in cols], weight[order])

    def write(self) -> bytes:
        """The automaton as bytes: every array in its narrowest type, compressed."""
        size = pc.binary_length(self.words).to_numpy(zero_copy_only=False)
        arrays = [size, *[np.diff(f) for f in self.first], *[x for arcs in self.arcs for x in arcs]]
        letters = b"".join(self.words.to_pylist())
        head, body = [len(letters)], [letters]
        for x in arrays:
            kind = next(k for k in (1, 2, 4, 8) if len(x) == 0 or int(x.max()) < 1 << (8 * k - (k == 8)))
            head += [len(x), kind]
            body.append(x.astype(f"<u{kind}").tobytes())
        raw = np.array(head, "<i8").tobytes() + b"".join(body)
        return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def read(cls, blob: bytes) -> Automaton:
        raw = pa.decompress(blob[8:], int(np.frombuffer(blob[:8], "<i8")[0]), codec="zstd", asbytes=True)
        head = np.frombuffer(raw, "<i8", 25).tolist()
        at = 25 * 8 + head[0]
        letters, arrays = raw[25 * 8 : at], []
        for n, kind in zip(head[1::2], head[2::2], strict=True):
            arrays.append(np.frombuffer(raw, f"<u{kind}", n, at).astype(np.int64))
            at += n * kind
        starts = [np.concatenate([np.zeros(1, np.int64), np.cumsum(x)]) for x in arrays[:3]]
        words = pa.Array.from_buffers(pa.binary(), len(arrays[0]), [None, pa.py_buffer(starts[0].astype(np.int32)), pa.py_buffer(letters)])
        return cls(words, [arrays[3:6], arrays[6:9], arrays[9:12]], starts[1:])


def write(g: Grams) -> bytes:
    return Automaton.of(own_alphabet(g)).write()


def read(blob: bytes) -> Grams:
    return Automaton.read(blob).paths()

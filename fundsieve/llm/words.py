"""Word hashing over Arrow string columns, vectorised over whole batches.

Words are hashed straight from the UTF-8 buffer: a running polynomial sum over the bytes gives each word's hash
from two positions, so no Python object is made per word. Hashes are 64 bits wide.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
PIECE = 1 << 18
TIDY = 1 << 22
U = np.uint64
LOWER = np.array([b + 32 * (65 <= b <= 90) for b in range(256)], np.uint8)

_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get("pow")
    if have is None or len(have) < n:
        size = max(n, PIECE + (1 << 16))
        up = np.full(size, U(BASE))
        up[0] = 1
        down = np.full(size, U(pow(BASE, -1, 1 << 64)))
        down[0] = 1
        with np.errstate(over="ignore"):
            _tables["pow"], _tables["inv"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _tables["pow"], _tables["inv"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def byte_tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(is separator, value) by byte. space: words end at blanks and control space; alnum: at any ASCII byte that is no letter or digit. A-Z fold to a-z."""
    b = np.arange(256)
    low = np.where((b >= 65) & (b <= 90), b + 32, b)
    if kind == "space":
        sep = (b == 32) | ((b >= 9) & (b <= 13))
    else:
        sep = ~(((low >= 97) & (low <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128))
    return sep, (low + 1).astype(np.uint64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_hashes(column, kind: str = "alnum", heads: tuple[int, ...] = ()):
    """All words' hashes in order, and each text's n + 1 offsets into them; for each length in heads also the hashes of the words' first bytes (0 for words that are no longer)."""
    raw, at = utf8(column)
    sep_of, value_of = byte_tables(kind)
    out, counts_at, done = [], np.zeros(len(at), np.int64), 0
    cut: list[list] = [[] for _ in heads]
    lo = 0
    while lo < len(raw):
        hi = min(len(raw), lo + PIECE)
        while hi < len(raw):  # a piece ends where a word ends or a text ends
            stop = np.flatnonzero(sep_of[raw[hi : hi + PIECE]])
            text = at[np.searchsorted(at, hi)]
            hi = min(int(text), hi + int(stop[0]) if len(stop) else min(len(raw), hi + PIECE))
            if len(stop) or hi == text:
                break
        piece = raw[lo:hi]
        word = ~sep_of[piece]
        first = np.empty_like(word)
        first[0] = True
        first[1:] = ~word[:-1]
        bounds = at[(at >= lo) & (at < hi)] - lo
        first[bounds] = True
        start = np.flatnonzero(word & first)
        last = np.empty_like(word)
        last[-1] = True
        last[:-1] = ~word[1:]
        inner = bounds[bounds > 0] - 1
        last[inner] = True
        end = np.flatnonzero(word & last) + 1
        up, down = powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(value_of[piece] * up[: len(piece)], out=total[1:])
            h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
            for k, own in zip(heads, cut, strict=True):
                part = mix((total[np.minimum(start + k, end)] - total[start]) * down[start] + U(k << 20))
                own.append(np.where(end - start > k, part, U(0)))
        out.append(h)
        where = np.flatnonzero((at >= lo) & (at < hi))
        counts_at[where] = done + np.searchsorted(start, at[where] - lo)
        done += len(h)
        lo = hi
    counts_at[at >= len(raw)] = done
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return (join(out), counts_at, *map(join, cut))


def distinct_words(raw: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in the order of their bytes, and the number of each occurrence; `word` marks the bytes of words."""
    upto = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(upto), pa.py_buffer(LOWER[raw[word]])]).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy(zero_copy_only=False)]


def give_back() -> None:
    """Return to the system what Arrow's and C's allocators hold unused."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidied(batches):
    """The record batches; after the last, the worker gives its unused memory back if the task had more than a little, as Spark keeps workers for later tasks."""
    seen = 0
    for b in batches:
        seen += b.nbytes
        yield b
        del b
    if seen > TIDY:
        give_back()


def slices(batches, column: int = 1, limit: int = 1 << 20):
    """The record batches in parts of about `limit` bytes of one text column, so that what is derived from a part stays small."""
    for b in tidied(batches):
        size = np.diff(utf8(b.column(column))[1])
        upto, lo = np.cumsum(size), 0
        while lo < b.num_rows:
            done = upto[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, done + limit, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words of one sequence; none if it is shorter."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, U(n))
    with np.errstate(over="ignore"):
        for k in range(n):
            h = mix(h * U(BASE) + words[k : k + m])
    return h

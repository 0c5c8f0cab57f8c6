"""Byte-level BPE with the tokenizers library over Arrow batches.

The ranks of a .tiktoken file become the library's vocabulary and merges: a token's merges are all its splits into two
known tokens, in rank order. Bytes stand as printable characters inside the library (the usual byte table); decoding
reverses that table and joins bytes first, so characters split over tokens come out whole. Each match of the pattern
is encoded by itself; special tokens do not exist.

Cases: null and empty texts have no tokens and decode to no bytes; texts of any length are encoded whole; rows pass
one by one, so repeated rows repeat and an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from fundsieve.llm.words import mix, powers, slices, utf8

PIECE = 1 << 22
MEMORY = 2_000_000
WIDE_BYTES = re.compile(b"[\xc2\xe1\xe2\xe3]")
RUN = 1 << 20


def byte_table() -> list[str]:
    """The printable character of each byte: itself where printable in Latin-1, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def build(path: str, pattern: str):
    ranks, table = read_ranks(path), byte_table()
    shown = {t: "".join(table[b] for b in t) for t in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        splits = [(ranks[token[:i]], ranks[token[i:]], token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        merges += [(shown[a], shown[b]) for *_, a, b in sorted(splits)]
    tok = Tokenizer(BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tok.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


def ragged(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + count], one after another."""
    return flat[np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())]


def part_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pattern surely begins a match whatever stands before.

    That is at a text's start; at a space or line feed between characters that are no white space, and behind such a
    line feed; and between an ASCII letter and an ASCII sign. White space of several bytes begins with C2, E1, E2 or E3;
    characters of these are left inside a part.
    """
    b = np.concatenate([np.full(3, 32, np.uint8), raw, np.full(1, 32, np.uint8)])
    kind = KIND[b]
    lone = (kind[2:-2] != BLANK) & (kind[4:] != BLANK) & (kind[4:] != WIDE) & (kind[1:-3] != WIDE) & (kind[:-4] != WIDE) & (kind[2:-2] != WIDE)
    free = lone & ((raw == 32) | (raw == 10)) | (kind[2:-2] == LETTER) & (kind[3:-1] == SIGN)
    free[1:] |= lone[:-1] & (raw[:-1] == 10)
    free[at[:-1][at[:-1] < len(raw)]] = True
    return np.flatnonzero(free)


OTHER, BLANK, WIDE, LETTER, SIGN = range(5)
_byte = np.arange(256)
_letter = ((_byte | 32) >= 97) & ((_byte | 32) <= 122) & (_byte < 128)
_sign = (_byte > 32) & (_byte < 127) & ~_letter & ~((_byte >= 48) & (_byte <= 57))
KIND = np.select([_byte <= 32, np.isin(_byte, [0xC2, 0xE1, 0xE2, 0xE3]), _letter, _sign], [BLANK, WIDE, LETTER, SIGN], OTHER).astype(np.uint8)


class Memory:
    """Ids of parts by the parts' hashes: sorted tables of growing size, merged as they fill, up to MEMORY parts."""

    def __init__(self):
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.flat, self.used, self.parts = np.zeros(1 << 16, np.int32), 0, 0

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash's ids begin (-1: unknown) and how many there are."""
        start, count = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        for keys, begin, size in self.tables:
            pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[pos] == h
            start[hit], count[hit] = begin[pos[hit]], size[pos[hit]]
        return start, count

    def add(self, h: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.tables.append((h, self.used + np.cumsum(count) - count, count))
        self.used += len(ids)
        self.parts += len(h)
        while len(self.tables) > 1 and len(self.tables[-2][0]) < 2 * len(self.tables[-1][0]):
            joined = [np.concatenate(x) for x in zip(self.tables.pop(), self.tables.pop(), strict=True)]
            order = np.argsort(joined[0], kind="stable")
            self.tables.append(tuple(x[order] for x in joined))


class Codec:
    """Encoder and decoder, built once in each worker."""

    _made: dict = {}

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = build(path, pattern)
        ranks = read_ranks(path)
        self.bytes = {r: t for t, r in ranks.items()}
        n = max(self.bytes) + 1
        own, digits = [self.bytes.get(i, b"") for i in range(n)], [b"%d," % i for i in range(n)]
        self.memory = Memory()
        self.shape = {}
        for name, parts in (("bytes", own), ("digits", digits)):
            size = np.array([len(x) for x in parts], np.int64)
            self.shape[name] = (np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)

    @classmethod
    def get(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def encode(self, texts: list[str]) -> list:
        """The library's encodings of whole texts, with character offsets."""
        return self.tok.encode_batch(texts, add_special_tokens=False)

    def decode_bytes(self, ids: list[int]) -> bytes:
        known = self.bytes
        return b"".join([known[i] for i in ids])

    def written(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Each id's bytes, or its digits and a comma, one after another."""
        flat, start, size = self.shape[name]
        return ragged(flat, start[ids], size[ids])

    def ids_of_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each part.

        Parts that begin with a space are encoded in one string, where each still begins a match, and other plain ones
        in lines; the rest alone.
        """
        how = [0 if p[:1] == b" " and p[1:2] > b" " and not WIDE_BYTES.search(p) else 1 if p[:1] > b" " and p[-1:] > b" " and not WIDE_BYTES.search(p) else 2 for p in parts]
        order = sorted(range(len(parts)), key=how.__getitem__)
        a, b = how.count(0), how.count(0) + how.count(1)
        texts = [b"".join(parts[i] for i in order[k : min(a, k + 50_000)]) for k in range(0, a, 50_000)]
        texts += [b"\n".join(parts[i] for i in order[k : min(b, k + 50_000)]) for k in range(a, b, 50_000)]
        lines = np.zeros(len(parts), np.int64)  # one byte more for the line feed that follows
        lines[a:b] = 1
        lines[[min(b, k + 50_000) - 1 for k in range(a, b, 50_000)]] = 0
        texts += [parts[i] for i in order[b:]]
        ids = np.array([x for e in self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False) for x in e.ids], np.int64)
        size = np.array([len(parts[i]) for i in order], np.int64)
        ends = np.cumsum(size + lines)
        upto = np.searchsorted(np.cumsum(self.shape["bytes"][2][ids]), ends, "left") + 1
        first = np.concatenate([[0], upto[:-1]])
        start, count = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        start[order], count[order] = first, upto - first - lines
        return ragged(ids, start, count), count

    def ids(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and each text's offsets into them. Distinct parts of a piece of the batch are encoded once."""
        raw, at = utf8(column)
        starts = part_starts(raw, at)
        out, upto = [], [np.zeros(1, np.int64)]
        lo = 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + PIECE)))
            end = int(starts[hi]) if hi < len(starts) else len(raw)
            s = starts[lo:hi]
            size = np.diff(np.append(s, end))
            flat, count = self.piece(raw[s[0] : end], s - s[0], size)
            out.append(flat)
            upto.append(upto[-1][-1] + np.cumsum(count))
            lo = hi
        upto = np.concatenate(upto) if len(starts) else np.zeros(1, np.int64)
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), upto[np.searchsorted(starts, at)]

    def piece(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
            h = mix((total[start + size] - total[start]) * down[start] + size.astype(np.uint64))
        h, first, which = np.unique(h, return_index=True, return_inverse=True)
        body = raw.tobytes()
        begin, count = self.memory.find(h)
        new = np.flatnonzero(begin < 0)
        flat, n = self.ids_of_parts([body[a:b] for a, b in zip(start[first[new]].tolist(), (start + size)[first[new]].tolist(), strict=True)])
        known = self.memory.flat
        begin[new], count[new] = len(known) + np.cumsum(n) - n, n
        ids = ragged(np.concatenate([known, flat]), begin[which], count[which])
        if len(new) and self.memory.parts + len(new) <= MEMORY:
            self.memory.add(h[new], flat, n)
        if self.written("bytes", ids).tobytes() == body:
            return ids, count[which]
        flat, count = self.ids_of_parts([body[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)])  # two parts had one hash
        return flat, count

    def digests(self, column) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids joined by commas, SHA-256 of the bytes decoded from them) of each text."""
        ids, at = self.ids(column)
        out = []
        lo = 0
        while lo < len(at) - 1:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + RUN, "right")) - 1)
            sums = [(hashlib.sha256(), hashlib.sha256()) for _ in range(lo, hi)]
            for k in range(int(at[lo]), int(at[hi]) + 1, RUN):  # a longer text comes in several runs
                run = ids[k : min(int(at[hi]), k + RUN)]
                for name, j in (("digits", 0), ("bytes", 1)):
                    text = self.written(name, run)
                    ends = np.concatenate([[0], np.cumsum(self.shape[name][2][run])])
                    where = ends[np.clip(at[lo : hi + 1] - k, 0, len(run))].tolist()
                    for d in range(hi - lo):
                        last = j == 0 and at[lo + d + 1] <= k + len(run) and where[d + 1] > where[d]
                        sums[d][j].update(text[where[d] : where[d + 1] - last])
            out += [(int(at[lo + d + 1] - at[lo + d]), *(x.hexdigest() for x in sums[d])) for d in range(hi - lo)]
            lo = hi
        return out


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """(doc_id, ids, starts, ends): token ids of each text and, if asked for, the characters that each token covers."""

    def run(batches):
        codec = Codec.get(path, pattern)
        for b in slices(batches):
            if offsets:
                rows = [codec.encode([t or ""])[0] for t in b.column(1).to_pylist()]
                parts = [[e.ids for e in rows], *([[x[i] for x in e.offsets] for e in rows] for i in (0, 1))]
                parts = [pa.array(x, pa.list_(pa.int32())) for x in parts]
            else:
                ids, at = codec.ids(b.column(1))
                parts = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))), *[pa.nulls(b.num_rows, pa.list_(pa.int32()))] * 2]
            yield pa.RecordBatch.from_arrays([b.column(0), *parts], ["doc_id", "ids", "starts", "ends"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, errors: str = "replace") -> DataFrame:
    """(doc_id, text) of tokens(doc_id, ids); bytes that make no character become the replacement mark."""

    def run(batches):
        codec = Codec.get(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([codec.decode_bytes(x or []).decode("utf-8", errors) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of each text's ids, joined by commas, and of the bytes decoded from them."""

    def run(batches):
        codec = Codec.get(path, pattern)
        for b in slices(batches):
            n, ids, back = zip(*codec.digests(b.column(1)), strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

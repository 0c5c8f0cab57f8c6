"""On which page of its document a piece of text stands first, by an equi-join on picked runs of characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 16


def slid(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each `width` neighbours."""
    n, reach = len(values) - width + 1, 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return best(values[:n], values[width - reach : width - reach + n])


def hashes(text: str) -> np.ndarray:
    """A number for each run of SIZE characters of a text."""
    h, base, reach = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1), np.array([0x9E3779B97F4A7C15], np.uint64), 1
    while reach < SIZE:
        h = h[:-reach] + base * h[reach:]
        base, reach = base * base, 2 * reach
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def picks(text: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the runs that are least among those of some `length` neighbouring characters of a text with that many."""
    h, width = hashes(text), length - SIZE + 1
    least = slid(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(slid(np.concatenate([edge, least, edge]), width, np.maximum) == h)
    return at, h[at]


def picked(rows: DataFrame, keys: list[str], text: str, length: int, first: bool) -> DataFrame:
    """(keys, at, hash) of the picks of each text, or of its first one only."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in frames:
            t = t[t["_text"].map(len) >= length]
            found = [picks(x, length) for x in t["_text"]]
            if first:
                found = [(at[:1], h[:1]) for at, h in found]
            out = t[keys].loc[t.index.repeat([len(at) for at, _ in found])].reset_index(drop=True)
            both = [np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.uint64) for i in (0, 1)]
            yield out.assign(at=both[0].astype(np.int32), hash=both[1].astype(np.uint64).view(np.int64))

    kind = dict(rows.dtypes)
    given = rows.where(F.col(text).isNotNull()).where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).select(*keys, F.col(text).alias("_text"))
    return given.mapInPandas(each, ", ".join([*[f"{k} {kind[k]}" for k in keys], "at int", "hash long"]))


def first_pages(pages: DataFrame, pieces: DataFrame, length: int = 70) -> DataFrame:
    """(doc_id, piece_id, page) of pieces(doc_id, piece_id, piece): the first page of pages(doc_id, page, text) that holds the piece's first `length` characters; null where none does.

    Of any `length` characters the run of SIZE characters with the least number is picked, so a piece and a page that
    holds it pick the same one: one a piece, about one in thirty places of a page. Only keys, places and numbers meet;
    each piece found so is then held against the page at that place. Pieces shorter than `length` are looked for in each
    page of their own document. Null and empty pieces are on no page.
    """
    pieces = pieces.select("doc_id", "piece_id", F.substring("piece", 1, length).alias("piece"))
    given = picked(pages, ["doc_id", "page"], "text", length, False)
    asked = picked(pieces, ["doc_id", "piece_id"], "piece", length, True).withColumnRenamed("at", "inside")
    near = asked.join(given, ["doc_id", "hash"]).select("doc_id", "piece_id", "page", (F.col("at") - F.col("inside")).alias("start")).where("start >= 0")
    whole = pieces.where(F.length("piece") == length)
    met = near.join(pages.select("doc_id", "page", "text"), ["doc_id", "page"]).select("doc_id", "piece_id", "page", F.substring("text", F.col("start") + 1, F.lit(length)).alias("there"))
    met = met.join(whole, ["doc_id", "piece_id"]).where(F.col("there") == F.col("piece"))
    short = pieces.where(F.length("piece").between(1, length - 1)).join(pages, "doc_id").where(F.col("text").contains(F.col("piece")))
    found = met.select("doc_id", "piece_id", "page").union(short.select("doc_id", "piece_id", "page")).groupBy("doc_id", "piece_id").agg(F.min("page").alias("page"))
    return pieces.select("doc_id", "piece_id").join(found, ["doc_id", "piece_id"], "left")

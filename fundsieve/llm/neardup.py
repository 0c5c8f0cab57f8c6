"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function gives every shingle a value; a document's sketch is its k smallest. Inverted lists of the retained
values generate overlaps, the sketch of the union estimates the Jaccard similarity and drops unlikely pairs, and
full shingle sets confirm every link. Documents with equal sets are one class from the start, so copies are never
paired.

A value that more than `hot` classes retain would make a list of too many pairs. Such lists are served exactly another
way: each list links its members to its most central one, and classes that are still apart meet by prefix filtering
over their full sets, rarest shingle first and by size range, which loses no pair over the threshold. Shingles that
stand in the same classes are one weighted element there. A list of that filter with more than `hot` members outside its
main component is split by the next element that a pair must share as well, where that makes less than half of the
pairs; so texts of one template, which share most of their shingles, make candidates in proportion to their number.

Cases: null and empty texts have no shingles and link with nothing; texts of fewer words than a shingle are one
shingle of all their words; equal rows fall in one class; rows of one id with different texts are one document, which
is linked wherever any of them is; a row with a null id makes no links and takes the component of its copies, or null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.tables import components, cut, small_batches
from fundsieve.llm.words import gram_hashes, mix, slices, tidied, word_hashes


CLASS = ["n_shingles", "digest", "digest2"]
ENTRIES = 1 << 16


def shingle_sets(column: pa.Array, n: int, kind: str) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    words, at = word_hashes(column, kind)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        own = words[lo:hi]
        out.append(np.unique(gram_hashes(own, n if len(own) >= n else max(1, len(own)))))
    return out


def _lists(parts: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.uint64).view(np.int64)))


def digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two digests of each set: what tells classes of equal sets apart (CLASS)."""
    with np.errstate(over="ignore"):
        first = [int(np.sum(s * (s >> np.uint64(7) | np.uint64(1)), dtype=np.uint64).astype(np.int64)) ^ (len(s) << 1) for s in sets]
    second = [int(np.bitwise_xor.reduce(s).astype(np.int64)) if len(s) else 0 for s in sets]
    return [pa.array(np.array([len(s) for s in sets], np.int64)), pa.array(first, pa.int64()), pa.array(second, pa.int64())]


def sketches(docs: DataFrame, n: int, k: int, kind: str) -> DataFrame:
    """(doc_id, n_shingles, digest, digest2, sketch) of every row, from the whole text."""

    def run(batches):
        for b in slices(batches):
            sets = shingle_sets(b.column(1), n, kind)
            yield pa.RecordBatch.from_arrays([b.column(0), *digests(sets), _lists([s[:k] for s in sets])], ["doc_id", *CLASS, "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, digest long, digest2 long, sketch array<long>")


def full_sets(docs: DataFrame, n: int, kind: str) -> DataFrame:
    """(doc_id, n_shingles, digest, digest2, shingles) of every row."""

    def run(batches):
        for b in slices(batches):
            sets = shingle_sets(b.column(1), n, kind)
            yield pa.RecordBatch.from_arrays([b.column(0), *digests(sets), _lists(sets)], ["doc_id", *CLASS, "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, digest long, digest2 long, shingles array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for t in tidied(batches):
            keep = []
            a, b = ([np.asarray(x) for x in c.to_numpy(zero_copy_only=False)] for c in (t.column(2), t.column(3)))
            for x, y in zip(a, b, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield t.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def least_shared(k: int, percent: int, sigmas: float = 6.0) -> int:
    """How many of the k smallest values of a union a pair at the threshold shares, but for `sigmas` deviations."""
    j = percent / 100
    return max(1, math.floor(k * j - sigmas * math.sqrt(k * j * (1 - j))))


def sketch_pairs(postings: DataFrame, reps: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """Pairs of classes in one inverted list whose sizes and union sketch allow the threshold."""
    p = postings.select("value", "node", "n_shingles")
    a, b = p.toDF("value", "a", "na"), p.toDF("value", "b", "nb")
    fits = (F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return estimated(a.join(b, "value").where(fits).select("a", "b").distinct(), reps, k, least, percent)


def estimated(pairs: DataFrame, reps: DataFrame, k: int, least: int, percent: int) -> DataFrame:
    """Keep pairs whose union sketch shares enough: the k smallest of both sketches, and how many are in both. Sketches of whole sets are exact."""
    s = reps.select("node", "sketch", "n_shingles")
    t = pairs.join(s.toDF("a", "sa", "na"), "a").join(s.toDF("b", "sb", "nb"), "b")

    def run(batches):
        for x in tidied(batches):
            sa, sb = (c.to_numpy(zero_copy_only=False) for c in (x.column(2), x.column(3)))
            keep = []
            for p, q in zip(sa, sb, strict=True):
                p, q = np.asarray(p).view(np.uint64), np.asarray(q).view(np.uint64)
                whole = len(p) < k and len(q) < k
                both = np.intersect1d(p, q, assume_unique=True)
                if whole:
                    keep.append(100 * len(both) >= percent * (len(p) + len(q) - len(both)))
                    continue
                union = np.union1d(p, q)[:k]
                keep.append(int(np.searchsorted(both, union[-1], "right")) >= least)
            yield x.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return t.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


LIST = ["key", "r1", "r2"]
ENTRY = "key long, r1 int, r2 int, is_low boolean, is_high boolean, node long, comp long, n long, slack long, pos int, missed long, got long, rest long"
ENTRY_NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def elements(sets: DataFrame) -> DataFrame:
    """(node, els, dfs, ws) of each set: its elements, the rarest first, with their classes and weights. Shingles of the same classes are one element."""
    flat = sets.select("node", F.explode("shingles").alias("sh"))
    lists = flat.groupBy("sh").agg(F.count(F.lit(1)).alias("df"), F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"))
    own = flat.join(lists, "sh").groupBy("node", "df", F.xxhash64("df", "h1", "h2").alias("el")).agg(F.count(F.lit(1)).alias("w"))
    ranked = own.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "el", "w"))).alias("s"))
    return ranked.select("node", F.col("s.el").alias("els"), F.col("s.df").alias("dfs"), F.col("s.w").alias("ws"))


def first_entries(ranked: DataFrame, percent: int, step: float) -> DataFrame:
    """A list entry for each element that may be the first that a pair shares, once for each range of partner sizes.

    A pair of sizes x and y at the threshold shares at least percent (x + y) / (100 + percent); a side may miss what it
    has beyond that (slack) before its first common element, for the smallest partner of the range.
    """

    log = lambda x: math.floor(math.log(x) / math.log(step))

    def parts(batches):
        for b in tidied(batches):
            for node, comp, els, dfs, ws in zip(*(c.to_numpy(zero_copy_only=False) for c in b.columns), strict=True):
                before = np.cumsum(ws) - ws
                n = int(ws.sum())
                low, high = -(-n * percent // 100), n * 100 // percent
                for q in range(log(low), log(high) + 1):
                    smallest = max(low, math.floor(step**q - 1e-9))
                    slack = n - -(-percent * (n + smallest) // (100 + percent))
                    at = np.flatnonzero((before <= slack) & (dfs > 1))
                    r = log(n)
                    one = np.ones(len(at), np.int64)
                    yield [els[at], one * min(r, q), one * max(r, q), one * (r <= q), one * (r >= q), one * node, one * comp, one * n, one * slack, at, before[at], ws[at], n - before[at] - ws[at]]

    return ranked.select("node", "comp", "els", "dfs", "ws").mapInArrow(lambda batches: entry_batches(parts(batches)), ENTRY)


def entries(parts: list[list[np.ndarray]], more: list[str] = ()) -> pa.RecordBatch:
    kinds = {"r1": np.int32, "r2": np.int32, "pos": np.int32, "is_low": bool, "is_high": bool}
    names = [*ENTRY_NAMES, *more]
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(kinds.get(n, np.int64))) for n, c in zip(names, cols, strict=True)], names)


def entry_batches(parts, more: list[str] = ()):
    """Record batches of about ENTRIES entries: a set makes as many as it has elements in its slack, so batches go by entries instead of sets."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= ENTRIES:
            yield entries(held, more)
            held, size = [], 0
    if size:
        yield entries(held, more)


def longer_entries(some: DataFrame, ranked: DataFrame) -> DataFrame:
    """For each entry one for each element that may be the next that a pair shares, with the list that it came from (parent)."""

    def parts(batches):
        for b in tidied(batches):
            for key, r1, r2, is_low, is_high, node, comp, n, slack, pos, missed, got, _, els, dfs, ws in zip(*(c.to_numpy(zero_copy_only=False) for c in b.columns), strict=True):
                ws, dfs, tail = ws[pos + 1 :], dfs[pos + 1 :], np.ascontiguousarray(els[pos + 1 :], np.int64)
                upto = np.cumsum(ws) - ws + missed
                at = np.flatnonzero((upto <= slack) & (dfs > 1))
                one = np.ones(len(at), np.int64)
                with np.errstate(over="ignore"):
                    child = mix(mix(np.array([key], np.int64).view(np.uint64)) + tail[at].view(np.uint64)).view(np.int64)
                shared = got + ws[at]
                yield [child, one * r1, one * r2, one * is_low, one * is_high, one * node, one * comp, one * n, one * slack, pos + 1 + at, upto[at], shared, n - upto[at] - shared, one * key]

    return some.join(ranked.select("node", "els", "dfs", "ws"), "node").select(*ENTRY_NAMES, "els", "dfs", "ws").mapInArrow(lambda batches: entry_batches(parts(batches), ["parent"]), ENTRY + ", parent long")


def mixed_lists(keys: DataFrame, parent: list[str] = ()) -> DataFrame:
    """Lists that hold several components and both size ranges: their main component and how many members stand outside it."""
    each = keys.groupBy(*LIST, "comp").agg(F.count(F.lit(1)).alias("w"), F.bool_or("is_low").alias("low"), F.bool_or("is_high").alias("high"), *[F.min(c).alias(c) for c in parent])
    t = each.groupBy(*LIST).agg(F.max(F.struct("w", "comp")).alias("m"), F.sum("w").alias("size"), F.count(F.lit(1)).alias("comps"), F.bool_or("low").alias("low"), F.bool_or("high").alias("high"), *[F.min(c).alias(c) for c in parent])
    return t.where("comps > 1 AND low AND high").select(*LIST, F.col("m.comp").alias("main"), (F.col("size") - F.col("m.w")).alias("outside"), "size", *parent)


def prefix_pairs(sets: DataFrame, comps: DataFrame, percent: int, hot: int = 48, step: float = 1.1, depth: int = 12) -> DataFrame:
    """Pairs in different components that may reach the threshold, by prefix filtering over full sets, rarest elements first.

    A list's pairs are those of members outside its main component with all others. Where more than `hot` are outside,
    its entries go on to the lists of their next elements, if those hold less than half of its pairs together; if not,
    or after `depth` elements, its pairs are made as they are.
    """
    ranked = cut(elements(sets).join(comps, "node"))
    keys = cut(first_entries(ranked, percent, step))
    lists = cut(mixed_lists(keys))
    final = []
    for _ in range(depth):
        many = lists.where(F.col("outside") > hot)
        if many.isEmpty():
            break
        longer = cut(longer_entries(keys.join(many.select(*LIST), LIST, "left_semi"), ranked))
        next_lists = cut(mixed_lists(longer, ["parent"]))
        made = next_lists.groupBy(F.col("parent").alias("key"), "r1", "r2").agg(F.sum(F.col("outside").cast("double") * F.col("size")).alias("made"))
        better = cut(many.join(made, LIST, "left").where(2 * F.coalesce("made", F.lit(0.0)) <= F.col("outside").cast("double") * F.col("size")).select(*LIST))
        final.append((keys, lists.join(better, LIST, "left_anti")))
        lists = cut(next_lists.join(better.withColumnRenamed("key", "parent"), ["parent", "r1", "r2"], "left_semi").select(*LIST, "main", "outside", "size"))
        keys = longer.drop("parent")
    final.append((keys, lists))

    def pairs(keys: DataFrame, lists: DataFrame) -> DataFrame:
        keys = cut(keys.join(lists.select(*LIST, "main"), LIST))
        own = ["comp", "n", "is_low", "is_high", "rest"]
        a = keys.where("comp <> main").select(*LIST, "got", F.col("node").alias("x"), *[F.col(c).alias(c + "_x") for c in own])
        b = keys.select(*LIST, F.col("node").alias("y"), *[F.col(c).alias(c + "_y") for c in own])
        roles = (F.col("is_low_x") & F.col("is_high_y")) | (F.col("is_high_x") & F.col("is_low_y"))
        most = F.col("got") + F.least("rest_x", "rest_y")
        fits = (F.col("comp_x") != F.col("comp_y")) & roles & ((100 + percent) * most >= percent * (F.col("n_x") + F.col("n_y")))
        return a.join(b, LIST).where(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    out = pairs(*final[0])
    for part in final[1:]:
        out = out.union(pairs(*part))
    return out.distinct()


def classes_of(sk: DataFrame) -> DataFrame:
    """(node, doc_id, sketch, ...CLASS) of each class of equal sets: its smallest doc_id and a number of its own, which is that id unless several classes have it."""
    reps = sk.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*CLASS).agg(F.min(F.struct("doc_id", "sketch")).alias("f"))
    reps = cut(reps.select(*CLASS, "f.doc_id", "f.sketch"))
    again = cut(reps.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", F.lit(True).alias("again")))
    return reps.join(again, "doc_id", "left").select(F.when(F.col("again"), F.xxhash64("doc_id", *CLASS)).otherwise(F.col("doc_id")).alias("node"), "doc_id", *CLASS, "sketch")


def same_id(sk: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the classes that rows of one doc_id belong to: they are one document."""
    ids = sk.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *CLASS)
    lo, hi = F.struct(*CLASS), F.struct(*CLASS)
    several = cut(ids.groupBy("doc_id").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi")).where("lo <> hi").select("doc_id"))
    named = ids.join(several, "doc_id", "left_semi").distinct().join(reps.select("node", *CLASS), CLASS)
    return named.join(named.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").where("a <> node").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, k: int = 96, hot: int = 48, kind: str = "space") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs(doc_id, text, ...)."""
    least = least_shared(k, percent)
    sk = cut(sketches(small_batches(docs), n, k, kind))
    reps = cut(classes_of(sk))
    values = reps.select("node", "n_shingles", F.explode("sketch").alias("value"))
    held = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A pair over the threshold shares `least` retained values, so one is among the k - least + 1 rarest of each.
    ranked = values.join(held, "value", "left").groupBy("node", "n_shingles").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "value"))).alias("s"))
    hot_values = F.size(F.filter("s", lambda e: e["df"] > hot))
    keep = F.greatest(F.lit(1), F.size("s") - F.least(F.lit(least), F.floor(F.size("s") * least / k)) + 1).cast("int")
    postings = cut(ranked.withColumn("central", hot_values).select("node", "n_shingles", "central", F.explode(F.filter(F.slice("s", F.lit(1), keep), lambda e: e["df"] > 1)).alias("e")).select("node", "n_shingles", "central", F.col("e.df").alias("df"), F.col("e.value").alias("value")))
    rare, common = postings.where(F.col("df") <= hot), postings.where(F.col("df") > hot)
    centre = common.groupBy("value").agg(F.max_by("node", F.struct("central", -F.col("node"))).alias("c"))
    spokes = common.join(centre, "value").where("node <> c").select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
    pairs = cut(sketch_pairs(rare, reps, k, percent, least).union(estimated(spokes, reps, k, least, percent)).distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(common.select("node")).distinct()
    wanted = cut(reps.join(wanted, "node", "left_semi").select("node", "doc_id", *CLASS))
    ids = wanted.select("doc_id").distinct()
    # Only classes' own rows: a doc_id may stand on rows of other sets too.
    sets = full_sets(docs.join(ids, docs["doc_id"].cast("long") == ids["doc_id"], "left_semi"), n, kind)
    sets = cut(sets.join(wanted, ["doc_id", *CLASS]).select("node", "shingles").dropDuplicates(["node"]))
    links = cut(confirm(pairs, sets, percent))
    if not common.isEmpty():
        first = components(links)
        near = cut(common.select("node").distinct().join(first, "node", "left").select("node", F.coalesce("component", "node").alias("comp")))
        apart = cut(prefix_pairs(sets.join(near, "node", "left_semi"), near, percent, hot))
        links = links.union(confirm(apart, sets, percent))
    comps = cut(components(links.union(same_id(sk, reps)))).withColumnRenamed("component", "comp")
    known = cut(reps.join(comps, "node", "left").select("doc_id", *CLASS, F.coalesce("comp", "node").alias("comp")))
    first = cut(known.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    known = cut(known.join(first, "comp").select(*CLASS, "component_id"))
    few = F.coalesce("component_id", F.col("doc_id"))
    some = sk.where("n_shingles > 0").select("doc_id", *CLASS).join(known, CLASS, "left").select("doc_id", "n_shingles", few.alias("component_id"))
    # Rows without words make no links; if their id stands on another row too, they go with that one.
    bare = sk.where("n_shingles = 0").select("doc_id", "n_shingles")
    twice = cut(some.join(bare.where("doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    bare = bare.join(twice, "doc_id", "left").select("doc_id", "n_shingles", few.alias("component_id"))
    return some.union(bare).select("*", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stand for their group, unchanged: of equal texts of one id one row stays, and every row with a null id."""
    gone = near_duplicates(docs, n, percent).where("NOT kept").select("doc_id").distinct()
    digest = "text_digest"
    while digest in docs.columns:
        digest += "_"
    known = docs.where("doc_id IS NOT NULL").join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
    known = known.withColumn(digest, F.sha2("text", 256)).dropDuplicates(["doc_id", digest])
    return known.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))

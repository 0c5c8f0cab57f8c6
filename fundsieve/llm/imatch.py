"""I-Match fingerprints: terms of a chosen inverse-document-frequency band, hashed over randomised lexicon subsets.

The lexicon holds the terms that occur in between `low` and `high` of all documents. A document's fingerprint has one
part for each of SUBSETS random subsets of the lexicon (a term is in a subset by 1 in 32, and in one at least, so that
the subsets cover the lexicon): the hash of its sorted distinct terms in that subset. Likeness is the share of parts
that agree, of those that either document fills.

A lexicon has at most (mean distinct terms of a document) / low terms, as each takes up `low` of all documents; its
size is counted, and it is broadcast only below `broadcast_terms`, else joined by shuffle.

Cases: null texts count as empty; a text without a term of the band is fingerprinted by its own hash and is like equal
texts only; rows stand in descending id order, null ids last, rows of one id by their text's hash, and the row after
the last is the first (a lone row follows itself); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.llm.tables import cut, quantile_cuts, range_bucket

SUBSETS, PART, BROADCAST_TERMS, ROWS_PER_RANGE, RANGES = 64, 4, 500_000, 2000, (128, 1024)
EMPTY = "." * PART


def distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def lexicon(docs: DataFrame, low: float, high: float) -> DataFrame:
    """The terms of the band, from counts over all documents."""
    n = docs.count()
    df = docs.select(F.explode(distinct_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return cut(df.where((F.col("df") >= low * n) & (F.col("df") <= max(1.0, high * n))).select("term"))


def subsets_of(term: Column) -> Column:
    """The random lexicon subsets that hold a term, as the set bits of 64; a term that none drew goes to one by its hash."""
    out = F.xxhash64(term, F.lit(1))
    for seed in range(2, 6):
        out = out.bitwiseAND(F.xxhash64(term, F.lit(seed)))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(term, F.lit(0)), F.lit(SUBSETS)).cast("int"))
    return F.when(out == 0, one).otherwise(out)


def fingerprint(terms: Column, digest: Column) -> Column:
    """Of the sorted distinct terms of a text that are in the lexicon: the terms hashed subset by subset."""
    hashed = lambda j: F.when(j == "", F.lit(EMPTY)).otherwise(F.right(F.concat(F.lit("0" * PART), F.lower(F.hex(F.xxhash64(j)))), F.lit(PART)))

    def parts(marked: Column) -> Column:
        own = lambda k: F.transform(F.filter(marked, lambda e: F.getbit(e["subsets"], k) == 1), lambda e: e["term"])
        return F.transform(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: F.array_join(own(k), " ")), hashed)

    marked = F.transform(terms, lambda t: F.struct(t.alias("term"), subsets_of(t).alias("subsets")))
    once = F.transform(F.array(marked), parts)[0]  # the lambda's argument is computed once, not for each subset
    return F.when(F.size(terms) == 0, F.concat(F.lit("t"), digest)).otherwise(F.array_join(once, ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those that either fingerprint fills; 1 for equal fingerprints."""
    part = lambda x, k: F.substring(x, k * PART + 1, F.lit(PART))
    ks = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    filled = F.size(F.filter(ks, lambda k: (part(a, k) != EMPTY) | (part(b, k) != EMPTY)))
    same = F.size(F.filter(ks, lambda k: (part(a, k) == part(b, k)) & (part(a, k) != EMPTY)))
    banded = ~a.startswith("t") & ~b.startswith("t")
    return F.when(a == b, 1.0).when(banded & (filled > 0), same / filled).otherwise(0.0)


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """docs(doc_id, text) with part, rid, next_rid and next_text, the next row in descending id order.

    Rows are dealt by ranges of ids; the first row of each range also visits the range before it, so no task needs
    another's rows. They stay dealt by part, so work that groups by part and rid needs no shuffle of its own.
    """
    cuts = quantile_cuts(docs, ["doc_id"], buckets, 32 * buckets)
    dealt = docs.withColumn("home", range_bucket(docs, ["doc_id"], cuts))
    edges = sorted((r.home, r.top) for r in dealt.groupBy("home").agg(F.max("doc_id").alias("top")).collect())
    visits = [(home, top, edges[(i + 1) % len(edges)][0]) for i, (home, top) in enumerate(edges)]
    visits = docs.sparkSession.createDataFrame(visits, "home int, top long, visited int")
    stay = F.struct(F.col("home").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("visited").alias("part"), F.lit(True).alias("guest"))
    rows = dealt.join(F.broadcast(visits), "home").select("doc_id", "text", "home", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(stay, visit)).otherwise(F.array(stay))).alias("v")).select("doc_id", "text", "home", "v.*")
    w = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    rid = lambda home, n: home.cast("long") * (1 << 40) + n
    rows = rows.select("*", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("next_text"), F.lead("guest").over(w).alias("next_guest"), F.lead("home").over(w).alias("next_home")).where("NOT guest")
    return rows.select("part", "doc_id", "text", "next_text", rid(F.col("part"), F.col("rn")).alias("rid"), F.when(F.col("next_guest"), rid(F.col("next_home"), F.lit(1))).otherwise(rid(F.col("part"), F.col("rn") + 1)).alias("next_rid"))


def edited_fingerprints(docs: DataFrame, low: float = 0.002, high: float = 0.25, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last half of the text replaced by as much of the next row's beginning.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = lexicon(docs, low, high)
    small = words.count() <= broadcast_terms
    rows = with_next(docs, min(RANGES[1], max(RANGES[0], -(-docs.count() // ROWS_PER_RANGE))))
    half = F.floor(F.char_length("text") / 2).cast("int")
    n = F.char_length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    own = F.struct("doc_id", n.cast("long").alias("n_chars"), F.sha2("text", 256).alias("sha"), F.sha2("edited", 256).alias("edited_sha256"), "next_rid")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.concat(F.array(F.lit("")), distinct_terms(F.col("text"))).alias("terms"), own.alias("own")), F.struct(F.lit(1).alias("side"), distinct_terms(F.col("edited")).alias("terms"), F.lit(None).alias("own")))
    flat = rows.select("part", "rid", F.explode(sides).alias("s")).select("part", "rid", "s.side", "s.own", F.explode("s.terms").alias("term")).withColumn("own", F.when(F.col("term") == "", F.col("own")))
    # The term "" carries a row's own columns through. It joins a broadcast lexicon, but no shuffled one, where it would be one key for all rows.
    if small:
        kept = flat.join(F.broadcast(words.union(docs.sparkSession.createDataFrame([("",)], "term string"))), "term")
    else:
        kept = flat.where("term <> ''").join(words, "term").unionByName(flat.where("term = ''"))
    of = lambda side: F.sort_array(F.collect_set(F.when((F.col("side") == side) & (F.col("term") != ""), F.col("term"))))
    made = kept.groupBy("part", "rid").agg(F.first("own", ignorenulls=True).alias("own"), of(0).alias("t0"), of(1).alias("t1"))
    made = made.select("rid", "own.*", fingerprint(F.col("t0"), F.col("own.sha")).alias("fingerprint"), fingerprint(F.col("t1"), F.col("own.edited_sha256")).alias("edited_fingerprint"))
    # Each row goes to its own id with its fingerprint and to the next one's id to fetch that.
    asks = F.struct(F.col("next_rid").alias("at"), F.lit(None).cast("string").alias("theirs"), F.struct("rid", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint").alias("row"))
    has = F.struct(F.col("rid").alias("at"), F.col("fingerprint").alias("theirs"), F.lit(None).alias("row"))
    met = made.select(F.explode(F.array(has, asks)).alias("e")).select("e.*").groupBy("at").agg(F.max("theirs").alias("theirs"), F.max("row").alias("row"))
    return met.select("row.doc_id", "row.n_chars", "row.edited_sha256", "row.fingerprint", "row.edited_fingerprint", likeness(F.col("row.fingerprint"), F.col("row.edited_fingerprint")).alias("near_edited"), likeness(F.col("row.fingerprint"), F.col("theirs")).alias("near_next"))

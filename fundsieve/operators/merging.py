"""Records of one programme folded into one, first rows over two keys, and staleness by owner."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.functions import text as T
from fundsieve.sources.scratch import written

# Titles that name no programme, without accents, and the endings of documents.
NO_TITLE = "document officiel|conditions particulieres|desole.*offre.*plus disponible|offre.*plus disponible|page introuvable|page non trouvee|erreur 404|404 not found|access denied|forbidden|service indisponible|site en maintenance"
DOCUMENT = r"(?i)\.(pdf|docx?|xlsx?)($|\?)"
LIFECYCLE = ["ACTIVE", "STALE", "ARCHIVE"]


def names_nothing(title: Column) -> Column:
    plain = T.norm(title)
    return (F.length(plain) < 4) | plain.rlike(NO_TITLE)


def page_worth(page: Column, catalogue_paths: list[str]) -> Column:
    """How good an official page is: any page before any document, then own pages, documents, catalogue pages, and what is no web address."""
    own = F.lower(F.regexp_replace(F.regexp_extract(page, r"(?i)^https?://[^/?#]*([^?#]*)", 1), "/+$", ""))
    path = F.when(own == "", "/").otherwise(own)
    kind = F.when(~page.rlike("(?i)^https?:"), 0).when(path.isin(catalogue_paths), 1).when(path.rlike(DOCUMENT), 2).otherwise(3)
    return F.struct((~page.rlike(DOCUMENT)).cast("int").alias("is_page"), kind.alias("kind"))


def fold_records(records: DataFrame, key: list[str], order: list[str], rank: Column, catalogue_paths: list[str], scalars: list[str] = (), at_least: list[str] = (), unions: list[str] = (), chains: list[str] = (), together: int = 1000) -> DataFrame:
    """One record per key from records in order, as a fold of each into what the ones before gave.

    Columns: title, official_page, lifecycle, last_seen, tier and the named ones. `order` must tell a key's records apart.

    - scalars: null and '' count as none; a later value replaces one only from a tier above all before.
    - at_least: like these from an equal tier too, but where the first record has none, only so.
    - unions: distinct values in the order in which they first stand, without null and ''; a lone record's stay as they are.
    - chains: all values, one record's after another's.
    - title: one that names nothing never replaces one, and any replaces it; a document's page changes no other title.
    - official_page: by page_worth, the first of equal ones. lifecycle: the first of ACTIVE, STALE, ARCHIVE that occurs.
    - last_seen: the last one. tier: the first of the highest rank. Each is null or the first record's where none has it.

    The highest rank before each record comes from one window, what each record would put in follows, and the last of
    these is the result. Records that come dealt by key and in order are neither shuffled nor sorted again, so columns
    derived after that cost no disk. Lists are made distinct for every `together` records, then for the key.
    """
    whole = Window.partitionBy(*key).orderBy(*order)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_at")
    some = lambda c: F.coalesce(F.col(c).cast("string") != "", F.lit(False))
    rows = records.withColumns({"_rank": rank, "_names": ~names_nothing(F.col("title"))})
    had = {f"_had_{c}": F.count(F.when(some(c), 1)).over(before) for c in scalars}
    rows = rows.withColumns({"_at": F.row_number().over(whole), "_most": F.max("_rank").over(before), "_named": F.max(F.col("_names").cast("int")).over(before)} | had)
    above, named = F.col("_rank") > F.col("_most"), F.col("_names")
    title = named & (F.coalesce(F.col("_named"), F.lit(0)) == 0) | named & ~F.coalesce(F.col("official_page").rlike(DOCUMENT), F.lit(False)) & F.coalesce(above, F.lit(False))
    took = {"title": title, "last_seen": some("last_seen")}
    for c in scalars:
        took[c] = some(c) & ((F.col(f"_had_{c}") == 0) | above)
    for c in at_least:
        took[c] = F.col("_most").isNull() | F.col(c).isNotNull() & (F.col("_rank") >= F.col("_most"))
    last = [F.max(F.when(cond, F.struct(at, F.col(c).alias("v")))).alias(f"_{c}") for c, cond in took.items()]
    first = F.min(F.struct(at, *[F.col(c) for c in dict.fromkeys([*took, "lifecycle", "official_page"])])).alias("_first")
    # The first record of the best page and of the highest tier: the least by what is worse, then by place.
    worth = page_worth(F.col("official_page"), catalogue_paths)
    best = F.min(F.when(some("official_page"), F.struct((-worth["is_page"]).alias("a"), (-worth["kind"]).alias("b"), at, F.col("official_page").alias("v"))))["v"].alias("_best")
    tier = F.min(F.when(F.col("_rank").isNotNull(), F.struct((-F.col("_rank")).alias("a"), at, F.col("tier").alias("v"))))["v"].alias("tier")
    states = [F.max((F.col("lifecycle") == s).cast("int")).alias(f"_is_{s}") for s in LIFECYCLE]
    out = rows.groupBy(*key).agg(*last, first, best, tier, F.max("_rank").alias("tier_rank"), F.count(F.lit(1)).alias("records"), *states)

    if unions or chains:
        listed = records.withColumn("_at", F.row_number().over(whole)).select(*key, "_at", F.floor(at / together).alias("_part"), *unions, *chains)
        held = lambda c: F.filter(c, lambda x: x != "")
        empty = lambda c: F.array().cast(records.schema[c].dataType)
        inside = lambda c, by, v: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(F.col(by).alias("n"), v.alias("v")))), lambda x: x["v"]))
        parts = listed.groupBy(*key, "_part").agg(*[F.array_distinct(inside(c, "_at", F.coalesce(held(c), empty(c)))).alias(c) for c in unions], *[inside(c, "_at", F.coalesce(c, empty(c))).alias(c) for c in chains], F.min(F.struct(at, *unions)).alias("_lone"))
        lists = parts.groupBy(*key).agg(*[F.array_distinct(inside(c, "_part", F.col(c))).alias(f"_u_{c}") for c in unions], *[inside(c, "_part", F.col(c)).alias(c) for c in chains], F.min("_lone").alias("_lone"))
        # Equal keys need no further shuffle; the few with a null in them, which a join on keys would lose, go apart.
        some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        apart, null_lists = out.where(some_null), lists.where(some_null)
        apart = apart.join(null_lists, [apart[k].eqNullSafe(null_lists[k]) for k in key]).drop(*[null_lists[k] for k in key])
        out = out.where(~some_null).join(lists, key).unionByName(apart)
    state = reduce(lambda t, s: F.when(F.col(f"_is_{s}") == 1, s).otherwise(t), reversed(LIFECYCLE), F.col("_first.lifecycle"))
    value = lambda c: F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.v")).otherwise(F.col(f"_first.{c}")).alias(c)
    union = lambda c: F.when(F.col("records") == 1, F.col(f"_lone.{c}")).otherwise(F.col(f"_u_{c}")).alias(c)
    alone = F.when(F.col("records") == 1, F.col("_first.official_page"))
    return out.select(*key, *[value(c) for c in took], F.coalesce("_best", alone).alias("official_page"), state.alias("lifecycle"), "tier", "tier_rank", "records", *[union(c) for c in unions], *chains)


def first_of_either(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in order, each kept unless a kept row before it has one of its keys; null and '' are no keys.

    By rounds: the first of all that are left in each of its keys stays, rows with a key of one that stays go. `order`
    should tell rows apart; rows that it does not stand in the order of their values. Rounds follow the longest chain of
    rows that wait for each other, some few unless rows are made to chain; every round's table is written.
    """
    named = [F.coalesce(F.col(c).cast("string") != "", F.lit(False)) for c in keys]
    rest = [c for c in rows.columns if c not in order]
    left = written(rows.withColumn("_at", F.struct(*order, *rest)).withColumn("_n", F.monotonically_increasing_id()).withColumn("_at", F.struct("_at", "_n")).drop("_n"))
    kept = []
    while not left.isEmpty():
        t = left
        for i, (c, has) in enumerate(zip(keys, named, strict=True)):
            lows = left.where(has).groupBy(c).agg(F.min("_at").alias(f"_low{i}"))
            t = t.join(lows, c, "left")
        first = reduce(lambda a, b: a & b, [~has | (F.col("_at") == F.col(f"_low{i}")) for i, has in enumerate(named)])
        t = written(t.withColumn("_first", first).drop(*[f"_low{i}" for i in range(len(keys))]))
        stays, left = t.where("_first").drop("_first"), t.where("NOT _first").drop("_first")
        kept.append(stays)
        for c, has in zip(keys, named, strict=True):
            left = left.join(stays.where(has).select(c).distinct(), c, "left_anti")
        left = written(left.select(*t.columns[:-1]))
    out = reduce(lambda a, b: a.unionByName(b), kept) if kept else left
    return out.select(*rows.columns)


def stale_by_owner(before: DataFrame, seen: DataFrame, safe: DataFrame, key: str, source: str, aliases: str) -> DataFrame:
    """Rows of the earlier snapshot that some source with a safe scan owns, by its id or among the row's aliases, and that no source has seen in this cycle."""
    owners = before.select(key, F.explode(F.array_distinct(F.array_compact(F.concat(F.array(source), F.coalesce(F.col(aliases), F.array()))))).alias("_owner"))
    owned = owners.join(safe.select(F.col(source).alias("_owner")), "_owner", "left_semi").select(key).distinct()
    return before.join(owned, key, "left_semi").join(seen.select(key), key, "left_anti")

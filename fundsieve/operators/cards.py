"""Listing cards: the nearest element around a link whose text tells an opening and a closing date.

Tags and texts of a page become rows, numbered in page order. A tag name's own running depth pairs its start and end
tags; elements without an end tag of their own enclose nothing. The depth over all paired elements gives each element's
parent, the last one before it that is one level up. Lengths and dates of an element follow from running sums, so no
element's text is built but the chosen ones'. All windows run inside one page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.sources.scratch import written

# How listings write a day, and the elements that have no end tag.
DAY = r"\b((?:0?[1-9]|[12][0-9]|3[01])/(?:0?[1-9]|1[0-2])/20[0-9]{2})\b"
VOID = "area base br col embed hr img input link meta source track wbr".split()


def tokens(pages: DataFrame) -> DataFrame:
    """(page_id, pos, kind, name, href, text): start (1), end (-1) and text (0) of a page in order; scripts, styles and comments are left out."""
    plain = F.regexp_replace("html", r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", "")
    t = pages.select("page_id", F.posexplode(F.regexp_extract_all(plain, F.lit(r"<[^<>]*>|[^<>]+"), F.lit(0))).alias("pos", "token"))
    name = F.lower(F.regexp_extract("token", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1))
    t = t.withColumn("name", name)
    closed = F.col("name").isin(VOID) | F.col("token").rlike(r"/>$")
    kind = F.when(~F.col("token").startswith("<"), 0).when(F.col("name") == "", None).when(F.col("token").startswith("</"), -1).when(closed, None).otherwise(1)
    text = F.when(~F.col("token").startswith("<"), F.trim(F.regexp_replace("token", r"[\s\u00a0]+", " "))).otherwise("")
    return t.select("page_id", "pos", kind.alias("kind"), "name", F.regexp_extract("token", r"(?i)^<a\s[^>]*?href\s*=\s*[\"']([^\"']*)", 1).alias("href"), text.alias("text")).where("kind IS NOT NULL AND (kind <> 0 OR text <> '')")


def elements(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(page_id, node, parent, last, name, href) of each element with an end tag, node and last being its tags' places; and the texts with their running sums."""
    own = Window.partitionBy("page_id", "name").orderBy("pos")
    level = F.sum("kind").over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.when(F.col("kind") == -1, 1).otherwise(0)
    tags = t.where("kind <> 0").withColumn("level", level)
    same = Window.partitionBy("page_id", "name", "level").orderBy("pos")
    tags = tags.withColumn("next_kind", F.lead("kind").over(same)).withColumn("last", F.lead("pos").over(same))
    paired = written(tags.where("kind = 1 AND next_kind = -1").select("page_id", F.col("pos").alias("node"), "last", "name", "href"))
    ends = F.array(F.struct(F.col("node").alias("pos"), F.lit(1).alias("step")), F.struct(F.col("last").alias("pos"), F.lit(-1).alias("step")))
    steps = paired.select("page_id", "node", F.explode(ends).alias("e")).select("page_id", "node", "e.*")
    depth = F.sum("step").over(Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    deep = steps.withColumn("depth", depth).where("step = 1").select("page_id", "node", "depth")
    # Each element stands at its own level as a possible parent and one level up as one that looks for its parent.
    seats = F.array(F.struct(F.col("depth").alias("seat"), F.col("node").alias("offers")), F.struct((F.col("depth") - 1).alias("seat"), F.lit(None).cast("int").alias("offers")))
    seated = deep.select("page_id", "node", F.explode(seats).alias("s")).select("page_id", "node", "s.*")
    last = F.last("offers", ignorenulls=True).over(Window.partitionBy("page_id", "seat").orderBy("node").rowsBetween(Window.unboundedPreceding, -1))
    parents = seated.withColumn("parent", last).where("offers IS NULL").select("page_id", "node", "parent")
    texts = t.where("kind = 0").select("page_id", "pos", "text", F.regexp_extract_all("text", F.lit(DAY), F.lit(1)).alias("days"))
    return paired.join(parents, ["page_id", "node"]), texts


def sums(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """nodes with the length of their text (pieces joined by a space), how many dates it has, and the first and the last."""
    places = F.array(F.struct(F.col("node").alias("pos"), F.lit(0).alias("side")), F.struct(F.col("last").alias("pos"), F.lit(1).alias("side")))
    asked = nodes.select("page_id", "node", F.explode(places).alias("p")).select("page_id", "node", "p.pos", "p.side")
    none = F.lit(None)
    given = texts.select("page_id", none.cast("int").alias("node"), "pos", none.cast("int").alias("side"), (F.length("text") + 1).alias("chars"), F.size("days").alias("n"), F.when(F.size("days") > 0, F.col("days")[0]).alias("a"), F.when(F.size("days") > 0, F.element_at("days", -1)).alias("z"))
    rows = asked.select("page_id", "node", "pos", "side", F.lit(0).alias("chars"), F.lit(0).alias("n"), none.cast("string").alias("a"), none.cast("string").alias("z")).union(given)
    before = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("page_id").orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select("page_id", "node", "side", F.sum("chars").over(before).alias("chars"), F.sum("n").over(before).alias("n"), F.first("a", ignorenulls=True).over(behind).alias("a"), F.last("z", ignorenulls=True).over(before).alias("z")).where("side IS NOT NULL")
    at = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    found = rows.groupBy("page_id", "node").agg((at("chars", 1) - at("chars", 0) - 1).alias("chars"), (at("n", 1) - at("n", 0)).alias("days"), at("a", 0).alias("first_day"), at("z", 1).alias("last_day"))
    return nodes.join(found, ["page_id", "node"])


def listing_cards(pages: DataFrame, levels: int = 8, most_chars: int = 2500, evidence: int = 1200) -> DataFrame:
    """(page_id, node, href, opening, closing, evidence) of each link of pages(page_id, html); null dates where none of its `levels` nearest elements has two dates in at most `most_chars` characters."""
    nodes, texts = elements(written(tokens(pages)))
    nodes = written(sums(nodes, texts))
    links = nodes.where("name = 'a' AND href <> ''").select("page_id", "node", "href", F.col("parent").alias("at"))
    up = nodes.select("page_id", F.col("node").alias("at"), "parent", "chars", "days", "first_day", "last_day", "last")
    done, looking = [], links
    for _ in range(levels):
        seen = written(looking.join(up, ["page_id", "at"]).withColumn("fits", (F.col("days") >= 2) & F.col("chars").between(1, most_chars)))
        done.append(seen.where("fits"))
        looking = seen.where("NOT fits AND parent IS NOT NULL").select("page_id", "node", "href", F.col("parent").alias("at"))
    cards = done[0]
    for more in done[1:]:
        cards = cards.unionByName(more)
    cards = written(cards.select("page_id", "node", "at", "last", "first_day", "last_day"))
    pieces = cards.select("page_id", "at", "last").distinct().join(texts.select("page_id", "pos", "text"), "page_id").where("pos > at AND pos < last")
    said = pieces.groupBy("page_id", "at").agg(F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("p")).select("page_id", "at", F.substring(F.array_join(F.transform("p", lambda x: x["text"]), " "), 1, evidence).alias("evidence"))
    iso = lambda c: F.concat_ws("-", F.split(c, "/")[2], F.lpad(F.split(c, "/")[1], 2, "0"), F.lpad(F.split(c, "/")[0], 2, "0"))
    told = cards.join(said, ["page_id", "at"]).select("page_id", "node", iso("first_day").alias("opening"), iso("last_day").alias("closing"), "evidence")
    return links.select("page_id", "node", "href").join(told, ["page_id", "node"], "left")

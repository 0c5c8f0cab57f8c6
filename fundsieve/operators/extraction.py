"""Facts from pages and texts: sections, evidence, titles, snippets, feeds and rows with unknown column names. Lexicons and patterns are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.functions import text as T

NO_TEXT = r"(?is)<(?:script|style|nav|header|footer|form|svg)(?:\s[^>]*)?>.*?</(?:script|style|nav|header|footer|form|svg)>"
BLOCK = r"(?is)<(h[1-5]|p|li|td|th|dt|dd)(?:\s[^>]*)?>(.*?)</(?:h[1-5]|p|li|td|th|dt|dd)>"
ANCHOR = '<a href="([^"]*)">([^<]*)</a>'


# The words by which links to programmes and to further pages of a listing are told, and the wording of result counters.
PROGRAMME_WORDS = r"appel a projets?|appel a manifestation|appel a candidatures?|\baap\b|\bami\b|aide|subvention|financement|avance remboursable|pret|concours|france 2030|feder|feader|fse|ftj"
PAGER_LABEL = r"^(suivant|next|precedent|previous|page\s*[0-9]+|[0-9]+)$"
PAGER_PARAMETER = r"[?&](page|p)=[0-9]+(&|$)|[?&][^=&]*(currentpage|pageindex|pagenumber)[^=&]*=[0-9]+"
COUNTERS = [r"(?i)([0-9]+)\s+dispositifs?\s+d['’]aide\s+correspondent", r"(?i)([0-9]+)\s+r[eé]sultat\(s\)", r"(?i)([0-9]+)\s+aide\(s\)\s*&\s*service\(s\)"]


def relevant_link(label: Column, url: Column, include: str | None = None, pattern: str | None = None) -> Column:
    """A link that holds the source's substring, matches its pattern, or names a programme in label or url."""
    found = [url.contains(include)] if include else []
    found += [url.rlike(f"(?i){pattern}")] if pattern else []
    return reduce(lambda a, b: a | b, [*found, T.norm(F.concat_ws(" ", label, url)).rlike(PROGRAMME_WORDS)])


def pagination_link(label: Column, url: Column) -> Column:
    """A link to another page of a listing, by its label or by a parameter of its decoded url."""
    return T.norm(label).rlike(PAGER_LABEL) | F.lower(F.coalesce(F.try_url_decode(url), url)).rlike(PAGER_PARAMETER)


def result_counter(text: Column) -> Column:
    """The number of results that a listing page states, by the first wording found."""
    return F.coalesce(*[F.try_element_at(F.regexp_extract_all(text, F.lit(p), F.lit(1)), F.lit(1)).try_cast("long") for p in COUNTERS])


def blocks(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, tag, text): headings, paragraphs and cells in page order, without menus and forms."""
    kept = F.regexp_replace(html, NO_TEXT, " ")
    both = F.arrays_zip(F.regexp_extract_all(kept, F.lit(BLOCK), F.lit(1)).alias("tag"), F.regexp_extract_all(kept, F.lit(BLOCK), F.lit(2)).alias("body"))
    found = pages.select(key, F.posexplode(both).alias("pos", "b"))
    return found.select(key, "pos", F.lower("b.tag").alias("tag"), T.html_to_text(F.col("b.body")).alias("text"))


def first_class(t: Column, lexicon: list[tuple[str, list[str]]]) -> Column:
    """The first class, in the lexicon's order, of which the normalised text holds a phrase."""
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [t.contains(p) for p in phrases]), F.lit(name)) for name, phrases in lexicon])


def sections(pages: DataFrame, key: str, html: str, lexicon: list[tuple[str, list[str]]], start: str = "objective", longest: int = 9000) -> DataFrame:
    """(key, section, text, blocks): a heading with a class opens its section, other headings leave it; very long blocks go."""
    b = blocks(pages, key, html)
    heading = F.col("tag").startswith("h")
    in_order = Window.partitionBy(key).orderBy("pos")
    b = b.withColumn("section", F.coalesce(F.last(F.when(heading, first_class(T.norm(F.col("text")), lexicon)), True).over(in_order), F.lit(start)))
    b = b.where(~heading & (F.length("text") < longest) & (F.col("text") != ""))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    return b.groupBy(key, "section").agg(F.array_join(parts, " \n ").alias("text"), F.count(F.lit(1)).alias("blocks"))


def emit_evidence(pages: DataFrame, key: str, html: str, lexicon: list[tuple[str, list[str]]], fallback: dict[str, str], most: int = 850) -> DataFrame:
    """(key, field, value, locator): each field's section, else the first sentence of the page that fits its pattern; fields without a pattern come from sections only."""
    names = [name for name, _ in lexicon]
    own = sections(pages, key, html, lexicon).groupBy(key).agg(*[F.max(F.when(F.col("section") == f, F.col("text"))).alias(f"s_{f}") for f in names])
    t = pages.select(key, T.sentences(T.html_to_text(F.col(html))).alias("sentences")).join(own, key, "left")

    def one(f: str) -> Column:
        found = T.first_matching(F.col("sentences"), fallback[f]) if f in fallback else F.lit(None).cast("string")
        where = F.when(F.col(f"s_{f}").isNotNull(), f"section:{f}").otherwise(f"page-text-match:{f}")
        return F.struct(F.lit(f).alias("field"), F.substring(F.coalesce(f"s_{f}", found), 1, most).alias("value"), where.alias("locator"))

    return t.select(key, F.explode(F.array(*[one(f) for f in names])).alias("e")).select(key, "e.*").where("value IS NOT NULL")


def anchors(pages: DataFrame, key: list[str], html: str) -> DataFrame:
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(2)).alias("label"))
    return pages.select(*key, F.posexplode(both).alias("pos", "a")).select(*key, F.col("pos").cast("long").alias("pos"), "a.href", "a.label")


def first_case(rules: list[tuple[str, Column]], default: str | None = None) -> Column:
    """The name of the first rule that holds."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules], F.lit(default))


def links_under(pages: DataFrame, key: str, html: str, label: str) -> DataFrame:
    """(key, pos, href): links after a heading that holds the label, up to the next heading of the same or a higher level; the page title is of level 1."""
    rx = r'<(title|h[1-5])(?:\s[^>]*)?>([^<]*)</|<a href="([^"]*)"'
    parts = F.arrays_zip(*[F.regexp_extract_all(html, F.lit(rx), F.lit(g)).alias(n) for g, n in ((1, "tag"), (2, "head"), (3, "href"))])
    t = pages.select(key, F.posexplode(parts).alias("pos", "x")).select(key, "pos", "x.*")
    level = F.when(F.col("tag") == "title", 1).when(F.col("tag") != "", F.substring("tag", 2, 1).cast("int"))
    w = Window.partitionBy(key).orderBy("pos")
    t = t.withColumn("level", level).withColumn("hit", F.col("level").isNotNull() & T.norm(F.col("head")).contains(label))
    t = t.withColumn("opened", F.last(F.when(F.col("hit"), F.struct("pos", "level")), True).over(w))
    ends = F.col("level").isNotNull() & ~F.col("hit") & (F.col("level") <= F.col("opened.level"))
    t = t.withColumn("ended", F.last(F.when(ends, F.col("pos")), True).over(w))
    return t.where(F.col("level").isNull() & F.col("opened").isNotNull() & (F.col("ended").isNull() | (F.col("ended") < F.col("opened.pos")))).select(key, F.col("pos").cast("long").alias("pos"), "href")


def aliased(rows: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Each logical field from the columns whose name equals or holds one of its aliases, in the aliases' order, first non-blank value; rows without title go.

    Names are resolved once for the schema, so the plan is a plain projection.
    """
    plain = {c: c.lower().replace("_", "") for c in rows.columns}

    def field(names: list[str]) -> Column:
        hits = [c for a in names for c in plain if plain[c] == a] + [c for a in names for c in plain if a in plain[c]]
        values = [F.nullif(F.trim(T.html_to_text(F.col(c).cast("string"))), F.lit("")) for c in dict.fromkeys(hits)]
        return F.coalesce(*values) if values else F.lit(None).cast("string")

    return rows.select(*[field(names).alias(f) for f, names in aliases.items()]).where("title IS NOT NULL")


def around(c: Column, at: Column, before: int, after: int) -> Column:
    """The text from `before` characters before position `at` to `after` behind it; null where at is 0."""
    start = F.greatest(F.lit(1), at - before)
    return F.when(at > 0, F.substring(c, start, at - start + after))


def inferred_title(c: Column, generic: str, lines: int = 120) -> Column:
    """The first line in capitals (12 letters, at most 190 characters), else the first of 18 to 150 characters; generic ones are passed over."""
    own = F.filter(F.slice(F.split(c, "\n"), 1, lines), lambda x: ~T.norm(x).rlike(generic))
    count = lambda x, rx: F.length(F.regexp_replace(x, rx, ""))
    loud = F.filter(own, lambda x: (F.length(x) <= 190) & (count(x, "[^A-Za-zÀ-ÿ]") >= 12) & (count(x, "[^A-ZÀ-Ý]") > 0.65 * count(x, "[^A-Za-zÀ-ÿ]")))
    return F.coalesce(F.try_element_at(loud, F.lit(1)), F.try_element_at(F.filter(own, lambda x: F.length(x).between(18, 150)), F.lit(1)))


def distinct_matches(items: Column, pattern: str, most: int, shortest: int = 12) -> Column:
    """The first distinct sentences that fit, joined by spaces; null without one."""
    hits = F.slice(F.array_distinct(F.filter(items, lambda s: T.found(s, pattern) & (F.length(s) >= shortest))), 1, most)
    return F.when(F.size(hits) > 0, F.array_join(hits, " "))


def with_policy(programs: DataFrame, policies: DataFrame, as_of: str) -> DataFrame:
    """Policy evidence of the programme's source and scope, while it is no older than its greatest age: a plain aid becomes a grant."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("policy_on"))
    t = programs.join(policies, ["source_id", "scope"], "left")
    applies = F.coalesce(age.between(0, F.col("max_age")) & (F.col("kind") == "AIDE"), F.lit(False))
    return t.select("program_id", applies.alias("applies"), F.when(applies, "SUBVENTION").otherwise(F.col("instrument")).alias("instrument"))


def size_parts(rows: DataFrame, key: str, span: int, limit: int) -> DataFrame:
    """(range, part, rows, chars): parts of about `limit` characters of JSON within each range of `span` keys, so no order runs over the whole table."""
    t = rows.select(key, F.floor(F.col(key) / span).alias("range"), F.length(F.to_json(F.struct(*rows.columns))).cast("long").alias("chars"))
    before = Window.partitionBy("range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("part", F.floor(F.coalesce(F.sum("chars").over(before), F.lit(0)) / limit))
    return t.groupBy("range", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def financial_terms(clauses: DataFrame, key: str) -> DataFrame:
    """Per key: bounds of the amounts in sentences on the aid and of the rates in sentences on rates, each of all sentences where none is so worded, and of project costs, whose maximum needs two amounts."""
    s = clauses.select(key, F.explode(T.sentences(F.col("text"))).alias("s")).select(key, "s", T.amounts(F.col("s")).alias("a"), T.rates(F.col("s")).alias("r"))
    s = s.select(key, "a", "r", F.when((F.size("a") > 0) | (F.size("r") > 0), T.norm(F.col("s"))).alias("n"))  # the wording of a sentence without figures says nothing
    both = lambda c, cond, name: [f(F.when(cond, g(c))).alias(f"{x}_{name}") for x, f, g in (("min", F.min, F.array_min), ("max", F.max, F.array_max))]
    always, aid, cost, rated = F.lit(True), F.col("n").rlike(T.AID), F.col("n").rlike(T.PROJECT_COST), F.col("n").rlike(T.RATED)
    g = s.groupBy(key).agg(*both("a", aid, "aid"), *both("a", always, "any"), *both("a", cost, "cost"), F.sum(F.when(cost, F.size("a")).otherwise(0)).alias("costs"), *both("r", rated, "rated"), *both("r", always, "said"))
    first = lambda a, b, name: F.coalesce(a, b).alias(name)
    return g.select(key, first("min_aid", "min_any", "min_amount"), first("max_aid", "max_any", "max_amount"), first("min_rated", "min_said", "min_rate"), first("max_rated", "max_said", "max_rate"), "min_cost", F.when(F.col("costs") >= 2, F.col("max_cost")).alias("max_cost"))


def terms_by_size(clauses: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each sentence and size of company that it names, with the bounds of its rates and amounts."""
    s = clauses.select(*keys, F.explode(T.sentences(F.col("text"))).alias("s"))
    s = s.select(*keys, F.explode(T.labels(T.norm(F.col("s")), T.SIZE_RULES)).alias("category"), T.rates(F.col("s")).alias("r"), T.amounts(F.col("s")).alias("a"))
    return s.select(*keys, "category", F.array_min("r").alias("rate_min"), F.array_max("r").alias("rate_max"), F.array_min("a").alias("amount_min"), F.array_max("a").alias("amount_max"))


def calendar(clauses: DataFrame, key: str) -> DataFrame:
    """Per key: opening, closing (the last final date, else the last deadline), number of deadlines, and whether open at all times.

    A dated line with a calendar word is an opening, a round, a final date, or, if none of these, a deadline.
    """
    lines = clauses.select(key, "text", F.explode_outer(F.split("text", r"\n|(?<=[.!?;])\s+")).alias("line")).withColumn("n", T.norm(F.col("line")))
    opens, final = F.col("n").rlike(T.OPENING), F.col("n").rlike(T.FINAL)
    due = final | F.col("n").rlike(T.ROUND) | ~opens
    dated = lines.select(key, F.when(F.col("n").rlike(T.CALENDAR), T.dates(F.col("line"))).alias("d"), opens.alias("opens"), final.alias("final"), due.alias("due"), F.col("n").rlike(T.PERMANENT).alias("permanent"))
    g = dated.select(key, "opens", "final", "due", "permanent", F.explode_outer("d").alias("d")).groupBy(key)
    return g.agg(F.min(F.when(F.col("opens"), F.col("d"))).alias("opening"), F.coalesce(F.max(F.when(F.col("final"), F.col("d"))), F.max(F.when(F.col("due"), F.col("d")))).alias("closing"), F.countDistinct(F.when(F.col("due"), F.col("d"))).alias("deadlines"), F.bool_or("permanent").alias("permanent"))

"""Main text of HTML pages by differencing each page with its nearest URLs on the same host.

A page becomes text blocks in page order, each with its place: in an article, in a part that markup names as no content
(menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles), or neither. Pages stand in
order of host and path; each is aligned with the two pages before and the two after it on its host by the longest common
subsequence of lines. Neighbouring pages with the same blocks count as one page, so copies delete nothing from each
other. A line goes if two of these pages share it (all of them, where there are fewer): the site's frame, but no text
that one other page quotes. Where a page marks its article, lines outside it are not content; an article that shares
most of its text (`copy`) is a copy as well; and inside it the alignment deletes the lines of places (paths of tags and
classes) all of whose lines are shared: boxes of the frame, but no passage that a text shares with a neighbour's.

Cases: a null html or one without text gives ''; a null url stands on host ''; a page alone on its host has nothing to
be aligned with; repeated rows are copies of each other; unclosed tags end with their parent; a
tag that ends before its `>` is text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter, deque
from itertools import chain

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundsieve.llm.hostrank import host_and_path
from fundsieve.llm.tables import quantile_cuts, range_bucket

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math canvas object audio video".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
ASIDE = RAW | set("head nav aside footer form button select textarea dialog menu title".split())
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|alert|newsletter|subscri\w*|popup|modal|sidebar|side|menu|nav\w*|breadcrumbs?|footer|header|masthead|comments?|replies|respond|disqus|share|sharing|social|related|recommend\w*|widget|toolbar|pagination|pager|skip)(?:$|[\s_-])", re.I)
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu".split())
# A value in quotes behind "=" ends at the next such quote, however far; without one the quote is a character. What begins
# like a tag and meets "<" or the end of the page first is text up to there, so every character is read once.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(>?)|<[!?][^<>]*>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE, DIGITS = re.compile(r"\s+"), re.compile(r"\d+")
NEITHER, ARTICLE = 0, 1
BESIDE = 2  # pages on each side that a page is aligned with


def is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE or tag == "header" and not in_article:
        return True
    if tag in ("article", "main", "body", "html"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "role" and value.lower() in ROLES or name.lower() != "role" and NAMED.search(value):
            return True
    return False


def blocks(html: str) -> list[tuple[int, int, str]]:
    """(kind, place, text) of the blocks that may be content, in page order; a place is one path of tags and classes."""
    out: list[tuple[int, int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int, int]] = []  # tag; asides, articles and place before it
    open_tags: Counter = Counter()
    unclosed: set[str] = set()
    asides = articles = place = 0

    def flush() -> None:
        line = SPACE.sub(" ", entities.unescape("".join(text))).strip()
        text.clear()
        if line and not asides:
            out.append((ARTICLE if articles else NEITHER, place, line))

    def close_to(tag: str) -> None:
        nonlocal asides, articles, place
        while stack:
            t, asides, articles, place = stack.pop()
            open_tags[t] -= 1
            if t == tag:
                break

    pos = 0
    while m := TOKEN.match(html, pos):
        pos = m.end()
        close, tag, attributes = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag or not m[4]:
            if tag or m[0][0] != "<" or m[0] == "<":
                text.append(m[0])
            continue
        if tag == "br" or tag not in BLOCKS and tag in VOID:
            text.append(" ")
            continue
        if tag in RAW and not close:
            end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(html, pos)
            if end is None:
                unclosed.add(tag)
            pos = end.end() if end else len(html) if tag in ("script", "style") else pos
            continue
        if tag in BLOCKS:
            flush()
        if close:
            if open_tags[tag]:
                flush()
                close_to(tag)
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS and any(s[0] == "p" for s in stack[-4:]):  # a block ends an open paragraph
            close_to("p")
        aside = is_aside(tag, attributes, articles > 0)
        if aside and tag not in BLOCKS:
            flush()
        stack.append((tag, asides, articles, place))
        open_tags[tag] += 1
        asides += aside
        articles += tag in ("article", "main")
        if tag in BLOCKS:
            names = " ".join("".join(v) for k, *v in ATTRIBUTE.findall(attributes) if k.lower() != "role")
            place = xxhash.xxh64_intdigest(f"{place} {tag} {DIGITS.sub('0', names)}") >> 1
    flush()
    return out


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions of a in one longest common subsequence of a and b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < min(len(a), len(b)) - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = set(range(lo)) | set(range(len(a) - tail, len(a)))
    both = set(a[lo : len(a) - tail]) & set(b[lo : len(b) - tail])
    x = [i for i in range(lo, len(a) - tail) if a[i] in both]
    where: dict[str, list[int]] = {}
    for j in range(lo, len(b) - tail):
        if b[j] in both:
            where.setdefault(b[j], []).append(j)
    # The longest increasing run of matching positions (Hunt and Szymanski), so cost follows the matches.
    ends: list[int] = []
    last: list[tuple] = []
    for i in x:
        for j in reversed(where[a[i]]):
            k = bisect_left(ends, j)
            node = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(node)
            elif j < ends[k]:
                ends[k], last[k] = j, node
    node = last[-1] if last else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def main_text(own: list[tuple[int, int, str]], neighbours: list[list[tuple[int, int, str]]], copy: float = 0.8) -> str:
    """The lines that no two neighbours share (no one, if there is but one); inside a marked article, shared lines go where all lines of their place are shared."""
    marked = any(p == ARTICLE for p, *_ in own)
    rows = [(place, t) for p, place, t in own if p == ARTICLE or not marked]
    lines = [t for _, t in rows]
    size = sum(map(len, lines))
    pages = 0
    times: Counter = Counter()
    for other in neighbours:
        shared = shared_lines(lines, [t for *_, t in other])
        if not marked or sum(len(lines[i]) for i in shared) < copy * size:
            times.update(shared)
            pages += 1
    gone = {i for i, n in times.items() if n >= min(2, pages)}
    if marked and gone:
        # The article's title and its running text share a line with a near copy or quote one; a box of the frame shares all.
        stays = {place for i, (place, _) in enumerate(rows) if i not in gone} | {place for place, _ in rows[:1]}
        gone = {i for i in gone if rows[i][0] not in stays}
    return "\n".join(t for i, t in enumerate(lines) if i not in gone)


def visits(edges: list, beside: int) -> list[tuple]:
    """(host, path, page_id, parts): keys of other ranges that each range needs, from (home, keys in order) of each range's first and last keys."""
    want: dict[tuple, set[int]] = {}
    for i, (home, _) in enumerate(edges):
        for step in (-1, 1):
            got, j = 0, i + step
            while got < beside and 0 <= j < len(edges):
                keys = edges[j][1][::step][: beside - got]
                for k in keys:
                    want.setdefault(k, set()).add(home)
                got, j = got + len(keys), j + step
    return [(*k, sorted(v)) for k, v in want.items()]


def extract(pages: DataFrame, rows_per_range: int = 2000, ranges: tuple[int, int] = (128, 1024)) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Rows are dealt by ranges of (host, path, page_id); the first and last keys of each range also visit the ranges beside.
    Copies of one page that stand across a border of ranges can take the place of another neighbour there.
    """
    host, path = host_and_path(F.col("url"))
    keys = ["host", "path", "page_id"]
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    named = rows.select(*keys)
    n = named.count()
    buckets = min(ranges[1], max(1, min(ranges[0], n // 8), -(-n // rows_per_range)))
    cuts = quantile_cuts(named, keys, buckets, 32 * buckets)
    dealt = named.withColumn("home", range_bucket(named, keys, cuts)).distinct()
    order = {way: F.row_number().over(Window.partitionBy("home").orderBy(*[F.col(k).asc() if way == "lo" else F.col(k).desc() for k in keys])) for way in ("lo", "hi")}
    ends: dict[int, set] = {}
    for way in order.values():
        for r in dealt.withColumn("r", way).where(F.col("r") <= BESIDE).collect():
            ends.setdefault(r.home, set()).add((r.host, r.path, r.page_id))
    edges = [(home, sorted(own, key=lambda k: (k[0], k[1], k[2] is not None, k[2] or 0))) for home, own in sorted(ends.items())]
    table = pages.sparkSession.createDataFrame(visits(edges, BESIDE), "v_host string, v_path string, v_page_id long, parts array<int>")
    same = F.col("host").eqNullSafe(F.col("v_host")) & F.col("path").eqNullSafe(F.col("v_path")) & F.col("page_id").eqNullSafe(F.col("v_page_id"))
    rows = rows.withColumn("home", range_bucket(rows, keys, cuts)).join(F.broadcast(table), same, "left")  # some keys for each of at most ranges[1] ranges
    parts = F.concat(F.array("home"), F.coalesce("parts", F.array().cast("array<int>")))
    rows = rows.select("page_id", "url", "host", "path", "html", "home", F.explode(parts).alias("part"))

    def split(frames):
        for f in frames:
            got = [blocks(h) for h in f.html]
            yield pd.DataFrame({"page_id": f.page_id, "url": f.url, "host": f.host, "path": f.path, "own": f.home == f.part, "part": f.part, "kinds": [[k for k, *_ in g] for g in got], "places": [[p for _, p, _ in g] for g in got], "texts": [[t for *_, t in g] for g in got]})

    def runs(frames):
        """(part and host, blocks, own rows) of each page; pages in a row with the same blocks are one."""
        key, lines, members = None, None, []
        for f in frames:
            for r in f.itertuples(index=False):
                now, got = (r.part, r.host), list(zip(r.kinds, r.places, r.texts, strict=True))
                if now != key or got != lines:
                    if key is not None:
                        yield key, lines, members
                    key, lines, members = now, got, []
                if r.own:
                    members.append((r.page_id, r.url))
        if key is not None:
            yield key, lines, members

    def align(frames):
        out = []
        window = deque([(None, [], [])] * (BESIDE + 1), 2 * BESIDE + 1)
        for run in chain(runs(frames), [(None, [], [])] * BESIDE):
            window.append(run)
            key, lines, members = window[-1 - BESIDE]
            if members and len(window) == 2 * BESIDE + 1:
                text = main_text(lines, [x[1] for i, x in enumerate(window) if i != BESIDE and x[0] == key])
                out += [(*m, text, len(text)) for m in members]
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])
                    out = []
        yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])

    lines = rows.mapInPandas(split, "page_id long, url string, host string, path string, own boolean, part int, kinds array<int>, places array<long>, texts array<string>")
    ordered = lines.repartition("part").sortWithinPartitions("part", "host", "path", "page_id")
    return ordered.mapInPandas(align, "page_id long, url string, text string, n_chars long")

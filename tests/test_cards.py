"""Listing cards against a stack parser in plain Python."""

import random
import re

from fundsieve.operators import cards


def plain_cards(html):
    """(href, opening, closing, evidence) of each link in order."""
    html = re.sub(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", "", html or "")
    items = re.findall(r"<[^<>]*>|[^<>]+", html)
    stacks, spans, texts = {}, [], {}
    for i, token in enumerate(items):
        m = re.match(r"</?([a-zA-Z][a-zA-Z0-9]*)", token)
        if not token.startswith("<"):
            texts[i] = re.sub(r"[\s\u00a0]+", " ", token).strip(" ")
        elif not m:
            continue
        elif token.startswith("</"):
            own = stacks.setdefault(m[1].lower(), [])
            if own:
                spans.append((own.pop(), i, m[1].lower()))
        elif m[1].lower() not in cards.VOID and not token.endswith("/>"):
            stacks.setdefault(m[1].lower(), []).append(i)
    out = []
    for a, z, name in sorted(spans):
        href = re.match(r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)", items[a])
        if name != "a" or not href or not href[1]:
            continue
        got = (None, None, None)
        for x, y, _ in sorted((s for s in spans if s[0] < a and s[1] > z), reverse=True)[:8]:
            raw = " ".join(t for i, t in sorted(texts.items()) if x < i < y and t)
            days = re.findall(cards.DAY, raw)
            if raw and len(raw) <= 2500 and len(days) >= 2:
                iso = lambda d: "-".join([d.split("/")[2], *(p.zfill(2) for p in d.split("/")[1::-1])])
                got = (iso(days[0]), iso(days[-1]), raw[:1200])
                break
        out.append((href[1], *got))
    return out


def nested(rng, depth=0):
    kind = rng.choice(["div", "ul", "li", "section", "span"])
    inside = "".join(rng.choice([lambda: nested(rng, depth + 1) if depth < 5 else "end", lambda: f'<a href="/{rng.randrange(99)}">x  y</a>', lambda: f" {rng.randrange(1, 29)}/0{rng.randrange(1, 9)}/2026 ", lambda: "text\n more", lambda: "<br>", lambda: "<!-- <div> -->", lambda: "<b>"])() for _ in range(rng.randrange(1, 5)))
    return f"<{kind} class='k'>{inside}</{kind}>"


def test_cards_equal_a_stack_parser(spark):
    rng = random.Random(8)
    pages = [(i, "<body>" + "".join(nested(rng) for _ in range(3)) + "</body>") for i in range(60)]
    pages += [(100, None), (101, ""), (102, "<a href='/x'>x</a> 1/2/2026 3/4/2026"), (103, "<div><a href='/x'>x</a> 1/2/2026 <p>3/4/2026<script>9/9/2026</script></div>" + "</div></p><p>"), (104, "<div>" + "long " * 600 + "1/2/2026 3/4/2026<a href='/x'>x</a></div>")]
    got = {}
    for r in sorted(cards.listing_cards(spark.createDataFrame(pages, "page_id long, html string")).collect(), key=lambda r: (r.page_id, r.node)):
        got.setdefault(r.page_id, []).append((r.href, r.opening, r.closing, r.evidence))
    want = {i: c for i, html in pages if (c := plain_cards(html))}
    assert got == want
    assert sum(x[1] is not None for c in want.values() for x in c) > 30

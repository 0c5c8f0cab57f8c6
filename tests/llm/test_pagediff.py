"""Page differencing: quoted values, broken tags, frame-heavy pages, copies, ranges of few pages."""

import pytest

from fundsieve.llm import pagediff

PAGES = "page_id long, url string, html string"


def texts(html):
    return [t for *_, t in pagediff.blocks(html)]


@pytest.mark.parametrize("html,want", [
    ('<p data-x="' + "a " * 3000 + '<b>x">hello</p>', ["hello"]),
    ("<p data-x='" + "a " * 300000 + "<b>x'>hello</p>", ["hello"]),
    ('<p title="it\'s > that">a</p>', ["a"]),
    ("<p title=it's>a</p><p>b's</p>", ["a", "b's"]),
    ('<p title="open>a</p><p>b</p>', ["a", "b"]),
    ("a < b and c <d", ["a < b and c <d"]),
    ("<p>x <y <i>z</i></p>", ["x <y z"]),
    ('<p>end <a href="x', ['end <a href="x']),
    ("<p class = 'k'  id=\"m\" hidden>t</p>", ["t"]),
])
def test_tags_end_where_they_should(html, want):
    assert texts(html) == want


def test_reading_is_linear():
    import time

    begin = time.time()
    for html in ('<a x="' * 200_000, "<a x='\"" * 200_000, '<a x="<b " x="<b " ' * 50_000, "<a x= " * 200_000, '<a x="' + "<b y='" * 200_000, "<a =" * 300_000 + ">"):
        pagediff.blocks(html)
    assert time.time() - begin < 20


def result(spark, rows, **more):
    return {r.page_id: r.text for r in pagediff.extract(spark.createDataFrame(rows, PAGES), **more).collect()}


def page(*lines):
    return "<body>" + "".join(f"<div>{t}</div>" for t in lines) + "</body>"


def test_a_frame_goes_however_much_of_the_page_it_is(spark):
    frame = [f"frame line {k} of the site" for k in range(30)]
    for n in (2, 3, 7):
        got = result(spark, [(i, f"http://a.b/{i}", page(*frame[:20], f"own {i}", *frame[20:])) for i in range(n)])
        assert got == {i: f"own {i}" for i in range(n)}


def test_copies_and_quotes_stay(spark):
    frame = ["menu of the site", "foot of the site"]
    body = {0: "first", 1: "second", 2: "third", 3: "same", 4: "same", 5: "same", 6: "sixth", 7: "seventh"}
    rows = [(i, f"http://a.b/{i}", page(frame[0], f"text {t}", *(["one quoted line"] if i in (1, 2) else []), frame[1])) for i, t in body.items()]
    want = {i: f"text {t}" + ("\none quoted line" if i in (1, 2) else "") for i, t in body.items()}
    assert result(spark, rows) == want
    lone = [(i, "http://c.d/x", page("all", "the", "same")) for i in range(50)]
    assert set(result(spark, lone).values()) == {"all\nthe\nsame"}


@pytest.mark.parametrize("ranges", [(1, 1), (64, 64)])
def test_ranges_change_nothing(spark, ranges):
    frame = ["menu of the site", "foot of the site"]
    rows = [(i % 90, f"http://h{i % 3}.b/{i // 7}", page(frame[0], f"text {i}", *(["news"] if i % 5 < 3 else []), frame[1])) for i in range(200)]
    kinds = sorted((r.page_id, r.url, r.text) for r in pagediff.extract(spark.createDataFrame(rows, PAGES), ranges=ranges).collect())
    again = sorted((r.page_id, r.url, r.text) for r in pagediff.extract(spark.createDataFrame(rows, PAGES), rows_per_range=9, ranges=(2, 1024)).collect())
    assert kinds == again


def test_visits_reach_over_short_ranges():
    edges = [(0, [("h", "a", 1)]), (1, [("h", "b", 1)]), (2, [("h", "c", 1), ("h", "d", 1)]), (5, [("h", "e", 1)])]
    assert dict(((h, p, i), parts) for h, p, i, parts in pagediff.visits(edges, 2)) == {("h", "a", 1): [1, 2], ("h", "b", 1): [0, 2], ("h", "c", 1): [0, 1, 5], ("h", "d", 1): [1, 5], ("h", "e", 1): [2]}

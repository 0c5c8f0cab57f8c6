"""License scans: joined names, identifiers, headings, repeated notices, and finds against a plain search over all places."""

import random
import time

import pyarrow as pa
import pytest

from fundsieve.llm import licenses


@pytest.fixture(scope="module")
def templates():
    return licenses.Templates(licenses.texts(), licenses.names())


def found(templates, text):
    return [(name, kind) for _, name, kind, *_ in templates.find(pa.array([text]), 0.8)]


@pytest.mark.parametrize("text,want", [
    ("Dual licensed under the MIT License and the Apache License, Version 2.0.", [("MIT", "notice"), ("Apache-2.0", "notice")]),
    ("Licensed under the MIT or Apache-2.0 license", [("MIT", "notice"), ("Apache-2.0", "notice")]),
    ("// SPDX-License-Identifier: Apache-2.0", [("Apache-2.0", "notice")]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0 OR 0BSD", [("MIT", "notice"), ("Apache-2.0", "notice"), ("0BSD", "notice")]),
    ("Licensed under MIT", [("MIT", "notice")]),
    ("intro\nMIT License\n\nsome text", [("MIT", "heading")]),
    ("intro\n  MIT License  ", [("MIT", "heading")]),
    ("the MIT License is short", []),
    ("he studied at MIT\nMIT\nand left", []),
    ("under the quiet trees MIT", []),
    ("Licensed under the MIT License. People at large and many others read the Apache License, Version 2.0", [("MIT", "notice")]),
    ("Licensed\nunder the\nMIT License", [("MIT", "notice")]),
    ("", []),
])
def test_names_and_phrases(templates, text, want):
    assert found(templates, text) == want
    assert found(templates, f"before {text}".replace("before intro", "intro") if text.startswith("intro") else f"one two. {text}") == want


def test_time_grows_with_the_notices(templates):
    def took(text):
        start = time.process_time()
        n = len(found(templates, text))
        return n, time.process_time() - start

    n, short = took("Licensed under the MIT License. " * 2000)
    m, long = took("Licensed under the MIT License. " * 20000)
    assert (n, m) == (2000, 20000) and long < 5 and long < 40 * max(short, 0.02)
    n, long = took("public license version 3 " * 20000)
    assert n == 0 and long < 5


def test_finds_equal_a_plain_search(templates):
    """Texts made of notices, joined names and prose: what was put in comes out, with its place."""
    rng = random.Random(7)
    plain = [(k, n) for k, n, strict in licenses.names() if not strict]
    for _ in range(150):
        words, want = [], []
        for _ in range(rng.randrange(1, 8)):
            words += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(6, 12))]
            if rng.random() < 0.7:
                phrase = rng.choice(licenses.PHRASES)
                start = len(licenses.Templates.words_at([" ".join(words), ""])[0])
                for i in range(rng.choice([1, 1, 2])):
                    key, name = rng.choice(plain)
                    words += ([phrase] if i == 0 else ["and the"]) + [name]
                    end = len(licenses.Templates.words_at([" ".join(words), ""])[0])
                    at = start if i == 0 else end - len(licenses.Templates.words_at([name, ""])[0])
                    want.append((key, at, end - 1))
        got = [(name, a, b) for _, name, _, _, a, b in templates.find(pa.array([" ".join(words)]), 0.8)]
        # A longer phrase may begin before a shorter one that was put in, and a short name stand inside a longer one.
        assert [g[0] for g in got] == [w[0] for w in want] and all(g[1] == w[1] and g[2] == w[2] for g, w in zip(got, want, strict=True)), (" ".join(words), got, want)


def test_batches_with_offsets(templates):
    column = pa.array(["x", None, "Licensed under MIT\nMIT License", "Released under the ISC License"]).slice(1)
    assert [(d, name, kind, a, b) for d, name, kind, _, a, b in templates.find(column, 0.8)] == [(1, "MIT", "notice", 0, 2), (1, "MIT", "heading", 3, 4), (2, "ISC", "notice", 0, 4)]

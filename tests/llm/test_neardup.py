"""Hot lists of near-duplicates: candidates of template texts, and links against brute force in hard mixtures."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundsieve.llm import neardup
from fundsieve.llm.tables import cut


def template_rows(n, seed=1, words=200, fields=12, values=10):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = [f"t{k}" for k in range(words)]
        for f in range(fields):
            text[f * words // fields + 5] = f"f{f}v{rng.randrange(values)}"
        out.append((i, " ".join(text)))
    return out


def brute_force(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}
    comp = {i: i for i in sets}
    find = lambda i: i if comp[i] == i else find(comp[i])
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                comp[q] = p
    return {i: find(i) for i in sets}


def candidates(spark, rows, monkeypatch):
    counted = []
    real = neardup.prefix_pairs

    def count(*a, **k):
        out = cut(real(*a, **k))
        counted.append(out.count())
        return out

    monkeypatch.setattr(neardup, "prefix_pairs", count)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return sum(counted), got


def test_template_texts_make_candidates_in_proportion(spark, monkeypatch):
    made = {}
    for n in (500, 2000):
        rows = template_rows(n)
        made[n], got = candidates(spark, rows, monkeypatch)
        monkeypatch.undo()
        if n == 500:
            assert got == brute_force(rows, 5, 80)
    assert made[2000] < 5 * made[500], made  # all pairs would be 16 times as many


@pytest.mark.parametrize("hot,depth", [(2, 12), (3, 1), (5, 3)])
def test_links_in_hot_lists_equal_brute_force(spark, monkeypatch, hot, depth):
    rng = random.Random(hot)
    rows = template_rows(60, 3, words=60, fields=6, values=2)
    base = [w for _, t in template_rows(3, 4, words=80, fields=3, values=3) for w in t.split()]
    for i in range(60, 140):  # near copies of several lengths and edits
        text = base[: rng.choice([60, 66, 72, 80])]
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(5)}"
        rows.append((i, " ".join(text)))
    real = neardup.prefix_pairs
    monkeypatch.setattr(neardup, "prefix_pairs", lambda *a: real(*a, depth=depth))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()}
    assert got == brute_force(rows, 5, 80)


def test_elements_hold_shingles_of_the_same_classes(spark):
    sets = spark.createDataFrame([(1, [1, 2, 3, 9]), (2, [1, 2, 3, 8, 7]), (3, [3, 4])], "node long, shingles array<long>")
    got = {r.node: list(zip(r.dfs, r.ws, strict=True)) for r in neardup.elements(sets).collect()}
    assert got == {1: [(1, 1), (2, 2), (3, 1)], 2: [(1, 2), (2, 2), (3, 1)], 3: [(1, 1), (3, 1)]}


def test_entries_come_in_bounded_batches():
    part = lambda k, n: [np.full(n, k), *[np.ones(n, np.int64)] * 12]
    sizes = [1, 0, 50_000, 40_000, 200_000, 3, 0, 65_536, 7]
    got = list(neardup.entry_batches(part(k, n) for k, n in enumerate(sizes)))
    assert [b.num_rows for b in got] == [90_001, 200_000, 65_539, 7]
    assert np.concatenate([b.column(0).to_numpy() for b in got]).tolist() == np.repeat(np.arange(len(sizes)), sizes).tolist()
    assert list(neardup.entry_batches(part(k, 0) for k in range(3))) == []


def test_workers_give_unused_memory_back():
    """Many small pieces freed under one that stays: C's allocator keeps them until asked."""
    code = """
import re
import pyarrow as pa
from fundsieve.llm.words import slices

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(["a " * (3 << 20)] * 2)], ["doc_id", "text"])
before = held()
for b in slices([batch]):
    pieces = [bytes(1000) for _ in range(150_000)]
    last = bytes(1000)
    del pieces
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=60, cwd=Path(__file__).parents[2])
    assert float(out.stdout) < 60

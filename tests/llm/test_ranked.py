"""Op 13: the sharing graph adds up every item's terms, and rankings equal scoring each pair."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import op13_ranked as op
from llm_fixtures import docs_of  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    queries = defaultdict(set)
    for i, t in items:
        queries[i] |= set(terms(t))
    out = []
    for item, q in queries.items():
        scored = []
        for d, b in bags:
            m = 100 - 50 + 50 * sum(b.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in q if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d, s))
        out += [(item, r, x[3], x[4]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def mine(spark, docs_of, docs, items, **options):
    items = spark.createDataFrame(items, "item_id string, text string").withColumn("score", F.lit("mine"))
    return sorted((tuple(r) for r in op.search(docs_of(docs), items, **options).collect()), key=str)


def test_graph_adds_up_every_item():
    rnd = random.Random(1)
    for _ in range(30):
        sets = [set(rnd.sample(range(40), rnd.randint(1, 25))) for _ in range(rnd.randint(1, 30))]
        g = op.mine(sets)
        value = np.array([[rnd.randint(0, 10**12) for _ in range(3)] for _ in range(40)])
        assert (g.scores(value[g.order]) == np.array([value[sorted(s)].sum(0) for s in sets])).all()
        assert g.additions() <= sum(len(s) - 1 for s in sets)


def test_shared_sets_are_summed_once():
    shared = set(range(100, 120))
    g = op.mine([shared | {i} for i in range(50)])
    assert g.additions() == 19 + 50 and g.n_nodes == 51
    two = [set(range(5)) | set(range(10, 15)), set(range(5)) | set(range(20, 25)), set(range(10, 15)) | set(range(20, 25)), set(range(5)) | set(range(10, 15)) | {99}]
    assert len(op.mine(two).levels) == 1


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "x2", "日本"]
    rows = [(i, " ".join(rnd.choice(words[:rnd.randint(1, 64)]).upper() + rnd.choice(["", ",", "-"]) for _ in range(rnd.randint(0, 80)))) for i in range(300)]
    return rows + [(None, rows[5][1]), (300, None), (301, ""), (302, "!?"), (303, rows[7][1]), rows[9], rows[9]]


@pytest.fixture(scope="module")
def items():
    rnd = random.Random(8)
    rows = [(f"i{k}", " ".join(f"w{rnd.randint(0, 70)}" for _ in range(rnd.randint(1, 30)))) for k in range(40)]
    return rows + [("none", None), ("void", "..."), ("i3", "naïve É 日本"), (None, "w1 X2"), ("rare", "zzz"), rows[4]]


@pytest.mark.parametrize("cells,per_block", [(4 << 20, 1024), (300, 1024), (4 << 20, 9)])
def test_against_scoring_every_pair(spark, docs_of, docs, items, monkeypatch, cells, per_block):
    monkeypatch.setattr(op, "BLOCK_CELLS", cells)
    monkeypatch.setattr(op, "ITEMS_PER_BLOCK", per_block)
    assert mine(spark, docs_of, docs, items) == brute(docs, items)


def test_few_best_and_edges(spark, docs_of, docs, items):
    assert mine(spark, docs_of, docs, items, k=3) == brute(docs, items, 3)
    assert mine(spark, docs_of, [], items) == [] and mine(spark, docs_of, docs, []) == []
    long = [(1, "w1 " * 400_000), (2, "w1 w2"), (3, "a" * 2_000_000)]
    assert mine(spark, docs_of, long, items) == brute(long, items)
    assert op.search(docs_of(docs), spark.createDataFrame(items, "item_id string, text string")).columns == ["item_id", "rank", "doc_id", "score"]

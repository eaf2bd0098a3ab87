"""Op 6: suffix arrays against sorting, and removal against counting every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import op6_suffix_dedup as op
from llm_fixtures import docs_of  # noqa: F401

WORDS = "abcdefgh"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def mine(docs_of, texts, length, **options):
    out = op.dedup(docs_of(list(enumerate(texts))), length=length, **options)
    return [tuple(r)[1:] for r in sorted(out.select("doc_id", *op.digests()).collect())]


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(5)
    for _ in range(200):
        top = rnd.choice([2, 3, 9])
        t = np.array([rnd.randint(1, top) for _ in range(rnd.randint(0, 60))] + [0])
        sa = op.suffix_array(t, 10**6)
        order = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert sa.tolist() == order
        plcp = op.common_prefixes(t.astype(np.uint16), sa, 1000)
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert plcp[b] == n


def test_equal_strings_have_equal_anchors():
    rnd = random.Random(6)
    common = bytes(rnd.choice(b"abcdefghij") for _ in range(300))
    texts = [bytes(rnd.choice(b"xyz") for _ in range(rnd.randint(0, 90))) + common + b"!" * k for k in range(8)]
    found = []
    for x in texts:
        row, h, s, a, n = op.anchors(np.frombuffer(x, np.uint8), np.array([0, len(x)]), 200)
        assert n.sum() == len(x) - 199  # every string belongs to one run
        by = {int(start): int(key) for key, first, k in zip(h, a, n) for start in range(first, first + k)}
        at = x.index(common)
        found.append([by[at + i] for i in range(101)])
    assert all(f == found[0] for f in found)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    word = lambda alphabet, most: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, most)))
    rows = [word("abé ", 250) for _ in range(40)] + [None, "", "abab" * 40, "ééé"]
    passage = "".join(rnd.choice(WORDS) for _ in range(100))
    return rows + [word(WORDS, 50) + passage + word(WORDS, 50) for _ in range(25)] + rows[:5]


@pytest.mark.parametrize("length,hot", [(12, 4096), (40, 4096), (40, 3)])
def test_removal_equals_brute_force(docs_of, texts, length, hot):
    assert mine(docs_of, texts, length, hot=hot) == brute(texts, length)


def test_edges(docs_of):
    assert mine(docs_of, [None, "", "short"], 200) == brute([None, "", "short"], 200)
    assert op.dedup(docs_of([])).count() == 0
    rnd = random.Random(2)
    long = "".join(rnd.choice(WORDS) for _ in range(300_000))
    got = mine(docs_of, [long, long[100_000:200_000], None], 200)
    assert got == brute_copy(long)
    out = op.dedup(docs_of([(None, "x" * 300), (None, "x" * 300)]), as_text=True)
    assert [r.kept for r in out.collect()] == ["", ""] and "score" in out.columns


def brute_copy(long):
    kept = (long[:100_000] + long[200_000:]).encode()
    none = hashlib.sha256(b"").hexdigest()
    return [(300_000, 100_000, 1, hashlib.sha256(kept).hexdigest()), (100_000, 100_000, 1, none), (0, 0, 0, none)]


def test_query_on_a_table(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    rows = table(spark, d, "documents").orderBy("doc_id").collect()
    got = [tuple(r)[1:] for r in sorted(QUERIES["op6_suffix_array_dedup"](spark, d).collect())]
    assert got == brute([r.text for r in rows], 200)

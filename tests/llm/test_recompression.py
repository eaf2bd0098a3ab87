"""Op 12: symbols are the same in every occurrence of a window; removal against counting every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from panelspark.llm import op12_recompression as op
from panelspark.llm.strong import StrongWords
from llm_fixtures import docs_of  # noqa: F401

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [SPACE.findall(t or "") for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, words):
        if doc is not None:
            for i in range(len(w) - window + 1):
                g = tuple(w[i:i + window])
                least[g] = min(least.get(g, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        if doc is not None:
            for i in range(len(w) - window + 1):
                if least[tuple(w[i:i + window])] < doc:
                    gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def mine(docs_of, rows, window):
    out = op.dedup(docs_of(rows), window=window)
    return sorted((tuple(r) for r in out.select("doc_id", *op.digests()).collect()), key=str)


def names_of(text):
    data = text.encode()
    return StrongWords(np.frombuffer(data, np.uint8), np.array([0, len(data)]), op.IS_WORD, lower=False)


@pytest.mark.parametrize("alphabet,window", [("ab", 12), ("abcdef", 20), ("abcdefghijklmnopqrstuvwxyz", 50)])
def test_equal_windows_have_equal_symbols(alphabet, window):
    rnd = random.Random(3)
    common = [rnd.choice(alphabet) for _ in range(3 * window)] + ["a"] * window + ["a", "b"] * window
    by = {}
    for _ in range(30):
        w = [rnd.choice(alphabet) for _ in range(rnd.randint(0, window))] + common + [rnd.choice(alphabet) for _ in range(rnd.randint(0, window))]
        words = names_of(" ".join(w))
        row, symbol, lo, n = op.stretches(words.names[0], words.first, window)
        assert n.sum() == len(w) - window + 1 and (lo[1:] == lo[:-1] + n[:-1]).all()
        for s, x, k in zip(symbol.tolist(), lo.tolist(), n.tolist()):
            for i in range(x, x + k):
                assert by.setdefault(tuple(w[i:i + window]), s) == s


def test_symbols_depend_on_their_words_alone():
    rnd = random.Random(4)
    words = names_of(" ".join(rnd.choice("abc") * rnd.randint(1, 2) for _ in range(400)))
    for _, lo, hi in op.rounds(words.names[0], words.first, 12):
        assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all() and (hi > lo).all()


def test_high_symbols_are_few():
    rnd = random.Random(5)
    words = names_of(" ".join(str(rnd.randint(0, 10**6)) for _ in range(20_000)))
    assert len(op.stretches(words.names[0], words.first, 50)[0]) < 20_000 / 12


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    text = lambda alphabet, most: " ".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, most)))
    passage = text("abcdefgh", 60) + " é " + text("abcdefgh", 60)
    rows = [text("ab", 60) for _ in range(15)] + [text("xyzuv", 20) + " \t" + passage + "\n " + text("xyzuv", 20) for _ in range(30)]
    rows += [passage, "a " * 80, "a " * 70 + "b", "a b " * 40, None, "", " \n "] + rows[20:25]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    out = list(zip(ids, rows))
    return out + [(None, passage), (None, rows[3]), (ids[20], passage), (ids[20], rows[20]), out[21], out[21]]


@pytest.mark.parametrize("window", [8, 20, 50])
def test_removal_equals_brute_force(docs_of, rows, window):
    assert mine(docs_of, rows, window) == brute(rows, window)


def test_edges(docs_of):
    assert mine(docs_of, [(1, None), (2, ""), (3, "short text")], 50) == brute([(1, None), (2, ""), (3, "short text")], 50)
    assert op.dedup(docs_of([])).count() == 0
    rnd = random.Random(2)
    long = [f"w{rnd.randint(0, 10**9)}" for _ in range(60_000)]
    rows = [(7, " ".join(long)), (9, "x " + " ".join(long[30_000:40_000])), (8, "y " * 3 + " ".join(long[:49])), (5, "z" * 1_000_000)]
    assert mine(docs_of, rows, 50) == brute(rows, 50)
    out = op.dedup(docs_of(rows))
    assert [r.kept for r in out.where("doc_id = 9").collect()] == ["x"] and "score" in out.columns


def test_words_of_a_polynomial_collision_differ(docs_of):
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    one, two = names_of(f"{a} {b}").names
    assert one[0] != one[1] and two[0] != two[1]
    rows = [(1, " ".join([a] + ["w"] * 60)), (2, " ".join([b] + ["w"] * 60))]
    assert mine(docs_of, rows, 50) == brute(rows, 50)


def test_query_on_a_table(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in QUERIES["op12_recompression"](spark, d).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in table(spark, d, "documents").collect()], 50)

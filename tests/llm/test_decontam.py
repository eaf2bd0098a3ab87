"""Op 8 against sliding every window over every document."""

import random
import re

import numpy as np
import pytest

from panelspark.llm import op8_decontam as op
from panelspark.llm.common import Words
from llm_fixtures import docs_of  # noqa: F401


def words(s):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add("" if i is None else str(i))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if (x := tuple(w[j:j + n])) in wins:
                    hit.update(range(j, j + n))
                    found |= wins[x]
        out.append((len(w), len(hit), sorted(found)))
    return out


def shard(texts, items, window):
    tests = op.TestSuffixes(["" if i is None else str(i) for i, _ in items], [t for _, t in items], window)
    data = [(t or "").encode() for t in texts]
    offs = np.r_[0, np.cumsum([len(d) for d in data])].astype(np.int64)
    w = Words(np.frombuffer(b"".join(data), np.uint8), offs, op.IS_WORD)
    got = op.shard_matches(w, tests)
    none = ([], [])
    out = []
    for i in range(len(texts)):
        hit = set()
        for m in got.get(i, none)[0]:
            hit.update(range(m["doc_word"], m["doc_word"] + m["words"]))
        out.append((int(w.first[i + 1] - w.first[i]), len(hit), sorted(set(got.get(i, none)[1]))))
    return out


def test_shards_of_random_words():
    rnd = random.Random(3)
    v = ["a", "b", "c", "É", "x1"]
    for _ in range(200):
        texts = [" ".join(rnd.choice(v) for _ in range(rnd.randint(0, 40))) for _ in range(6)] + [None, ""]
        items = [(i, " ".join(rnd.choice(v) for _ in range(rnd.randint(0, 9)))) for i in range(4)] + [(9, None)]
        assert shard(texts, items, 4) == brute(texts, items, 4)


def test_longest_match_and_its_place():
    item = "one two three four five six seven eight nine ten eleven twelve"
    tests = op.TestSuffixes(["7"], [item])
    data = ("x y " + item + " z").encode()
    w = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), op.IS_WORD)
    assert op.shard_matches(w, tests) == {0: ([{"item": "7", "item_word": 0, "doc_word": 2, "words": 12}], ["7"])}


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_rows(spark, docs_of, block):
    """Item blocks of 60 bytes take several passes and give the same."""
    base = [f"w{i}" for i in range(30)]
    items = [(1, " ".join(base[:14])), (2, "Short, item!"), (2, " ".join(base[10:25])), (3, None), (4, "..."), (None, "lonely")]
    rows = [(1, "pre " + " ".join(base) + " post"), (2, "a SHORT item here"), (None, "lonely"), (4, None), (5, ""), (1, "pre " + " ".join(base) + " post"),
            (7, "filler " * 30_000 + " ".join(base[:11]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = op.flag(docs_of(rows), bench, item_block_bytes=block).collect()
    want = brute([t for _, t in rows], items)
    key = lambda x: (x[0], x[1], x[2])
    assert sorted(((r.n_words, r.n_hit, list(r["items"])) for r in got), key=key) == sorted(want, key=key)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) and r.kept == "mine" for r in got)
    clean = op.decontaminate(docs_of(rows), bench)
    assert clean.columns == docs_of(rows).columns and sorted(r.doc_id for r in clean.collect()) == [4, 5]
    assert op.flag(docs_of([]), bench).count() == 0
    assert op.flag(docs_of(rows), bench.limit(0)).where("contaminated").count() == 0


def test_query_on_a_table(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in table(spark, d, "benchmark").collect()]
    got = sorted(QUERIES["op8_decontaminate"](spark, d).collect(), key=lambda r: r.doc_id)
    want = brute([r.text for r in docs], items)
    import hashlib
    assert [(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got] == [(n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest()) for n, h, i in want]
    assert any(r.contaminated for r in got)


def twins(n=10):
    """A Thue-Morse word of 1,024 letters and its swap: equal under any odd base modulo 2**64."""
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [10, 11, 12])
def test_words_that_collide_as_polynomials(n):
    a, b = twins(n)
    texts, items = [f"x {b} y", f"x {a} y", b[:-1], a], [(1, a), (2, "q " * 9 + a)]
    assert shard(texts, items, 10) == brute(texts, items, 10)


def test_shared_window_repeated_in_one_text(monkeypatch):
    """1,000 items share a window that a text holds 1,000 times: a match for each place, the items once."""
    window = " ".join(f"w{i}" for i in range(10))
    tests = op.TestSuffixes([str(i) for i in range(1000)], [f"a{i} {window} b{i}" for i in range(1000)])
    data = " . ".join([f"{window} z"] * 1000).encode()
    w = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), op.IS_WORD)
    monkeypatch.setattr(op, "PAIRS", 50_000)
    found, items = op.shard_matches(w, tests)[0]
    assert len(found) == 1000 and len(items) == 1000
    assert {(m["item"], m["item_word"], m["words"]) for m in found} == {("0", 1, 10)}


def test_slices_of_items_change_nothing(monkeypatch):
    rnd = random.Random(9)
    v = ["a", "b", "c"]
    texts = [" ".join(rnd.choice(v) for _ in range(60)) for _ in range(5)]
    items = [(i, " ".join(rnd.choice(v) for _ in range(rnd.randint(1, 12)))) for i in range(20)]
    monkeypatch.setattr(op, "PAIRS", 7)
    assert shard(texts, items, 4) == brute(texts, items, 4)

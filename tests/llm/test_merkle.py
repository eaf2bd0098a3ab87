"""Op 11: roots, proofs and the log against a plain recursive build."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm import op11_merkle as op
from panelspark.llm.common import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc, source, lang, n, text = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def climb(nodes):
    """Root of the nodes and of each its siblings (before, after), from the lowest level up."""
    level, paths, at = nodes, [[] for _ in nodes], list(range(len(nodes)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            run = i // 16 * 16
            path.append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        level, at = [sha(*level[i:i + 16]) for i in range(0, len(level), 16)], [i // 16 for i in at]
    return level[0], paths


def brute(rows):
    null_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted({r[1] for r in rows}, key=null_first)
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (null_first(r[0]), leaf(r)))
        trees[s] = own, *climb([leaf(r) for r in own])
    root, tops = climb([trees[s][1] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        own, sub, paths = trees[s]
        for r, path in zip(own, paths):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            d, path = leaf(r, tampered), path + top
            for a, b in path:
                d = sha(a, d, b)
            out.append((r[0], leaf(r), sub, root, sha(*(a + b for a, b in path)), d, d == root))
    return out


def mine(spark, rows, extra=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("tree", "idx", "leaf", "proof", "root", "n", "pos", "__key", "digest"):
            docs = docs.withColumn(c, F.lit("mine"))
    out = op.manifest(docs, more={"changed": op.tampering()})
    return [tuple(r) for r in out.select("doc_id", *op.digests()).collect()]


def equal(a, b):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_against_brute_force(spark):
    rows = [(i * 7 % 5003, "hot", "en", i, f"Text {i} É") for i in range(4500)]  # three levels and a bit: two tiers
    rows += [(i, f"src{i % 300}", None, None, "ABC") for i in range(600)]  # more sources than one block
    rows += [(9, "one", "de", 3, "lone")]
    got = mine(spark, rows)
    equal(got, brute(rows))
    assert {r[-1] for r in got} == {True, False}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, ""), (1, None, "x", 1, "a"), (1, None, "x", 1, "b"), (1, None, "x", 1, "b"), (2, "", "é", -1, None), (3, "é", "", 0, "x" * 300_000), (3, "z", "", 0, "Y")]
    rows += [(5, "z", "", 0, "Y")] * 20
    equal(mine(spark, rows, extra=True), brute(rows))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes(spark, n):
    rows = [(i, "s", "en", i, str(i)) for i in range(n)]
    equal(mine(spark, rows), brute(rows))


def test_empty(spark):
    assert mine(spark, spark.createDataFrame([], SCHEMA).collect()) == []


def test_positions_are_the_order_of_completion():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4096, 4097, 5000):
        counts = [n]
        while counts[-1] > 1:
            counts.append(-(-counts[-1] // 16))
        log = []
        for i in range(n):
            for level, count in enumerate(counts):
                j = i // 16 ** level
                if level and min(n, (j + 1) * 16 ** level) != i + 1:
                    break
                log.append((level, j))
        assert [op.position(n, *x) for x in log] == list(range(sum(counts)))


def test_log_is_whole_and_in_order(spark):
    scratch = Scratch(spark)
    leaves = spark.range(700).select(F.lit(0).cast("long").alias("tree"), F.lit(700).cast("long").alias("n"), F.col("id").alias("idx"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    tiers = op.append_log(leaves, scratch)
    assert len(tiers) == 2
    rows = sorted((r for t in tiers for r in t.collect()), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(700 + 44 + 3 + 1))
    assert op.roots(tiers).collect()[0].digest == climb([sha(str(i)) for i in range(700)])[0]
    scratch.drop()

"""Near-duplicate detection by a chosen-path set similarity join.

A text's set is its distinct 5-word shingles.  ``TREES`` independent trees branch the sets: at each
level a node's members are dealt to children by one minwise token (the token with the smallest
value under that tree's and level's hash function), so a pair of Jaccard similarity J shares a child
with probability J.  Nodes of up to ``LEAF`` members are compared exhaustively, first
by their chosen tokens, then on full sets;
larger ones branch on, up to ``LEVELS`` levels.  A pair of similarity J is missed by all trees with
probability (1 - J**d)**trees if its nodes are small at level d.  There are as many trees as keep this
below ``MISSED`` at the threshold and the last level (``trees_for``: 16 at 0.85, 25 at 0.8).  Sets that meet others in fewer
than ``meets_for`` trees at the first level are left out beforehand: similar sets meet each other in about
J * trees trees, and in fewer than that with probability below ``PRUNED``, while sets that share a common
phrase only meet in one or two.  Within a node the same holds for pairs, so only the parts of a node
that are connected by such pairs are compared on full sets, and a part that several trees found once.

No link is lost to size: a node still larger than ``LEAF`` at the last level is first compared in
pieces, each together with the node's smallest member, and if its members are then not all
connected, all pairs of pieces that may still hold links are compared.

Groups of copies stay small: equal texts are collapsed before branching, and parts that overlap
are compared as one block, as long as that stays within ``LEAF`` sets.  Every
compared block yields a spanning forest of its links, not all pairs, and components come from
alternating small-star and large-star steps over these, until every node hangs on its component's smallest.

The number of Spark jobs does not grow with ``LEVELS``: the members of large nodes are counted at all deeper
levels at once, by distinct paths, so that sets which take the same path make no rows of their own there; and
overlapping parts find each other in ``UNITE`` passes of minima, not by components.

Edge cases: null text and texts without words have an empty set and are linked with nothing;
shorter texts than 5 words have their whole word sequence as only shingle; equal texts, repeated
rows included, are one component; a component's id is its smallest non-null doc_id; of rows that
agree in doc_id and text ``dedup`` keeps one; empty tables give empty results; input columns
named like an output column are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.relational import opaque
from .common import BASE, MASK, Scratch, Words, blocks, mix, text_bytes, unwrapped, wrapped
from .op6_suffix_dedup import distinct_texts

SHINGLE = 5
TREES = 16  # at least
LEVELS = 6
LEAF = 256
#: Passes in which parts that share sets take the smallest set among them as their label.
UNITE = 2
#: Highest shares of pairs at the threshold that may be missed: by all trees at the last level, and by leaving out sets.
MISSED = 5.2e-4
PRUNED = 1e-6
U64 = np.uint64

#: Word bytes: all but white space.
IS_WORD = np.ones(256, bool)
IS_WORD[0x20] = IS_WORD[0x09:0x0E] = False


def trees_for(percent: int, levels: int = LEVELS) -> int:
    """Trees of which all miss a pair at the threshold with a probability of ``MISSED`` at most."""
    j = percent / 100
    return max(TREES, math.ceil(math.log(MISSED) / math.log(1 - min(j, 0.999) ** levels)))


def meets_for(percent: int, trees: int) -> int:
    """In how many trees a pair at the threshold shares the first node, but for a probability of ``PRUNED``; at least 1."""
    j, m, below = percent / 100, 0, 0.0
    while m < trees and (below := below + math.comb(trees, m) * j ** m * (1 - j) ** (trees - m)) <= PRUNED:
        m += 1
    return max(1, m)


# -- sets and paths ----------------------------------------------------------------------
def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE):
    """Yield each row's sorted distinct shingle hashes."""
    words = Words(buf, offs, IS_WORD)
    first = words.first.tolist()
    whole = words.window(k)
    short: dict[int, np.ndarray] = {}
    for lo, hi in zip(first[:-1], first[1:]):
        n = hi - lo
        if n >= k:
            yield np.unique(whole[lo:hi - k + 1])
        elif n:
            if n not in short:
                short[n] = words.window(n)
            yield short[n][lo:lo + 1]
        else:
            yield whole[:0]


def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(BASE)) | U64(1)


def paths(tokens: np.ndarray, odd: np.ndarray, trees: int, levels: int) -> np.ndarray:
    """The node of a set at each level of each tree: a hash of the minwise tokens chosen so far."""
    least = np.full(len(odd), MASK, U64)
    for i in range(0, len(tokens), 2048):
        np.minimum(least, (tokens[i:i + 2048, None] * odd).min(0), out=least)
    least = least.reshape(trees, levels)
    node = np.arange(trees, dtype=U64)
    out = np.empty((trees, levels), U64)
    for d in range(levels):
        out[:, d] = node = mix(node * U64(BASE) + mix(least[:, d]))
    return out.reshape(-1)


def _sketches(texts: DataFrame, trees: int, levels: int, k: int) -> DataFrame:
    schema = StructType.fromDDL("__k1 bigint, __k2 bigint, __doc bigint, n bigint, first array<bigint>, path array<bigint>")

    def run(batches):
        odd = multipliers(trees * levels)
        for b in batches:
            buf, offs = text_bytes(b.column(3))
            for lo, hi, part, at in blocks(buf, offs):
                n, path = [], []
                for s in shingle_sets(part, at, k):
                    n.append(len(s))
                    path.append(paths(s, odd, trees, levels).view(np.int64) if len(s) else None)
                first = [None if x is None else x[::levels] for x in path]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (first, path)]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in range(3)), pa.array(n, pa.int64()), *lists], names=schema.names)

    return texts.select("__k1", "__k2", F.col("__doc").cast("long").alias("__doc"), "__text").mapInArrow(run, schema)


# -- comparing blocks -----------------------------------------------------------------------
def block_forest(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set of a block the first one that it is connected with by links."""
    s = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    token, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(s), size)
    shared = count[col] > 1
    place = np.cumsum(count > 1) - 1
    row, col = row[shared], place[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    inter = np.zeros((s, s), np.float64)
    width = max(256, (1 << 22) // s)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, (lo, lo + width))
        m = np.zeros((s, width), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        inter += m @ m.T
    inter = np.rint(inter).astype(np.int64)
    link = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    link &= (size > 0)[:, None] & (size > 0)[None, :]
    np.fill_diagonal(link, True)
    root = np.arange(s)
    while True:
        new = np.where(link, root[None, :], s).min(1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root.tolist()
        root = new


def _agreeing(members: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """The parts of each block whose sets choose the same first token in ``least`` trees, as blocks of their own.

    A part is named after its members, so that one group that several trees found is compared once; low is its
    smallest set.
    """
    schema = StructType.fromDDL("block bigint, cls bigint, low bigint")
    rows = members.join(sketches.select(F.col("cid").alias("cls"), "first"), "cls").select("block", "cls", "first")

    def parts(cls: np.ndarray, first: np.ndarray):
        cls, at = np.unique(cls, return_index=True)
        first = first[at]
        agree = sum((first[:, None, t] == first[None, :, t]).astype(np.int16) for t in range(first.shape[1])) >= least
        root = np.arange(len(cls))
        while True:
            new = np.where(agree, root[None, :], len(cls)).min(1)
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        count = np.bincount(root, minlength=len(cls))
        name = np.zeros(len(cls), U64)
        np.add.at(name, root, mix(cls.astype(U64) + U64(1)))
        ok = count[root] > 1
        return mix(name)[root][ok].view(np.int64), cls[ok], cls[root][ok]

    def run(batches):
        def flush(rows):
            if len(rows) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts(np.array([c for c, _ in rows], np.int64), np.array([f for _, f in rows], np.int64))], names=schema.names)

        block, held = None, []
        for b in batches:
            ids, cls = b.column(0).to_numpy(), b.column(1).to_numpy()
            first = b.column(2).flatten().to_numpy().reshape(len(ids), -1)
            for x, c, f in zip(ids.tolist(), cls.tolist(), first):
                if x != block:
                    yield from flush(held)
                    block, held = x, []
                held.append((c, f))
        yield from flush(held)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small blocks take long: not merged by their bytes
    return rows.repartition(n, "block").sortWithinPartitions("block").mapInArrow(run, schema).distinct()


def _blocks(members: DataFrame, sketches: DataFrame, scratch: Scratch, least: int, leaf: int) -> DataFrame:
    """(block, cls): what is compared on full sets.

    Parts that overlap are united as long as a block stays within ``leaf`` sets, so that most
    texts travel once; the parts of larger unions stay blocks of their own.  A part goes into a union
    whole, so no link depends on how many of the parts that overlap get the same label."""
    rows = scratch.write(_agreeing(members, sketches, least), "parts").withColumnRenamed("low", "label")
    for _ in range(UNITE):  # a set lies in few parts, at most one of LEAF / 2 of them has the same pivot; a part has LEAF sets
        for key in ("cls", "block"):
            rows = rows.withColumn("label", F.min("label").over(Window.partitionBy(key)))
    rows = scratch.write(rows, "labelled")
    small = rows.select("label", "cls").distinct().groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") <= leaf)
    small = scratch.write(small.select("label", F.lit(True).alias("united")), "small")
    return rows.join(small, "label", "left").select(F.when(F.col("united"), F.col("label")).otherwise(F.col("block")).alias("block"), "cls").distinct()


def _compare(members: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """(a, b) links that connect what is connected within each block; members has block, cls."""
    schema = StructType.fromDDL("a bigint, b bigint")
    where = sketches.select(F.col("cid").alias("cls"), "__k1", "__k2")
    rows = members.join(where, "cls").join(texts.select("__k1", "__k2", "__text"), ["__k1", "__k2"]).select("block", "cls", "__text")

    def solve(ids: list[int], data: list[bytes]):
        offs = np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int64)
        buf = np.frombuffer(b"".join(data), np.uint8)
        order = np.argsort(ids)
        sets = list(shingle_sets(buf, offs, k))
        root = block_forest([sets[i] for i in order], percent)
        return [(ids[order[i]], ids[order[r]]) for i, r in enumerate(root) if r != i]

    def run(batches):
        block, ids, data, out = None, [], [], []
        for b in batches:
            for x, c, t in zip(*(col.to_pylist() for col in (b.column(0), b.column(1), b.column(2).cast(pa.large_binary())))):
                if x != block:
                    if len(ids) > 1:
                        out += solve(ids, data)
                    block, ids, data = x, [], []
                    if len(out) > 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()) for y in zip(*out)], names=["a", "b"])
                        out = []
                ids.append(c)
                data.append(t)
        if len(ids) > 1:
            out += solve(ids, data)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()) for y in zip(*out)], names=["a", "b"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small blocks take long: not merged by their bytes
    return rows.repartition(n, "block").sortWithinPartitions("block").mapInArrow(run, schema).distinct()


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes with edges (a, b), a written table: alternating small-star and large-star steps.

    Tables in the shared folder cut the lineage after each step.  Every node ends at the smallest
    node of its component: that is so once every node has one edge, to a node without edges to smaller ones.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    while True:
        # small star: of every node, the smaller neighbours and itself go to the smallest of them
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(opaque(least, "a"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).where("a > b")
        small = scratch.write(small, "edges")
        # large star: of every node, the larger neighbours go to its smallest neighbour (or itself)
        both = small.selectExpr("inline(array(struct(a, b), struct(b AS a, a AS b)))")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
        large = both.join(opaque(least, "a"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        e = scratch.write(large, "edges")
        ends = e.selectExpr("inline(array(struct(a AS node, 1 AS up, 0 AS down), struct(b AS node, 0 AS up, 1 AS down)))")
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.agg(F.count_if(F.expr("up > 1 OR (up > 0 AND down > 0)"))).first()[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


# -- the join ---------------------------------------------------------------------------------
def _deeper(paths: DataFrame, levels: int) -> DataFrame:
    """(node, size, sign, low, parent, last) of all nodes below the first level; paths has the nodes n0, n1, ... of
    each path that sets take, and the facts of these sets.  Each level adds up the nodes of the one below it."""
    at, out = paths, None
    for d in range(levels - 1, 0, -1):
        step = at.select(F.col(f"n{d}").alias("node"), "size", "sign", "low", F.col(f"n{d - 1}").alias("parent"), F.lit(d == levels - 1).alias("last"))
        out = step if out is None else out.unionAll(step)
        at = at.groupBy(*[f"n{i}" for i in range(d)]).agg(F.sum("size").alias("size"), F.bit_xor("sign").alias("sign"), F.min("low").alias("low"))
    return out


def _links(sketches: DataFrame, texts: DataFrame, scratch: Scratch, percent: int, k: int, trees: int, levels: int, leaf: int) -> DataFrame:
    least = meets_for(percent, trees)
    compare = lambda m: _compare(_blocks(m, sketches, scratch, least, leaf), sketches, texts, percent, k)
    meets = sketches.where("n > 0").select(F.col("cid").alias("cls"), F.explode("first").alias("node"))
    shared = scratch.write(meets.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").select("node"), "shared")
    meets = scratch.write(meets.join(shared, "node"), "meets")
    busy = scratch.write(meets.groupBy("cls").agg(F.count("*").alias("trees")).where(F.col("trees") >= least).select("cls"), "busy")
    rows = meets.join(busy, "cls").select("cls", "node")
    facts = [F.count("*").alias("size"), F.bit_xor(F.xxhash64("cls")).alias("sign"), F.min("cls").alias("low")]
    nodes = scratch.write(rows.groupBy("node").agg(*facts).where("size > 1"), "nodes")
    leaves, large, last, paths = nodes.where(F.col("size") <= leaf), scratch.write(nodes.where(F.col("size") > leaf), "large"), rows, None
    if levels > 1 and not large.isEmpty():  # deeper levels are for the members of large nodes alone, all levels at once
        some = rows.join(large.select("node"), "node").select("cls").distinct()
        deep = sketches.join(some, F.col("cid") == F.col("cls")).select("cls", F.explode(F.expr(f"transform(sequence(0, {trees - 1}), t -> slice(path, t * {levels} + 1, {levels}))")).alias("path"))
        deep = deep.join(large.select(F.col("node").alias("first")), F.col("path")[0] == F.col("first"), "left_semi")
        deep = scratch.write(deep.select("cls", *[F.col("path")[d].alias(f"n{d}") for d in range(levels)]), "rows")
        paths = scratch.write(deep.groupBy(*[f"n{d}" for d in range(levels)]).agg(*facts), "paths")
        nodes = scratch.write(_deeper(paths, levels).where("size > 1"), "nodes")
        large = scratch.write(large.withColumn("last", F.lit(False)).unionByName(nodes.where(F.col("size") > leaf).drop("parent")), "large")
        below = nodes.where(F.col("size") <= leaf).join(large.select(F.col("node").alias("parent")), "parent", "left_semi")
        leaves = leaves.unionByName(below.select(*leaves.columns))
        large, last = large.where("last").drop("last"), deep.select("cls", F.col(f"n{levels - 1}").alias("node"))
    leaves = scratch.write(leaves.groupBy("sign", "size", "low").agg(F.min("node").alias("block")).select("block"), "leaves")
    members = rows.join(leaves, F.col("node") == F.col("block")).select("block", "cls")
    if paths is not None:  # a path has one leaf at most
        ends = [paths.select(F.col(f"n{levels - 1}").alias("node"), F.col(f"n{d}").alias("block")) for d in range(1, levels)]
        members = members.unionByName(last.join(reduce(DataFrame.unionAll, ends).join(leaves, "block"), "node").select("block", "cls"))
    if large.isEmpty():
        return scratch.write(compare(members), "links")
    # large nodes of the last level: in pieces, each with the node's smallest member
    rest = scratch.write(last.join(large.select("node", "size", "low"), "node").select("node", "cls", "size", "low"), "rest")
    stars = rest.select("low", "cls").distinct()
    pieces = scratch.write(stars.groupBy("low").agg(F.ceil(F.count("*") / (leaf // 2)).alias("pieces")), "pieces")
    dealt = stars.join(pieces, "low").withColumn("piece", F.pmod(F.xxhash64("cls"), F.col("pieces")))
    lows = pieces.select("low", F.col("low").alias("cls"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    pivots = dealt.where("cls != low").select("low", "cls", "piece").unionAll(lows).select(F.xxhash64(F.lit("star"), "low", "piece").alias("block"), "cls")
    first = scratch.write(compare(members.unionAll(pivots)), "links")
    roots = connected(first, scratch)
    labelled = rest.join(roots, rest.cls == roots.node, "left").select(rest.node, "cls", "size", F.coalesce("root", "cls").alias("root"))
    open_ = labelled.groupBy("node").agg((F.min("root") != F.max("root")).alias("open")).where("open").select("node")
    labelled = scratch.write(labelled.join(open_, "node"), "open")
    if labelled.isEmpty():
        return first
    # pieces of one component each, or of small components together; pairs of pieces but those within one component
    sizes = scratch.write(labelled.groupBy("node", "root").agg(F.count("*").alias("m")), "sizes")
    group = F.when(F.col("m") > leaf // 2, F.col("root")).otherwise(F.lit(-1))
    dealt = labelled.join(sizes, ["node", "root"]).withColumn("group", group).withColumn("piece", F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / (leaf // 2))))
    dealt = scratch.write(dealt.select("node", "group", "piece", "cls"), "dealt")
    kinds = scratch.write(dealt.select("node", "group", "piece").distinct(), "kinds")
    x, y = kinds.alias("x"), kinds.alias("y")
    pair = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.struct("x.group", "x.piece") <= F.struct("y.group", "y.piece")) & ~((F.col("x.group") == F.col("y.group")) & (F.col("x.group") >= 0)))
    block = F.xxhash64(F.lit("pair"), "x.node", "x.group", "x.piece", "y.group", "y.piece").alias("block")
    sides = pair.select(block, F.col("x.node").alias("node"), F.col("x.group").alias("group"), F.col("x.piece").alias("piece")).unionAll(
        pair.select(block, F.col("y.node").alias("node"), F.col("y.group").alias("group"), F.col("y.piece").alias("piece"))).distinct()
    second = dealt.join(sides, ["node", "group", "piece"]).select("block", "cls").distinct()
    return scratch.write(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(compare(second)), "links")


def classify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 85, k: int = SHINGLE, trees: int | None = None, levels: int = LEVELS, leaf: int = LEAF, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with n_shingles, component_id and kept (doc_id = component_id)."""
    out = _classified(docs, text, doc_id, percent, k, trees or trees_for(percent, levels), levels, leaf, scratch or Scratch(docs.sparkSession))
    return out.select(*unwrapped(docs.columns, ["n_shingles", "component_id", "kept"]))


def _classified(docs, text, doc_id, percent, k, trees, levels, leaf, scratch) -> DataFrame:
    """__row, its text's key and number of copies, n_shingles, component_id, kept."""
    keyed, texts = distinct_texts(wrapped(docs, __t=text, __id=doc_id), "__t", scratch, F.min("__id").alias("__doc"))
    sketches = scratch.write(_sketches(texts, trees, levels, k).withColumn("cid", F.monotonically_increasing_id()), "sketches")
    links = _links(sketches, texts, scratch, percent, k, trees, levels, leaf)
    roots = connected(links, scratch)
    facts = sketches.select("__k1", "__k2", "__doc", "n", "cid").join(roots, F.col("cid") == roots.node, "left")
    facts = scratch.write(facts.select("__k1", "__k2", "__doc", F.col("n").alias("n_shingles"), F.coalesce("root", "cid").alias("root")), "facts")
    ids = facts.groupBy("root").agg(F.min("__doc").alias("component_id"))
    known = facts.join(opaque(ids, "root"), "root").select("__k1", "__k2", "n_shingles", "component_id")
    known = scratch.write(known.join(texts.select("__k1", "__k2", "__copies"), ["__k1", "__k2"]), "known")
    own = F.col("__id").cast("long")
    out = keyed.select("__row", "__id", "__k1", "__k2").join(known, ["__k1", "__k2"])
    linked = F.col("n_shingles") > 0
    return out.withColumn("component_id", F.when(linked, F.col("component_id")).otherwise(own)).withColumn("kept", ~linked | own.eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    out = _classified(docs, text, doc_id, percent, SHINGLE, trees_for(percent), LEVELS, LEAF, scratch or Scratch(docs.sparkSession)).where("kept")
    many = (F.col("__copies") > 1) & (F.col("n_shingles") > 0)
    return out.where(~many).select("__row.*").unionAll(out.where(many).dropDuplicates(["__k1", "__k2"]).select("__row.*"))

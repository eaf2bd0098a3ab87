"""Merkle manifest of a dataset: a postorder append log and inclusion proofs from it.

A record's leaf is the SHA-256 of its fields.  The leaves of one source, in order, form a tree: every
``FAN`` consecutive nodes (the last run may hold fewer, even one) become the SHA-256 of their
joined hexadecimal digests, until one node is left, the source's subroot; the subroots, in order
of their source, form one more tree in the same way, whose last node is the root.

* Numbering.  Records are range-partitioned by (source, key, leaf), so a source with a third of
  all rows lies in many pieces; counts of (source, piece) and their running sums give each leaf its
  tree, its index and the size of its tree.
* Builders are aligned: one takes the ``BLOCK`` = FAN * FAN consecutive nodes of a tree that form
  one node two levels up.  It reads them as a sorted stream and appends every node to the log when
  it is complete, a parent right after its last child, holding at most two open runs.  The
  nodes two levels up are the next tier's input; a tree of n leaves needs log(n) / log(BLOCK) tiers.
* The log is a table (tree, n, level, idx, pos, digest).  ``position`` gives the place of any node
  in closed form from the sizes of the subtrees that end before it, so a sibling is addressed by
  arithmetic on the log's order.
* Proofs go from the top tier down.  A block's part of the log, the proof of its own top node and the
  rows that ask for a proof meet in one sorted stream; each run's siblings are read from their
  positions once.  ``fold`` recomputes the root from a leaf and its proof with SQL functions.

Edge cases: null fields are ``-`` in a leaf; a null source is a tree of its own and comes first; null
keys come first; records that agree in source and key are ordered by leaf, and repeated records are
leaves of their own; a lone leaf is its tree's root with nothing to prove inside the tree; an
empty table gives no rows; columns named like an output column are replaced.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Scratch

FAN = 16
BLOCK = FAN * FAN
#: The tree over the subroots.
TOP = -1
NODE = "tree bigint, n bigint, level int, idx bigint, pos bigint, digest string"
PROOF = "array<struct<before: string, after: string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# -- leaves ----------------------------------------------------------------------------------
def record(*fields: Column) -> Column:
    """The leaf: SHA-256 of the fields, each ``-`` if null, else its bytes in UTF-8, ``:`` and its value."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def numbered(records: DataFrame, scratch: Scratch) -> DataFrame:
    """``records`` (__source, __key, leaf and more) with tree, n (leaves of its tree) and idx."""
    # null first, then bytewise: '-' is smaller than '='
    keyed = records.withColumn("__s", F.coalesce(F.concat(F.lit("="), F.col("__source").cast("string")), F.lit("-")))
    ranged = keyed.repartitionByRange(F.col("__s"), F.col("__key").asc_nulls_first(), F.col("leaf"))
    rows = scratch.write(ranged.withColumn("__piece", F.spark_partition_id()), "leaves")
    counts = scratch.write(rows.groupBy("__s", "__piece").agg(F.count("*").alias("c")), "counts")
    trees = counts.groupBy("__s").agg(F.min("__piece").alias("__piece"), F.sum("c").alias("n"))
    # sources that start in a piece follow those of earlier pieces; one row for each piece
    starts = trees.groupBy("__piece").agg(F.count("*").alias("m"))
    starts = starts.select("__piece", (F.sum("m").over(Window.orderBy("__piece")) - F.col("m")).alias("sources_before"))
    in_piece = F.row_number().over(Window.partitionBy("__piece").orderBy("__s")) - 1
    trees = trees.withColumn("k", in_piece).join(starts, "__piece").select("__s", "n", (F.col("sources_before") + F.col("k")).alias("tree"))
    so_far = Window.partitionBy("__s").orderBy("__piece")
    offsets = counts.withColumn("before", F.sum("c").over(so_far) - F.col("c")).join(scratch.write(trees, "trees"), "__s")
    order = Window.partitionBy("__s", "__piece").orderBy(F.col("__key").asc_nulls_first(), "leaf")
    out = rows.join(offsets.select("__s", "__piece", "before", "n", "tree"), ["__s", "__piece"])
    return out.withColumn("idx", F.col("before") + F.row_number().over(order) - 1).drop("__s", "__piece", "before")


# -- the log ---------------------------------------------------------------------------------
def position(n: int, level: int, i: int) -> int:
    """Place in the postorder log of node i of a level, in a tree of n leaves.

    When the node is complete, so are all nodes up to its level that end with it or before, and
    those of higher levels that end before it.
    """
    end, span, place = min(n, (i + 1) * FAN ** level), 1, -1
    for _ in range(level + 1):
        place += -(-end // span)
        span *= FAN
    while span < end:
        place += (end - 1) // span
        span *= FAN
    return place


def _appended(nodes: DataFrame, base: int) -> DataFrame:
    """The log that the builders of one tier write; nodes (tree, n, idx, digest) stand on level ``base``."""
    schema = StructType.fromDDL(NODE)

    def run(batches):
        low, high, out = [], [], []
        joined = lambda run: hashlib.sha256("".join(run).encode()).hexdigest()

        def flush():
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)
            out.clear()
            return got

        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        for b in batches:
            for tree, n, idx, digest in zip(*(c.to_pylist() for c in b.columns)):
                put = lambda level, i, d: out.append((tree, n, level, i, position(n, level, i), d))  # noqa: B023, E731
                count = -(-n // FAN ** base)
                if base == 0:
                    put(0, idx, digest)
                if count == 1:
                    continue
                low.append(digest)
                if len(low) == FAN or idx == count - 1:
                    high.append(joined(low))
                    low.clear()
                    put(base + 1, idx // FAN, high[-1])
                    if len(high) == FAN or idx == count - 1:
                        if count > FAN:
                            put(base + 2, idx // BLOCK, joined(high))
                        high.clear()
                if len(out) >= 8192:
                    yield flush()
            if out:
                yield flush()

    block = F.floor(F.col("idx") / BLOCK)
    dealt = nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    return dealt.select("tree", "n", "idx", "digest").mapInArrow(run, schema)


def append_log(leaves: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """The log of all trees of ``leaves`` (tree, n, idx, digest), as its tiers."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers, base = [], 0
    while not tiers or most > FAN ** base:
        nodes = tiers[-1].where((F.col("level") == base) & (F.col("n") > FAN ** base)) if tiers else leaves
        tiers.append(scratch.write(_appended(nodes, base), f"log{base}"))
        base += 2
    return tiers


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, n, digest) of each tree's last node."""
    size = F.expr("shiftleft(1L, 4 * level)")
    return _all(tiers).where((F.col("n") <= size) & ((F.col("level") == 0) | (F.col("n") > F.expr("shiftleft(1L, 4 * (level - 1))")))).select("tree", "n", "digest")


def _all(tiers: list[DataFrame]) -> DataFrame:
    log = tiers[0]
    for t in tiers[1:]:
        log = log.unionAll(t)
    return log


# -- proofs ----------------------------------------------------------------------------------
def _proved(log: DataFrame, above: DataFrame, asked: DataFrame, base: int) -> DataFrame:
    """``asked`` (tree, idx and more; nodes of level ``base``) with subroot and proof.

    ``above`` has tree, idx, subroot and proof of the nodes two levels up (or of the tree's root, idx 0).
    """
    more = [f for f in asked.schema if f.name not in ("tree", "idx")]
    block = lambda level: F.floor(F.col("idx") / FAN ** (base + 2 - level)).cast("long")
    here = log.where((F.col("level") >= base) & (F.col("level") <= base + 2))
    # of each level the block it belongs to; a node two levels up is its block's own
    part = here.select("tree", F.when(F.col("level") == base, block(base)).when(F.col("level") == base + 1, block(base + 1)).otherwise(F.col("idx")).alias("block"), F.lit(1).alias("kind"), F.col("pos").alias("at"), "n", "digest")
    top = above.select("tree", F.col("idx").alias("block"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), "subroot", "proof")
    wish = asked.select("tree", block(base).alias("block"), F.lit(2).alias("kind"), F.col("idx").alias("at"), *(f"`{f.name}`" for f in more))
    rows = part.unionByName(top, True).unionByName(wish, True)
    rows = rows.select("tree", "block", "kind", "at", "n", "digest", "subroot", "proof", *(f"`{f.name}`" for f in more))
    schema = StructType.fromDDL(f"tree bigint, idx bigint, subroot string, proof {PROOF}")
    for f in more:
        schema.add(f)

    def run(batches):
        at_block, nodes, n, above_here, subroot, known = None, [], 0, [], None, {}

        def siblings(block: int, j: int) -> list[tuple[str, str]]:
            count = -(-n // FAN ** base)
            size, out = min(BLOCK, count - block * BLOCK), []
            for level in (0, 1):
                if -(-count // FAN ** level) == 1:
                    break
                run = j // FAN ** (level + 1)
                if (level, run) not in known:
                    last = min((run + 1) * FAN, -(-size // FAN ** level))
                    known[level, run] = [nodes[position(size, level, i)] for i in range(run * FAN, last)]
                kids, own = known[level, run], j // FAN ** level % FAN
                out.append(("".join(kids[:own]), "".join(kids[own + 1:])))
            return out

        for b in batches:
            cols = [c.to_pylist() for c in b.columns[:7]]
            proofs = b.column(7)
            take, tree, idx, sub, offsets, before, after = [], [], [], [], [0], [], []

            def flush():
                pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])  # noqa: B023
                made = [pa.array(tree, pa.int64()), pa.array(idx, pa.int64()), pa.array(sub, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)]  # noqa: B023
                rest = b.slice(0, b.num_rows).take(pa.array(take, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([*made, *rest.columns[8:]], names=schema.names)

            for k, (t, blk, kind, at, size, digest, s) in enumerate(zip(*cols)):
                if (t, blk) != at_block:
                    at_block, nodes, above_here, subroot, known = (t, blk), [], [], None, {}
                if kind == 0:
                    above_here, subroot = [(x["before"], x["after"]) for x in proofs[k].as_py()], s
                elif kind == 1:
                    nodes.append(digest)
                    n = size
                else:
                    path = siblings(blk, at - blk * BLOCK) + above_here
                    take.append(k)
                    tree.append(t)
                    idx.append(at)
                    sub.append(subroot)
                    before += [x for x, _ in path]
                    after += [y for _, y in path]
                    offsets.append(len(before))
                    if len(take) >= 1024:
                        yield flush()
                        take, tree, idx, sub, offsets, before, after = [], [], [], [], [0], [], []
            if take:
                yield flush()

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "at").mapInArrow(run, schema)


def prove(tiers: list[DataFrame], tops: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """``asked`` (tree, idx and more) with subroot and proof.

    ``tops`` has tree, n, subroot and proof of each tree's root: what lies above the tree, if anything.
    """
    log, above = _all(tiers), None
    for t in range(len(tiers) - 1, -1, -1):
        base = 2 * t
        # trees whose root a builder of this tier wrote
        ends = (F.col("n") <= FAN ** (base + 2)) & (F.col("n") > FAN ** base if t else F.lit(True))
        own = tops.where(ends).select("tree", F.lit(0).cast("long").alias("idx"), "subroot", "proof")
        above = own if above is None else own.unionByName(above.select(*own.columns))
        if t == 0:
            return _proved(log, above, asked, 0)
        inner = log.where((F.col("level") == base) & (F.col("n") > FAN ** base)).select("tree", "idx")
        above = scratch.write(_proved(log, above, inner, base), f"proofs{base}")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def manifest(docs: DataFrame, source: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, more: dict[str, Column] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """key, source, leaf, subroot, root and proof (siblings before and after, from the leaf up) of each record.

    ``more`` are further columns by name, each of bounded size.
    """
    scratch, more = scratch or Scratch(docs.sparkSession), more or {}
    records = docs.select(F.col(source).alias("__source"), F.col(key).alias("__key"), record(*(F.col(f"`{f}`") for f in fields)).alias("leaf"), *(c.alias(f"__more_{k}") for k, c in more.items()))
    leaves = scratch.write(numbered(records, scratch), "numbered")
    tiers = append_log(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), scratch)
    subroots = scratch.write(roots(tiers), "subroots")
    count = subroots.count()
    top = append_log(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("idx"), "digest"), scratch)
    root = roots(top).first()
    nothing = F.array().cast(PROOF)
    ends = roots(top).select("tree", "n", F.lit(None).cast("string").alias("subroot"), nothing.alias("proof"))
    asked = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("n").alias("size"), F.col("digest").alias("own"))
    tops = prove(top, ends, asked, scratch).select(F.col("idx").alias("tree"), F.col("size").alias("n"), F.col("own").alias("subroot"), "proof")
    wish = leaves.select("tree", "idx", "__source", "__key", "leaf", *(f"__more_{k}" for k in more))
    out = prove(tiers, scratch.write(tops, "tops"), wish, scratch)
    return out.select(F.col("__key").alias(key), F.col("__source").alias(source), "leaf", "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "proof", *(F.col(f"__more_{k}").alias(k) for k in more))


#: A-Z and a-z, as SQL's translate takes them.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampering(fields: tuple[str, ...] = FIELDS, key: str = "doc_id", text: str = "text") -> Column:
    """The leaf of a record where 5 divides the CRC-32 of its key: with lower-cased text; else null."""
    changed = [F.translate(text, UPPER, LOWER) if f == text else F.col(f"`{f}`") for f in fields]
    return F.when(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, record(*changed))


def digests(changed: str = "changed") -> list[Column]:
    folded = fold(F.coalesce(changed, "leaf"), F.col("proof"))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    return [F.col("leaf"), F.col("subroot"), F.col("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified")]

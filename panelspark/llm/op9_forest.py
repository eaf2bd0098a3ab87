"""Approximate nearest neighbours (Euclidean) by a hash-prefix forest.

Each of ``TREES`` trees gives every vector a hash string of ``BITS`` bits: bit k says on which side
of the hyperplane half way between two random sample vectors it lies.  A shard of the index keeps
one sorted array of these strings per tree.  A query descends in every tree to the longest prefix
that any string shares with its own; then all trees ascend together, one bit at a time, and the
vectors under the prefix of that length become candidates, until there are enough of them.
Candidates are compared by exact distance, in double precision; the best of all shards win.

How many are enough is measured, not set: on a bounded sample of the index (``SAMPLE`` vectors,
where neighbours are further apart than in the whole and so harder to find) the share of a shard
that gives ``RECALL`` against brute force is taken, up to the whole shard where prefixes say
nothing about nearness.  The trees are fitted on the same sample; every vector is indexed.

Queries are a stated set; they are searched in blocks of ``QUERY_BLOCK``, each collected and
broadcast alone, against all shards.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor
do those of another length than the most frequent one (the shorter at a tie), nor rows without
an id.  A candidate with the query's own id is left out.  Rows that repeat an id count once, with
the smallest distance; a query id that repeats searches its smallest vector.  Ties go to the
smaller id.  With fewer candidates than wanted all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ship

TREES = 64
BITS = 32
SAMPLE = 6144
RECALL = 0.95
QUERY_BLOCK = 2048
SHARD_ROWS = 16384
U64 = np.uint64


class Forest:
    """Hash functions of all trees, and the share of a shard that a search takes."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, k: int = 10, recall: float = RECALL, seed: int = 9):
        rng = np.random.default_rng(seed)
        ends = sample[rng.integers(0, len(sample), (trees * bits, 2))]
        self.normal = ends[:, 0] - ends[:, 1]
        self.level = (self.normal * (ends[:, 0] + ends[:, 1])).sum(1) / 2
        self.trees, self.bits, self.share = trees, bits, 1.0
        self.share = self.enough(sample, k, recall, rng)

    def strings(self, x: np.ndarray) -> np.ndarray:
        """(tree, vector) hash strings as numbers."""
        out = np.zeros((self.trees, len(x)), U64)
        for lo in range(0, len(x), 4096):
            side = (x[lo:lo + 4096] @ self.normal.T > self.level).reshape(-1, self.trees, self.bits)
            for b in range(self.bits):
                out[:, lo:lo + 4096] = out[:, lo:lo + 4096] << U64(1) | side[:, :, b].T.astype(U64)
        return out

    def enough(self, sample: np.ndarray, k: int, recall: float, rng) -> float:
        if len(sample) <= 20 * k:
            return 1.0
        asked = rng.choice(len(sample), min(128, len(sample)), replace=False)
        shard = Shard(self, np.arange(len(sample)), sample)
        truth = shard.search(sample[asked], asked, k, 1.0)
        for share in (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.75):
            got = shard.search(sample[asked], asked, k, share)
            found = sum(len(np.intersect1d(a[0], b[0])) for a, b in zip(truth, got))
            if found >= recall * sum(len(a[0]) for a in truth):
                return share
        return 1.0


class Shard:
    """Sorted arrays of hash strings of some vectors, one for each tree."""

    def __init__(self, forest: Forest, ids: np.ndarray, x: np.ndarray):
        self.forest, self.ids, self.x = forest, ids, x
        s = forest.strings(x)
        self.order = np.argsort(s, axis=1, kind="stable")
        self.sorted = np.take_along_axis(s, self.order, 1)

    def search(self, q: np.ndarray, own: np.ndarray, k: int, share: float | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, distances) of the k nearest candidates of each query, nearest first."""
        f, n = self.forest, len(self.ids)
        want = min(n, max(4 * k, int(np.ceil((f.share if share is None else share) * n))))
        asked = f.strings(q)
        shift = np.arange(f.bits + 1, dtype=U64)  # bits ascended
        low = asked[:, :, None] >> shift << shift
        high = low + (U64(1) << shift)
        lo, hi = (np.stack([np.searchsorted(self.sorted[t], v[t].ravel()).reshape(v[t].shape) for t in range(f.trees)]) for v in (low, high))
        first = np.argmax((hi - lo).sum(0) >= want, axis=1)
        out = []
        for j in range(len(q)):
            for up in range(int(first[j]), f.bits + 1):  # equal vectors in several trees count once
                seen = np.zeros(n, bool)
                if want == n or up == f.bits:
                    seen[:] = True
                else:
                    for t in range(f.trees):
                        seen[self.order[t, lo[t, j, up]:hi[t, j, up]]] = True
                if seen.sum() >= want:
                    break
            at = np.flatnonzero(seen & (self.ids != own[j]))
            d = np.sqrt(((self.x[at] - q[j]) ** 2).sum(1))
            best = np.lexsort((self.ids[at], d))
            _, once = np.unique(self.ids[at][best], return_index=True)
            best = best[np.sort(once)][:k]
            out.append((self.ids[at][best], d[best]))
        return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col("v")
    ok = F.col("id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where(ok)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, query_block: int = QUERY_BLOCK, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of ``queries``."""
    spark = vectors.sparkSession
    schema = StructType.fromDDL("query_id bigint, vec_id bigint, score double")
    index, asked = usable(vectors, key, vector), usable(queries, key, vector)
    sizes = index.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    index, asked = (x.where(F.size("v") == sizes[0]["size"]) for x in (index, asked))
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    drawn = index.orderBy(F.xxhash64(F.lit(9), "id", "v"), "id").limit(sample).toArrow().column("v").combine_chunks()
    forest = ship(spark, Forest(drawn.flatten().to_numpy().reshape(len(drawn), -1), k=k, **options))
    parts = -(-asked.count() // query_block) or 1
    found = []
    for p in range(parts):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).orderBy("id").collect()
        if not block:
            continue
        shared = spark.sparkContext.broadcast((np.array([r.id for r in block], np.int64), np.array([r.v for r in block], np.float64)))

        def run(batches, shared=shared):
            ids, q = shared.value

            trees = forest()

            def solve(part):
                shard = Shard(trees, np.concatenate([a for a, _ in part]), np.concatenate([x for _, x in part]))
                for lo in range(0, len(q), 256):
                    got = shard.search(q[lo:lo + 256], ids[lo:lo + 256], k)
                    near = np.concatenate([a for a, _ in got])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[lo:lo + 256], [len(a) for a, _ in got])), pa.array(near), pa.array(np.concatenate([d for _, d in got]))], names=schema.names)

            part, rows = [], 0
            for b in batches:
                if b.num_rows:
                    part.append((b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)))
                    rows += b.num_rows
                if rows >= SHARD_ROWS:
                    yield from solve(part)
                    part, rows = [], 0
            if part:
                yield from solve(part)

        found.append(index.mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    out = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

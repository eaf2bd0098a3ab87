"""Ranked lexical search of many items at once, with their common subexpressions evaluated once.

Every item is a sum over its terms, and items share terms.  ``mine`` finds the shared term sets:
terms that occur in exactly the same items form one class, and then the pair of nodes that
most items hold together becomes a node of its own, again and again, while at least two items
share a pair.  The result is a directed graph: classes sum their terms, inner nodes sum two nodes, items sum
what they are left with.  Scores are integers, so no order of adding changes them.

1. ``parsed``: one pass over the documents finds the terms of the items in every whole text and
   writes (doc_id, n, terms, tfs); df, N and L are counted over all of it.
2. ``search``: each task goes through its documents in blocks of about ``BLOCK_CELLS`` accumulators.
   A block's accumulators of classes and inner nodes are materialised once, level by level of the
   graph, and every item adds up its nodes.  A task keeps the best ``k`` documents of each
   item; the best of all tasks come from a window that is pre-aggregated before the shuffle.

Items are the stated query set.  They are dealt into blocks of about ``ITEM_BLOCK_BYTES`` of text and
``ITEMS_PER_BLOCK`` items, one search for each block, and only one block is on the driver at a time.

Terms are runs of letters, digits and non-ASCII bytes, A-Z lower-cased, compared by 128-bit names
(``strong``).  Edge cases: null or wordless texts are no documents and hit nothing; a null doc_id
ranks after all others of its score; repeated documents are ranked each; rows of one
item_id are one item with the terms of them all, and a null item_id is an item too; items without terms or
without a document above 0 have no rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from .common import Scratch, blocks, ship, text_bytes
from .strong import StrongWords

TOP_K = 50
BLOCK_CELLS = 4 << 20
ITEM_BLOCK_BYTES = 4 << 20
ITEMS_PER_BLOCK = 1024
#: Items of more classes than this are summed as they are (which changes no score).
MINED_CLASSES = 512
U64 = np.uint64

#: Bytes of a term: letters, digits and all of non-ASCII characters.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


# -- the query-sharing graph -------------------------------------------------------------------
class Graph:
    """Classes of terms, inner nodes as sums of two nodes, and each item's nodes.

    ``order`` lists the terms class by class; nodes are numbered classes first.
    """

    def __init__(self, classes: list[list[int]], pairs: list[tuple[int, int]], items: list[list[int]]):
        self.order = np.array([t for c in classes for t in c], np.int64)
        self.class_start = np.r_[0, np.cumsum([len(c) for c in classes])[:-1]].astype(np.int64) if classes else np.empty(0, np.int64)
        self.n_classes, self.n_nodes = len(classes), len(classes) + len(pairs)
        depth = [0] * self.n_nodes
        by_depth = defaultdict(list)
        for k, (a, b) in enumerate(pairs, self.n_classes):
            depth[k] = 1 + max(depth[a], depth[b])
            by_depth[depth[k]].append((k, a, b))
        self.levels = [np.array(by_depth[d], np.int64).T for d in sorted(by_depth)]
        self.item_nodes = np.array([x for i in items for x in i], np.int64)
        self.item_start = np.r_[0, np.cumsum([len(i) for i in items])[:-1]].astype(np.int64) if items else np.empty(0, np.int64)

    def additions(self) -> int:
        """Sums of two numbers for one document."""
        return len(self.order) - self.n_classes + (self.n_nodes - self.n_classes) + len(self.item_nodes) - len(self.item_start)

    def scores(self, gains: np.ndarray) -> np.ndarray:
        """items x documents from terms (in ``order``) x documents."""
        acc = np.empty((self.n_nodes, gains.shape[1]), np.int64)
        np.add.reduceat(gains, self.class_start, axis=0, out=acc[:self.n_classes])
        for node, a, b in self.levels:
            acc[node] = acc[a] + acc[b]
        return np.add.reduceat(acc[self.item_nodes], self.item_start, axis=0)


def mine(items: list[set[int]]) -> Graph:
    """The graph of the items' term sets (none of them empty)."""
    of = defaultdict(list)
    for i, terms in enumerate(items):
        for t in terms:
            of[t].append(i)
    same = defaultdict(list)
    for t, holders in sorted(of.items()):
        same[tuple(holders)].append(t)
    classes, holders = list(same.values()), [set(h) for h in same]
    rows: list[set[int]] = [set() for _ in items]
    for k, h in enumerate(holders):
        for i in h:
            rows[i].add(k)
    count: Counter = Counter()
    for row in rows:
        shared = sorted(k for k in row if len(holders[k]) > 1) if len(row) <= MINED_CLASSES else []
        count.update((a, b) for j, a in enumerate(shared) for b in shared[j + 1:])
    heap = [(-c, a, b) for (a, b), c in count.items() if c > 1]
    del count
    heapq.heapify(heap)
    pairs = []
    while heap:
        c, a, b = heapq.heappop(heap)
        both = {i for i in holders[a] & holders[b] if len(rows[i]) <= MINED_CLASSES}
        if len(both) < 2:
            continue
        if len(both) != -c:
            heapq.heappush(heap, (-len(both), a, b))
            continue
        new = len(holders)
        pairs.append((a, b))
        holders.append(both)
        holders[a] -= both
        holders[b] -= both
        beside: Counter = Counter()
        for i in both:
            rows[i] -= {a, b}
            beside.update(x for x in rows[i] if len(holders[x]) > 1)
            rows[i].add(new)
        for x, c in beside.items():
            if c > 1:
                heapq.heappush(heap, (-c, x, new))
    return Graph(classes, pairs, [sorted(r) for r in rows])


class Terms:
    """Terms by number, found by their names."""

    def __init__(self, names: np.ndarray):
        sort = np.lexsort((names[:, 1], names[:, 0]))
        self.first, self.second, self.number = names[sort, 0], names[sort, 1], sort.astype(np.int32)
        if (self.first[1:] == self.first[:-1]).any():
            raise ValueError("two terms share half of their names")

    def __len__(self) -> int:
        return len(self.number)

    def lookup(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Number of each word's term, or -1."""
        if not len(self):
            return np.full(len(first), -1, np.int32)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), self.number[at], np.int32(-1))


class Block:
    """A block of items: ids, terms (numbered in the graph's order) and the graph over them."""

    def __init__(self, rows: list[tuple]):
        texts = defaultdict(set)
        for item, text in rows:
            texts[item].add(text or "")
        self.ids, terms = [], {}
        sets = []
        for item, several in texts.items():
            data = "\n".join(sorted(several)).encode()
            words = StrongWords(np.frombuffer(data, np.uint8), np.array([0, len(data)]), IS_TERM, lower=True)
            own = {terms.setdefault(x, len(terms)) for x in zip(*(h.tolist() for h in words.names))}
            if own:
                self.ids.append(item)
                sets.append(own)
        self.graph = mine(sets)
        by_number = np.array(list(terms), U64).reshape(-1, 2)
        self.terms = Terms(by_number[self.graph.order])


# -- documents -----------------------------------------------------------------------------------
def parsed(docs: DataFrame, block: Block, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of each text with terms: n counts all terms, the arrays only those of the items."""
    kind = docs.schema[doc_id].dataType
    schema = StructType([StructField("doc_id", kind), *StructType.fromDDL("n bigint, terms array<int>, tfs array<int>")])
    load = ship(docs.sparkSession, block.terms)  # those of one block of items

    def run(batches):
        known = load()
        width = max(1, len(known))
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            for lo, hi, part, at in blocks(buf, offs):
                words = StrongWords(part, at, IS_TERM, lower=True)
                n = np.diff(words.first)
                row = np.repeat(np.arange(hi - lo), n)
                term = known.lookup(*words.names)
                ok = term >= 0
                key, tf = np.unique(row[ok] * width + term[ok], return_counts=True)
                ends = np.searchsorted(key // width, np.arange(hi - lo + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % width, tf)]
                got = pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), *lists], names=schema.names)
                yield got.filter(pa.array(n > 0))

    return docs.select(doc_id, text).mapInArrow(run, schema)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _best(rows: DataFrame, block: Block, weights: np.ndarray, docs: int, length: int, k: int, item_field: StructField) -> DataFrame:
    """Of each task the k best documents of every item."""
    kind = rows.schema["doc_id"]
    schema = StructType([StructField("item_id", item_field.dataType), StructField("doc_id", kind.dataType), *StructType.fromDDL("score bigint")])
    item_type, doc_type = to_arrow_type(item_field.dataType), to_arrow_type(kind.dataType)
    load, shared = ship(rows.sparkSession, block.graph), rows.sparkSession.sparkContext.broadcast((block.ids, weights))

    def run(batches):
        graph, (ids, w) = load(), shared.value
        wide = max(1, BLOCK_CELLS // max(1, graph.n_nodes + len(graph.item_nodes) + len(w)))
        least = np.ones(len(ids), np.int64)  # an item's k-th score so far
        held = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]  # item, score, place in docs
        docs_held = pa.array([], doc_type)

        def prune():
            nonlocal docs_held
            item, score, place = (np.concatenate(x) for x in zip(*held))
            # ties go to the smaller doc_id, null last
            values, back = np.unique(place, return_inverse=True)
            docs_held = docs_held.take(pa.array(values))
            order = pc.sort_indices(docs_held).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            sort = np.lexsort((rank[back], -score, item))
            item, score, place = item[sort], score[sort], back[sort]
            start = np.searchsorted(item, np.arange(len(ids) + 1))
            keep = np.arange(len(item)) - start[item] < k
            full = np.flatnonzero(np.diff(start) >= k)
            least[full] = score[start[full] + k - 1]
            held[:] = [(item[keep], score[keep], place[keep])]

        for b in batches:
            n, terms, tfs = b.column(1).to_numpy(), b.column(2), b.column(3)
            ends = np.r_[0, np.cumsum(pc.list_value_length(terms).to_numpy())].astype(np.int64)
            term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            m = 50 + 50 * n * docs // length
            for lo in range(0, len(n), wide):
                hi = min(lo + wide, len(n))
                t, f = term[ends[lo]:ends[hi]], tf[ends[lo]:ends[hi]]
                col = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
                gains = np.zeros((len(w), hi - lo), np.int64)
                gains[t, col] = w[t] * (1_000_000_000 * f // (1000 * f + 20 * m[lo:hi][col]))
                score = graph.scores(gains)
                item, at = np.nonzero(score >= least[:, None])
                if len(item):
                    held.append((item, score[item, at], at + len(docs_held)))
                    docs_held = pa.concat_arrays([docs_held, b.column(0).slice(lo, hi - lo)])
                    prune()
        if len(held[0][0]):
            item, score, place = held[0]
            for lo in range(0, len(item), 8192):
                cut = slice(lo, lo + 8192)
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in item[cut].tolist()], item_type), docs_held.take(pa.array(place[cut])), pa.array(score[cut])], names=schema.names)

    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """item_id, rank (int, from 1), doc_id and score (long) of each item's k best documents of a score above 0."""
    scratch = scratch or Scratch(docs.sparkSession)
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count_distinct("item_id").alias("items")).first()
    parts = max(1, -(-size.bytes // ITEM_BLOCK_BYTES), -(-size.items // ITEMS_PER_BLOCK))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    out = None
    for part in range(parts):
        block = Block([tuple(r) for r in wanted.where(F.pmod(F.xxhash64(F.lit(13), "item_id"), F.lit(parts)) == part).collect()])
        if not block.ids:
            continue
        rows = scratch.write(parsed(docs, block, text, doc_id), "parsed")
        total = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
        if not total.docs:
            continue
        df = np.zeros(len(block.terms), np.int64)
        for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator():
            df[r.term] = r.df
        weights = np.array([weight(x, total.docs) for x in df.tolist()], np.int64)
        found = _best(rows, block, weights, total.docs, total.length, k, wanted.schema["item_id"])
        found = found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        found = scratch.write(found, "found") if parts > 1 else found
        out = found if out is None else out.unionAll(found)
    if out is None:
        kinds = (wanted.schema["item_id"].dataType, docs.schema[doc_id].dataType)
        schema = StructType([StructField("item_id", kinds[0]), *StructType.fromDDL("rank int"), StructField("doc_id", kinds[1]), *StructType.fromDDL("score bigint")])
        return docs.sparkSession.createDataFrame([], schema)
    return out

"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier g over hashed words is trained from confirmed toxic examples P and unlabelled
text U with the class-prior-corrected, non-negative risk (prior p, logistic loss l)::

    risk = p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])

While the second part is negative its gradient is turned round, which keeps the classifier
from calling everything in U negative.  Training is numpy on a bounded sample: at most about
``MAX_POSITIVE`` toxic and ``MAX_UNLABELLED`` other rows, drawn evenly by a hash of the row, as
features only.  Scoring is one pass over all rows: score = 1 / (1 + exp(-g)).

Features: the distinct words of a text (A-Z lower-cased runs of letters, digits and non-ASCII
bytes), hashed to ``BUCKETS``; those in at least ``MIN_POSITIVE`` toxic rows are used, if they are
``SCREEN`` standard errors more or less frequent there than in unlabelled text.  Labels,
lang, source and doc_id are never features.  Rows whose crc32(doc_id as text) mod 5 is 0, or
whose doc_id is null, are held out of training.

Edge cases: null text is the empty text and scores by the bias; a row is confirmed toxic if any
of its label rows says so; null labels say nothing; without any toxic example every score is 0;
repeated rows score alike; empty tables give empty results; input columns named like an output
column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_blocks
from .op8_decontam import IS_WORD

BUCKETS = 1 << 20
MAX_POSITIVE = 4000
MAX_UNLABELLED = 8000
MIN_POSITIVE = 5
#: A word is used if its share of toxic rows is so many standard errors off its share of the others.
SCREEN = 4.5
#: Used where no labelled row tells how frequent the class is.
DEFAULT_PRIOR = 0.1


def row_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct words of each row, sorted."""
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    key = np.unique(row.astype(np.uint64) << np.uint64(20) | words.hash >> np.uint64(44))
    return (key >> np.uint64(20)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``features``: the buckets of its distinct words."""
    def start():
        def rows(batch, buf, offs):
            row, bucket = row_features(Words(buf, offs, IS_WORD))
            at = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(at), pa.array(bucket.astype(np.int32)))]
        return rows
    return map_blocks(docs, text, "features array<int>", start)


class Rows:
    """Rows of distinct buckets: one flat array, and how many belong to each row."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size = flat.astype(np.int32, copy=False), size

    @classmethod
    def of(cls, rows: list) -> Rows:
        return cls(np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.empty(0, np.int32), np.array([len(r) for r in rows], np.int64))

    def __len__(self) -> int:
        return len(self.size)

    def counts(self) -> np.ndarray:
        return np.bincount(self.flat, minlength=BUCKETS)


class Sparse:
    """The same over the columns ``used`` (sorted buckets) alone."""

    def __init__(self, rows: Rows, used: np.ndarray):
        place = np.full(BUCKETS, -1, np.int32)
        place[used] = np.arange(len(used))
        col = place[rows.flat]
        ok = col >= 0
        self.col, self.row = col[ok], np.repeat(np.arange(len(rows), dtype=np.int32), rows.size)[ok]
        self.n, self.width = len(rows), len(used)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def risk(p: Sparse, u: Sparse, w: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """(positive part, negative part, step direction) of the risk at weights and bias ``w``.

    The direction is the gradient of the sum of both parts; while the negative part is below 0, that of its opposite alone."""
    gp, gu = p.dot(w[:-1]) + w[-1], u.dot(w[:-1]) + w[-1]
    sp, su = sigmoid(gp), sigmoid(gu)
    positive = prior * np.logaddexp(0, -gp).mean()
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    d_pos, d_neg_u, d_neg_p = prior * (sp - 1) / p.n, su / u.n, -prior * sp / p.n
    if negative >= 0:
        dp, du = d_pos + d_neg_p, d_neg_u
    else:  # the part that must not be negative is pushed back up
        dp, du = -d_neg_p, -d_neg_u
    return float(positive), float(negative), np.r_[p.back(dp) + u.back(du), dp.sum() + du.sum()]


def train(positive: Rows, unlabelled: Rows, prior: float, steps: int = 400, rate: float = 0.2, l2: float = 2e-5, screen: float = SCREEN, min_positive: int = MIN_POSITIVE) -> dict:
    """Weights by bucket and the bias, by full-batch Adam on the non-negative risk."""
    in_p, in_u = positive.counts(), unlabelled.counts()
    share = (in_p + in_u) / (len(positive) + len(unlabelled))
    spread = np.sqrt(share * (1 - share) * (1 / len(positive) + 1 / len(unlabelled))) + 1e-12
    used = np.flatnonzero((in_p >= min(min_positive, max(1, len(positive) // 20))) & (np.abs(in_p / len(positive) - in_u / len(unlabelled)) > screen * spread))
    p, u = Sparse(positive, used), Sparse(unlabelled, used)
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        grad = risk(p, u, w, prior)[2]
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        lr = rate * (1 - (t - 1) / steps)
        w -= lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return {"used": used, "weights": w[:-1], "bias": float(w[-1])}


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None, **options) -> dict | None:
    """Train on bounded, evenly drawn samples of the rows that are not held out; None without toxic rows."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not n.toxic:
        return None
    share = prior or (n.toxic / n.n if n.toxic < n.n else DEFAULT_PRIOR)
    pool = docs.where(~held_out()).select("doc_id", "text")
    rows = pool.count()
    draw = lambda *of: F.abs(F.xxhash64(F.lit(10), *of) % 1_000_000)
    some = lambda most, of, *by: draw(*by) < max(1, int(1_000_000 * min(1.0, most / max(1, of))))
    # toxic ids are drawn first, about max_positive of them, so that no text is moved: one scan, without a shuffle
    ids = F.broadcast(known.where("toxic = 1").where(some(max_positive, n.toxic, "doc_id")).select("doc_id", F.lit(1).alias("toxic")))
    kinds = F.array_compact(F.array(F.when(F.col("toxic") == 1, 1), F.when(some(max_unlabelled, rows, "doc_id", "text"), 0)))
    drawn = features(pool.join(ids, "doc_id", "left").select("text", F.explode(kinds).alias("p")))
    # copies of one text count once, so that a large group of copies doesn't lead
    got = drawn.select("p", "features").distinct().orderBy(F.xxhash64("features")).toArrow()
    sample = []
    for kind in (1, 0):
        rows = got.column("features").filter(pc.equal(got.column("p"), kind)).combine_chunks()
        sample.append(Rows(rows.flatten().to_numpy(), pc.list_value_length(rows).to_numpy()))
    del got
    pa.default_memory_pool().release_unused()
    return train(*sample, float(np.clip(share, 0.001, 0.9)), **options) if all(map(len, sample)) else None


def score(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (int)."""
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS weights

    def start():
        weight = np.zeros(BUCKETS)
        weight[shared.value["used"]] = shared.value["weights"]
        bias = shared.value["bias"]

        def rows(batch, buf, offs):
            row, bucket = row_features(Words(buf, offs, IS_WORD))
            got = sigmoid(np.bincount(row, weight[bucket], batch.num_rows) + bias)
            return [got, (got >= 0.5).astype(np.int32)]
        return rows

    return map_blocks(docs, text, "score double, predicted int", start)

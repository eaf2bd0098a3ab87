"""Exact order statistics and value counts without unbounded buffers.

``F.median``/``F.percentile`` keep every distinct value of a group in one buffer, ``collect_set`` and
``mode`` every distinct category: one task for a whole column, or for a hot entity.  Here

* a column's quantiles come from **histogram selection**: a round counts the rows of each of
  ``BUCKETS`` monotone buckets of the interval that still holds a wanted rank, and goes on with the
  smallest and largest value of the bucket the rank fell into, until the value is known.  Only counts
  are shuffled (at most BUCKETS + 1 per open interval and task); values never are.  The first round's buckets
  are logarithmic, the others linear, so wide and narrow distributions take the same few rounds;
* quantiles per entity come from **counts per value, running counts and positional lookup**: the
  counts are partially aggregated, the running sum is the two-level one of :mod:`.metrics`, so the values
  of a hot entity lie in many partitions;
* modes and distinct counts come from (entity, feature, value) counts of all features at once, followed
  by one aggregate with fixed-size buffers.

Numbers are compared as doubles; -inf < finite < inf < NaN, as Spark sorts them; nulls are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


# ---------------------------------------------------------------- one column, whole table
def _ranks(p: float, n: int) -> tuple[int, int, float]:
    """(lower rank, upper rank, weight of the upper) of a quantile with linear interpolation."""
    at = p * (n - 1)
    return math.floor(at), math.ceil(at), at - math.floor(at)


def _log(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def _bucket(x: Column, lo: float, hi: float, log: bool) -> Column:
    """A non-decreasing function of x in lo..hi with 0 at lo and BUCKETS at hi."""
    if log:
        lo_, hi_ = _log(F.lit(lo)), _log(F.lit(hi))
        # of an interval too narrow for logarithms everything is one bucket, and the next round is linear
        return F.floor(F.coalesce(F.try_divide(_log(x) - lo_, hi_ - lo_), F.lit(0.0)) * BUCKETS)
    if math.isinf(hi - lo):
        return F.floor((x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) * BUCKETS)
    return F.floor((x - F.lit(lo)) / F.lit(hi - lo) * BUCKETS)


def _select(df: DataFrame, wanted: dict[tuple[str, int], tuple[float, float, int, int]]) -> dict[tuple[str, int], float]:
    """Values of (column, rank): wanted has the smallest and largest finite value, the rank among them, and their number."""
    known, first = {}, True
    while True:
        for k, (lo, hi, rank, n) in wanted.items():
            if rank == 0 or lo == hi:
                known[k] = lo
            elif rank == n - 1:
                known[k] = hi
        wanted = {k: w for k, w in wanted.items() if k not in known}
        if not wanted:
            return known
        spans = sorted({(c, lo, hi) for (c, _), (lo, hi, _, _) in wanted.items()})
        number = {s: g for g, s in enumerate(spans)}
        one = []
        for g, (c, lo, hi) in enumerate(spans):
            x = F.col(c).cast("double")
            one.append(F.when(x.between(lo, hi), F.struct(F.lit(g).alias("g"), _bucket(x, lo, hi, first).cast("int").alias("b"), x.alias("v"))))
        rows = df.select(F.explode(F.array(*one)).alias("s")).where("s IS NOT NULL").select("s.*")
        hist = rows.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        # at most BUCKETS + 1 rows for each g
        hist = hist.withColumn("before", F.sum("n").over(Window.partitionBy("g").orderBy("b")) - F.col("n"))
        of = {k: (number[k[0], lo, hi], rank) for k, (lo, hi, rank, _) in wanted.items()}
        hit = F.lit(False)
        for g, rank in sorted(set(of.values())):
            hit = hit | ((F.col("g") == g) & (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank))
        got = hist.where(hit).collect()
        for k, (g, rank) in of.items():
            r = next(r for r in got if r.g == g and r.before <= rank < r.before + r.n)
            wanted[k] = (r.lo, r.hi, rank - r.before, r.n)
        first = False


def exact_quantiles(df: DataFrame, probs: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """The quantiles (with linear interpolation) of each column; None for a column without values."""
    inf, stats = float("inf"), []
    for i, c in enumerate(probs):
        x = F.col(c).cast("double")
        finite = F.when(~x.isin(inf, -inf) & ~F.isnan(x), x)
        stats += [F.count(x).alias(f"n{i}"), F.count(finite).alias(f"f{i}"), F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}"),
                  F.count(F.when(x == -inf, 1)).alias(f"neg{i}"), F.count(F.when(x == inf, 1)).alias(f"pos{i}")]
    row = df.agg(*stats).first()
    known, wanted = {}, {}
    for i, (c, ps) in enumerate(probs.items()):
        n, finite, neg, pos = (row[f"{k}{i}"] for k in ("n", "f", "neg", "pos"))
        for rank in {r for p in ps if n for r in _ranks(p, n)[:2]}:
            if rank < neg:
                known[c, rank] = -inf
            elif rank < neg + finite:
                wanted[c, rank] = (row[f"lo{i}"], row[f"hi{i}"], rank - neg, finite)
            else:
                known[c, rank] = inf if rank < neg + finite + pos else float("nan")
    known |= _select(df, wanted)

    def value(c: str, p: float, n: int) -> float:
        a, b, w = _ranks(p, n)
        lo, hi = known[c, a], known[c, b]
        return lo if w == 0 or lo == hi else (1 - w) * lo + w * hi

    return {c: [value(c, p, row[f"n{i}"]) if row[f"n{i}"] else None for p in ps] for i, (c, ps) in enumerate(probs.items())}


# ---------------------------------------------------------------- per entity
def value_counts(df: DataFrame, keys: list[str], cols: list[str], cast: str | None = None) -> DataFrame:
    """keys, __c (place in ``cols``), __v, __n: rows of each non-null value of all columns, in one exchange."""
    one = [F.struct(F.lit(i).alias("c"), (F.col(c).cast(cast) if cast else F.col(c)).alias("v")) for i, c in enumerate(cols)]
    rows = df.select(*keys, F.explode(F.array(*one)).alias("__s")).select(*keys, F.col("__s.c").alias("__c"), F.col("__s.v").alias("__v"))
    return rows.where("__v IS NOT NULL").groupBy(*keys, "__c", "__v").agg(F.count(F.lit(1)).alias("__n"))


def same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of key columns."""
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def keyed_quantiles(df: DataFrame, keys: list[str], cols: list[str], p: float = 0.5, fmt: str = "{c}_median") -> DataFrame:
    """One row for each key that has any value, with the quantile of each column."""
    from .metrics import running_sums
    from .relational import opaque
    counts = value_counts(df, keys, cols, "double").withColumn("__n", F.col("__n").cast("double"))
    order = [F.col(k).asc() for k in (*keys, "__c", "__v")]
    cum = running_sums(counts, order, ["__n"], prefix="__cum_")
    mine = [f"__k{i}" for i in range(len(keys) + 1)]
    ends = cum.groupBy(*(F.col(k).alias(m) for k, m in zip((*keys, "__c"), mine))).agg(F.min(F.col("__cum___n") - F.col("__n")).alias("__start"), F.max("__cum___n").alias("__end"))
    at = F.lit(p) * (F.col("__end") - F.col("__start") - 1)
    before = F.col("__cum___n") - F.col("__n") - F.col("__start")
    lo, hi = F.floor(at), F.ceil(at)
    holds = lambda rank: (before <= rank) & (rank < before + F.col("__n"))
    # the key columns of one side get an exchange of their own, so that a hot entity's rows can be split
    rows = cum.join(opaque(ends, mine), same([*keys, "__c"], mine))
    rows = rows.where(holds(lo) | holds(hi)).withColumns({"__lo": F.when(holds(lo), F.col("__v")), "__hi": F.when(holds(hi), F.col("__v")), "__w": at - lo})
    aggs = []
    for i, c in enumerate(cols):
        own = lambda x, i=i: F.max(F.when(F.col("__c") == i, F.col(x)))
        aggs.append(F.when((own("__w") == 0) | (own("__lo") == own("__hi")), own("__lo")).otherwise((1 - own("__w")) * own("__lo") + own("__w") * own("__hi")).alias(fmt.format(c=c)))
    return rows.groupBy(*keys).agg(*aggs)


def keyed_modes(df: DataFrame, keys: list[str], mode: list[str] = (), nunique: list[str] = (), fmt: str = "{c}_{f}") -> DataFrame:
    """One row for each key that has any value: the most frequent value (the smallest of equals) and
    the number of distinct values."""
    cols = list(dict.fromkeys([*mode, *nunique]))
    kinds: dict = {}
    for c in cols:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = None
    for group in kinds.values():
        counts = value_counts(df, keys, group)
        aggs = []
        for i, c in enumerate(group):
            own = F.col("__c") == i
            if c in mode:
                aggs.append(F.min_by(F.when(own, F.col("__v")), F.when(own, F.struct(-F.col("__n"), F.col("__v")))).alias(fmt.format(c=c, f="mode")))
            if c in nunique:
                aggs.append(F.count(F.when(own, 1)).alias(fmt.format(c=c, f="nunique")))
        g = counts.groupBy(*keys).agg(*aggs)
        out = g if out is None else join_keys(out, g, keys, "full_outer")
    return out


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two frames of one row per key; a null key meets a null key."""
    mine = {k: f"__j{i}" for i, k in enumerate(keys)}
    out = left.join(right.withColumnsRenamed(mine), same(keys, list(mine.values())), how)
    own = [F.coalesce(F.col(k), F.col(mine[k])).alias(k) if how == "full_outer" else F.col(k) for k in keys]
    return out.select(*own, *(c for c in left.columns if c not in keys), *(c for c in right.columns if c not in keys))

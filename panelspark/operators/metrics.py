"""Ranking metrics and global running sums (§2.5 win_cumulative_weight,
win_rank_average; §2.12 metrics).

The reference metric sorts the whole prediction table and takes cumulative
sums.  A window without ``partitionBy`` would move every row into one task, so
running sums here are two-level:

1. ``repartitionByRange`` on (group, order) and sort inside each partition --
   the range bounds include the unique id, so a hot score value is spread
   over partitions too;
2. per-partition cumulative sums (``mapInPandas``, carried across Arrow
   batches, no extra shuffle);
3. per-partition totals -> exclusive prefix over partitions: a table of
   ``partitions`` rows, broadcast back; per-group sums subtract the global sum
   before the group's first row (one row per group, measured join).

Score: the mean of the normalised weighted Gini and the share of positives
captured in the top 4% of weight (negatives weigh 20).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import pin

# Fixed values of the ranking metric.
NEG_WEIGHT = 20.0
TOP_FRACTION = 0.04


def running_sums(df: DataFrame, order: list[Column], cols: list[str], by: tuple[str, ...] = (),
                 n_parts: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` (restarting per ``by`` group).

    One global pass ordered by (by, order); a group's sums are the global
    sums minus the global sum just before the group's first row (one row per
    group), joined back by ``join_small``."""
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(b).asc() for b in by] + list(order)
    allc = list(cols) + (["__one"] if by and "__one" not in cols else [])
    d = df.withColumn("__one", F.lit(1.0)) if by else df
    d = d.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__pid", F.spark_partition_id())
    loc_names = [f"__loc_{c}" for c in allc]
    schema = T.StructType(d.schema.fields + [T.StructField(x, T.DoubleType()) for x in loc_names])

    def local(batches):
        carry = np.zeros(len(allc))
        for pdf in batches:
            cum = pdf[allc].astype("float64").to_numpy().cumsum(axis=0) + carry
            if len(pdf):
                carry = cum[-1]
            out = pdf.copy()
            for j, x in enumerate(loc_names):
                out[x] = cum[:, j] if len(pdf) else pd.Series(dtype="float64")
            yield out

    # Partition totals and local sums read the same pinned result (``pin``): a
    # separately planned range exchange would re-sample its bounds and the
    # partition ids would not line up.
    loc = pin(d.mapInPandas(local, schema))
    tot = loc.groupBy("__pid").agg(*[F.sum(F.col(c).cast("double")).alias(f"__tot_{c}") for c in allc])
    w = Window.partitionBy().orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__pid", *[F.coalesce(F.sum(f"__tot_{c}").over(w), F.lit(0.0)).alias(f"__off_{c}") for c in allc])
    res = loc.join(F.broadcast(off), "__pid")  # one row per partition
    res = res.withColumns({f"__g_{c}": F.col(f"__loc_{c}") + F.col(f"__off_{c}") for c in allc})
    if by:
        # global sum just before each group's first row (first = smallest global position)
        start = res.groupBy(*by).agg(*[F.min_by(F.col(f"__g_{c}") - F.col(c), F.col("__g___one")).alias(f"__s_{c}")
                                       for c in cols])
        from .relational import join_small
        res = join_small(res, start, list(by))
        res = res.withColumns({f"{prefix}{c}": F.col(f"__g_{c}") - F.col(f"__s_{c}") for c in cols})
        res = res.drop(*[f"__s_{c}" for c in cols])
    else:
        res = res.withColumns({f"{prefix}{c}": F.col(f"__g_{c}") for c in cols})
    return res.drop("__pid", "__one", *loc_names, *[f"__off_{c}" for c in allc], *[f"__g_{c}" for c in allc])


def _weighted(df: DataFrame, target: str) -> DataFrame:
    t = F.col(target).cast("double")
    return df.withColumns({"__w": F.when(t == 0, F.lit(NEG_WEIGHT)).otherwise(F.lit(1.0)),
                           "__t": t})


def _cum(df: DataFrame, score: str, target: str, idcol: str, by=()) -> DataFrame:
    d = _weighted(df.select(*by, idcol, score, target), target)
    d = d.withColumn("__tw", F.col("__t") * F.col("__w"))
    return running_sums(d, [F.col(score).desc(), F.col(idcol).asc()], ["__w", "__tw"], by=tuple(by))


def cumulative_weight(df: DataFrame, score: str = "prediction", target: str = "target", idcol: str = "id") -> DataFrame:
    """win_cumulative_weight: running weight in score order (desc, id)."""
    c = _cum(df, score, target, idcol)
    return c.select(idcol, F.col("cum___w").alias("cum_weight"))


def topk_weighted_fraction(df: DataFrame, score: str = "prediction", target: str = "target",
                           idcol: str = "id", frac: float = TOP_FRACTION) -> DataFrame:
    """topk_weighted_fraction: rows in score order while the running weight is
    <= floor(frac * total weight)."""
    c = _cum(df, score, target, idcol)
    wsum = _weighted(df.select(target), target).agg(F.sum("__w")).scalar()  # scalar subquery, no join
    return c.where(F.col("cum___w") <= F.floor(F.lit(frac) * wsum)).select(idcol, score, target)


def _components(df: DataFrame, score: str, target: str, idcol: str, by=(), fast: bool = False) -> DataFrame:
    """Per group: weighted gini, its perfect-order maximum, top-4% capture.

    Only one ordered pass is needed.  With W = sum w, Q = sum w^2, P = #positives:
      sum_i w_i cumW_i = (W^2 + Q) / 2            (order-free)
      gini = sum_i w_i cumPos_i / P - (W^2 + Q) / (2 W)
      gini_max (positives first, w = 1) = (P + 1)/2 + 20 N - (W^2 + Q) / (2 W)
    which equals the closed form 10 N (P + 20 N - 19) / (P + 20 N)."""
    by = tuple(by)
    d = _weighted(df.select(*by, idcol, score, target), target)
    totals = {"W": F.sum("__w"), "Q": F.sum(F.col("__w") * F.col("__w")), "n_pos": F.sum("__t"),
              "n": F.count(F.lit(1))}
    c = running_sums(d, [F.col(score).desc(), F.col(idcol).asc()], ["__w", "__t"], by=by)
    if by:
        tot = d.groupBy(*by).agg(*[v.alias(k) for k, v in totals.items()])
        from .relational import join_small
        c = join_small(c, tot, list(by))
    else:  # global totals as scalar subqueries (merged into one aggregate), no join
        c = c.withColumns({k: d.agg(v.alias(k)).scalar() for k, v in totals.items()})
    if fast:
        cond = F.try_divide(F.col("cum___w"), F.col("W")) <= F.lit(TOP_FRACTION)
    else:
        cond = F.col("cum___w") <= F.floor(F.lit(TOP_FRACTION) * F.col("W"))
    g = c.groupBy(*by).agg(F.sum(F.col("__w") * F.col("cum___t")).alias("S_tw"),
                           F.sum(F.when(cond, F.col("__t")).otherwise(0.0)).alias("cap_pos"),
                           F.first("W").alias("W"), F.first("Q").alias("Q"), F.first("n_pos").alias("n_pos"),
                           F.first("n").alias("n"))
    # a group without positives or without rows has no score: NULL, not an error
    sw = F.try_divide(F.col("W") * F.col("W") + F.col("Q"), F.lit(2.0) * F.col("W"))
    n_neg = F.col("n") - F.col("n_pos")
    return g.withColumns({"gini": F.try_divide(F.col("S_tw"), F.col("n_pos")) - sw,
                          "gini_exact_max": (F.col("n_pos") + 1) / 2.0 + F.lit(NEG_WEIGHT) * n_neg - sw,
                          "d": F.try_divide(F.col("cap_pos"), F.col("n_pos")), "n_neg": n_neg})


def _gini_max(n_pos: Column, n_neg: Column) -> Column:
    """Gini of the perfect order in closed form (positives first)."""
    return F.try_divide(F.lit(10.0) * n_neg * (n_pos + F.lit(20.0) * n_neg - 19), n_pos + F.lit(20.0) * n_neg)


def metric_frame(df: DataFrame, score: str = "prediction", target: str = "target", idcol: str = "id",
                 by=(), fast: bool = False) -> DataFrame:
    """One row per group with gini, gini_max, norm_gini, top4 (d) and score;
    NULL where a group has no positives."""
    g = _components(df, score, target, idcol, by, fast)
    gmax = _gini_max(F.col("n_pos"), F.col("n_neg")) if fast else F.col("gini_exact_max")
    g = g.withColumn("gini_max", gmax).withColumn("norm_gini", F.try_divide(F.col("gini"), F.col("gini_max")))
    return g.select(*by, "gini", "gini_max", "norm_gini", F.col("d").alias("top4"),
                    (F.lit(0.5) * (F.col("norm_gini") + F.col("d"))).alias("score"))


def grouped_sums(df: DataFrame, order: list[Column], cols: list[str], group: str, n_parts: int | None = None) -> DataFrame:
    """Running sums in one order over all rows (``cum_<c>``) and over each row's own group
    (``own_<c>``): one range exchange and one pinned pass carry a vector of sums, one entry per group.

    The group domain is small (folds): the offsets are one row for each piece and group."""
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__pid", F.spark_partition_id())
    loc = [f"__loc_{c}" for c in cols] + [f"__own_{c}" for c in cols]
    schema = T.StructType(d.schema.fields + [T.StructField(x, T.DoubleType()) for x in loc])

    def local(batches):
        total, own = np.zeros(len(cols)), {}
        for pdf in batches:
            x = pdf[cols].astype("float64").to_numpy()
            mine = np.zeros_like(x)
            codes, names = pd.factorize(pdf[group], use_na_sentinel=False)
            for k, g in enumerate(names.tolist()):
                g = None if pd.isna(g) else g
                at = np.flatnonzero(codes == k)
                mine[at] = x[at].cumsum(axis=0) + own.get(g, 0.0)
                own[g] = mine[at[-1]].copy()
            both = np.hstack([x.cumsum(axis=0) + total, mine])
            if len(pdf):
                total = both[-1, :len(cols)]
            yield pdf.assign(**{c: both[:, j] for j, c in enumerate(loc)})

    rows = pin(d.mapInPandas(local, schema))
    part = rows.groupBy("__pid", group).agg(*[F.sum(F.col(c).cast("double")).alias(f"__t_{c}") for c in cols])
    # one row for each piece and group: what lies before the piece, in its group and in all
    own_before = Window.partitionBy(group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    all_before = Window.orderBy("__pid").rangeBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    part = part.select("__pid", F.col(group).alias("__group"), *[zero(F.sum(f"__t_{c}").over(own_before)).alias(f"__ob_{c}") for c in cols],
                       *[zero(F.sum(f"__t_{c}").over(all_before)).alias(f"__ab_{c}") for c in cols])
    part = part.withColumnRenamed("__pid", "__piece")
    out = rows.join(F.broadcast(part), (F.col("__pid") == F.col("__piece")) & F.col(group).eqNullSafe(F.col("__group")))
    return out.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__ab_{c}")).alias(f"cum_{c}") for c in cols],
                      *[(F.col(f"__own_{c}") + F.col(f"__ob_{c}")).alias(f"own_{c}") for c in cols])


def score_by_fold(df: DataFrame, fold: str = "val_fold_n", score: str = "prediction", target: str = "target", idcol: str = "id") -> DataFrame:
    """metric_by_fold: the score of each fold, their mean and the pooled score, from one ordered pass."""
    d = _weighted(df.select(fold, idcol, score, target), target)
    c = grouped_sums(d, [F.col(score).desc(), F.col(idcol).asc()], ["__w", "__t"], fold)

    def scores(rows: DataFrame, by: list[str], kind: str) -> DataFrame:
        # the totals of a group are the largest running sums in it
        sums = {"W": F.sum("__w"), "Q": F.sum(F.col("__w") * F.col("__w")), "n_pos": F.sum("__t"), "n": F.count(F.lit(1)),
                "S_tw": F.sum(F.col("__w") * F.col(f"{kind}___t"))}
        tot = rows.groupBy(*by).agg(*[v.alias(k) for k, v in sums.items()])
        if by:
            limit = rows.join(F.broadcast(tot.select(F.col(fold).alias("__f"), "W")), F.col(fold).eqNullSafe(F.col("__f")))  # one row per fold
        else:
            limit = rows.withColumn("W", rows.agg(F.sum("__w")).scalar())
        cap = limit.groupBy(*by).agg(F.sum(F.when(F.col(f"{kind}___w") <= F.floor(F.lit(TOP_FRACTION) * F.col("W")), F.col("__t")).otherwise(0.0)).alias("cap_pos"))
        if by:
            g = tot.join(cap.withColumnRenamed(fold, "__f"), F.col(fold).eqNullSafe(F.col("__f")))
        else:
            g = tot.withColumn("cap_pos", cap.scalar())
        sw = F.try_divide(F.col("W") * F.col("W") + F.col("Q"), F.lit(2.0) * F.col("W"))
        gini = F.try_divide(F.col("S_tw"), F.col("n_pos")) - sw
        most = (F.col("n_pos") + 1) / 2.0 + F.lit(NEG_WEIGHT) * (F.col("n") - F.col("n_pos")) - sw
        return g.select(*by, (F.lit(0.5) * (F.try_divide(gini, most) + F.try_divide(F.col("cap_pos"), F.col("n_pos")))).alias("score"))

    per = scores(c, [fold], "own").select(F.col(fold).cast("string").alias("fold"), "score")
    mean = per.agg(F.avg("score").alias("score")).select(F.lit("mean").alias("fold"), "score")
    pooled = scores(c, [], "cum").select(F.lit("pooled").alias("fold"), "score")
    return per.unionByName(mean).unionByName(pooled)


def average_rank(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """win_rank_average: 1-based average rank with ties (``rankdata``).

    Counts per distinct value (partial aggregation), running counts over the
    distinct values (two-level, no single-task window), joined back by value."""
    out = out or f"{col}_rank"
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    vc = running_sums(vc, [F.col(col).asc()], ["__n"])
    vc = vc.select(col, (F.col("cum___n") - F.col("__n") + (F.col("__n") + 1) / 2).alias(out))
    return df.join(vc, col, "left")  # a NULL value keeps its row and has no rank


def rank_average(df: DataFrame, cols: list[str], idcol: str = "id", out: str = "rank_avg") -> DataFrame:
    """rank_average: mean over models of each model's average rank."""
    d = df.select(idcol, *cols)
    for c in cols:
        d = average_rank(d, c, f"__r_{c}")
    return d.select(idcol, (sum(F.col(f"__r_{c}") for c in cols) / len(cols)).alias(out))


def auc_exact(df: DataFrame, score: str = "prediction", target: str = "target") -> DataFrame:
    """ROC AUC by the rank-sum formula (ties count one half); exact, distributed."""
    vc = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).cast("double").alias("__n"),
                               F.sum(F.col(target).cast("double")).alias("__p"))
    vc = running_sums(vc, [F.col(score).asc()], ["__n"])
    r = vc.select((F.col("__p") * (F.col("cum___n") - F.col("__n") + (F.col("__n") + 1) / 2)).alias("rs"),
                  "__p", "__n")
    a = r.agg(F.sum("rs").alias("rs"), F.sum("__p").alias("P"), F.sum("__n").alias("N"))
    return a.select(F.try_divide(F.col("rs") - F.col("P") * (F.col("P") + 1) / 2, F.col("P") * (F.col("N") - F.col("P"))).alias("auc"))


def logloss(df: DataFrame, score: str = "prediction", target: str = "target", eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    t = F.col(target).cast("double")
    return df.agg((-F.avg(t * F.ln(p) + (1 - t) * F.ln(1 - p))).alias("logloss"))

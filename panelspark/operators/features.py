"""Feature-family jobs (§2.4): panel -> one row per entity.

Each family is ONE ``groupBy(entity)`` (aggregation fusion: the reference runs
several passes and joins them back) followed by one projection for the derived
columns.  Windows, where needed, are partitioned by the same entity key, so
Spark reuses the hash partitioning and the whole job has a single exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ratio, sentinel_to_null
from ..spec import PanelSpec
from .aggregates import OK, agg_exprs, entity_agg, with_order_key
from .ordered import entity_scan

NUM_AGGS = ["mean", "std", "min", "max", "last", "first"]
CAT_AGGS = ["mode", "last", "first", "nunique"]


def clean_sentinels(df: DataFrame, cols, sentinel=-1.0) -> DataFrame:
    """sentinel_to_null over several numeric columns in one projection."""
    return df.withColumns({c: sentinel_to_null(c, sentinel) for c in cols})


def basic_agg_features(df: DataFrame, spec: PanelSpec, clean: bool = False) -> DataFrame:
    """num {mean,std,min,max,last,first}; cat {mode,last,first,nunique};
    last/mean, last-mean, last-first.  ``clean=False`` keeps -1 as a value
    (as the basic job does)."""
    num, cat = list(spec.num), list(spec.cat)
    if clean:
        df = clean_sentinels(df, num, spec.sentinel)
    df = with_order_key(df, spec)
    g = entity_agg(df, spec, [(num, NUM_AGGS), (cat, CAT_AGGS)])
    derived = {}
    for c in num:
        last, mean, first = F.col(f"{c}_last"), F.col(f"{c}_mean"), F.col(f"{c}_first")
        derived[f"{c}_last_pct_mean"] = ratio(last, mean)
        derived[f"{c}_diff_mean"] = last - mean
        derived[f"{c}_last_minus_first"] = last - first
    return g.withColumns(derived)


def null_handled_agg_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """basic aggregates after -1 -> NULL, plus ``<c>_na_count`` per numeric."""
    num = list(spec.num)
    df = with_order_key(clean_sentinels(df, num, spec.sentinel), spec)
    na = [(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"{c}_na_count") for c in num]
    g = entity_agg(df, spec, [(num, NUM_AGGS), (spec.cat, CAT_AGGS)], na)
    derived = {}
    for c in num:
        last, mean, first = F.col(f"{c}_last"), F.col(f"{c}_mean"), F.col(f"{c}_first")
        derived[f"{c}_last_pct_mean"] = ratio(last, mean)
        derived[f"{c}_diff_mean"] = last - mean
        derived[f"{c}_last_minus_first"] = last - first
    return g.withColumns(derived)


# ---------------------------------------------------------------- null-rate split
def null_shares(df: DataFrame, cols, sentinel=-1.0) -> dict[str, float]:
    """split_cols_by_null_rate / null_flag_cols_by_rate: one-pass share of
    missing values per column (a tiny eager job whose result shapes the plan)."""
    exprs = []
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    for c in cols:
        miss = F.col(c).isNull()
        if sentinel is not None and c in numeric:
            miss = miss | (F.col(c) == F.lit(sentinel))
        exprs.append(F.avg(F.coalesce(miss, F.lit(True)).cast("double")).alias(c))
    row = df.agg(*exprs).first()
    return {c: float(row[c]) if row[c] is not None else 1.0 for c in cols}


def split_cols_by_null_rate(df: DataFrame, cols, threshold: float = 0.90, sentinel=-1.0):
    """-> (full-aggregation columns, last-only columns)."""
    sh = null_shares(df, cols, sentinel)
    return [c for c in cols if sh[c] < threshold], [c for c in cols if sh[c] >= threshold]


def _recent_rank(df: DataFrame, spec: PanelSpec, name: str = "__rd") -> DataFrame:
    return df.withColumn(name, F.row_number().over(spec.window(desc=True)))


def recent_stats(df: DataFrame, spec: PanelSpec, cols, n: int, funcs, tag: str | None = None) -> DataFrame:
    """Statistics of the last ``n`` statements per entity.  ``row_number() <= n``
    is a top-n filter, so Spark inserts a partial WindowGroupLimit below the
    exchange: at most n rows per entity and map task are shuffled, and a hot
    entity cannot overload one reducer."""
    tag = tag or f"{n}sts"
    last = _recent_rank(df, spec).where(F.col("__rd") <= n)
    return last.groupBy(spec.entity).agg(*agg_exprs(list(cols), list(funcs), fmt="{c}_" + tag + "_{f}"))


def refined_agg_features(df: DataFrame, spec: PanelSpec, full_cols=None, last_cols=None,
                         fit_df: DataFrame | None = None, recent: int = 5) -> DataFrame:
    """-1 -> NULL; full aggregates for low-null columns, ``last`` only for
    >=90%-missing ones (decided on ``fit_df``, e.g. the train split); mean/std
    of the last ``recent`` statements; cat {last,first,nunique}; 4 differences.

    Plan: a partial hash aggregate over all rows (skew-safe) and a top-n
    branch for the recent statistics (WindowGroupLimit), joined on the entity
    (both sides already hash-partitioned by it)."""
    num = list(spec.num)
    if full_cols is None or last_cols is None:
        full_cols, last_cols = split_cols_by_null_rate(fit_df if fit_df is not None else df, num,
                                                       0.90, spec.sentinel)
    df = with_order_key(clean_sentinels(df, num, spec.sentinel), spec)
    s = f"{recent}sts"
    g = entity_agg(df, spec, [(full_cols, NUM_AGGS), (last_cols, ["last"]), (spec.cat, ["last", "first", "nunique"])])
    g = g.join(recent_stats(df, spec, full_cols, recent, ["mean", "std"]), spec.entity)
    d = {}
    for c in full_cols:
        last = F.col(f"{c}_last")
        d[f"{c}_last_minus_mean"] = last - F.col(f"{c}_mean")
        d[f"{c}_last_minus_first"] = last - F.col(f"{c}_first")
        d[f"{c}_last_minus_{s}_mean"] = last - F.col(f"{c}_{s}_mean")
        d[f"{c}_{s}_mean_minus_mean"] = F.col(f"{c}_{s}_mean") - F.col(f"{c}_mean")
    return g.withColumns(d)


def refined_agg_features_median_3_7(df: DataFrame, spec: PanelSpec, full_cols=None, last_cols=None,
                                    fit_df: DataFrame | None = None) -> DataFrame:
    """As refined, with median and last-3 / last-7 windows; 6 differences.
    The last-3 statistics come from the last-7 rows (one top-n branch)."""
    num = list(spec.num)
    if full_cols is None or last_cols is None:
        full_cols, last_cols = split_cols_by_null_rate(fit_df if fit_df is not None else df, num,
                                                       0.90, spec.sentinel)
    df = with_order_key(clean_sentinels(df, num, spec.sentinel), spec)
    funcs = ["median", "std", "min", "max", "last", "first"]
    few = ["median", "std"]  # of at most 7 rows
    last7 = _recent_rank(df, spec).where(F.col("__rd") <= 7)
    rec = last7.groupBy(spec.entity).agg(
        *agg_exprs(full_cols, few, fmt="{c}_3sts_{f}", where=F.col("__rd") <= 3),
        *agg_exprs(full_cols, few, fmt="{c}_7sts_{f}"))
    g = entity_agg(df, spec, [(full_cols, funcs), (last_cols, ["last"]), (spec.cat, ["last", "first", "nunique"])]).join(rec, spec.entity)
    d = {}
    for c in full_cols:
        last, med = F.col(f"{c}_last"), F.col(f"{c}_median")
        m3, m7 = F.col(f"{c}_3sts_median"), F.col(f"{c}_7sts_median")
        d[f"{c}_last_minus_median"] = last - med
        d[f"{c}_last_minus_first"] = last - F.col(f"{c}_first")
        d[f"{c}_last_minus_3sts_median"] = last - m3
        d[f"{c}_last_minus_7sts_median"] = last - m7
        d[f"{c}_3sts_median_minus_median"] = m3 - med
        d[f"{c}_3sts_median_minus_7sts_median"] = m3 - m7
    return g.withColumns(d)


def after_pay_agg_features(df: DataFrame, spec: PanelSpec, b_cols, p_cols) -> DataFrame:
    """Pairwise ``b - p`` ("after payment" balances, raw values) -> 6 aggregates."""
    pairs = {f"{b}_minus_{p}": F.col(b) - F.col(p) for b in b_cols if b in df.columns for p in p_cols}
    df = with_order_key(df.withColumns(pairs), spec)
    return df.groupBy(spec.entity).agg(*agg_exprs(list(pairs), NUM_AGGS))


# ---------------------------------------------------------------- null patterns
def first_streak_exprs(flags, rn: str = "__rn", cnt: str = "__fc_{}") -> tuple[dict, list]:
    """agg_first_streak: length of the first run of True in statement order.

    From the ordered scan: ``rn`` (row number) and ``cnt`` (number of True up
    to the row).  With p = first True position, the run ends at q = the first
    False that has a True before it (cnt > 0): length = q - p, or n - p + 1
    if no such False follows; 0 if no True.  Plain aggregates, no
    whole-entity window.  Returns (scan inputs, (flag, p, q) aggregates)."""
    scan = {cnt.format(c): F.when(F.col(c), F.lit(1)) for c in flags}
    aggs = [(c, F.min(F.when(F.col(c), F.col(rn))),
             F.min(F.when(~F.col(c) & (F.col(cnt.format(c)) > 0), F.col(rn)))) for c in flags]
    return scan, aggs


def na_agg_features(df: DataFrame, spec: PanelSpec, features=None) -> DataFrame:
    """null flags of every feature -> mean, sum, last, first_streak, at_random_sum
    (= sum - first_streak: the missing values not in the first run)."""
    feats = list(features) if features is not None else spec.features
    num = set(spec.num)
    flags = {f"{c}_is_null": (F.coalesce(F.col(c).isNull() | (F.col(c) == F.lit(spec.sentinel)), F.lit(True))
                             if c in num and spec.sentinel is not None else F.col(c).isNull())
             for c in feats}
    df = df.select(spec.entity, *[F.col(c) for c in ([spec.ts] + ([spec.tiebreak] if spec.tiebreak else []))],
                   *[v.alias(k) for k, v in flags.items()])
    scan, streak_aggs = first_streak_exprs(list(flags))
    df = entity_scan(df.withColumns({f"__in{k}": v for k, v in scan.items()}), spec, row_number="__rn",
                     count_nonnull={k: f"__in{k}" for k in scan})
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in flags:
        fl = F.col(c).cast("int")
        aggs += [F.avg(fl).alias(f"{c}_mean"), F.sum(fl).cast("long").alias(f"{c}_sum"),
                 F.max_by(fl, F.col("__rn")).alias(f"{c}_last")]
    for c, p, q in streak_aggs:
        aggs += [p.alias(f"__p_{c}"), q.alias(f"__q_{c}")]
    g = df.groupBy(spec.entity).agg(*aggs)
    d = {}
    for c in flags:
        p, q = F.col(f"__p_{c}"), F.col(f"__q_{c}")
        streak = (F.when(p.isNull(), 0).when(q.isNull(), F.col("__n") - p + 1).otherwise(q - p)).cast("long")
        d[f"{c}_first_streak"] = streak
        d[f"{c}_at_random_sum"] = F.col(f"{c}_sum") - streak
    g = g.withColumns(d)
    return g.drop("__n", *[f"__p_{c}" for c in flags], *[f"__q_{c}" for c in flags])


def row_null_count(df: DataFrame, spec: PanelSpec, features=None, name: str = "na_row_total") -> DataFrame:
    """fn_row_null_count: missing cells per row (sentinel or NULL)."""
    feats = list(features) if features is not None else spec.features
    num = set(spec.num)
    flags = [(F.coalesce((F.col(c).isNull() | (F.col(c) == F.lit(spec.sentinel))) if c in num
                         else F.col(c).isNull(), F.lit(True))).cast("int") for c in feats]
    tot = flags[0]
    for x in flags[1:]:
        tot = tot + x
    return df.withColumn(name, tot)


def na_clusters(df: DataFrame, cols, sentinel=-1.0, min_size: int = 10) -> DataFrame:
    """Groups of more than ``min_size`` columns sharing the same (non-zero)
    null count: whole-table profile in one aggregate, then a tiny regroup."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    def miss(c):
        m = F.col(c).isNull()
        return F.coalesce(m | (F.col(c) == F.lit(sentinel)), F.lit(True)) if c in numeric else m

    counts = df.agg(*[F.sum(miss(c).cast("long")).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("na_count"))
                                                for c in cols])).alias("s")).select("s.*")
    return (stacked.where("na_count > 0").groupBy("na_count")
            .agg(F.sort_array(F.collect_list("feature")).alias("features"), F.count(F.lit(1)).alias("n_features"))
            .where(F.col("n_features") > min_size))


# ---------------------------------------------------------------- dates
def date_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Month gap between consecutive statements: ((m - lag m) pmod 12, 0 -> 12) - 1;
    {count,sum,max,std,mean,last}, last - mean; missing -> -1 (sum/count 0)."""
    m = F.month(spec.ts)
    df = df.select(spec.entity, spec.ts, *([spec.tiebreak] if spec.tiebreak else []))
    df = entity_scan(df.withColumn("__m", m), spec, lag={"__pm": "__m"})
    gap = F.pmod(F.col("__m") - F.col("__pm"), F.lit(12))
    df = df.withColumn("month_gap", F.when(gap == 0, 12).otherwise(gap) - 1)
    df = with_order_key(df, spec)
    g = df.groupBy(spec.entity).agg(*agg_exprs(["month_gap"], ["count", "sum", "max", "std", "mean", "last"]))
    g = g.withColumn("month_gap_minus_mean", F.col("month_gap_last") - F.col("month_gap_mean"))
    fill = {c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0))
            for c in ["month_gap_max", "month_gap_std", "month_gap_mean", "month_gap_last", "month_gap_minus_mean"]}
    return g.withColumns(fill).withColumn("month_gap_sum", F.col("month_gap_sum").cast("long"))


def sampling_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Share of entities whose last statement falls on that date among those
    whose last statement is in that month-of-year.  Two tiny count tables
    (bounded by #dates / 12 months) joined back; no unpartitioned window."""
    last = df.groupBy(spec.entity).agg(F.max(spec.ts).alias("__last"))
    last = last.withColumn("__m", F.month("__last"))
    by_date = last.groupBy("__last").agg(F.count(F.lit(1)).alias("__nd"))
    by_month = last.groupBy("__m").agg(F.count(F.lit(1)).alias("__nm"))
    out = last.join(F.broadcast(by_month), "__m").join(by_date, "__last")
    return out.select(spec.entity, (F.col("__nd") / F.col("__nm")).alias(f"{spec.ts}_month_freq"))


# ---------------------------------------------------------------- differences
def diff_features(df: DataFrame, spec: PanelSpec, periods=(1, 2), fill=-1.0) -> DataFrame:
    """last - value ``p`` statements earlier (row-wise, NULLs kept), missing -> fill."""
    num = list(spec.num)
    df = _recent_rank(clean_sentinels(df, num, spec.sentinel), spec)
    ks = sorted({1} | {p + 1 for p in periods})
    g = df.where(F.col("__rd") <= max(ks)).groupBy(spec.entity).agg(
        *[F.max(F.when(F.col("__rd") == k, F.col(c))).alias(f"__{c}_{k}") for c in num for k in ks])
    return g.select(spec.entity, *[F.coalesce(F.col(f"__{c}_1") - F.col(f"__{c}_{p + 1}"), F.lit(fill))
                                   .alias(f"{c}_diff_{p}") for c in num for p in periods])


def diff_agg_features(df: DataFrame, spec: PanelSpec, fill=-1.0) -> DataFrame:
    """Statement-to-statement differences over the last ``max_periods``
    statements, NULL differences -> ``fill`` (a short history yields one
    artificial ``fill`` for its first row), then {mean,std,min,max}."""
    num = list(spec.num)
    df = clean_sentinels(df, num, spec.sentinel)
    w = spec.window()
    # keep the last max_periods rows first (top-n: partial WindowGroupLimit),
    # then lag inside those bounded rows; the oldest kept row only feeds a lag
    df = _recent_rank(df, spec).where(F.col("__rd") <= spec.max_periods)
    d = {f"{c}_diff1": F.col(c) - F.lag(c).over(w) for c in num}
    df = df.withColumns(d).where(F.col("__rd") < spec.max_periods)
    if fill is not None:
        df = df.withColumns({k: F.coalesce(F.col(k), F.lit(fill)) for k in d})
    return df.groupBy(spec.entity).agg(*agg_exprs(list(d), ["mean", "std", "min", "max"]))


# ---------------------------------------------------------------- group-relative
def _f32(c: Column) -> Column:
    """float32 storage of a statistic (the reference keeps group stats as float32)."""
    return c.cast("float").cast("double")


def group_rel_transform(df: DataFrame, spec: PanelSpec, group: Column | str, gname: str, cols,
                        by=(), time_aggs=("mean", "std", "last", "min", "max")) -> DataFrame:
    """z-score of each column against its group's mean/std (float32), rows with
    a NULL group dropped, then aggregated over time per entity."""
    from .relational import join_small
    num = list(cols)
    g = F.col(group) if isinstance(group, str) else group
    base = clean_sentinels(df, num, spec.sentinel).withColumn("__g", g).where(F.col("__g").isNotNull())
    keys = ["__g", *by]
    stats = base.groupBy(*keys).agg(*[_f32(F.avg(c)).alias(f"__mu_{c}") for c in num],
                                    *[_f32(F.stddev_samp(c)).alias(f"__sd_{c}") for c in num])
    z = join_small(base, stats, keys)
    rel = {f"{c}_rel_{gname}_mean": F.try_divide(F.col(c) - F.col(f"__mu_{c}"), F.col(f"__sd_{c}")) for c in num}
    z = with_order_key(z.withColumns(rel), spec)
    return z.groupBy(spec.entity).agg(*agg_exprs(list(rel), list(time_aggs)))


def group_rel_features(df: DataFrame, spec: PanelSpec, important=None, split_col: str = "dset",
                       time_aggs=("mean", "std", "last", "min", "max")) -> DataFrame:
    """Month-relative z of all numerics (stats per split) + category-relative z
    of ``important`` numerics (stats over all splits), aggregated over time.

    One pass: the (bounded, measured) statistics tables are joined onto the
    rows, every z column is computed per row and all aggregates go into ONE
    ``groupBy(entity)``.  A NULL category gives a NULL z, which the aggregates
    skip -- equal to dropping those rows from that category's block."""
    from .relational import join_small
    num = list(spec.num)
    important = list(important or num[:2])
    base = clean_sentinels(df, num, spec.sentinel).withColumn("__month", F.trunc(spec.ts, "MM"))
    ms = base.groupBy("__month", split_col).agg(*[_f32(F.avg(c)).alias(f"__mu_m_{c}") for c in num],
                                               *[_f32(F.stddev_samp(c)).alias(f"__sd_m_{c}") for c in num])
    z = join_small(base, ms, ["__month", split_col], "left")
    zc = {f"{c}_rel_{spec.ts}_mean": F.try_divide(F.col(c) - F.col(f"__mu_m_{c}"), F.col(f"__sd_m_{c}")) for c in num}
    from .encode import category_stats, lookup
    aggs = [x for c in important for x in (_f32(F.avg(c)).alias(f"mu_{c}"), _f32(F.stddev_samp(c)).alias(f"sd_{c}"))]
    stats = category_stats(base, spec.cat, aggs) if spec.cat else None
    for cat in spec.cat:
        z = lookup(z, stats, cat, {f"__{k}_{cat}_{c}": f"{k}_{c}" for c in important for k in ("mu", "sd")})
        zc.update({f"{c}_rel_{cat}_mean": F.try_divide(F.col(c) - F.col(f"__mu_{cat}_{c}"), F.col(f"__sd_{cat}_{c}"))
                   for c in important})
    z = with_order_key(z.withColumns(zc), spec)
    return z.groupBy(spec.entity).agg(*agg_exprs(list(zc), list(time_aggs)))


# ---------------------------------------------------------------- flattening
def flat_history_features(df: DataFrame, spec: PanelSpec, cols, drop_last_slot: bool = True) -> DataFrame:
    """``{c}_his_{i}``: i-th statement (oldest first, left-aligned) of the last
    ``max_periods`` statements; slot ``max_periods-1`` dropped."""
    n = spec.max_periods
    df = _recent_rank(df, spec).where(F.col("__rd") <= n)
    df = df.withColumn("__cnt", F.count(F.lit(1)).over(spec.whole()))
    df = df.withColumn("__pos", F.col("__cnt") - F.col("__rd"))
    slots = range(n - 1) if drop_last_slot else range(n)
    return df.groupBy(spec.entity).agg(*[F.max(F.when(F.col("__pos") == i, F.col(c))).alias(f"{c}_his_{i}")
                                         for c in cols for i in slots])


def months_ago(df: DataFrame, spec: PanelSpec, name: str = "months_ago") -> DataFrame:
    """win_months_ago: calendar periods between a statement and the entity's last one."""
    from .history import months_ago as _ma
    return _ma(df, spec, name)


def flatten_full_history(df: DataFrame, spec: PanelSpec, cols=None, fill=-1.0) -> DataFrame:
    """Every column x periods-ago 0..max_periods-1 (month-aligned, holes kept),
    missing -> fill.  The last row of each period wins.

    The last row of each (entity, period) comes from a partial ``max_by``, so at most
    ``max_periods`` structs per entity are collected; the period lookup happens on that
    bounded array (no pivot)."""
    cols = list(cols or spec.features)
    n = spec.max_periods
    df = months_ago(df, spec, "__ma").where(F.col("__ma") < n)
    last = df.groupBy(spec.entity, "__ma").agg(F.max_by(F.struct(*cols), spec.order_key()).alias("v"))
    g = last.groupBy(spec.entity).agg(F.collect_list(F.struct(F.col("__ma").alias("ma"), "v")).alias("__h"))

    def at_period(i):
        return lambda x: x["ma"] == F.lit(i)  # one-argument lambda (two would mean (x, index))

    per = {i: F.try_element_at(F.filter(F.col("__h"), at_period(i)), F.lit(1))["v"] for i in range(n)}
    out = [spec.entity]
    for i in range(n):
        for c in cols:
            x = per[i][c]
            x = F.coalesce(x, F.lit(fill)) if c in spec.num else F.coalesce(x, F.lit(str(int(fill))))
            out.append(x.alias(f"{c}_{i}"))
    return g.select(*out)

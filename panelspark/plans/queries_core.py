"""Registered queries: generic aggregates, windows, relational, set and scalar
operators (SURVEY §2.2-§2.8) on the fixture panels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import encode as E
from ..operators import features as feat
from ..operators import history as H
from ..operators import relational as R
from ..operators.quantiles import exact_quantiles
from ..sources.fixtures import ORDERS_SPEC as SP
from ..sources.fixtures import DAYS_SPEC, customer_labels, panel_days, panel_orders, scores, table
from . import oracle as O
from .catalog import register

PC = "pc AS (SELECT customer_id, s_2, seq, " + ", ".join(f"{O.clean(c)} AS {c}" for c in O.NUM) + ", d_63, d_64, dset FROM panel)"
RANKED = f"r AS ({O.ranked('pc')})"


def W(*ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def clean_panel(spark, sf):
    return feat.clean_sentinels(panel_orders(spark, sf), SP.num, SP.sentinel)


def _agg_key(key, funcs, cols=("p_2", "b_1", "d_42"), clean=True, sql_funcs=None, doc=""):
    items, floats = [], []
    for c in cols:
        i, n = O.num_aggs(c, tuple(sql_funcs or funcs))
        items += i
        floats += n
    sql = W(O.PANEL_ORDERS, PC if clean else "pc AS (SELECT * FROM panel)", RANKED,
            f"g AS (SELECT customer_id, {', '.join(items)} FROM r GROUP BY customer_id)",
            final=O.report(floats, ["customer_id"]))

    def q(spark, sf):
        p = clean_panel(spark, sf) if clean else panel_orders(spark, sf)
        return A.agg_panel(p, SP, list(cols), list(funcs))

    q.__doc__ = doc
    register(key, sql)(q)


# ------------------------------------------------------------------ §2.4 generic aggregates
_agg_key("agg_panel", ["mean", "std", "min", "max", "last", "first", "median", "sum"],
         doc="features x functions in one groupBy (-1 cleaned)")
_agg_key("agg_mean", ["mean"], doc="mean skipping missing")
_agg_key("agg_std", ["std"], doc="sample std (1 value -> NULL)")
_agg_key("agg_min_max", ["min", "max"], doc="min and max")
_agg_key("agg_last_nonnull", ["last"], doc="last non-null by (s_2, seq)")
_agg_key("agg_first_nonnull", ["first"], doc="first non-null by (s_2, seq)")
_agg_key("agg_median", ["median"], doc="exact median")
_agg_key("agg_sum", ["sum"], doc="sum, all-missing -> 0")

register("agg_count", W(O.PANEL_ORDERS, PC, final="SELECT customer_id, " + ", ".join(
    f"CAST(count({c}) AS BIGINT) AS {c}_count" for c in O.NUM) + " FROM pc GROUP BY customer_id"))(
    lambda spark, sf: A.agg_panel(clean_panel(spark, sf), SP, list(SP.num), ["count"]))

register("agg_nunique", W(O.PANEL_ORDERS, final="SELECT customer_id, " + ", ".join(
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS {c}_nunique" for c in O.CAT) + " FROM panel GROUP BY customer_id"))(
    lambda spark, sf: A.agg_panel(panel_orders(spark, sf), SP, list(SP.cat), ["nunique"]))

register("agg_mode", W(O.PANEL_ORDERS, *[O.mode_cte(c) for c in O.CAT],
                       "k AS (SELECT DISTINCT customer_id FROM panel)",
                       final="SELECT customer_id, " + ", ".join(f"{c}_mode" for c in O.CAT) + " FROM k "
                       + " ".join(f"LEFT JOIN mode_{c} USING (customer_id)" for c in O.CAT)))(
    lambda spark, sf: A.agg_panel(panel_orders(spark, sf), SP, list(SP.cat), ["mode"]))


def _concat_doc(spark, sf):
    """agg_concat_doc: space-joined category history in statement order."""
    p = panel_orders(spark, sf)
    return p.groupBy("customer_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_2", "seq", F.coalesce("d_63", F.lit("nan")).alias("v")))),
                                 lambda s: s["v"]), " ").alias("d_63_doc"))


register("agg_concat_doc", W(O.PANEL_ORDERS, final="SELECT customer_id, string_agg(coalesce(d_63, 'nan'), ' ' ORDER BY s_2, seq) AS d_63_doc FROM panel GROUP BY customer_id"))(_concat_doc)


register("agg_concat_doc_chunks", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", final="SELECT customer_id, (rn - 1) // 4 AS chunk, string_agg(coalesce(d_63, 'nan'), ' ' ORDER BY rn) AS text FROM r GROUP BY 1, 2"))(
    lambda spark, sf: E.document_chunks(panel_orders(spark, sf), SP, "d_63", rows=4))


def _null_stats(spark, sf):
    p = A.with_order_key(panel_orders(spark, sf), SP)
    flags = p.select("customer_id", A.OK, *[S.is_null_or_sentinel(c, -1).alias(c) for c in SP.num])
    return flags.groupBy("customer_id").agg(*A.agg_null_stats(list(SP.num)))


_ns_items, _ns_f = [], []
for _c in O.NUM:
    _fl = f"CAST(({_c} IS NULL OR {_c} = -1) AS INTEGER)"
    _ns_items += [f"avg({_fl}) AS {_c}_is_null_mean", f"CAST(sum({_fl}) AS BIGINT) AS {_c}_is_null_sum",
                  f"arg_max({_fl}, rn) AS {_c}_is_null_last"]
    _ns_f.append(f"{_c}_is_null_mean")
register("agg_null_stats", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})",
                             f"g AS (SELECT customer_id, {', '.join(_ns_items)} FROM r GROUP BY customer_id)",
                             final=O.report(_ns_f, ["customer_id"] + [f"{c}_is_null_{k}" for c in O.NUM for k in ("sum", "last")])))(_null_stats)


def _first_streak(spark, sf):
    """agg_first_streak on the b_1 / d_63 null flags."""
    out = feat.na_agg_features(panel_orders(spark, sf), SP, features=["b_1", "d_63"])
    return out.select("customer_id", "b_1_is_null_first_streak", "d_63_is_null_first_streak")


def _streak_sql(cols):
    fl = ", ".join(f"({O.clean(c)}) IS NULL AS f_{c}" if c in O.NUM else f"{c} IS NULL AS f_{c}" for c in cols)
    ctes = [O.PANEL_ORDERS, f"fl AS (SELECT customer_id, s_2, seq, {fl} FROM panel)",
            "r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS rn, count(*) OVER (PARTITION BY customer_id) AS n FROM fl)"]
    sel = []
    for c in cols:
        ctes.append(f"p_{c} AS (SELECT customer_id, min(rn) AS p FROM r WHERE f_{c} GROUP BY customer_id)")
        ctes.append(f"q_{c} AS (SELECT r.customer_id, min(rn) AS q FROM r JOIN p_{c} USING (customer_id) WHERE NOT f_{c} AND rn > p GROUP BY r.customer_id)")
        sel.append(f"CAST(CASE WHEN p_{c}.p IS NULL THEN 0 WHEN q_{c}.q IS NULL THEN n - p_{c}.p + 1 ELSE q_{c}.q - p_{c}.p END AS BIGINT) AS {c}_is_null_first_streak")
    ctes.append("k AS (SELECT customer_id, max(n) AS n FROM r GROUP BY customer_id)")
    joins = " ".join(f"LEFT JOIN p_{c} USING (customer_id) LEFT JOIN q_{c} USING (customer_id)" for c in cols)
    return W(*ctes, final=f"SELECT customer_id, {', '.join(sel)} FROM k {joins}")


register("agg_first_streak", _streak_sql(["b_1", "d_63"]))(_first_streak)


def _max_period(spark, sf):
    """agg_max_period: per-entity max valid months_ago (< 13)."""
    p = H.months_ago(panel_orders(spark, sf), SP)
    return p.groupBy("customer_id").agg(F.max(F.when(F.col("months_ago") < 13, F.col("months_ago"))).cast("long").alias("valid_max"))


MA = "m AS (SELECT *, max(year(s_2) * 12 + month(s_2)) OVER (PARTITION BY customer_id) - (year(s_2) * 12 + month(s_2)) AS months_ago FROM panel)"
register("agg_max_period", W(O.PANEL_ORDERS, MA, final="SELECT customer_id, CAST(max(CASE WHEN months_ago < 13 THEN months_ago END) AS BIGINT) AS valid_max FROM m GROUP BY customer_id"))(_max_period)


def _value_counts(spark, sf):
    """agg_value_counts: frequency of each d_64 value mapped back onto rows
    (count table bounded by the category domain, joined after measuring it)."""
    p = panel_orders(spark, sf)
    vc = p.groupBy("d_64").agg(F.count(F.lit(1)).alias("d_64_count"))
    return R.join_small(p.select("seq", "d_64"), vc, "d_64").select("seq", "d_64_count")


register("agg_value_counts", W(O.PANEL_ORDERS, final="SELECT seq, count(*) OVER (PARTITION BY d_64) AS d_64_count FROM panel"))(_value_counts)


def _group_mean_std(spark, sf):
    """agg_group_mean_std: mean/std of every numeric per calendar month (float32)."""
    p = clean_panel(spark, sf)
    return p.groupBy(F.trunc("s_2", "MM").cast("timestamp_ntz").alias("month")).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in SP.num], *[F.stddev_samp(c).alias(f"{c}_std") for c in SP.num])


register("agg_group_mean_std", W(O.PANEL_ORDERS, PC, "g AS (SELECT CAST(date_trunc('month', s_2) AS TIMESTAMP) AS month, " + ", ".join(
    [f"avg({c}) AS {c}_mean" for c in O.NUM] + [f"stddev_samp({c}) AS {c}_std" for c in O.NUM]) + " FROM pc GROUP BY 1)",
    final=O.report([f"{c}_mean" for c in O.NUM] + [f"{c}_std" for c in O.NUM], ["month"])))(_group_mean_std)


def _column_profile(spark, sf):
    """agg_column_profile: whole-table null count, median (histogram selection), min, std per column."""
    p = clean_panel(spark, sf)
    med = exact_quantiles(p, {c: [0.5] for c in SP.num})
    aggs = []
    for c in SP.num:
        aggs += [(F.count(F.lit(1)) - F.count(c)).alias(f"{c}_na_count"), F.lit(med[c][0]).cast("double").alias(f"{c}_median"),
                 F.min(c).alias(f"{c}_min"), F.stddev_samp(c).alias(f"{c}_std")]
    return p.agg(*aggs)


register("agg_column_profile", W(O.PANEL_ORDERS, PC, "g AS (SELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS {c}_na_count, median({c}) AS {c}_median, min({c}) AS {c}_min, stddev_samp({c}) AS {c}_std"
    for c in O.NUM) + " FROM pc)", final=O.report([f"{c}_{k}" for c in O.NUM for k in ("median", "min", "std")],
                                                  [f"{c}_na_count" for c in O.NUM])))(_column_profile)


def skewness_g1(c):
    """Bias-corrected sample skewness (pandas/DuckDB): Spark's population g1 * sqrt(n(n-1))/(n-2)."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def _skewness(spark, sf):
    """agg_skewness: bias-corrected skewness per column and per customer."""
    p = clean_panel(spark, sf)
    return p.groupBy("customer_id").agg(*[skewness_g1(c).alias(f"{c}_skew") for c in ("p_2", "b_1")])


register("agg_skewness", W(O.PANEL_ORDERS, PC, "g AS (SELECT customer_id, " + ", ".join(
    f"CASE WHEN count({c}) > 2 THEN skewness({c}) END AS {c}_skew" for c in ("p_2", "b_1")) + " FROM pc GROUP BY customer_id)",
    final=O.report(["p_2_skew", "b_1_skew"], ["customer_id"])))(_skewness)


def _corr_matrix(spark, sf):
    """agg_corr_matrix: Pearson correlations of prediction columns (one aggregate, long form)."""
    s = scores(spark, sf).withColumn("target_f", F.col("target").cast("double"))
    cols = ["prediction", "prediction_2", "target_f"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = s.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("corr"))
                                          for a, b in pairs])).alias("s")).select("s.*")


_cols = ["prediction", "prediction_2", "target_f"]
register("agg_corr_matrix", W(O.SCORES, "s AS (SELECT *, CAST(target AS DOUBLE) AS target_f FROM scores)",
                              "g AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM s"
                                                            for i, a in enumerate(_cols) for b in _cols[i:]) + ")",
                              final=O.report(["corr"], ["a", "b"])))(_corr_matrix)


def _pivot(spark, sf):
    """pivot_by_period: p_2 of the last row of each month, wide by months_ago 0..12."""
    p = H.months_ago(panel_orders(spark, sf), SP).where("months_ago < 13")
    p = p.withColumn("__k", F.row_number().over(Window.partitionBy("customer_id", "months_ago").orderBy(F.desc("s_2"), F.desc("seq")))).where("__k = 1")
    w = p.groupBy("customer_id").pivot("months_ago", list(range(13))).agg(F.first("p_2"))
    return w.select("customer_id", *[F.col(f"`{i}`").alias(f"p_2_{i}") for i in range(13)])


register("pivot_by_period", W(O.PANEL_ORDERS, MA, "d AS (SELECT *, row_number() OVER (PARTITION BY customer_id, months_ago ORDER BY s_2 DESC, seq DESC) AS k FROM m WHERE months_ago < 13)",
                              "g AS (SELECT customer_id, " + ", ".join(f"max(CASE WHEN months_ago = {i} THEN p_2 END) AS p_2_{i}" for i in range(13)) + " FROM d WHERE k = 1 GROUP BY customer_id)",
                              final=O.report([f"p_2_{i}" for i in range(13)], ["customer_id"])))(_pivot)


# ------------------------------------------------------------------ §2.5 windows
def _rows(cols_sql: str, extra_ctes=(), src="panel", where="") -> str:
    return W(O.PANEL_ORDERS, *extra_ctes, final=f"SELECT {cols_sql} FROM {src} {where}")


register("win_last_broadcast", _rows("seq, customer_id, max(s_2) OVER (PARTITION BY customer_id) AS last_ts"))(
    lambda spark, sf: H.last_broadcast(panel_orders(spark, sf), SP).select("seq", "customer_id", "last_ts"))

register("win_lag_diff", W(O.PANEL_ORDERS, "g AS (SELECT seq, customer_id, p_2 - lag(p_2) OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS p_2_diff FROM panel)",
                           final=O.report(["p_2_diff"], ["seq", "customer_id"])))(
    lambda spark, sf: H.lag_diff(panel_orders(spark, sf), SP, ["p_2"]).select("seq", "customer_id", "p_2_diff"))

register("win_nth_from_end", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", final="SELECT customer_id, seq, s_2, " + O.stable("p_2") + " AS p_2 FROM r WHERE rd = 2"))(
    lambda spark, sf: H.nth_from_end(panel_orders(spark, sf), SP, 2).select("customer_id", "seq", "s_2", "p_2"))

register("win_tail_n", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", final="SELECT customer_id, seq, s_2, " + O.stable("p_2") + " AS p_2 FROM r WHERE rd <= 5"))(
    lambda spark, sf: H.tail_n(panel_orders(spark, sf), SP, 5).select("customer_id", "seq", "s_2", "p_2"))

register("win_ffill", W(O.PANEL_ORDERS, PC, "g AS (SELECT customer_id, seq, last(b_1 IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY s_2, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b_1 FROM pc)",
                        final=O.report(["b_1"], ["customer_id", "seq"])))(
    lambda spark, sf: H.ffill(clean_panel(spark, sf), SP, ["b_1"]).select("customer_id", "seq", "b_1"))

register("win_leading_null", W(O.PANEL_ORDERS, PC, final="SELECT customer_id, seq, count(d_42) OVER (PARTITION BY customer_id ORDER BY s_2, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 AS d_42_leading_null FROM pc"))(
    lambda spark, sf: H.leading_null_flags(clean_panel(spark, sf), SP, ["d_42"]).select("customer_id", "seq", "d_42_leading_null"))

register("win_months_ago", W(O.PANEL_ORDERS, MA, final="SELECT customer_id, seq, CAST(months_ago AS INTEGER) AS months_ago FROM m"))(
    lambda spark, sf: H.months_ago(panel_orders(spark, sf), SP).select("customer_id", "seq", F.col("months_ago").cast("int")))

register("win_days_ago", W(O.PANEL_ORDERS, final="SELECT customer_id, seq, CAST(date_diff('day', s_2, max(s_2) OVER (PARTITION BY customer_id)) AS INTEGER) AS days_ago FROM panel"))(
    lambda spark, sf: H.days_ago(panel_orders(spark, sf), SP).select("customer_id", "seq", "days_ago"))

register("win_sequence_num", W(O.PANEL_ORDERS, MA, final="SELECT customer_id, seq, CAST(max(CASE WHEN months_ago < 13 THEN months_ago END) OVER (PARTITION BY customer_id) - months_ago AS INTEGER) AS sequence_num FROM m"))(
    lambda spark, sf: H.sequence_num(H.months_ago(panel_orders(spark, sf), SP), SP).select("customer_id", "seq", F.col("sequence_num").cast("int")))


# ------------------------------------------------------------------ §2.2 projections, filters
register("scan_panel", W(O.PANEL_ORDERS, final=O.report(O.NUM, ["customer_id", "s_2", "seq", "d_63", "d_64", "dset"], "panel")))(lambda spark, sf: panel_orders(spark, sf))

register("scan_pruned", W(O.PANEL_ORDERS, final=O.report(["p_2"], ["customer_id", "s_2"], "panel")))(
    lambda spark, sf: panel_orders(spark, sf).select("customer_id", "s_2", "p_2"))

register("project_drop", W(O.PANEL_ORDERS, final=O.report(["p_2", "b_1"], ["customer_id", "s_2", "seq", "d_63", "d_64"], "panel")))(
    lambda spark, sf: R.project_drop(panel_orders(spark, sf), ["dset", "d_42", *R.DROP_ALWAYS]))


def _by_role(spark, sf):
    p = panel_orders(spark, sf)
    num, _ = R.select_features_by_role(p, cat=SP.cat)
    return p.select("customer_id", *num)


register("select_features_by_role", W(O.PANEL_ORDERS, final=O.report(O.NUM, ["customer_id"], "panel")))(_by_role)


def _by_pattern(spark, sf):
    f = feat.basic_agg_features(panel_orders(spark, sf), SP)
    return R.select_by_name_pattern(f, r"_last$", keep=("customer_id",))


def _basic():
    from .queries import _basic_sql
    return _basic_sql()


register("select_by_name_pattern", "WITH b AS (" + _basic() + ") SELECT customer_id, p_2_last, b_1_last, d_42_last, d_63_last, d_64_last FROM b")(_by_pattern)


def _null_split(spark, sf):
    """split_cols_by_null_rate: null share per numeric on train; >= 0.90 -> last-only."""
    p = panel_orders(spark, sf).where("dset = 'train'")
    sh = feat.null_shares(p, list(SP.num), SP.sentinel)
    rows = [(c, v, "last" if v >= 0.90 else "full") for c, v in sh.items()]
    return spark.createDataFrame(rows, "feature string, null_share double, kind string")


_share = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1.0 ELSE 0.0 END) AS null_share FROM panel WHERE dset = 'train'" for c in O.NUM)
register("split_cols_by_null_rate", W(O.PANEL_ORDERS, f"s AS ({_share})", "g AS (SELECT feature, CAST(null_share AS DOUBLE) AS null_share, CASE WHEN null_share >= 0.90 THEN 'last' ELSE 'full' END AS kind FROM s)",
                                      final=O.report(["null_share"], ["feature", "kind"])))(_null_split)


def _flag_rate(spark, sf):
    """null_flag_cols_by_rate: keep flags for columns with null share > 0.005."""
    p = panel_orders(spark, sf)
    sh = feat.null_shares(p, list(SP.features), SP.sentinel)
    return spark.createDataFrame([(c, v, v > 0.005) for c, v in sh.items()], "feature string, null_share double, keep_flag boolean")


_share2 = " UNION ALL ".join([f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1.0 ELSE 0.0 END) AS null_share FROM panel" for c in O.NUM]
                             + [f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_share FROM panel" for c in O.CAT])
register("null_flag_cols_by_rate", W(O.PANEL_ORDERS, f"s AS ({_share2})", "g AS (SELECT feature, CAST(null_share AS DOUBLE) AS null_share, null_share > 0.005 AS keep_flag FROM s)",
                                     final=O.report(["null_share"], ["feature", "keep_flag"])))(_flag_rate)

register("rename_suffix", W(O.PANEL_ORDERS, final="SELECT customer_id, s_2 AS s_2_r, seq AS seq_r, " + O.stable("p_2") + " AS p_2_r FROM panel"))(
    lambda spark, sf: R.rename_suffix(panel_orders(spark, sf).select("customer_id", "s_2", "seq", "p_2"), "_r", keep=("customer_id",)))


def _cast_restore(spark, sf):
    p = panel_orders(spark, sf).select("customer_id", "seq", "b_1")
    schema = p.schema
    filled = p.withColumn("seq", F.col("seq").cast("double")).withColumn("b_1", S.sentinel_to_null("b_1")).fillna(-1.0)
    return R.cast_restore(filled, schema)


register("cast_restore", W(O.PANEL_ORDERS, final="SELECT customer_id, seq, CAST(coalesce(" + O.clean("b_1") + ", -1) AS FLOAT) AS b_1 FROM panel"))(_cast_restore)

register("reorder_cols", W(O.PANEL_ORDERS, final="SELECT d_63, d_64, customer_id, s_2, seq, " + ", ".join(O.f(c, c) for c in O.NUM) + ", dset FROM panel"))(
    lambda spark, sf: R.reorder_cols(panel_orders(spark, sf), first=("d_63", "d_64"), last=("dset",)))

register("filter_eq", W(O.PANEL_ORDERS, MA, final="SELECT customer_id, seq, " + O.stable("p_2") + " AS p_2 FROM m WHERE months_ago = 1"))(
    lambda spark, sf: H.months_ago(panel_orders(spark, sf), SP).where("months_ago = 1").select("customer_id", "seq", "p_2"))


def _isin(spark, sf):
    cust = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_id"))
    return panel_orders(spark, sf).join(cust, "customer_id", "left_semi").select("customer_id", "seq")


register("filter_isin", W(O.PANEL_ORDERS, final="SELECT customer_id, seq FROM panel WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"))(_isin)

def _filter_fold(spark, sf):
    """filter_fold: the training rows (other folds) and the validation rows (the fold), as two filters."""
    s = scores(spark, sf).select("id", "val_fold_n")
    return s.where("val_fold_n <> 2").withColumn("is_val", F.lit(False)).unionByName(s.where("val_fold_n = 2").withColumn("is_val", F.lit(True)))


register("filter_fold", W(O.SCORES, final="SELECT id, val_fold_n, val_fold_n = 2 AS is_val FROM scores"))(_filter_fold)

register("sentinel_to_null", W(O.PANEL_ORDERS, PC, final=O.report(["b_1", "d_42"], ["customer_id", "seq"], "pc")))(
    lambda spark, sf: clean_panel(spark, sf).select("customer_id", "seq", "b_1", "d_42"))

register("fill_const", W(O.PANEL_ORDERS, PC, final="SELECT customer_id, seq, CAST(coalesce(d_42, 0) AS FLOAT) AS d_42, coalesce(d_63, '999') AS d_63 FROM pc"))(
    lambda spark, sf: R.fill_const(R.fill_const(clean_panel(spark, sf), 0.0, ["d_42"]), "999", ["d_63"]).select("customer_id", "seq", "d_42", "d_63"))


def _fill_stat(spark, sf):
    p = clean_panel(spark, sf)
    a, _ = R.fill_col_stat(p, ["b_1"], "median")
    b, _ = R.fill_col_stat(a, ["d_42"], "minstd", k=2.0)
    return b.select("customer_id", "seq", "b_1", "d_42")


register("fill_col_stat", W(O.PANEL_ORDERS, PC, "st AS (SELECT median(b_1) AS med, min(d_42) - 2 * stddev_samp(d_42) AS lo FROM pc)",
                            "g AS (SELECT customer_id, seq, coalesce(b_1, med) AS b_1, coalesce(d_42, lo) AS d_42 FROM pc, st)",
                            final=O.report(["b_1", "d_42"], ["customer_id", "seq"])))(_fill_stat)


def _inf(spark, sf):
    p = panel_orders(spark, sf).withColumn("x", F.when(F.col("seq") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("p_2")))
    return R.inf_to_const(p, ["x"], -1.0).select("customer_id", "seq", "x")


register("inf_to_const", W(O.PANEL_ORDERS, "g AS (SELECT customer_id, seq, CASE WHEN seq % 17 = 0 THEN -1 ELSE p_2 END AS x FROM panel)",
                           final=O.report(["x"], ["customer_id", "seq"])))(_inf)

register("masked_update", W(O.PANEL_ORDERS, "g AS (SELECT customer_id, seq, CASE WHEN d_63 IS NULL THEN -3 ELSE b_1 END AS b_1, CASE WHEN d_63 IS NULL THEN -3 ELSE d_42 END AS d_42 FROM panel)",
                            final=O.report(["b_1", "d_42"], ["customer_id", "seq"])))(
    lambda spark, sf: R.masked_update(panel_orders(spark, sf), F.col("d_63").isNull(), ["b_1", "d_42"], -3.0).select("customer_id", "seq", "b_1", "d_42"))

# Per-column caps of the hand-written bounds operator on the fixture
FIXED_BOUNDS = {"p_2": (1000.0, 400000.0), "b_1": (None, 300000.0)}

register("clip_fixed_bounds", W(O.PANEL_ORDERS, PC, "g AS (SELECT customer_id, seq, least(greatest(p_2, 1000), 400000) AS p_2, CASE WHEN b_1 IS NOT NULL THEN least(b_1, 300000) END AS b_1 FROM pc)",
                                final=O.report(["p_2", "b_1"], ["customer_id", "seq"])))(
    lambda spark, sf: R.clip_bounds(clean_panel(spark, sf), FIXED_BOUNDS).select("customer_id", "seq", "p_2", "b_1"))


def _learned_splits(spark, sf):
    """four split values per feature learned from the data (quartile-like cuts of the train split)."""
    p = clean_panel(spark, sf).where("dset = 'train'")
    return exact_quantiles(p, {c: [0.05, 0.1, 0.9, 0.95] for c in ("p_2", "b_1")})


def _clip_learned(spark, sf):
    b = R.learned_bounds(_learned_splits(spark, sf))
    return R.clip_bounds(clean_panel(spark, sf), b).select("customer_id", "seq", "p_2", "b_1")


register("clip_learned_bounds", W(O.PANEL_ORDERS, PC,
                                  "q AS (SELECT quantile_cont(p_2, [0.05, 0.1, 0.9, 0.95]) AS qp, quantile_cont(b_1, [0.05, 0.1, 0.9, 0.95]) AS qb FROM pc WHERE dset = 'train')",
                                  "g AS (SELECT customer_id, seq, least(greatest(p_2, 2 * qp[1] - qp[2]), 2 * qp[4] - qp[3]) AS p_2, CASE WHEN b_1 IS NOT NULL THEN least(greatest(b_1, 2 * qb[1] - qb[2]), 2 * qb[4] - qb[3]) END AS b_1 FROM pc, q)",
                                  final=O.report(["p_2", "b_1"], ["customer_id", "seq"])))(_clip_learned)

register("distinct_entities", W(O.PANEL_ORDERS, final="SELECT DISTINCT customer_id FROM panel"))(
    lambda spark, sf: R.distinct_entities(panel_orders(spark, sf), SP))

register("dedup_keep_first", W(O.PANEL_ORDERS, "d AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS k FROM panel)", final="SELECT customer_id, seq FROM d WHERE k = 1"))(
    lambda spark, sf: H.dedup_keep_first(panel_orders(spark, sf), "customer_id", [F.col("s_2"), F.col("seq")]).select("customer_id", "seq"))


# ------------------------------------------------------------------ §2.3 joins
def _inner_key(spark, sf):
    p = panel_orders(spark, sf)
    a = p.groupBy("customer_id").agg(F.avg("p_2").alias("p_2_mean"))
    b = p.where("d_63 = 'F'").groupBy("customer_id").agg(F.max("s_2").alias("last_f"))
    return a.join(b, "customer_id", "inner")


register("join_inner_key", W(O.PANEL_ORDERS, "a AS (SELECT customer_id, avg(p_2) AS p_2_mean FROM panel GROUP BY 1)",
                             "b AS (SELECT customer_id, max(s_2) AS last_f FROM panel WHERE d_63 = 'F' GROUP BY 1)",
                             "g AS (SELECT * FROM a JOIN b USING (customer_id))", final=O.report(["p_2_mean"], ["customer_id", "last_f"])))(_inner_key)


def _outer3(spark, sf):
    p = panel_orders(spark, sf)
    a = p.where("d_63 = 'F'").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_f"))
    b = p.where("d_64 = '1-URGENT'").groupBy("customer_id").agg(F.sum("p_2").alias("urgent_sum"))
    c = customer_labels(spark, sf).where("target = 1")
    return R.join_features_outer([a, b, c], "customer_id")


register("join_features_outer", W(O.PANEL_ORDERS, O.CUSTOMER_LABELS,
                                  "a AS (SELECT customer_id, count(*) AS n_f FROM panel WHERE d_63 = 'F' GROUP BY 1)",
                                  "b AS (SELECT customer_id, sum(p_2) AS urgent_sum FROM panel WHERE d_64 = '1-URGENT' GROUP BY 1)",
                                  "c AS (SELECT * FROM labels_c WHERE target = 1)",
                                  "g AS (SELECT * FROM a FULL OUTER JOIN b USING (customer_id) FULL OUTER JOIN c USING (customer_id))",
                                  final=O.report(["urgent_sum"], ["customer_id", "n_f", "target"])))(_outer3)


def _join_labels(spark, sf):
    f = panel_orders(spark, sf).where("dset = 'train'").groupBy("customer_id").agg(F.avg("p_2").alias("p_2_mean"))
    return f.join(customer_labels(spark, sf), "customer_id", "inner")


register("join_labels", W(O.PANEL_ORDERS, O.CUSTOMER_LABELS, "f AS (SELECT customer_id, avg(p_2) AS p_2_mean FROM panel WHERE dset = 'train' GROUP BY 1)",
                          "g AS (SELECT * FROM f JOIN labels_c USING (customer_id))", final=O.report(["p_2_mean"], ["customer_id", "target"])))(_join_labels)


def _composite(spark, sf):
    p = panel_orders(spark, sf)
    day = p.groupBy("customer_id", "s_2").agg(F.count(F.lit(1)).alias("n_same_day"))
    return R.join_small(p, day, ["customer_id", "s_2"]).select("customer_id", "seq", "n_same_day")


register("join_composite_key", W(O.PANEL_ORDERS, "d AS (SELECT customer_id, s_2, count(*) AS n_same_day FROM panel GROUP BY 1, 2)",
                                 final="SELECT customer_id, seq, n_same_day FROM panel JOIN d USING (customer_id, s_2)"))(_composite)


def _outer_ind(spark, sf):
    p = H.months_ago(panel_orders(spark, sf), SP).where("months_ago < 13").select("customer_id", "months_ago").distinct()
    cal = R.entity_periods(p, "customer_id", 13)
    return R.join_outer_indicator(p.withColumn("present", F.lit(1)), cal, ["customer_id", "months_ago"]).select("customer_id", "months_ago", "_merge")


register("join_outer_indicator", W(O.PANEL_ORDERS, MA, "p AS (SELECT DISTINCT customer_id, months_ago FROM m WHERE months_ago < 13)",
                                   "cal AS (SELECT customer_id, unnest(range(0, 13)) AS months_ago FROM (SELECT DISTINCT customer_id FROM p))",
                                   final="SELECT customer_id, months_ago, CASE WHEN p.customer_id IS NOT NULL AND cal.customer_id IS NOT NULL THEN 'both' WHEN p.customer_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge "
                                         "FROM p FULL OUTER JOIN cal USING (customer_id, months_ago)"))(_outer_ind)

register("join_cross_calendar", W(O.PANEL_ORDERS, final="SELECT customer_id, CAST(unnest(range(0, 13)) AS INTEGER) AS months_ago FROM (SELECT DISTINCT customer_id FROM panel)"))(
    lambda spark, sf: R.entity_periods(panel_orders(spark, sf), "customer_id", 13))


def _map_lookup(spark, sf):
    p = panel_orders(spark, sf)
    stats = p.where("dset = 'train'").groupBy("d_63").agg(F.avg("p_2").alias("d_63_p2_mean"))
    return R.join_map_lookup(p.where("dset = 'test'").select("customer_id", "seq", "d_63"), stats, "d_63").select("customer_id", "seq", "d_63_p2_mean")


register("join_map_lookup", W(O.PANEL_ORDERS, "st AS (SELECT d_63, avg(p_2) AS d_63_p2_mean FROM panel WHERE dset = 'train' GROUP BY 1)",
                              "g AS (SELECT customer_id, seq, st.d_63_p2_mean FROM panel LEFT JOIN st ON panel.d_63 = st.d_63 WHERE dset = 'test')",
                              final=O.report(["d_63_p2_mean"], ["customer_id", "seq"])))(_map_lookup)


def _group_stats(spark, sf):
    p = panel_orders(spark, sf).withColumn("month", F.trunc("s_2", "MM"))
    st = p.groupBy("month").agg(F.avg("p_2").alias("mu"), F.stddev_samp("p_2").alias("sd"))
    return R.join_small(p, st, "month").select("customer_id", "seq", "mu", "sd")


register("join_group_stats", W(O.PANEL_ORDERS, "st AS (SELECT date_trunc('month', s_2) AS month, avg(p_2) AS mu, stddev_samp(p_2) AS sd FROM panel GROUP BY 1)",
                               "g AS (SELECT customer_id, seq, mu, sd FROM panel JOIN st ON date_trunc('month', s_2) = st.month)",
                               final=O.report(["mu", "sd"], ["customer_id", "seq"])))(_group_stats)

register("join_semi", W(O.PANEL_ORDERS, O.CUSTOMER_LABELS, final="SELECT customer_id, seq FROM panel WHERE customer_id IN (SELECT customer_id FROM labels_c WHERE target = 1)"))(
    lambda spark, sf: panel_orders(spark, sf).join(customer_labels(spark, sf).where("target = 1"), "customer_id", "left_semi").select("customer_id", "seq"))

register("join_anti", W(O.PANEL_ORDERS, O.CUSTOMER_LABELS, final="SELECT customer_id, seq FROM panel WHERE customer_id NOT IN (SELECT customer_id FROM labels_c WHERE target = 1)"))(
    lambda spark, sf: panel_orders(spark, sf).join(customer_labels(spark, sf).where("target = 1"), "customer_id", "left_anti").select("customer_id", "seq"))


def _aligned(spark, sf):
    """join_aligned_subtract: last-statement frame minus first-statement frame,
    aligned by entity with conditional aggregates (no join)."""
    p = A.with_order_key(clean_panel(spark, sf), SP)
    g = p.groupBy("customer_id").agg(*[F.max_by(c, F.col(A.OK)).alias(f"__l_{c}") for c in SP.num],
                                     *[F.min_by(c, F.col(A.OK)).alias(f"__f_{c}") for c in SP.num])
    return g.select("customer_id", *[(F.col(f"__l_{c}") - F.col(f"__f_{c}")).alias(f"{c}_last_minus_first_row") for c in SP.num])


register("join_aligned_subtract", W(O.PANEL_ORDERS, PC, RANKED, "g AS (SELECT customer_id, " + ", ".join(
    f"max(CASE WHEN rd = 1 THEN {c} END) - max(CASE WHEN rn = 1 THEN {c} END) AS {c}_last_minus_first_row" for c in O.NUM) + " FROM r GROUP BY 1)",
    final=O.report([f"{c}_last_minus_first_row" for c in O.NUM], ["customer_id"])))(_aligned)

register("join_positional", W(O.PANEL_ORDERS, final="SELECT customer_id, seq, b_1 IS NULL OR b_1 = -1 AS b_1_is_null, CAST(b_1 AS FLOAT) AS b_1 FROM panel"))(
    lambda spark, sf: panel_orders(spark, sf).select("customer_id", "seq", S.is_null_or_sentinel("b_1").alias("b_1_is_null"), "b_1"))


# ------------------------------------------------------------------ §2.6 sorts, limits
register("sort_multi_key", W(O.PANEL_ORDERS, MA, final="SELECT customer_id, CAST(months_ago AS INTEGER) AS months_ago, seq FROM m ORDER BY customer_id, months_ago DESC, seq"))(
    lambda spark, sf: H.months_ago(panel_orders(spark, sf), SP).select("customer_id", F.col("months_ago").cast("int"), "seq")
    .orderBy("customer_id", F.desc("months_ago"), "seq"))


def _restore(spark, sf):
    """sort_restore_order: keep an order column through a join, sort at the sink."""
    p = panel_orders(spark, sf).select("customer_id", "seq", "d_64")
    vc = p.groupBy("d_64").agg(F.count(F.lit(1)).alias("n"))
    return R.join_small(p, vc, "d_64").orderBy("seq").select("seq", "customer_id", "n")


register("sort_restore_order", W(O.PANEL_ORDERS, final="SELECT seq, customer_id, count(*) OVER (PARTITION BY d_64) AS n FROM panel ORDER BY seq"))(_restore)


def _sort_imp(spark, sf):
    """sort_importances: feature importances (here: non-missing share) descending."""
    p = panel_orders(spark, sf)
    sh = feat.null_shares(p, list(SP.features), SP.sentinel)
    return spark.createDataFrame([(c, 1.0 - v) for c, v in sh.items()], "feature string, importance double").orderBy(F.desc("importance"), "feature")


_imp = " UNION ALL ".join([f"SELECT '{c}' AS feature, 1.0 - avg(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1.0 ELSE 0.0 END) AS importance FROM panel" for c in O.NUM]
                          + [f"SELECT '{c}' AS feature, 1.0 - avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS importance FROM panel" for c in O.CAT])
register("sort_importances", W(O.PANEL_ORDERS, f"g AS ({_imp})", final=O.report(["importance"], ["feature"]) + " ORDER BY importance DESC, feature"))(_sort_imp)

register("limit_preview", "WITH d AS (" + __import__("panelspark.plans.queries", fromlist=["DATE_SQL"]).DATE_SQL + ") SELECT * FROM d ORDER BY customer_id LIMIT 10")(
    lambda spark, sf: feat.date_features(panel_orders(spark, sf), SP).orderBy("customer_id").limit(10))


# ------------------------------------------------------------------ §2.7 set operations
def _union_tagged(spark, sf):
    p = panel_orders(spark, sf).drop("dset")
    tr, te = p.where("customer_id % 5 <> 0"), p.where("customer_id % 5 = 0")
    return R.union_tagged(tr, te).select("customer_id", "seq", "dset")


register("union_tagged", W(O.PANEL_ORDERS, final="SELECT customer_id, seq, 'train' AS dset FROM panel WHERE customer_id % 5 <> 0 UNION ALL SELECT customer_id, seq, 'test' AS dset FROM panel WHERE customer_id % 5 = 0"))(_union_tagged)


def _union_aug(spark, sf):
    p = panel_orders(spark, sf)
    full = p.groupBy("customer_id").agg(F.avg("p_2").alias("p_2_mean"), F.count(F.lit(1)).alias("n")).withColumn("aug", F.lit(0))
    ex = H.except_last(p, SP).groupBy("customer_id").agg(F.avg("p_2").alias("p_2_mean"), F.count(F.lit(1)).alias("n")).withColumn("aug", F.lit(1))
    return R.union_augment(full, ex)


register("union_augment", W(O.PANEL_ORDERS, "e AS (SELECT * FROM panel WHERE s_2 < (SELECT max(s_2) FROM panel p2 WHERE p2.customer_id = panel.customer_id))",
                            "g AS (SELECT customer_id, avg(p_2) AS p_2_mean, count(*) AS n, 0 AS aug FROM panel GROUP BY 1 UNION ALL SELECT customer_id, avg(p_2), count(*), 1 FROM e GROUP BY 1)",
                            final=O.report(["p_2_mean"], ["customer_id", "n", "aug"])))(_union_aug)

register("union_all_nth", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", final="SELECT customer_id, seq, CAST(rd AS INTEGER) AS nth FROM r WHERE rd <= 3"))(
    lambda spark, sf: H.rank_desc(panel_orders(spark, sf), SP, "nth").where("nth <= 3").select("customer_id", "seq", "nth"))

register("except_last", W(O.PANEL_ORDERS, "d AS (SELECT *, dense_rank() OVER (PARTITION BY customer_id ORDER BY s_2 DESC) AS dr FROM panel)", final="SELECT customer_id, seq FROM d WHERE dr > 1"))(
    lambda spark, sf: H.except_last(panel_orders(spark, sf), SP, 1).select("customer_id", "seq"))


def _trend(spark, sf):
    """apply_panel: slope and curvature of p_2 over each customer's last 13 statements, by numpy."""
    def fit(pdf):
        import numpy as np
        import pandas as pd
        y = pdf["p_2"].to_numpy()
        x = np.arange(len(y), dtype=float)
        dx = x - x.mean()
        slope = float((dx * y).sum() / (dx * dx).sum()) if len(y) > 1 else None
        return pd.DataFrame({"customer_id": [pdf["customer_id"].iloc[0]], "n": [len(y)], "slope": [slope]})

    return H.apply_panel(panel_orders(spark, sf).select("customer_id", "s_2", "seq", "p_2"), SP, fit, "customer_id long, n long, slope double")


register("apply_panel", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", "l AS (SELECT customer_id, p_2, row_number() OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS x FROM r WHERE rd <= 13)",
                          "g AS (SELECT customer_id, count(*)::BIGINT AS n, regr_slope(p_2, x) AS slope FROM l GROUP BY customer_id)", final=O.report(["slope"], ["customer_id", "n"])))(_trend)


def _halves(spark, sf):
    """split_half_by_entity: both halves of the panel, each customer whole in one of them."""
    halves = R.split_half_by_entity(panel_orders(spark, sf), "customer_id")
    sides = [h.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows")) for h in halves]
    return sides[0].unionByName(sides[1])


register("split_half_by_entity", W(O.PANEL_ORDERS, final="SELECT customer_id, count(*)::BIGINT AS rows FROM panel GROUP BY customer_id"))(_halves)


# ------------------------------------------------------------------ §2.8 scalar functions
def _row_fn(key, spark_cols, sql_cols, src="panel", floats=(), clean=False):
    def q(spark, sf):
        p = clean_panel(spark, sf) if clean else panel_orders(spark, sf)
        return p.select("customer_id", "seq", *spark_cols())
    others = ["customer_id", "seq"] + [c for c in sql_cols if c not in floats]
    ctes = [O.PANEL_ORDERS] + ([PC] if clean else []) + [f"g AS (SELECT customer_id, seq, {', '.join(f'{e} AS {n}' for n, e in sql_cols.items())} FROM {'pc' if clean else 'panel'})"]
    register(key, W(*ctes, final=O.report(list(floats), others)))(q)


_row_fn("fn_parse_date", lambda: [S.parse_date("s_2").cast("timestamp_ntz").alias("d"), S.parse_date(F.date_format("s_2", "yyyy-MM-dd"), "yyyy-MM-dd").cast("timestamp_ntz").alias("d2")],
        {"d": "CAST(CAST(s_2 AS DATE) AS TIMESTAMP)", "d2": "CAST(CAST(strptime(strftime(s_2, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS TIMESTAMP)"})
_row_fn("fn_month", lambda: [S.month("s_2").alias("m")], {"m": "CAST(month(s_2) AS INTEGER)"})
_row_fn("fn_period_month", lambda: [S.period_month("s_2").cast("timestamp_ntz").alias("pm")], {"pm": "CAST(date_trunc('month', s_2) AS TIMESTAMP)"})
_row_fn("fn_ratio", lambda: [S.ratio("p_2", F.col("b_1") + 1).alias("r")], {"r": "p_2 / nullif(b_1 + 1, 0)"}, floats=["r"])
_row_fn("fn_diff", lambda: [S.diff("p_2", "b_1").alias("d")], {"d": "p_2 - b_1"}, floats=["d"])
_row_fn("fn_modulo", lambda: [S.pmod(F.month("s_2") - 7, 12).alias("m")], {"m": "CAST((((month(s_2) - 7) % 12) + 12) % 12 AS INTEGER)"})
_row_fn("fn_round2", lambda: [S.round2(F.col("p_2") / 7).alias("r")], {"r": "round_even(p_2 / 7, 2)"}, floats=["r"])
_row_fn("fn_clip", lambda: [S.clip("b_1", 0.0, 250000.0).alias("c")], {"c": "least(greatest(b_1, 0), 250000)"}, floats=["c"])
_row_fn("fn_cast_string", lambda: [S.cast_string("seq").alias("s")], {"s": "CAST(seq AS VARCHAR)"})
_row_fn("fn_chars", lambda: [S.chars("d_64").alias("chars")], {"chars": "string_split(lower(d_64), '')"})
_row_fn("fn_is_null_or_sentinel", lambda: [S.is_null_or_sentinel("b_1").alias("b_1_na"), S.is_null_or_sentinel("d_63", None).alias("d_63_na")],
        {"b_1_na": "b_1 IS NULL OR b_1 = -1", "d_63_na": "d_63 IS NULL"})
_row_fn("fn_row_null_count", lambda: [S.row_null_count(["p_2", "b_1", "d_42"]).alias("na_num"), F.col("d_63").isNull().cast("int").alias("na_cat")],
        {"na_num": "CAST((p_2 = -1) AS INTEGER) + CAST((b_1 = -1) AS INTEGER) + CAST((d_42 = -1) AS INTEGER)", "na_cat": "CAST((d_63 IS NULL) AS INTEGER)"})


def _logit(spark, sf):
    return scores(spark, sf).select("id", S.logit("prediction").alias("logit"))


register("fn_logit", W(O.SCORES, "g AS (SELECT id, ln(least(greatest(prediction, 0.0001), 0.9999) / (1 - least(greatest(prediction, 0.0001), 0.9999))) AS logit FROM scores)",
                       final=O.report(["logit"], ["id"])))(_logit)


def _log1p(spark, sf):
    p = panel_orders(spark, sf)
    mn, mx = p.agg(F.min("p_2"), F.max("p_2")).first()
    return p.select("customer_id", "seq", S.log1p_shift("p_2", mn).alias("log_r"), S.log1p_reflect("p_2", mx).alias("log_l"))


register("fn_log1p_shift", W(O.PANEL_ORDERS, "st AS (SELECT min(p_2) AS mn, max(p_2) AS mx FROM panel)",
                             "g AS (SELECT customer_id, seq, ln(1 + p_2 - mn) AS log_r, ln(1 + mx - p_2) AS log_l FROM panel, st)",
                             final=O.report(["log_r", "log_l"], ["customer_id", "seq"])))(_log1p)


def _z(spark, sf):
    p = panel_orders(spark, sf)
    mu, sd = p.agg(F.avg("p_2"), F.stddev_samp("p_2")).first()
    return p.select("customer_id", "seq", S.zscore("p_2", F.lit(mu), F.lit(sd)).alias("z"))


register("fn_zscore", W(O.PANEL_ORDERS, "st AS (SELECT avg(p_2) AS mu, stddev_samp(p_2) AS sd FROM panel)",
                        "g AS (SELECT customer_id, seq, (p_2 - mu) / nullif(sd, 0) AS z FROM panel, st)", final=O.report(["z"], ["customer_id", "seq"])))(_z)


def _join_string(spark, sf):
    p = panel_orders(spark, sf)
    return p.groupBy("customer_id").agg(S.join_string(F.array_sort(F.collect_set("d_64"))).alias("cats"))


register("fn_join_string", W(O.PANEL_ORDERS, final="SELECT customer_id, string_agg(DISTINCT d_64, ' ' ORDER BY d_64) AS cats FROM panel GROUP BY 1"))(_join_string)

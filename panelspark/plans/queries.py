"""Registered queries over the fixture panels (one per SURVEY §2 key)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat
from ..sources.fixtures import ORDERS_SPEC, panel_orders
from . import oracle as O
from .catalog import register


def _basic_sql(clean: bool = False, na_count: bool = False) -> str:
    src = "panel"
    ctes = [O.PANEL_ORDERS]
    if clean:
        cols = ", ".join(f"{O.clean(c)} AS {c}" for c in O.NUM)
        ctes.append(f"pc AS (SELECT customer_id, s_2, seq, {cols}, d_63, d_64 FROM panel)")
        src = "pc"
    ctes.append(f"r AS ({O.ranked(src)})")
    ctes += [O.mode_cte(c, src) for c in O.CAT]
    items, floats = [], []
    for c in O.NUM:
        i, n = O.num_aggs(c)
        items += i
        floats += n
        if na_count:
            items.append(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}_na_count")
    for c in O.CAT:
        items += O.cat_aggs(c)
    ctes.append(f"a AS (SELECT customer_id, {', '.join(items)} FROM r GROUP BY customer_id)")
    derived = []
    for c in O.NUM:
        derived += [f"{c}_last / nullif({c}_mean, 0) AS {c}_last_pct_mean",
                    f"{c}_last - {c}_mean AS {c}_diff_mean",
                    f"{c}_last - {c}_first AS {c}_last_minus_first"]
        floats += [f"{c}_last_pct_mean", f"{c}_diff_mean", f"{c}_last_minus_first"]
    joins = " ".join(f"LEFT JOIN mode_{c} USING (customer_id)" for c in O.CAT)
    ctes.append(f"g AS (SELECT a.*, {', '.join(f'{c}_mode' for c in O.CAT)}, {', '.join(derived)} FROM a {joins})")
    others = ["customer_id"] + [f"{c}_{k}" for c in O.CAT for k in ("mode", "last", "first", "nunique")]
    if na_count:
        others += [f"{c}_na_count" for c in O.NUM]
    return "WITH " + ",\n".join(ctes) + "\n" + O.report(floats, others)


@register("basic_agg_features", _basic_sql())
def q_basic_agg_features(spark, sf):
    """num {mean,std,min,max,last,first}, cat {mode,last,first,nunique}, 3 derived."""
    return feat.basic_agg_features(panel_orders(spark, sf), ORDERS_SPEC)


@register("null_handled_agg_features", _basic_sql(clean=True, na_count=True))
def q_null_handled(spark, sf):
    """basic aggregates after -1 -> NULL plus na_count."""
    return feat.null_handled_agg_features(panel_orders(spark, sf), ORDERS_SPEC)


# ------------------------------------------------------------------ helpers
def _sql(ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def _clean_cte(name: str = "pc", cols=O.NUM, src: str = "panel") -> str:
    c = ", ".join(f"{O.clean(x)} AS {x}" for x in cols)
    return f"{name} AS (SELECT customer_id, s_2, seq, {c}, d_63, d_64, dset FROM {src})"


def _refined_sql(med: bool = False) -> str:
    full, last_only = ["p_2", "b_1"], ["d_42"]
    ctes = [O.PANEL_ORDERS, _clean_cte(), f"r AS ({O.ranked('pc')})"]
    items, floats = [], []
    funcs = ("median", "std", "min", "max", "last", "first") if med else ("mean", "std", "min", "max", "last", "first")
    for c in full:
        i, n = O.num_aggs(c, funcs)
        items += i
        floats += n
    for c in last_only:
        i, n = O.num_aggs(c, ("last",))
        items += i
        floats += n
    windows = ((3, "median"), (7, "median")) if med else ((5, "mean"),)
    for k, stat in windows:
        for c in full:
            i, n = O.num_aggs(c, (stat, "std"), name=f"{c}_{k}sts", cond=f"rd <= {k}")
            items += i
            floats += n
    for c in O.CAT:
        items += O.cat_aggs(c)
    ctes.append(f"a AS (SELECT customer_id, {', '.join(items)} FROM r GROUP BY customer_id)")
    der = []
    for c in full:
        if med:
            pairs = [("last_minus_median", f"{c}_last - {c}_median"), ("last_minus_first", f"{c}_last - {c}_first"),
                     ("last_minus_3sts_median", f"{c}_last - {c}_3sts_median"),
                     ("last_minus_7sts_median", f"{c}_last - {c}_7sts_median"),
                     ("3sts_median_minus_median", f"{c}_3sts_median - {c}_median"),
                     ("3sts_median_minus_7sts_median", f"{c}_3sts_median - {c}_7sts_median")]
        else:
            pairs = [("last_minus_mean", f"{c}_last - {c}_mean"), ("last_minus_first", f"{c}_last - {c}_first"),
                     ("last_minus_5sts_mean", f"{c}_last - {c}_5sts_mean"),
                     ("5sts_mean_minus_mean", f"{c}_5sts_mean - {c}_mean")]
        for nm, e in pairs:
            der.append(f"{e} AS {c}_{nm}")
            floats.append(f"{c}_{nm}")
    ctes.append(f"g AS (SELECT a.*, {', '.join(der)} FROM a)")
    others = ["customer_id"] + [f"{c}_{k}" for c in O.CAT for k in ("last", "first", "nunique")]
    return _sql(ctes, O.report(floats, others))


@register("refined_agg_features", _refined_sql())
def q_refined(spark, sf):
    """null-rate split on train; full + last-5 aggregates; cat last/first/nunique."""
    p = panel_orders(spark, sf)
    return feat.refined_agg_features(p, ORDERS_SPEC, fit_df=p.where("dset = 'train'"))


@register("refined_agg_features_median_3_7", _refined_sql(med=True))
def q_refined_med(spark, sf):
    """median variant with last-3 / last-7 windows."""
    p = panel_orders(spark, sf)
    return feat.refined_agg_features_median_3_7(p, ORDERS_SPEC, fit_df=p.where("dset = 'train'"))


def _after_pay_sql() -> str:
    pairs = [("b_1", "p_2"), ("d_42", "p_2")]
    cols = ", ".join(f"{b} - {p} AS {b}_minus_{p}" for b, p in pairs)
    ctes = [O.PANEL_ORDERS, f"ap AS (SELECT customer_id, s_2, seq, {cols} FROM panel)", f"r AS ({O.ranked('ap')})"]
    items, floats = [], []
    for b, p in pairs:
        i, n = O.num_aggs(f"{b}_minus_{p}")
        items += i
        floats += n
    ctes.append(f"g AS (SELECT customer_id, {', '.join(items)} FROM r GROUP BY customer_id)")
    return _sql(ctes, O.report(floats, ["customer_id"]))


@register("after_pay_agg_features", _after_pay_sql())
def q_after_pay(spark, sf):
    """b - p balance differences (raw values) -> mean,std,min,max,last,first."""
    return feat.after_pay_agg_features(panel_orders(spark, sf), ORDERS_SPEC, ["b_1", "d_42"], ["p_2"])


def _na_agg_sql() -> str:
    feats = list(O.NUM) + list(O.CAT)
    fl = ", ".join([f"(coalesce({c} = -1, true) OR {c} IS NULL) AS {c}_is_null" for c in O.NUM]
                   + [f"({c} IS NULL) AS {c}_is_null" for c in O.CAT])
    ctes = [O.PANEL_ORDERS, f"fl AS (SELECT customer_id, s_2, seq, {fl} FROM panel)",
            "r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS rn, "
            "count(*) OVER (PARTITION BY customer_id) AS n FROM fl)"]
    # first run of True: start p = first True; end = first False after p
    st = [f"p_{c} AS (SELECT customer_id, min(rn) AS p FROM r WHERE {c}_is_null GROUP BY customer_id)" for c in feats]
    ctes += st
    ctes += [f"q_{c} AS (SELECT r.customer_id, min(rn) AS q FROM r JOIN p_{c} USING (customer_id) "
             f"WHERE NOT {c}_is_null AND rn > p GROUP BY r.customer_id)" for c in feats]
    items, floats, others = [], [], ["customer_id"]
    for c in feats:
        f_ = f"{c}_is_null"
        items += [f"avg(CAST({f_} AS INTEGER)) AS {f_}_mean", f"CAST(sum(CAST({f_} AS INTEGER)) AS BIGINT) AS {f_}_sum",
                  f"CAST(arg_max(CAST({f_} AS INTEGER), rn) AS INTEGER) AS {f_}_last"]
        floats.append(f"{f_}_mean")
        others += [f"{f_}_sum", f"{f_}_last", f"{f_}_first_streak", f"{f_}_at_random_sum"]
    ctes.append(f"a AS (SELECT customer_id, max(n) AS n, {', '.join(items)} FROM r GROUP BY customer_id)")
    streak = []
    joins = []
    for c in feats:
        f_ = f"{c}_is_null"
        s = f"CAST(CASE WHEN p_{c}.p IS NULL THEN 0 WHEN q_{c}.q IS NULL THEN n - p_{c}.p + 1 ELSE q_{c}.q - p_{c}.p END AS BIGINT)"
        streak += [f"{s} AS {f_}_first_streak", f"{f_}_sum - {s} AS {f_}_at_random_sum"]
        joins.append(f"LEFT JOIN p_{c} USING (customer_id) LEFT JOIN q_{c} USING (customer_id)")
    ctes.append(f"g AS (SELECT a.*, {', '.join(streak)} FROM a {' '.join(joins)})")
    return _sql(ctes, O.report(floats, others))


@register("na_agg_features", _na_agg_sql())
def q_na_agg(spark, sf):
    """null flags -> mean, sum, last, first_streak, at_random_sum."""
    return feat.na_agg_features(panel_orders(spark, sf), ORDERS_SPEC)


DATE_SQL = _sql([
    O.PANEL_ORDERS,
    "m AS (SELECT customer_id, s_2, seq, month(s_2) - lag(month(s_2)) OVER (PARTITION BY customer_id ORDER BY s_2, seq) AS d FROM panel)",
    "gp AS (SELECT customer_id, s_2, seq, CASE WHEN ((d % 12) + 12) % 12 = 0 THEN 12 ELSE ((d % 12) + 12) % 12 END - 1 AS month_gap FROM m)",
    f"r AS ({O.ranked('gp')})",
    "a AS (SELECT customer_id, CAST(count(month_gap) AS BIGINT) AS month_gap_count, CAST(coalesce(sum(month_gap), 0) AS BIGINT) AS month_gap_sum, "
    "max(month_gap) AS mx, stddev_samp(month_gap) AS sd, avg(month_gap) AS mu, "
    "arg_max(month_gap, rn) FILTER (WHERE month_gap IS NOT NULL) AS lst FROM r GROUP BY customer_id)",
    "g AS (SELECT customer_id, month_gap_count, month_gap_sum, coalesce(CAST(mx AS DOUBLE), -1) AS month_gap_max, "
    "coalesce(sd, -1) AS month_gap_std, coalesce(mu, -1) AS month_gap_mean, coalesce(CAST(lst AS DOUBLE), -1) AS month_gap_last, "
    "coalesce(lst - mu, -1) AS month_gap_minus_mean FROM a)"],
    O.report(["month_gap_max", "month_gap_std", "month_gap_mean", "month_gap_last", "month_gap_minus_mean"],
             ["customer_id", "month_gap_count", "month_gap_sum"]))


@register("date_features", DATE_SQL)
def q_date(spark, sf):
    """month-gap statistics between consecutive statements."""
    return feat.date_features(panel_orders(spark, sf), ORDERS_SPEC)


SAMPLING_SQL = _sql([
    O.PANEL_ORDERS,
    "l AS (SELECT customer_id, max(s_2) AS last_d FROM panel GROUP BY customer_id)",
    "g AS (SELECT customer_id, count(*) OVER (PARTITION BY last_d) / CAST(count(*) OVER (PARTITION BY month(last_d)) AS DOUBLE) AS s_2_month_freq FROM l)"],
    O.report(["s_2_month_freq"], ["customer_id"]))


@register("sampling_features", SAMPLING_SQL)
def q_sampling(spark, sf):
    """share of entities whose last statement is on that date within its month-of-year."""
    return feat.sampling_features(panel_orders(spark, sf), ORDERS_SPEC)


def _diff_sql() -> str:
    ctes = [O.PANEL_ORDERS, _clean_cte(), f"r AS ({O.ranked('pc')})"]
    items = []
    for c in O.NUM:
        for k in (1, 2, 3):
            items.append(f"max(CASE WHEN rd = {k} THEN {c} END) AS {c}_{k}")
    ctes.append(f"a AS (SELECT customer_id, {', '.join(items)} FROM r GROUP BY customer_id)")
    outs, floats = [], []
    for c in O.NUM:
        for p in (1, 2):
            outs.append(f"coalesce({c}_1 - {c}_{p + 1}, -1) AS {c}_diff_{p}")
            floats.append(f"{c}_diff_{p}")
    ctes.append(f"g AS (SELECT customer_id, {', '.join(outs)} FROM a)")
    return _sql(ctes, O.report(floats, ["customer_id"]))


@register("diff_features", _diff_sql())
def q_diff(spark, sf):
    """last - value 1 and 2 statements earlier, missing -> -1."""
    return feat.diff_features(panel_orders(spark, sf), ORDERS_SPEC)


def _diff_agg_sql() -> str:
    d = ", ".join(f"coalesce({c} - lag({c}) OVER (PARTITION BY customer_id ORDER BY s_2, seq), -1) AS {c}_diff1" for c in O.NUM)
    ctes = [O.PANEL_ORDERS, _clean_cte(),
            f"dd AS (SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY s_2 DESC, seq DESC) AS rd, {d} FROM pc)"]
    items, floats = [], []
    for c in O.NUM:
        i, n = O.num_aggs(f"{c}_diff1", ("mean", "std", "min", "max"))
        items += i
        floats += n
    ctes.append(f"g AS (SELECT customer_id, {', '.join(items)} FROM dd WHERE rd < 13 GROUP BY customer_id)")
    return _sql(ctes, O.report(floats, ["customer_id"]))


@register("diff_agg_features", _diff_agg_sql())
def q_diff_agg(spark, sf):
    """consecutive differences over the last 13 statements -> mean,std,min,max."""
    return feat.diff_agg_features(panel_orders(spark, sf), ORDERS_SPEC)


def _group_rel_sql() -> str:
    f32 = lambda e: f"CAST(CAST({e} AS FLOAT) AS DOUBLE)"
    ctes = [O.PANEL_ORDERS, _clean_cte(), f"r AS ({O.ranked('pc')})"]
    # month groups per split, all numerics
    st = ", ".join(f"{f32(f'avg({c})')} AS mu_{c}, {f32(f'stddev_samp({c})')} AS sd_{c}" for c in O.NUM)
    ctes.append(f"ms AS (SELECT date_trunc('month', s_2) AS g, dset, {st} FROM pc GROUP BY 1, 2)")
    z = ", ".join(f"({c} - mu_{c}) / nullif(sd_{c}, 0) AS {c}_rel_s_2_mean" for c in O.NUM)
    ctes.append(f"mz AS (SELECT r.customer_id, r.rn, {z} FROM r JOIN ms ON date_trunc('month', r.s_2) = ms.g AND r.dset = ms.dset)")
    floats = []
    aggs = []
    for c in O.NUM:
        i, n = O.num_aggs(f"{c}_rel_s_2_mean", ("mean", "std", "last", "min", "max"))
        aggs += i
        floats += n
    ctes.append(f"ma AS (SELECT customer_id, {', '.join(aggs)} FROM mz GROUP BY customer_id)")
    joined = "ma"
    for cat in O.CAT:
        imp = ["p_2", "b_1"]
        st = ", ".join(f"{f32(f'avg({c})')} AS mu_{c}, {f32(f'stddev_samp({c})')} AS sd_{c}" for c in imp)
        ctes.append(f"cs_{cat} AS (SELECT {cat} AS g, {st} FROM pc WHERE {cat} IS NOT NULL GROUP BY 1)")
        z = ", ".join(f"({c} - mu_{c}) / nullif(sd_{c}, 0) AS {c}_rel_{cat}_mean" for c in imp)
        ctes.append(f"cz_{cat} AS (SELECT r.customer_id, r.rn, {z} FROM r JOIN cs_{cat} ON r.{cat} = cs_{cat}.g)")
        aggs = []
        for c in imp:
            i, n = O.num_aggs(f"{c}_rel_{cat}_mean", ("mean", "std", "last", "min", "max"))
            aggs += i
            floats += n
        ctes.append(f"ca_{cat} AS (SELECT customer_id, {', '.join(aggs)} FROM cz_{cat} GROUP BY customer_id)")
        joined += f" FULL OUTER JOIN ca_{cat} USING (customer_id)"
    ctes.append(f"g AS (SELECT * FROM {joined})")
    return _sql(ctes, O.report(floats, ["customer_id"]))


@register("group_rel_features", _group_rel_sql())
def q_group_rel(spark, sf):
    """z-scores vs month group (per split) and vs category groups, aggregated over time."""
    return feat.group_rel_features(panel_orders(spark, sf), ORDERS_SPEC, important=["p_2", "b_1"])


def _flat_his_sql() -> str:
    ctes = [O.PANEL_ORDERS, f"r AS ({O.ranked()})",
            "t AS (SELECT *, count(*) OVER (PARTITION BY customer_id) - rd AS pos FROM r WHERE rd <= 13)"]
    items, floats = [], []
    for c in ("p_2", "b_1"):
        for i in range(12):
            items.append(f"max(CASE WHEN pos = {i} THEN {c} END) AS {c}_his_{i}")
            floats.append(f"{c}_his_{i}")
    ctes.append(f"g AS (SELECT customer_id, {', '.join(items)} FROM t GROUP BY customer_id)")
    return _sql(ctes, O.report(floats, ["customer_id"]))


@register("flat_history_features", _flat_his_sql())
def q_flat_his(spark, sf):
    """p_2, b_1 positional history his_0..his_11 (oldest first, left-aligned)."""
    return feat.flat_history_features(panel_orders(spark, sf), ORDERS_SPEC, ["p_2", "b_1"])


def _flatten_sql() -> str:
    ctes = [O.PANEL_ORDERS,
            "m AS (SELECT *, max(year(s_2) * 12 + month(s_2)) OVER (PARTITION BY customer_id) - (year(s_2) * 12 + month(s_2)) AS ma FROM panel)",
            "d AS (SELECT *, row_number() OVER (PARTITION BY customer_id, ma ORDER BY s_2 DESC, seq DESC) AS k FROM m WHERE ma < 13)"]
    items, floats, others = [], [], ["customer_id"]
    for i in range(13):
        for c in list(O.NUM) + list(O.CAT):
            if c in O.NUM:
                items.append(f"coalesce(max(CASE WHEN ma = {i} THEN {c} END), -1) AS {c}_{i}")
                floats.append(f"{c}_{i}")
            else:
                items.append(f"coalesce(max(CASE WHEN ma = {i} THEN {c} END), '-1') AS {c}_{i}")
                others.append(f"{c}_{i}")
    ctes.append(f"g AS (SELECT customer_id, {', '.join(items)} FROM d WHERE k = 1 GROUP BY customer_id)")
    return _sql(ctes, O.report(floats, others))


@register("flatten_full_history", _flatten_sql())
def q_flatten(spark, sf):
    """every feature x months-ago 0..12 (last row per month), missing -> -1."""
    return feat.flatten_full_history(panel_orders(spark, sf), ORDERS_SPEC)


#: Twelve columns that are null where b_1 is: one cluster above the size rule.
_WIDE = {f"b_1_x{i}": i for i in range(1, 13)}
NA_CLUSTERS_SQL = _sql([
    O.PANEL_ORDERS,
    "c AS (" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST(sum(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1 ELSE 0 END) AS BIGINT) AS na_count FROM panel"
        for n, c in [*((c, c) for c in O.NUM), *((n, "b_1") for n in _WIDE)]) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS na_count FROM panel"
        for c in O.CAT) + ")"],
    "SELECT na_count, list(feature ORDER BY feature) AS features, CAST(count(*) AS BIGINT) AS n_features "
    "FROM c WHERE na_count > 0 GROUP BY na_count HAVING count(*) > 10")


@register("na_clusters", NA_CLUSTERS_SQL)
def q_na_clusters(spark, sf):
    """columns grouped by equal null count, clusters of more than 10 columns."""
    p = panel_orders(spark, sf).withColumns({c: F.col(c).cast("double") for c in ORDERS_SPEC.num})
    wide = p.withColumns({n: F.when(F.col("b_1") != -1, F.col("b_1") * i) for n, i in _WIDE.items()})
    return feat.na_clusters(wide, [*ORDERS_SPEC.features, *_WIDE])

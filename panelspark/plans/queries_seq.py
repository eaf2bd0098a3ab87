"""Registered queries: calendar completion, sequences, array operators and
encoders (SURVEY §2.9, §2.10) on the fixture panels."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import history as H
from ..operators import relational as R
from ..operators import sequences as Q
from ..operators.quantiles import exact_quantiles
from ..sources.fixtures import DAYS_SPEC as DS
from ..sources.fixtures import ORDERS_SPEC as SP
from ..sources.fixtures import panel_days, panel_orders
from . import oracle as O
from .catalog import register

DN = list(O.DAYS_NUM)
DAY_AGO = "date_diff('day', s_2, max(s_2) OVER (PARTITION BY customer_id))"
MONTH_AGO = "max(year(s_2) * 12 + month(s_2)) OVER (PARTITION BY customer_id) - (year(s_2) * 12 + month(s_2))"


def W(*ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def cal_sql(src: str = "panel", ago: str = DAY_AGO, order: str = "s_2", pre: str = "") -> list[str]:
    """Calendar completion in SQL: views rows1 (last row per period), d (dense)."""
    return [
        f"rows0 AS (SELECT *, {ago} AS months_ago{pre} FROM {src})",
        f"rows1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, months_ago ORDER BY {O.desc(order)}) AS kk FROM rows0 WHERE months_ago < 13) t WHERE kk = 1)",
        "cal AS (SELECT customer_id AS cid, CAST(unnest(range(0, 13)) AS BIGINT) AS ma FROM (SELECT DISTINCT customer_id FROM rows1) t)",
        "d0 AS (SELECT cal.cid, cal.ma, rows1.*, rows1.customer_id IS NOT NULL AS present FROM cal LEFT JOIN rows1 ON cal.cid = rows1.customer_id AND cal.ma = rows1.months_ago)",
        "d1 AS (SELECT *, max(CASE WHEN present THEN ma END) OVER (PARTITION BY cid) AS vmax FROM d0)",
        "d AS (SELECT *, CAST((NOT present AND ma < vmax) AS INTEGER) AS missing_statement, CAST((NOT present AND ma > vmax) AS INTEGER) AS pre_history, vmax - ma AS seqnum FROM d1)",
    ]


def seq_final(vec: list[str], name: str = "seq", extra: str = "") -> str:
    items = ", ".join(f"CAST({v} AS DOUBLE)" for v in vec)
    return (f"SELECT customer_id, {O.seq_report(name)}{extra} FROM (SELECT cid AS customer_id, "
            f"list([{items}] ORDER BY ma DESC) AS {name} FROM d GROUP BY cid) s")


# ------------------------------------------------------------------ calendar
def _complete(spark, sf):
    d = H.complete_calendar(panel_orders(spark, sf), SP)
    return d.select("customer_id", F.col("months_ago").cast("int"), "seq", F.col("missing_statement").cast("int"))


register("complete_calendar", W(O.PANEL_ORDERS, *cal_sql(ago=MONTH_AGO, order="s_2, seq"),
                                final="SELECT cid AS customer_id, CAST(ma AS INTEGER) AS months_ago, seq, CAST((NOT present) AS INTEGER) AS missing_statement FROM d"))(_complete)


def _gap(spark, sf):
    d = H.gap_vs_prehistory(H.complete_calendar(panel_orders(spark, sf), SP), SP)
    return d.select("customer_id", F.col("months_ago").cast("int"), "missing_gap", "prehistory")


register("gap_vs_prehistory", W(O.PANEL_ORDERS, *cal_sql(ago=MONTH_AGO, order="s_2, seq"),
                                final="SELECT cid AS customer_id, CAST(ma AS INTEGER) AS months_ago, missing_statement AS missing_gap, pre_history AS prehistory FROM d"))(_gap)


# ------------------------------------------------------------------ sequence variants (daily panel)
_seen = "".join(f", count({c}) OVER (PARTITION BY customer_id ORDER BY s_2 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 AS seen_{c}" for c in DN)
register("sequence_v1", W(O.PANEL_DAYS, *cal_sql(pre=_seen),
                          final=seq_final([f"CASE WHEN NOT present THEN -3 WHEN {c} IS NOT NULL THEN {c} WHEN seen_{c} THEN -1 ELSE -2 END" for c in DN])))(
    lambda spark, sf: Q.sequence_v1(panel_days(spark, sf), DS))

V2_VEC = [f"CASE WHEN NOT present THEN -3 ELSE coalesce({c}, -1) END" for c in DN] + ["CAST((NOT present) AS DOUBLE)", "ma"]
register("sequence_v2", W(O.PANEL_DAYS, *cal_sql(), final=seq_final(V2_VEC)))(
    lambda spark, sf: Q.sequence_v2(panel_days(spark, sf), DS))


def _v3_sql() -> str:
    st = ", ".join(f"min({c}) - 2 * stddev_samp({c}) AS m2_{c}, min({c}) - stddev_samp({c}) AS m1_{c}" for c in DN)
    ff = ", ".join(f"last(CASE WHEN present THEN {c} END IGNORE NULLS) OVER (PARTITION BY cid ORDER BY ma DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_{c}" for c in DN)
    ctes = [O.PANEL_DAYS, "pz AS (SELECT customer_id, s_2, coalesce(p_2, 0) AS p_2, b_1, d_39 FROM panel)",
            f"st AS (SELECT {st} FROM pz)", *cal_sql("pz"), f"dd AS (SELECT d.*, {ff} FROM d)"]
    items = ", ".join(f"CAST(CASE WHEN NOT present THEN m2_{c} ELSE coalesce(ff_{c}, m1_{c}) END AS DOUBLE)" for c in DN)
    return W(*ctes, final=f"SELECT customer_id, {O.seq_report('seq')} FROM (SELECT cid AS customer_id, list([{items}] ORDER BY ma DESC) AS seq FROM dd, st GROUP BY cid) s")


register("sequence_v3", _v3_sql())(lambda spark, sf: Q.sequence_v3(panel_days(spark, sf), DS))

BRANCHES = {"P": ["p_2"], "B": ["b_1"], "D": ["d_39"]}


def _branched_sql() -> str:
    md = ", ".join(f"median({c}) AS md_{c}" for c in DN)
    ff = ", ".join(f"last(CASE WHEN present THEN {c} END IGNORE NULLS) OVER (PARTITION BY cid ORDER BY ma DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_{c}" for c in DN)
    ctes = [O.PANEL_DAYS, f"st AS (SELECT {md} FROM panel)", *cal_sql(), f"dd AS (SELECT d.*, {ff} FROM d)"]
    lists = ", ".join(f"list([CAST(CASE WHEN NOT present THEN -3 ELSE coalesce(ff_{c}, md_{c}) END AS DOUBLE)] ORDER BY ma DESC) AS {b}"
                      for b, cs in BRANCHES.items() for c in cs)
    rep = ", ".join(O.seq_report(b) for b in BRANCHES)
    return W(*ctes, final=f"SELECT customer_id, {rep} FROM (SELECT cid AS customer_id, {lists} FROM dd, st GROUP BY cid) s")


register("sequence_branched", _branched_sql())(
    lambda spark, sf: Q.sequence_branched(panel_days(spark, sf), DS, BRANCHES).select("customer_id", "branches.*"))

QS = [0.05, 0.1, 0.9, 0.95]
CAP_COLS = ["p_2", "d_39"]


def _bounds(df):
    return R.learned_bounds(exact_quantiles(df, {c: QS for c in CAP_COLS}))


def _cap_ctes() -> list[str]:
    q = ", ".join(f"quantile_cont({c}, [0.05, 0.1, 0.9, 0.95]) AS q_{c}" for c in CAP_COLS)
    clip = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, 2 * q_{c}[1] - q_{c}[2]), 2 * q_{c}[4] - q_{c}[3]) END AS {c}" for c in CAP_COLS)
    return [O.PANEL_DAYS, f"q AS (SELECT {q} FROM panel)",
            f"pc AS (SELECT customer_id, s_2, {clip}, b_1, d_39 IS NULL AS isnull_d_39 FROM panel, q)", *cal_sql("pc")]


CAP_VEC = [f"CASE WHEN NOT present THEN -3 ELSE coalesce({c}, -1) END" for c in DN] + ["vmax", "seqnum", "pre_history", "missing_statement", "ma"]


def _capped(spark, sf):
    p = panel_days(spark, sf)
    return Q.sequence_capped(p, DS, _bounds(p), DN, flag_cols=["d_39"])


register("sequence_capped", W(*_cap_ctes(), final=seq_final(CAP_VEC, extra=", null_flags").replace(
    "list([", "list([", 1).replace(" FROM d GROUP BY cid) s", ", list([coalesce(isnull_d_39, true)] ORDER BY ma DESC) AS null_flags FROM d GROUP BY cid) s")))(_capped)


def _p2_first(spark, sf):
    p = panel_days(spark, sf)
    return Q.sequence_p2_first(p, DS, _bounds(p), "p_2", ["b_1", "d_39", "p_2"])


register("sequence_p2_first", W(*_cap_ctes(), final=seq_final(CAP_VEC)))(_p2_first)


def _ordinal_cats(spark, sf):
    return Q.sequence_ordinal_cats(panel_orders(spark, sf), SP, cols=["p_2"])


def _ordinal_cats_sql() -> str:
    cats = list(O.CAT)
    coal = ", ".join(f"coalesce({c}, '999') AS {c}" for c in cats)
    ctes = [O.PANEL_ORDERS,
            f"pk AS (SELECT customer_id, s_2, seq, p_2, {coal}, date_diff('day', s_2, max(s_2) OVER (PARTITION BY customer_id)) AS days_ago FROM panel)"]
    for c in cats:
        ctes.append(f"dic_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) AS INTEGER) AS code1 FROM (SELECT DISTINCT {c} AS v FROM pk) t)")
    ctes.append("pe AS (SELECT pk.*, " + ", ".join(f"dic_{c}.code1 AS code_{c}" for c in cats) + " FROM pk "
                + " ".join(f"LEFT JOIN dic_{c} ON pk.{c} = dic_{c}.v" for c in cats) + ")")
    ctes += cal_sql("pe", ago=MONTH_AGO, order="s_2, seq")
    vec = ([f"CASE WHEN NOT present THEN 0 ELSE coalesce(code_{c}, 0) END" for c in cats]
           + ["CASE WHEN NOT present THEN -3 ELSE coalesce(p_2, -1) END", "CASE WHEN NOT present THEN -3 ELSE days_ago END"])
    return W(*ctes, final=seq_final(vec))


register("sequence_ordinal_cats", _ordinal_cats_sql())(_ordinal_cats)


# ------------------------------------------------------------------ array operators on sequences
def _v2(spark, sf):
    return Q.sequence_v2(panel_days(spark, sf), DS)


V2_CTES = [O.PANEL_DAYS, *cal_sql(),
           "s AS (SELECT cid AS customer_id, list([" + ", ".join(f"CAST({v} AS DOUBLE)" for v in V2_VEC) + "] ORDER BY ma DESC) AS seq FROM d GROUP BY cid)"]

register("fn_array_shift_pad", W(*V2_CTES, "g AS (SELECT customer_id, list_concat([list_transform(seq[1], lambda x: CAST(-3 AS DOUBLE))], seq[1:12]) AS seq FROM s)",
                                 final=f"SELECT customer_id, {O.seq_report('seq')} FROM g"))(
    lambda spark, sf: _v2(spark, sf).select("customer_id", Q.shift_pad(F.col("seq")).alias("seq")))

register("fn_array_get", W(*V2_CTES, final="SELECT customer_id, " + O.stable("seq[-1][1]") + " AS last_p_2, " + O.stable("seq[1][5]") + " AS first_ago FROM s"))(
    lambda spark, sf: _v2(spark, sf).select("customer_id", Q.array_get(F.col("seq"), -1, 1).alias("last_p_2"), Q.array_get(F.col("seq"), 1, 5).alias("first_ago")))

register("fn_array_slice", W(*V2_CTES, "g AS (SELECT customer_id, list_transform(seq, lambda x: x[2:]) AS seq FROM s)", final=f"SELECT customer_id, {O.seq_report('seq')} FROM g"))(
    lambda spark, sf: _v2(spark, sf).select("customer_id", Q.array_drop_feature(F.col("seq"), 1).alias("seq")))

register("fn_array_sum", W(*V2_CTES, final="SELECT customer_id, " + O.stable("list_sum(list_transform(seq, lambda x: x[4]))") + " AS n_missing FROM s"))(
    lambda spark, sf: _v2(spark, sf).select("customer_id", Q.array_sum_feature(F.col("seq"), 4).alias("n_missing")))


def _concat_feats(spark, sf):
    a = _v2(spark, sf)
    b = Q.sequence_v1(panel_days(spark, sf), DS).withColumnRenamed("seq", "seq1")
    return a.join(b, "customer_id").select("customer_id", Q.array_concat_features(F.col("seq"), F.col("seq1")).alias("seq"))


_seen1 = _seen
V1_CTES = [O.PANEL_DAYS, *[c.replace("rows0 AS", "r1rows0 AS").replace("FROM rows0", "FROM r1rows0").replace("rows1", "r1rows1").replace("cal AS", "r1cal AS").replace("FROM cal", "FROM r1cal").replace("cal.", "r1cal.").replace("d0 AS", "r1d0 AS").replace("FROM d0", "FROM r1d0").replace("d1 AS", "r1d1 AS").replace("FROM d1", "FROM r1d1").replace("d AS (", "r1d AS (")
                             for c in cal_sql(pre=_seen1)],
           "s1 AS (SELECT cid AS customer_id, list([" + ", ".join(f"CAST(CASE WHEN NOT present THEN -3 WHEN {c} IS NOT NULL THEN {c} WHEN seen_{c} THEN -1 ELSE -2 END AS DOUBLE)" for c in DN) + "] ORDER BY ma DESC) AS seq1 FROM r1d GROUP BY cid)"]
register("fn_array_concat_features", W(*V2_CTES, *V1_CTES[1:], "g AS (SELECT customer_id, list_transform(seq, lambda x, i: list_concat(x, seq1[i])) AS seq FROM s JOIN s1 USING (customer_id))",
                                       final=f"SELECT customer_id, {O.seq_report('seq')} FROM g"))(_concat_feats)

register("next_value_target", W(*V2_CTES, "g AS (SELECT customer_id, list_transform(seq, lambda x: x[2:]) AS seq, seq[-1][1] AS next_target FROM s)",
                                final=f"SELECT customer_id, {O.seq_report('seq')}, " + O.stable("next_target") + " AS next_target FROM g"))(
    lambda spark, sf: Q.next_value_target(_v2(spark, sf)))


def _scale(spark, sf):
    return Q.scale_sequences(_v2(spark, sf), "customer_id", skip_first=1)


register("scale_sequences", W(*V2_CTES,
                              "cells AS (SELECT f, x[f] AS v FROM (SELECT unnest(seq) AS x FROM s) t, (SELECT unnest(range(1, 6)) AS f) u)",
                              "st AS (SELECT f, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS sd FROM cells GROUP BY f)",
                              "sc AS (SELECT list(sd ORDER BY f) AS sds, list(mu ORDER BY f) AS mus FROM st)",
                              "g AS (SELECT customer_id, list_transform(seq, lambda x: list_transform(x, lambda v, i: CASE WHEN i - 1 < 1 THEN v ELSE (v - mus[i]) / sds[i] END)) AS seq FROM s, sc)",
                              final=f"SELECT customer_id, {O.seq_report('seq')} FROM g"))(_scale)


def _aug(spark, sf):
    return Q.augment_shift(_capped(spark, sf).drop("null_flags"), "seq", n_features=3)


def _aug_all(spark, sf):
    """The capped sequence as branches: one per feature, the indicators last."""
    k = len(DN)
    part = lambda lo, n: F.transform("seq", lambda x: F.slice(x, lo, n))
    cols = {f"b_{c}": part(i + 1, 1) for i, c in enumerate(DN)} | {"b_steps": part(k + 1, 5)}
    d = _capped(spark, sf).select("customer_id", *[v.alias(n) for n, v in cols.items()])
    return Q.augment_shift_all(d, list(cols))


def _aug_sql(eligible: str) -> str:
    """Shift augmentation in DuckDB list functions (lambda index is 1-based)."""
    k = len(DN)
    items = ", ".join(f"CAST({v} AS DOUBLE)" for v in CAP_VEC)
    ctes = [*_cap_ctes(), f"s0 AS (SELECT cid AS customer_id, list([{items}] ORDER BY ma DESC) AS seq FROM d GROUP BY cid)",
            "sh AS (SELECT customer_id, list_concat([list_transform(seq[1], lambda y: CAST(-3 AS DOUBLE))], "
            f"list_slice(seq, 1, len(seq) - 1)) AS seq FROM s0 WHERE {eligible})"]
    ma = f"(x[{k + 5}] - 1)"
    step = (f"list_concat(list_slice(x, 1, {k}), [vm, CASE WHEN i = 1 THEN vm - 12 ELSE vm - {ma} END, "
            f"CASE WHEN i = 1 THEN 1.0 ELSE x[{k + 3}] END, CASE WHEN i = 1 THEN 0.0 ELSE x[{k + 4}] END, "
            f"CASE WHEN i = 1 THEN 12.0 ELSE {ma} END])")
    ctes.append(f"sf AS (SELECT customer_id, list_transform(seq, lambda x, i: {step}) AS seq "
                f"FROM (SELECT *, seq[-1][{k + 1}] - 1 AS vm FROM sh) t)")
    return W(*ctes, final=f"SELECT customer_id, {O.seq_report('seq')}, 0 AS aug FROM s0 "
                          f"UNION ALL SELECT customer_id, {O.seq_report('seq')}, 1 AS aug FROM sf")


_K = len(DN)
register("augment_shift", _aug_sql(f"list_sum(list_transform(seq, lambda x: x[{_K + 3}] + x[{_K + 4}])) <= 11"))(_aug)


def _aug_flag_sql() -> str:
    k = len(DN)
    items = ", ".join(f"CAST({v} AS DOUBLE)" for v in CAP_VEC)
    step = (f"CASE WHEN i = 1 THEN list_concat(list_slice(x, 1, {k + 3}), [CAST(1 AS DOUBLE), CAST(12 AS DOUBLE)]) "
            f"ELSE list_concat(list_slice(x, 1, {k + 4}), [x[{k + 5}] - 1]) END")
    shift = lambda c: f"list_concat([list_transform({c}[1], lambda y: CAST(-3 AS DOUBLE))], list_slice({c}, 1, len({c}) - 1))"
    ctes = [*_cap_ctes(),
            f"s0 AS (SELECT cid AS customer_id, list([{items}] ORDER BY ma DESC) AS seq, "
            "list([CAST(coalesce(isnull_d_39, true) AS DOUBLE)] ORDER BY ma DESC) AS null_flags FROM d GROUP BY cid)",
            f"sh AS (SELECT customer_id, {shift('seq')} AS seq, {shift('null_flags')} AS null_flags FROM s0 WHERE seq[12][{k + 4}] <> 1)",
            f"sf AS (SELECT customer_id, list_transform(seq, lambda x, i: {step}) AS seq, null_flags FROM sh)"]
    rep = f"{O.seq_report('seq')}, {O.seq_report('null_flags')}"
    return W(*ctes, final=f"SELECT customer_id, {rep}, 0 AS aug FROM s0 UNION ALL SELECT customer_id, {rep}, 1 AS aug FROM sf")


def _aug_all_sql() -> str:
    ctes = _cap_ctes()
    lists = [f"list([CAST({v} AS DOUBLE)] ORDER BY ma DESC) AS b_{c}" for c, v in zip(DN, CAP_VEC)]
    lists.append(f"list([{', '.join(f'CAST({v} AS DOUBLE)' for v in CAP_VEC[len(DN):])}] ORDER BY ma DESC) AS b_steps")
    names = [*[f"b_{c}" for c in DN], "b_steps"]
    shift = lambda c: f"list_concat([list_transform({c}[1], lambda y: CAST(-3 AS DOUBLE))], list_slice({c}, 1, len({c}) - 1))"
    ctes += [f"s0 AS (SELECT cid AS customer_id, {', '.join(lists)} FROM d GROUP BY cid)",
             f"sh AS (SELECT customer_id, {', '.join(f'{shift(n)} AS {n}' for n in names)} FROM s0)",
             f"sf AS (SELECT customer_id, {', '.join(names[:-1])}, list_transform(b_steps, lambda x: list_concat(list_slice(x, 1, 4), [x[5] - 1])) AS b_steps FROM sh)"]
    rep = ", ".join(O.seq_report(n) for n in names)
    return W(*ctes, final=f"SELECT customer_id, {rep}, 0 AS aug FROM s0 UNION ALL SELECT customer_id, {rep}, 1 AS aug FROM sf")


register("augment_shift_flag", _aug_flag_sql())(lambda spark, sf: Q.augment_shift_flag(_capped(spark, sf)))
register("augment_shift_all", _aug_all_sql())(_aug_all)


# ------------------------------------------------------------------ encoders (orders panel)
def _mean_last(spark, sf):
    return E.cat_mean_last(panel_orders(spark, sf), SP, list(SP.cat))


register("encode_cat_mean_last", W(O.PANEL_ORDERS, f"r AS ({O.ranked()})", "l AS (SELECT * FROM r WHERE rd = 1)",
                                   *[f"m_{c} AS (SELECT {c}, avg(p_2) AS {c}_p2_mean FROM l WHERE {c} IS NOT NULL GROUP BY 1)" for c in O.CAT],
                                   "g AS (SELECT l.customer_id, l.dset, " + ", ".join(f"m_{c}.{c}_p2_mean" for c in O.CAT) + " FROM l "
                                   + " ".join(f"LEFT JOIN m_{c} ON l.{c} = m_{c}.{c}" for c in O.CAT) + ")",
                                   final=O.report([f"{c}_p2_mean" for c in O.CAT], ["customer_id", "dset"])))(_mean_last)

register("encode_cat_mean_all", W(O.PANEL_ORDERS, *[f"m_{c} AS (SELECT {c}, avg(p_2) AS {c}_p2_mean FROM panel WHERE {c} IS NOT NULL GROUP BY 1)" for c in O.CAT],
                                  "g AS (SELECT p.customer_id, p.s_2, p.seq, p.dset, " + ", ".join(f"m_{c}.{c}_p2_mean" for c in O.CAT) + " FROM panel p "
                                  + " ".join(f"LEFT JOIN m_{c} ON p.{c} = m_{c}.{c}" for c in O.CAT) + ")",
                                  final=O.report([f"{c}_p2_mean" for c in O.CAT], ["customer_id", "s_2", "seq", "dset"])))(
    lambda spark, sf: E.cat_mean_all(panel_orders(spark, sf), SP, list(SP.cat)))


def _mean_flat_sql() -> str:
    ctes = [O.PANEL_ORDERS, f"r AS ({O.ranked()})", "l AS (SELECT * FROM r WHERE rd = 1)",
            *[f"m_{c} AS (SELECT {c}, avg(p_2) AS mm_{c} FROM l WHERE {c} IS NOT NULL GROUP BY 1)" for c in O.CAT],
            "e AS (SELECT p.*, " + ", ".join(f"m_{c}.mm_{c}" for c in O.CAT) + ", " + MONTH_AGO.replace("s_2", "p.s_2").replace("customer_id", "p.customer_id") + " AS ma FROM panel p "
            + " ".join(f"LEFT JOIN m_{c} ON p.{c} = m_{c}.{c}" for c in O.CAT) + ")",
            "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, ma ORDER BY s_2 DESC, seq DESC) AS kk FROM e WHERE ma < 13) t WHERE kk = 1)"]
    items, floats = [], []
    for c in O.CAT:
        for i in range(13):
            items.append(f"max(CASE WHEN ma = {i} THEN mm_{c} END) AS {c}_{i}_p2_mean")
            floats.append(f"{c}_{i}_p2_mean")
    ctes.append(f"g AS (SELECT customer_id, {', '.join(items)} FROM k GROUP BY customer_id)")
    return W(*ctes, final=O.report(floats, ["customer_id"]))


register("encode_cat_mean_flat", _mean_flat_sql())(lambda spark, sf: E.cat_mean_flat(panel_orders(spark, sf), SP, list(SP.cat)))


def _dict_train(spark, sf):
    p = panel_orders(spark, sf)
    return p, E.ordinal_dictionary(p.where("dset = 'train'"), list(SP.cat))


def _ordinal(spark, sf, plus_one=False):
    p, dic = _dict_train(spark, sf)
    return E.encode_ordinal(p, dic, list(SP.cat), plus_one=plus_one).select("customer_id", "seq", *SP.cat)


def _ord_sql(plus: int, dflt: int) -> str:
    ctes = [O.PANEL_ORDERS] + [f"dic_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {c} AS v FROM panel WHERE dset = 'train' AND {c} IS NOT NULL) t)" for c in O.CAT]
    sel = ", ".join(f"CAST(coalesce(dic_{c}.code + {plus}, {dflt}) AS INTEGER) AS {c}" for c in O.CAT)
    joins = " ".join(f"LEFT JOIN dic_{c} ON p.{c} = dic_{c}.v" for c in O.CAT)
    return W(*ctes, final=f"SELECT p.customer_id, p.seq, {sel} FROM panel p {joins}")


register("encode_ordinal", _ord_sql(0, -1))(lambda spark, sf: _ordinal(spark, sf))
register("encode_ordinal_plus1", _ord_sql(1, 0))(lambda spark, sf: _ordinal(spark, sf, True))


def _cat_mode(spark, sf):
    p, dic = _dict_train(spark, sf)
    return E.cat_mode(p, dic, list(SP.cat), "category").select("customer_id", "seq", *SP.cat)


register("cat_mode", _ord_sql(0, -1))(_cat_mode)



# the four modes of the training driver on one frame: dictionaries of the training split alone
def _coded(spark, sf, mode):
    from ..operators import models as MD
    p = panel_orders(spark, sf).select("customer_id", "seq", "dset", "p_2", *SP.cat)
    out, names = MD.Encoding(p.where("dset = 'train' AND d_64 <> '5-LOW'"), list(SP.cat), mode).transform(p)
    keep = ["customer_id", "seq", "p_2"]
    if mode == "onehot":  # the places that are set
        on = lambda c: F.filter(F.transform(vector_to_array(c), lambda x, i: F.when(x == 1, i)), lambda i: i.isNotNull())
        return out.select(*keep, *[on(c).alias(c) for c in names])
    return out.select(*keep, *[F.col(c).cast("int").alias(c) for c in names])


def _coded_sql(mode):
    ctes = [O.PANEL_ORDERS] + [f"dic_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code, CAST(count(*) OVER () AS INTEGER) AS k "
                               f"FROM (SELECT DISTINCT {c} AS v FROM panel WHERE dset = 'train' AND d_64 <> '5-LOW' AND {c} IS NOT NULL) t)" for c in O.CAT]
    one = {"drop": lambda c: [], "label": lambda c: [f"coalesce(dic_{c}.code, -1) AS {c}"],
           "category": lambda c: [f"coalesce(dic_{c}.code, (SELECT max(k) FROM dic_{c})) AS {c}"],
           "onehot": lambda c: [f"CASE WHEN coalesce(dic_{c}.code, 0) = 0 THEN CAST([] AS INTEGER[]) ELSE [dic_{c}.code - 1] END AS {c}_onehot"]}[mode]
    sel = ", ".join(["p.customer_id", "p.seq", f"{O.stable('p.p_2')} AS p_2"] + [x for c in O.CAT for x in one(c)])
    return W(*ctes, final=f"SELECT {sel} FROM panel p " + " ".join(f"LEFT JOIN dic_{c} ON p.{c} = dic_{c}.v" for c in O.CAT))


for _m in ("drop", "label", "category", "onehot"):
    register(f"cat_mode_{_m}", _coded_sql(_m))(lambda spark, sf, m=_m: _coded(spark, sf, m))

# Category domains of the orders fixture (TPC-H order status / priority).
D63_LEVELS = ["F", "O", "P"]
D64_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _onehot(spark, sf):
    p, dic = _dict_train(spark, sf)
    return E.onehot_drop_first(p.select("customer_id", "seq", *SP.cat), dic, list(SP.cat))


register("encode_onehot_drop_first", W(O.PANEL_ORDERS, final="SELECT customer_id, seq, " + ", ".join(
    [f'CAST(coalesce(d_63 = \'{v}\', false) AS INTEGER) AS "d_63_{v}"' for v in D63_LEVELS[1:]]
    + [f'CAST(coalesce(d_64 = \'{v}\', false) AS INTEGER) AS "d_64_{v}"' for v in D64_LEVELS[1:]]) + " FROM panel"))(_onehot)


VOCAB = sorted(set(" ".join(D64_LEVELS).lower()) | {" "})


def _char_sql(tfidf: bool) -> str:
    ctes = [O.PANEL_ORDERS, "docs AS (SELECT customer_id, lower(string_agg(d_64, ' ' ORDER BY s_2, seq)) AS doc FROM panel GROUP BY 1)"]
    cnt = ", ".join(f"CAST(length(doc) - length(replace(doc, '{ch}', '')) AS DOUBLE) AS c{i}" for i, ch in enumerate(VOCAB))
    ctes.append(f"cv AS (SELECT customer_id, {cnt} FROM docs)")
    n = len(VOCAB)
    if not tfidf:
        return W(*ctes, final=O.report([f"d_64_doc_cv_{i}" for i in range(n)], ["customer_id"],
                                       "(SELECT customer_id, " + ", ".join(f"c{i} AS d_64_doc_cv_{i}" for i in range(n)) + " FROM cv)"))
    ctes.append("nd AS (SELECT count(*) AS n, " + ", ".join(f"sum(CASE WHEN c{i} > 0 THEN 1 ELSE 0 END) AS df{i}" for i in range(n)) + " FROM cv)")
    ctes.append("w AS (SELECT customer_id, " + ", ".join(f"c{i} * (ln((1.0 + n) / (1.0 + df{i})) + 1) AS w{i}" for i in range(n)) + " FROM cv, nd)")
    norm = " + ".join(f"w{i} * w{i}" for i in range(n))
    ctes.append(f"g AS (SELECT customer_id, " + ", ".join(f"w{i} / sqrt({norm}) AS d_64_doc_tfidf_{i}" for i in range(n)) + " FROM w)")
    return W(*ctes, final=O.report([f"d_64_doc_tfidf_{i}" for i in range(n)], ["customer_id"]))


def _char_vec(spark, sf, tfidf: bool):
    """Character vectors of the d_64 history document, counted from the rows
    (the document itself is never built)."""
    p = panel_orders(spark, sf)
    return E.char_vectors_from_counts(E.document_char_counts(p, SP, "d_64"), p.select("customer_id").distinct(),
                                      "customer_id", "d_64_doc", tfidf)


register("char_count_vector", _char_sql(False))(lambda spark, sf: _char_vec(spark, sf, False))
register("char_tfidf_vector", _char_sql(True))(lambda spark, sf: _char_vec(spark, sf, True))


def _svd(spark, sf):
    from ..operators import features as feat
    flat = feat.flatten_full_history(panel_orders(spark, sf), SP, cols=["d_64"])
    return E.category_history_svd(flat, "customer_id", [f"d_64_{i}" for i in range(13)], k=12, name="d_64")


register("category_history_svd")(_svd)


def _scale(spark, sf):
    p = panel_orders(spark, sf)
    out, _ = E.standard_scale(p.select("customer_id", "seq", "p_2", "b_1"), ["p_2", "b_1"])
    return out


register("standard_scale", W(O.PANEL_ORDERS, "st AS (SELECT avg(p_2) AS mp, CASE WHEN stddev_pop(p_2) = 0 THEN 1 ELSE stddev_pop(p_2) END AS sp, avg(b_1) AS mb, CASE WHEN stddev_pop(b_1) = 0 THEN 1 ELSE stddev_pop(b_1) END AS sb FROM panel)",
                             "g AS (SELECT customer_id, seq, (p_2 - mp) / sp AS p_2, (b_1 - mb) / sb AS b_1 FROM panel, st)",
                             final=O.report(["p_2", "b_1"], ["customer_id", "seq"])))(_scale)

LOG_TH = 1.0


def _autolog(spark, sf):
    p = panel_orders(spark, sf).select("customer_id", "seq", "p_2", F.exp(F.col("p_2") / 50000.0).alias("e_p2"), F.lit(1e6).cast("double").__sub__(F.exp(F.col("p_2") / 50000.0)).alias("r_p2"))
    out, _ = E.auto_log_transform(p, ["p_2", "e_p2", "r_p2"], threshold=LOG_TH)
    return out


def _autolog_sql() -> str:
    cols = ["p_2", "e_p2", "r_p2"]
    ctes = [O.PANEL_ORDERS, "x AS (SELECT customer_id, seq, p_2, exp(p_2 / 50000.0) AS e_p2, 1e6 - exp(p_2 / 50000.0) AS r_p2 FROM panel)",
            "s1 AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}, skewness({c}) AS sk_{c}" for c in cols) + " FROM x)",
            "s2 AS (SELECT " + ", ".join(f"skewness(ln(1 + {c} - mn_{c})) AS r_{c}, skewness(ln(1 + mx_{c} - {c})) AS l_{c}" for c in cols) + " FROM x, s1)"]
    sel = []
    for c in cols:
        sel.append(f"CASE WHEN sk_{c} > 0 AND abs(sk_{c}) - abs(r_{c}) > {LOG_TH} THEN ln(1 + {c} - mn_{c}) "
                   f"WHEN sk_{c} <= 0 AND abs(sk_{c}) - abs(l_{c}) > {LOG_TH} THEN ln(1 + mx_{c} - {c}) ELSE {c} END AS {c}")
    ctes.append(f"g AS (SELECT customer_id, seq, {', '.join(sel)} FROM x, s1, s2)")
    return W(*ctes, final=O.report(cols, ["customer_id", "seq"]))


register("auto_log_transform", _autolog_sql())(_autolog)

"""Registered queries: folds and ranking metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import folds as FO
from ..operators import metrics as M
from ..sources.fixtures import customer_labels, scores
from ..spec import ensure_checkpoint_dir
from . import oracle as O
from .catalog import register


def W(*ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


SW = "sw AS (SELECT *, CASE WHEN target = 0 THEN 20.0 ELSE 1.0 END AS w, CAST(target AS DOUBLE) AS t FROM scores)"


def _cum_cte(name: str, order: str, part: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    win = f"OVER ({p}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"{name} AS (SELECT *, sum(w) {win} AS cw, sum(t * w) {win} AS ctw FROM sw)"


def _metric_sql(part: str = "", fast: bool = False) -> tuple[list[str], str]:
    """CTEs computing per-group gini, gini_max, d -> view 'mt'."""
    key = f"{part}, " if part else ""
    grp = f"GROUP BY {part}" if part else ""
    ctes = [O.SCORES, SW, _cum_cte("c", "prediction DESC, id", part), _cum_cte("cp", "t DESC, id", part),
            f"tot AS (SELECT {key}sum(w) AS W, sum(t * w) AS TW, sum(t) AS n_pos, count(*) - sum(t) AS n_neg FROM sw {grp})",
            f"gc AS (SELECT {key}sum(w * ctw) AS s_tw, sum(w * cw) AS s_w FROM c {grp})",
            f"gp AS (SELECT {key}sum(w * ctw) AS s_tw, sum(w * cw) AS s_w FROM cp {grp})"]
    j = f"USING ({part})" if part else "ON true"
    cond = "c.cw / tot.W <= 0.04" if fast else "c.cw <= floor(0.04 * tot.W)"
    ctes.append(f"cap AS (SELECT {('c.' + part + ', ') if part else ''}sum(CASE WHEN {cond} THEN c.t ELSE 0 END) AS cap_pos FROM c JOIN tot {j} {('GROUP BY c.' + part) if part else ''})")
    gmax = ("10.0 * n_neg * (n_pos + 20.0 * n_neg - 19) / (n_pos + 20.0 * n_neg)" if fast
            else "gp.s_tw / tot.TW - gp.s_w / tot.W")
    ctes.append(f"mt AS (SELECT {('tot.' + part + ', ') if part else ''}gc.s_tw / tot.TW - gc.s_w / tot.W AS gini, {gmax} AS gini_max, cap_pos / n_pos AS top4 "
                f"FROM tot JOIN gc {j} JOIN gp {j} JOIN cap {j})")
    ctes.append("ms AS (SELECT *, gini / gini_max AS norm_gini, 0.5 * (gini / gini_max + top4) AS score FROM mt)")
    return ctes, "ms"


register("win_cumulative_weight", W(O.SCORES, SW, _cum_cte("c", "prediction DESC, id"), final=O.report(["cum_weight"], ["id"], "(SELECT id, cw AS cum_weight FROM c)")))(
    lambda spark, sf: M.cumulative_weight(scores(spark, sf)))

register("topk_weighted_fraction", W(O.SCORES, SW, _cum_cte("c", "prediction DESC, id"), "tot AS (SELECT sum(w) AS wsum FROM sw)",
                                     final="SELECT id, " + O.stable("prediction") + " AS prediction, target FROM c, tot WHERE cw <= floor(0.04 * wsum)"))(
    lambda spark, sf: M.topk_weighted_fraction(scores(spark, sf)))

_c, _v = _metric_sql()
register("metric_topk_capture", W(*_c, final=O.report(["top4"], [], _v)))(
    lambda spark, sf: M.metric_frame(scores(spark, sf)).select("top4"))
register("metric_weighted_gini", W(*_c, final=O.report(["gini"], [], _v)))(
    lambda spark, sf: M.metric_frame(scores(spark, sf)).select("gini"))
register("metric_norm_gini", W(*_c, final=O.report(["gini_max", "norm_gini"], [], _v)))(
    lambda spark, sf: M.metric_frame(scores(spark, sf)).select("gini_max", "norm_gini"))
register("metric_combined", W(*_c, final=O.report(["gini", "gini_max", "norm_gini", "top4", "score"], [], _v)))(
    lambda spark, sf: M.metric_frame(scores(spark, sf)))
_cf, _vf = _metric_sql(fast=True)
register("metric_combined_fast", W(*_cf, final=O.report(["gini", "gini_max", "norm_gini", "top4", "score"], [], _vf)))(
    lambda spark, sf: M.metric_frame(scores(spark, sf), fast=True))
def _by_fold_sql() -> str:
    cb, vb = _metric_sql(part="val_fold_n")
    cp, vp = _metric_sql()
    # rename the pooled CTEs so both sets can live in one WITH
    cp = [x.replace("sw AS", "sw0 AS", 1) if x.startswith("sw AS") else x for x in cp]
    ren = {"c AS": "c0 AS", "cp AS": "cp0 AS", "tot AS": "tot0 AS", "gc AS": "gc0 AS", "gp AS": "gp0 AS",
           "cap AS": "cap0 AS", "mt AS": "mt0 AS", "ms AS": "ms0 AS"}
    pooled = []
    for x in cp[2:]:
        for a, b in ren.items():
            if x.startswith(a):
                x = b + x[len(a):]
        pooled.append(x)
    pooled = [p.replace(" FROM c ", " FROM c0 ").replace("FROM cp ", "FROM cp0 ")
              .replace("JOIN tot ", "JOIN tot0 ").replace("FROM tot ", "FROM tot0 ").replace("JOIN gc ", "JOIN gc0 ")
              .replace("JOIN gp ", "JOIN gp0 ").replace("JOIN cap ", "JOIN cap0 ").replace("FROM mt", "FROM mt0")
              .replace("FROM c JOIN", "FROM c0 JOIN").replace("gc.s_", "gc0.s_").replace("gp.s_", "gp0.s_")
              .replace("tot.W", "tot0.W").replace("tot.TW", "tot0.TW").replace("c.cw", "c0.cw").replace("c.t ", "c0.t ")
              for p in pooled]
    return W(*cb, *pooled,
             f"g AS (SELECT CAST(val_fold_n AS VARCHAR) AS fold, score FROM {vb} "
             f"UNION ALL SELECT 'mean' AS fold, avg(score) FROM {vb} UNION ALL SELECT 'pooled' AS fold, score FROM ms0)",
             final=O.report(["score"], ["fold"]))


register("metric_by_fold", _by_fold_sql())(lambda spark, sf: M.score_by_fold(scores(spark, sf)))

register("win_rank_average", W(O.SCORES, "g AS (SELECT id, rank() OVER (ORDER BY prediction) + (count(*) OVER (PARTITION BY prediction) - 1) / 2.0 AS prediction_rank FROM scores)",
                               final=O.report(["prediction_rank"], ["id"])))(
    lambda spark, sf: M.average_rank(scores(spark, sf).select("id", "prediction"), "prediction").select("id", "prediction_rank"))

register("rank_average", W(O.SCORES, "g AS (SELECT id, ((rank() OVER (ORDER BY prediction) + (count(*) OVER (PARTITION BY prediction) - 1) / 2.0) + "
                                     "(rank() OVER (ORDER BY prediction_2) + (count(*) OVER (PARTITION BY prediction_2) - 1) / 2.0)) / 2 AS rank_avg FROM scores)",
                           final=O.report(["rank_avg"], ["id"])))(
    lambda spark, sf: M.rank_average(scores(spark, sf), ["prediction", "prediction_2"]))


def _logloss_auc(spark, sf):
    s = scores(spark, sf)
    return M.logloss(s).withColumn("auc", M.auc_exact(s).scalar())  # one-row results: scalar subquery


register("metric_logloss_auc", W(O.SCORES, "r AS (SELECT target, rank() OVER (ORDER BY prediction) + (count(*) OVER (PARTITION BY prediction) - 1) / 2.0 AS rk, "
                                           "least(greatest(prediction, 1e-15), 1 - 1e-15) AS p FROM scores)",
                                 "g AS (SELECT -avg(target * ln(p) + (1 - target) * ln(1 - p)) AS logloss, "
                                 "(sum(CASE WHEN target = 1 THEN rk ELSE 0 END) - sum(target) * (sum(target) + 1) / 2.0) / (sum(target) * (count(*) - sum(target))) AS auc FROM r)",
                                 final=O.report(["logloss", "auc"], [])))(_logloss_auc)


def _folds(spark, sf):
    return FO.stratified_folds(customer_labels(spark, sf), "customer_id", "target", k=5, seed=28)


register("stratified_folds", W(O.CUSTOMER_LABELS, final="SELECT customer_id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(customer_id AS VARCHAR) || ':28'), customer_id) - 1) % 5 AS INTEGER) AS val_fold_n FROM labels_c"))(_folds)


def _bag(spark, sf):
    """bag_predictions: mean over the stored fits (2 runs x 5 folds) that predicted an entity."""
    from ..operators import models as MD
    s = scores(spark, sf)
    store = MD.FitStore(spark, f"{ensure_checkpoint_dir(spark)}/fits-{uuid.uuid4().hex}", "two score columns as runs")
    fits = [(k, run) for k in range(5) for run in range(2)]
    for k, run in fits:
        rows = s.where(F.col("val_fold_n") == k).select("id", F.lit("oof").alias("split"), F.col("prediction_2" if run else "prediction").alias("p"))
        store.write(k, run, rows, {})
    return MD.bag_predictions(store.predictions(fits), "id")


register("bag_predictions", W(O.SCORES, "g AS (SELECT id, avg(p) AS prediction FROM (SELECT id, prediction AS p FROM scores UNION ALL SELECT id, prediction_2 FROM scores) GROUP BY id)",
                              final=O.report(["prediction"], ["id"])))(_bag)


# ------------------------------------------------------------------ greedy buckets
def _bucket_input(spark, sf):
    """last statement p_2 per customer with the learnable label."""
    from ..operators import history as H
    from ..sources.fixtures import ORDERS_SPEC, panel_orders
    last = H.tail_n(panel_orders(spark, sf), ORDERS_SPEC, 1).select("customer_id", "p_2")
    return customer_labels(spark, sf).join(last, "customer_id")


BUCKET_N = 10
_WALK = W(O.PANEL_ORDERS, O.CUSTOMER_LABELS,
          "lastp AS (SELECT customer_id, arg_max(p_2, seq) AS p_2 FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s_2 DESC, seq DESC) AS k FROM panel) t WHERE k = 1 GROUP BY 1)",
          "base AS (SELECT customer_id, target, p_2 FROM labels_c JOIN lastp USING (customer_id))",
          "s AS (SELECT *, row_number() OVER (ORDER BY p_2 DESC NULLS LAST, customer_id) - 1 AS pos, CAST(target = 0 AS INTEGER) AS z, CAST(target = 1 AS INTEGER) AS o FROM base)",
          f"RECURSIVE walk AS (SELECT pos, CAST(0 AS BIGINT) AS b, CASE WHEN z >= {BUCKET_N} AND o >= {BUCKET_N} THEN 1 ELSE 0 END AS nb, "
          f"CASE WHEN z >= {BUCKET_N} AND o >= {BUCKET_N} THEN 0 ELSE z END AS q0, CASE WHEN z >= {BUCKET_N} AND o >= {BUCKET_N} THEN 0 ELSE o END AS q1 FROM s WHERE pos = 0 "
          f"UNION ALL SELECT s.pos, w.nb, CASE WHEN w.q0 + s.z >= {BUCKET_N} AND w.q1 + s.o >= {BUCKET_N} THEN w.nb + 1 ELSE w.nb END, "
          f"CASE WHEN w.q0 + s.z >= {BUCKET_N} AND w.q1 + s.o >= {BUCKET_N} THEN 0 ELSE w.q0 + s.z END, "
          f"CASE WHEN w.q0 + s.z >= {BUCKET_N} AND w.q1 + s.o >= {BUCKET_N} THEN 0 ELSE w.q1 + s.o END FROM walk w JOIN s ON s.pos = w.pos + 1)",
          "wb AS (SELECT s.customer_id, s.target, s.p_2, s.pos, walk.b AS bucket FROM s JOIN walk USING (pos))",
          final="SELECT customer_id, target, " + O.stable("p_2") + " AS p_2, pos, bucket FROM wb").replace("WITH ", "WITH RECURSIVE ", 1).replace("RECURSIVE walk AS", "walk AS")

register("win_greedy_buckets", _WALK)(
    lambda spark, sf: FO.greedy_buckets(_bucket_input(spark, sf), "customer_id", "p_2", "target", BUCKET_N))

_FOLDS = (_WALK.rsplit("\nSELECT", 1)[0]
          + ", b2 AS (SELECT *, CASE WHEN p_2 IS NULL THEN -1 WHEN bucket = 0 THEN 1 ELSE bucket END AS b FROM wb), "
          "b3 AS (SELECT *, CASE WHEN b = max(b) OVER () THEN b - 1 ELSE b END + target * 1000000 AS stratum FROM b2) "
          "SELECT customer_id, target, CAST(stratum AS BIGINT) AS stratum, CAST((row_number() OVER (PARTITION BY stratum ORDER BY md5(CAST(customer_id AS VARCHAR) || ':28'), customer_id) - 1) % 10 AS INTEGER) AS val_fold_n FROM b3")
register("bucket_stratified_folds", _FOLDS)(
    lambda spark, sf: FO.bucket_stratified_folds(_bucket_input(spark, sf), "customer_id", "p_2", "target", k=10))

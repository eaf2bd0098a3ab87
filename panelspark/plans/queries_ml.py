"""Registered queries: CV training, models, stacking, imputation, capping
(SURVEY §2.11, §2.12).  Model outputs are not SQL-expressible (rows-only
check); ``meta_features`` and ``impute_ffill`` carry oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import folds as FO
from ..operators import history as H
from ..operators import models as MD
from ..operators import sequences as Q
from ..operators.ordered import pin
from ..sources.fixtures import DAYS_SPEC as DS
from ..sources.fixtures import ORDERS_SPEC as SP
from ..sources.fixtures import customer_labels, panel_days, panel_orders, scores
from . import oracle as O
from .catalog import register

FEATS = ["p_2_mean", "p_2_std", "p_2_min", "p_2_max", "p_2_last", "b_1_mean", "b_1_last", "d_42_last",
         "p_2_diff_mean", "d_63_nunique", "d_64_nunique"]
FAST_GBT = dict(max_iter=10, max_depth=3)


def training_frames(spark, sf):
    """Flat features + labels + stratified folds; train = 'train' split, test = 'test' split."""
    p = panel_orders(spark, sf)
    f = feat.null_handled_agg_features(p, SP).select("customer_id", *FEATS)
    lab = FO.stratified_folds(customer_labels(spark, sf), "customer_id", "target")
    split = p.select("customer_id", "dset").distinct()
    base = f.join(split, "customer_id")
    train = base.where("dset = 'train'").join(lab, "customer_id").drop("dset")
    test = base.where("dset = 'test'").drop("dset")
    return train, test


def _cv(spark, sf):
    """train_cv_oof: 5-fold GBT, out-of-fold predictions per training customer."""
    tr, te = training_frames(spark, sf)
    oof, _, _ = MD.train_cv_oof(tr, te, "customer_id", FEATS, lambda run: MD.model_gbt(seed=28 + run, **FAST_GBT))
    return oof


register("train_cv_oof")(_cv)


def _cv_frame(spark, sf):
    """What the driver leaves: each training customer predicted by its fold's fit, each test customer by all five."""
    tr, te = training_frames(spark, sf)
    oof, test, _ = MD.train_cv_oof(tr, te, "customer_id", FEATS, lambda run: MD.model_gbt(seed=28 + run, max_iter=3, max_depth=3))
    ok = lambda c: F.col(c).between(0, 1).alias("is_probability")
    return oof.select("customer_id", F.lit("oof").alias("split"), F.col("val_fold_n").cast("int").alias("fold"), ok("oof_pred")).unionByName(
        test.select("customer_id", F.lit("test").alias("split"), F.lit(None).cast("int").alias("fold"), ok("prediction")))


register("train_cv_keys", "WITH " + O.PANEL_ORDERS + ",\n" + O.CUSTOMER_LABELS + """,
c AS (SELECT DISTINCT customer_id, dset FROM panel),
k AS (SELECT customer_id, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(customer_id AS VARCHAR) || ':28'), customer_id) - 1) % 5 AS INTEGER) AS fold FROM labels_c)
SELECT customer_id, 'oof' AS split, fold, true AS is_probability FROM c JOIN k USING (customer_id) WHERE dset = 'train'
UNION ALL SELECT customer_id, 'test', NULL, true FROM c WHERE dset = 'test'""")(_cv_frame)


def _cv_scores(spark, sf):
    """The run's log: score of each fold, pooled, and their mean; feature gains."""
    tr, _ = training_frames(spark, sf)
    _, _, log = MD.train_cv_oof(tr, None, "customer_id", FEATS, lambda run: MD.model_gbt(seed=28 + run, max_iter=3, max_depth=3), score_fn=MD.oof_scores)
    entries = [(k, v) for k, v in log.items() if isinstance(v, float)] + [(f"gain {f}", g) for f, g in log["Aggregated_FI"]]
    return spark.createDataFrame(entries, "entry string, value double")


register("train_cv_scores")(_cv_scores)


def _cv_categories(spark, sf):
    """Statement rows (several per customer) with nominal categories: dictionaries of each fold's training rows."""
    p = panel_orders(spark, sf)
    lab = FO.stratified_folds(customer_labels(spark, sf), "customer_id", "target", k=3)
    last = F.max("seq").over(Window.partitionBy("customer_id"))
    rows = H.tail_n(p, SP, 3).withColumn("is_last", F.col("seq") == last).select("customer_id", "seq", "is_last", "p_2", "b_1", *SP.cat)
    oof, _, _ = MD.train_cv_oof(rows.join(lab, "customer_id"), None, "customer_id", ["p_2", "b_1"], lambda run: MD.model_gbt(max_iter=3, max_depth=3),
                                cats=list(SP.cat), cat_mode="category", val_filter=F.col("is_last"))
    return oof.select("customer_id", F.col("val_fold_n").cast("int").alias("fold"), F.col("oof_pred").between(0, 1).alias("is_probability"))


register("train_cv_categories", "WITH " + O.CUSTOMER_LABELS + """
SELECT customer_id, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(customer_id AS VARCHAR) || ':28'), customer_id) - 1) % 3 AS INTEGER) AS fold, true AS is_probability FROM labels_c""")(_cv_categories)


def _days_labels(spark, sf):
    d = panel_days(spark, sf)
    lab = d.groupBy("customer_id").agg((F.count("d_39") >= 8).cast("int").alias("target"))
    return FO.stratified_folds(lab, "customer_id", "target", k=3)


def _cv_seq(spark, sf):
    """train_cv_oof_sequences: flattened sequence tensors (+ shift-augmented
    copies for training; validation uses the first copy only)."""
    d = panel_days(spark, sf)
    seqs = Q.sequence_v2(d, DS)
    aug = Q.augment_shift(seqs, "seq", eligible=F.lit(True))
    n = 13 * 5
    flat = aug.select("customer_id", "aug", *[F.element_at(F.flatten("seq"), i + 1).alias(f"x{i}") for i in range(n)])
    tr = flat.join(_days_labels(spark, sf), "customer_id")
    n_rows = tr.count()
    oof, _, _ = MD.train_cv_oof(tr, None, "customer_id", [f"x{i}" for i in range(n)],
                                lambda run: MD.model_logistic(C=1.0, n=n_rows, max_iter=50), val_filter=F.col("aug") == 0)
    return oof


register("train_cv_oof_sequences")(_cv_seq)


def _everyone(tr, te):
    """All customers: the training split with its folds, the test split without one."""
    return tr.unionByName(te, allowMissingColumns=True)


def _single(make):
    """Fit on all folds but the first; predict every customer of both splits."""
    def q(spark, sf):
        tr, te = (pin(x) for x in training_frames(spark, sf))  # written once: the count, the fit and the prediction read it
        m = MD.private_outputs(make(tr)).setLabelCol("target").fit(MD.assemble(tr.where("val_fold_n <> 0"), FEATS))
        return m.transform(MD.assemble(_everyone(tr, te), FEATS)).select("customer_id", MD.positive_probability(None).alias("prediction"))
    return q


register("model_gbt")(_single(lambda tr: MD.model_gbt(**FAST_GBT)))
register("model_logistic")(_single(lambda tr: MD.model_logistic(C=1.0, n=tr.count())))
register("model_logistic_elasticnet")(_single(lambda tr: MD.model_logistic(C=0.05, n=tr.count(), l1_ratio=0.5)))


# ------------------------------------------------------------------ optimality certificates
# Standard-deviation units; a fit away from its optimum shows in the fourth decimal.
TOL = dict(max_iter=100, tol=1e-12)


def _certified(rows, features, C, l1_ratio=0.0):
    """Fit, then report for each feature the moment that the predictions and the penalty give; at the
    optimum of the regularised loss, and only there, it is the labels' moment, which SQL computes from the tables."""
    rows = pin(rows)
    n = rows.count()
    m = MD.private_outputs(MD.model_logistic(C=C, n=n, l1_ratio=l1_ratio, **TOL)).setLabelCol("target").fit(MD.assemble(rows, features))
    cert = MD.logistic_certificate(rows, features, m.coefficients.toArray().tolist(), m.intercept, 1.0 / (C * n), l1_ratio)
    return cert.select("feature", F.round("fitted_moment", 4).alias("moment"), (F.col("gap") < 1e-5).alias("optimal"))


def _fit_rows(spark, sf):
    tr, _ = training_frames(spark, sf)
    return tr.where("val_fold_n <> 0")


def _flat_certificate_sql():
    pc = "pc AS (SELECT customer_id, s_2, seq, " + ", ".join(f"{O.clean(c)} AS {c}" for c in O.NUM) + ", d_63, d_64, dset FROM panel)"
    items = sum((O.num_aggs(c, f)[0] for c, f in (("p_2", ("mean", "std", "min", "max", "last")), ("b_1", ("mean", "last")), ("d_42", ("last",)))), [])
    return _moments_sql([O.PANEL_ORDERS, O.CUSTOMER_LABELS, pc, f"r AS ({O.ranked('pc')})",
                         f"a AS (SELECT customer_id, any_value(dset) AS dset, {', '.join(items)}, count(DISTINCT d_63) AS d_63_nunique, count(DISTINCT d_64) AS d_64_nunique FROM r GROUP BY customer_id)",
                         "f AS (SELECT *, p_2_last - p_2_mean AS p_2_diff_mean FROM a)",
                         "k AS (SELECT customer_id, target, (row_number() OVER (PARTITION BY target ORDER BY md5(CAST(customer_id AS VARCHAR) || ':28'), customer_id) - 1) % 5 AS val_fold_n FROM labels_c)",
                         "t AS (SELECT f.*, target FROM f JOIN k USING (customer_id) WHERE dset = 'train' AND val_fold_n <> 0)"], FEATS)


def _moments_sql(ctes, features):
    """For each feature the labels' moment in units of its standard deviation (missing values are -1, as in the fit)."""
    rows = ["SELECT '(intercept)' AS feature, avg(target) AS m FROM t"]
    for c in features:
        x = f"coalesce({c}, -1)"
        rows.append(f"SELECT '{c}' AS feature, avg(target * {x}) / CASE WHEN stddev_pop({x}) = 0 THEN 1 ELSE stddev_pop({x}) END AS m FROM t")
    return "WITH " + ",\n".join(ctes) + ",\nq AS (" + " UNION ALL ".join(rows) + ")\nSELECT feature, " + O.stable("round(m, 4)") + " AS moment, true AS optimal FROM q"


def _stack_certificate(spark, sf):
    tr, te = _stack_frames(spark, sf)
    cols = ["prediction", "prediction_2"]
    return _certified(MD.logit_scale(tr, te, cols)[0].select("target", *cols), cols, 0.05)


_LOGIT = "ln({c} / (1 - {c}))".format(c="least(greatest({c}, 1e-4), 1 - 1e-4)")
_STACK_MOMENTS = _moments_sql(
    [O.SCORES, "l AS (SELECT id, target, " + ", ".join(f"{_LOGIT.format(c=c)} AS {c}" for c in ("prediction", "prediction_2")) + " FROM scores)",
     "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ("prediction", "prediction_2")) + " FROM l)",
     "t AS (SELECT target, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in ("prediction", "prediction_2")) + " FROM l, st WHERE id % 10 <> 0)"],
    ["prediction", "prediction_2"])

register("model_logistic_optimality", _flat_certificate_sql())(lambda spark, sf: _certified(_fit_rows(spark, sf), FEATS, 1.0))
register("model_elasticnet_optimality", _flat_certificate_sql())(lambda spark, sf: _certified(_fit_rows(spark, sf), FEATS, 0.05, 0.5))
register("stack_logistic_optimality", _STACK_MOMENTS)(_stack_certificate)


def _mlp(spark, sf):
    tr, te = training_frames(spark, sf)
    a = MD.standard_scaled_vector(_everyone(tr, te), FEATS)
    m = MD.private_outputs(MD.model_mlp(len(FEATS), max_iter=50)).setLabelCol("target").fit(a.where("val_fold_n <> 0"))
    return m.transform(a).select("customer_id", MD.positive_probability(None).alias("prediction"))


register("model_mlp")(_mlp)


def _residual(spark, sf):
    """model_residual: GBT regressor on target - base prediction, added back."""
    tr, te = training_frames(spark, sf)
    base = F.least(F.greatest(F.col("p_2_mean") / 500000.0, F.lit(0.0)), F.lit(1.0))
    tr, te = tr.withColumn("base", base), te.withColumn("base", base)
    from pyspark.ml.regression import GBTRegressor
    oof, _, _ = MD.train_cv_oof(tr, te, "customer_id", FEATS, lambda run: GBTRegressor(maxIter=10, maxDepth=3, seed=28),
                                residual_of="base")
    return oof


register("model_residual")(_residual)


def _early(spark, sf):
    """early_stop_by_metric: the prefix of 20 trees with the best ranking score on the held-out fold."""
    tr, _ = training_frames(spark, sf)
    return MD.early_stop_by_metric(tr, "customer_id", FEATS, lambda: MD.model_gbt(max_iter=20, max_depth=3))


register("early_stop_by_metric")(_early)


def _fi(spark, sf):
    """feature_importance: GBT importances averaged over the real number of folds."""
    tr, te = training_frames(spark, sf)
    _, _, log = MD.train_cv_oof(tr, te, "customer_id", FEATS, lambda run: MD.model_gbt(**FAST_GBT))
    return spark.createDataFrame(log["Aggregated_FI"], "feature string, importance double")


register("feature_importance")(_fi)


def _meta(spark, sf):
    s = scores(spark, sf)
    return MD.meta_features({"m1": s.select("id", F.col("prediction").alias("oof_pred")).where("val_fold_n <> 4"),
                             "m2": s.select("id", F.col("prediction_2").alias("oof_pred")).where("val_fold_n <> 3")}, "id")


register("meta_features", "WITH " + O.SCORES + ", a AS (SELECT id, prediction AS oof_pred_m1 FROM scores WHERE val_fold_n <> 4), "
         "b AS (SELECT id, prediction_2 AS oof_pred_m2 FROM scores WHERE val_fold_n <> 3), g AS (SELECT * FROM a FULL OUTER JOIN b USING (id)) "
         + O.report(["oof_pred_m1", "oof_pred_m2"], ["id"]))(_meta)


def _stack_frames(spark, sf):
    s = scores(spark, sf)
    return s.where("id % 10 <> 0"), s.where("id % 10 = 0").drop("target", "val_fold_n")


def _stack_l1(spark, sf):
    tr, te = _stack_frames(spark, sf)
    oof, _, _ = MD.stack(tr, te, "id", ["prediction", "prediction_2"], "logistic", C=0.05)
    return oof


def _stack_gbt(spark, sf):
    tr, te = _stack_frames(spark, sf)
    oof, _, _ = MD.stack(tr, te, "id", ["prediction", "prediction_2"], "gbt", **FAST_GBT)
    return oof


def _stack_l2(spark, sf):
    tr, te = _stack_frames(spark, sf)
    o1, t1, _ = MD.stack(tr, te, "id", ["prediction", "prediction_2"], "logistic", C=0.05)
    o2, t2, _ = MD.stack(tr, te, "id", ["prediction", "prediction_2"], "gbt", **FAST_GBT)
    l2_tr = MD.meta_features({"l1_lr": o1, "l1_gbt": o2}, "id").join(tr.select("id", "target", "val_fold_n"), "id")
    l2_te = MD.meta_features({"l1_lr": t1.withColumnRenamed("prediction", "oof_pred"),
                              "l1_gbt": t2.withColumnRenamed("prediction", "oof_pred")}, "id")
    oof, _, _ = MD.stack(l2_tr, l2_te, "id", ["oof_pred_l1_lr", "oof_pred_l1_gbt"], "logistic", C=100000.0)
    return oof


def _stack_test(spark, sf):
    """Final test predictions of both level-1 stacks: one fit each on all training rows."""
    tr, te = _stack_frames(spark, sf)
    out = None
    for kind, kw in (("logistic", dict(C=0.05)), ("gbt", dict(max_iter=3, max_depth=3))):
        _, t, _ = MD.stack(tr, te, "id", ["prediction", "prediction_2"], kind, **kw)
        t = t.select("id", F.lit(kind).alias("stack"), F.col("prediction").between(0, 1).alias("is_probability"))
        out = t if out is None else out.unionByName(t)
    return out


register("stack_test_predictions", "WITH " + O.SCORES + " SELECT id, stack, true AS is_probability FROM scores, (VALUES ('logistic'), ('gbt')) v(stack) WHERE id % 10 = 0")(_stack_test)

register("stack_logistic_l1")(_stack_l1)
register("stack_gbt_l1")(_stack_gbt)
register("stack_logistic_l2")(_stack_l2)


def _impute(spark, sf):
    """impute_model: per-column GBT imputation of the -1-cleaned numerics."""
    p = feat.clean_sentinels(panel_orders(spark, sf), SP.num, SP.sentinel)
    out = MD.impute_model(p.select("customer_id", "seq", *SP.num, *SP.cat), list(SP.num), max_iter=5, cats=list(SP.cat))
    return out.select("customer_id", "seq", *SP.num)


register("impute_model")(_impute)

register("impute_ffill", "WITH " + O.PANEL_ORDERS + ", pc AS (SELECT customer_id, s_2, seq, " + O.clean("b_1") + " AS b_1, " + O.clean("d_42") + " AS d_42 FROM panel), "
         "g AS (SELECT customer_id, seq, last(b_1 IGNORE NULLS) OVER w AS b_1, last(d_42 IGNORE NULLS) OVER w AS d_42 FROM pc "
         "WINDOW w AS (PARTITION BY customer_id ORDER BY s_2, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) "
         + O.report(["b_1", "d_42"], ["customer_id", "seq"]))(
    lambda spark, sf: H.ffill(feat.clean_sentinels(panel_orders(spark, sf), SP.num, SP.sentinel), SP, ["b_1", "d_42"]).select("customer_id", "seq", "b_1", "d_42"))


def _caps(spark, sf):
    """cap_bounds_from_trees: GBT on last statements -> split-histogram edges."""
    p = feat.clean_sentinels(panel_orders(spark, sf), SP.num, SP.sentinel)
    last = H.tail_n(p, SP, 1).join(FO.stratified_folds(customer_labels(spark, sf), "customer_id", "target"), "customer_id")
    b = MD.cap_bounds_from_trees(spark, last, list(SP.num), cats=list(SP.cat))
    return spark.createDataFrame([(k, *v) for k, v in sorted(b.items())], "feature string, s0 double, s1 double, s2 double, s3 double")


register("cap_bounds_from_trees")(_caps)

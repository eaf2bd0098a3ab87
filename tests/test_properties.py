"""Invariants on the fixture panels."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelspark.operators import features as feat
from panelspark.operators import folds as FO
from panelspark.operators import history as H
from panelspark.operators import metrics as M
from panelspark.operators import models as MD
from panelspark.operators import sequences as Q
from panelspark.sources.fixtures import DAYS_SPEC, ORDERS_SPEC, customer_labels, panel_days, panel_orders, scores


def test_folds_balanced_and_exclusive(spark):
    lab = customer_labels(spark, SF_SMALL)
    f = FO.stratified_folds(lab, "customer_id", "target", k=5)
    assert f.count() == lab.count() == f.select("customer_id").distinct().count()
    sizes = f.groupBy("target", "val_fold_n").count().groupBy("target").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in sizes)


def test_sequences_shape_and_calendar(spark):
    p = panel_days(spark, SF_SMALL)
    s = Q.sequence_capped(p, DAYS_SPEC, {}, list(DAYS_SPEC.num), flag_cols=["d_39"])
    rows = s.collect()
    for r in rows:
        assert len(r["seq"]) == 13 and all(len(x) == 3 + 5 for x in r["seq"])
        assert len(r["null_flags"]) == 13
        ms = sum(x[3 + 3] for x in r["seq"])
        pre = sum(x[3 + 2] for x in r["seq"])
        present = sum(1 for x in r["seq"] if x[0] != -3.0)
        assert ms + pre + present == 13


def test_ffill_idempotent(spark):
    p = feat.clean_sentinels(panel_orders(spark, SF_SMALL), ORDERS_SPEC.num)
    a = H.ffill(p, ORDERS_SPEC, ["b_1"])
    b = H.ffill(a, ORDERS_SPEC, ["b_1"])
    assert a.select("seq", "b_1").exceptAll(b.select("seq", "b_1")).count() == 0


def test_partition_count_invariance(spark):
    p = panel_orders(spark, SF_SMALL)
    from panelspark.plans.catalog import report
    a = report(feat.basic_agg_features(p, ORDERS_SPEC))
    b = report(feat.basic_agg_features(p.repartition(7, "seq").sortWithinPartitions(F.rand(3)), ORDERS_SPEC))
    # order-dependent results identical; sums equal up to float reporting
    assert a.exceptAll(b).count() == 0


def test_running_sums_match_window(spark):
    s = scores(spark, SF_SMALL)
    two = M.cumulative_weight(s)
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("prediction"), "id").rowsBetween(Window.unboundedPreceding, 0)
    one = s.select("id", F.sum(F.when(F.col("target") == 0, 20.0).otherwise(1.0)).over(w).alias("cum_weight"))
    assert two.exceptAll(one).count() == 0


def test_oof_covers_each_customer_once_and_learns(spark):
    from plans_helpers import training_frames
    tr, te = training_frames(spark, "/root/testdata/sf0.01")
    feats = ["p_2_mean", "p_2_last", "p_2_max"]
    oof, test_pred, log = MD.train_cv_oof(tr, te, "customer_id", feats,
                                          lambda run: MD.model_logistic(C=1.0, n=1000, max_iter=50))
    assert oof.count() == tr.select("customer_id").distinct().count()
    assert oof.groupBy("customer_id").count().where("count > 1").count() == 0
    auc = M.auc_exact(oof.join(tr.select("customer_id", "target"), "customer_id")
                      .withColumnRenamed("oof_pred", "prediction")).first()["auc"]
    assert auc > 0.7
    assert test_pred.count() == te.count()

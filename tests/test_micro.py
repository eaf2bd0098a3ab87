"""Micro-panels with hand-computed answers (FIXTURES §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelspark.operators import encode as E
from panelspark.operators import features as feat
from panelspark.operators import history as H
from panelspark.operators import metrics as M
from panelspark.operators import sequences as Q
from panelspark.spec import PanelSpec

SPEC = PanelSpec(entity="customer_id", ts="s_2", tiebreak="seq", num=("x",), cat=("c",), sentinel=-1.0)
SCHEMA = "customer_id long, s_2 timestamp_ntz, seq long, x double, c string"


def d(y, m, day=1):
    return dt.datetime(y, m, day)


def panel(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_statement(spark):
    p = panel(spark, [(1, d(2020, 1), 1, 5.0, "a")])
    b = feat.basic_agg_features(p, SPEC).first()
    assert b["x_std"] is None and b["x_last"] == 5.0 and b["x_first"] == 5.0
    g = feat.date_features(p, SPEC).first()
    assert g["month_gap_sum"] == 0 and g["month_gap_count"] == 0 and g["month_gap_mean"] == -1.0
    df = feat.diff_features(p, SPEC).first()
    assert df["x_diff_1"] == -1.0 and df["x_diff_2"] == -1.0


def test_short_history_diff_agg_and_left_aligned_history(spark):
    rows = [(1, d(2020, m), m, float(m * 10), "a") for m in range(1, 5)]  # 10,20,30,40
    p = panel(spark, rows)
    a = feat.diff_agg_features(p, SPEC).first()
    # differences: -1 (artificial first), 10, 10, 10
    assert a["x_diff1_min"] == -1.0 and a["x_diff1_max"] == 10.0
    assert math.isclose(a["x_diff1_mean"], 29 / 4)
    h = feat.flat_history_features(p, SPEC, ["x"]).first()
    assert [h[f"x_his_{i}"] for i in range(5)] == [10.0, 20.0, 30.0, 40.0, None]


def test_thirteen_statements_no_artificial_diff(spark):
    rows = [(1, d(2020 + (m - 1) // 12, (m - 1) % 12 + 1), m, float(m), "a") for m in range(1, 14)]
    a = feat.diff_agg_features(panel(spark, rows), SPEC).first()
    assert a["x_diff1_min"] == 1.0 and a["x_diff1_max"] == 1.0


def test_all_null_feature(spark):
    p = panel(spark, [(1, d(2020, m), m, -1.0, None) for m in (1, 2)])
    b = feat.null_handled_agg_features(p, SPEC).first()
    assert b["x_mean"] is None and b["x_na_count"] == 2 and b["c_mode"] is None and b["c_nunique"] == 0


def test_mode_tie_smallest_wins(spark):
    p = panel(spark, [(1, d(2020, m), m, 1.0, v) for m, v in zip((1, 2, 3, 4), "abba")])
    assert feat.basic_agg_features(p, SPEC).first()["c_mode"] == "a"


def test_streak(spark):
    vals = [1.0, -1.0, -1.0, 1.0, -1.0]  # F T T F T as null flags
    p = panel(spark, [(1, d(2020, m + 1), m, v, "a") for m, v in enumerate(vals)])
    r = feat.na_agg_features(p, SPEC, features=["x"]).first()
    assert r["x_is_null_first_streak"] == 2 and r["x_is_null_sum"] == 3 and r["x_is_null_at_random_sum"] == 1
    assert r["x_is_null_last"] == 1


def test_same_month_twice_gap_quirk(spark):
    p = panel(spark, [(1, d(2020, 1, 1), 1, 1.0, "a"), (1, d(2020, 1, 20), 2, 2.0, "a")])
    g = feat.date_features(p, SPEC).first()
    assert g["month_gap_max"] == 11.0  # 0 -> 12 -> 11


def test_gap_and_prehistory(spark):
    p = panel(spark, [(1, d(2020, m), m, float(m), "a") for m in (10, 11, 12)] + [(1, d(2020, 8), 8, 8.0, "a")])
    c = H.gap_vs_prehistory(H.complete_calendar(p, SPEC), SPEC)
    rows = {r["months_ago"]: r for r in c.collect()}
    assert len(rows) == 13
    assert rows[3]["missing_gap"] == 1 and rows[4]["missing_gap"] == 0
    assert all(rows[i]["prehistory"] == 1 for i in range(5, 13))


def test_constant_group_zscore_null(spark):
    p = panel(spark, [(1, d(2020, 1), 1, 5.0, "a"), (2, d(2020, 1), 2, 5.0, "a")]).withColumn("dset", F.lit("train"))
    out = feat.group_rel_transform(p, SPEC, "c", "c", ["x"]).collect()
    assert all(r["x_rel_c_mean_mean"] is None for r in out)


def test_unseen_category(spark):
    train = panel(spark, [(1, d(2020, 1), 1, 1.0, "a"), (1, d(2020, 2), 2, 1.0, "b")])
    test = panel(spark, [(2, d(2020, 1), 3, 1.0, "z")])
    dic = E.ordinal_dictionary(train, ["c"])
    assert E.encode_ordinal(test, dic, ["c"]).first()["c"] == -1
    oh = E.onehot_drop_first(test, dic, ["c"]).first()
    assert oh["c_b"] == 0 and "c_a" not in oh.asDict()


def test_tied_scores_deterministic(spark):
    s = spark.createDataFrame([(i, i % 2, 0.5) for i in range(10)], "id long, target int, prediction double")
    a = M.cumulative_weight(s).orderBy("id").collect()
    b = M.cumulative_weight(s.repartition(3)).orderBy("id").collect()
    assert a == b and a[0]["cum_weight"] == 20.0


def test_sequence_v1_sentinels(spark):
    spec = SPEC.with_(cat=())
    rows = [(1, d(2020, 1), 1, -1.0, "a"), (1, d(2020, 2), 2, 3.0, "a"), (1, d(2020, 4), 4, -1.0, "a")]
    p = feat.clean_sentinels(panel(spark, rows), ["x"])
    seq = Q.sequence_v1(p, spec, ["x"]).first()["seq"]
    assert len(seq) == 13
    assert [s[0] for s in seq[-4:]] == [-2.0, 3.0, -3.0, -1.0]
    assert all(s[0] == -3.0 for s in seq[:-4])


def test_metric_perfect_order(spark):
    s = spark.createDataFrame([(i, int(i < 30), float(i < 30) + i / 1000) for i in range(200)],
                              "id long, target int, prediction double")
    r = M.metric_frame(s).first()
    assert math.isclose(r["norm_gini"], 1.0) and r["top4"] > 0


def test_fast_and_exact_gini_agree_without_ties(spark):
    s = spark.createDataFrame([(i, int(i % 7 == 0), ((i * 7919) % 1009) / 1009.0) for i in range(500)],
                              "id long, target int, prediction double")
    a = M.metric_frame(s).first()
    b = M.metric_frame(s, fast=True).first()
    assert a["gini"] == pytest.approx(b["gini"]) and a["gini_max"] == pytest.approx(b["gini_max"])

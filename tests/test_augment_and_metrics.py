"""Hand-computed cases: shift augmentation, scores of groups without positives, ranks with NULLs."""

from pyspark.sql import functions as F

from panelspark.operators import metrics as M
from panelspark.operators import sequences as Q


def _seqs(spark):
    """Three steps of (value, missing flag, months ago), oldest first, and one null flag a step."""
    rows = [("a", [[1.0, 0.0, 2.0], [2.0, 0.0, 1.0], [3.0, 0.0, 0.0]], [[False], [True], [False]]),
            ("b", [[1.0, 0.0, 2.0], [-3.0, 1.0, 1.0], [3.0, 0.0, 0.0]], [[False], [True], [True]])]
    return spark.createDataFrame(rows, "id string, seq array<array<double>>, null_flags array<array<boolean>>")


def test_augment_shift_flag_by_hand(spark):
    """A missing second-to-last step makes a sequence ineligible; both tensors shift."""
    got = {(r.id, r.aug): (r.seq, r.null_flags) for r in Q.augment_shift_flag(_seqs(spark), n_steps=3).collect()}
    assert set(got) == {("a", 0), ("b", 0), ("a", 1)}
    assert got["a", 1] == ([[-3.0, 1.0, 2.0], [1.0, 0.0, 1.0], [2.0, 0.0, 0.0]], [[-3.0], [0.0], [1.0]])
    assert got["b", 0][1] == [[0.0], [1.0], [1.0]]


def test_augment_shift_all_by_hand(spark):
    """Every branch shifts for everyone; months ago falls by one on all steps of the last branch."""
    d = _seqs(spark).select("id", F.transform("seq", lambda x: F.slice(x, 1, 1)).alias("p"), F.transform("seq", lambda x: F.slice(x, 2, 2)).alias("m"))
    got = {(r.id, r.aug): (r.p, r.m) for r in Q.augment_shift_all(d, ["p", "m"]).collect()}
    assert len(got) == 4
    assert got["b", 1] == ([[-3.0], [1.0], [-3.0]], [[-3.0, -4.0], [0.0, 1.0], [1.0, 0.0]])


def test_scores_without_positives_are_null(spark):
    rows = [(1, 0.9, 1, 0), (2, 0.1, 0, 0), (3, 0.5, 0, 1), (4, 0.4, 0, 1)]
    d = spark.createDataFrame(rows, "id long, prediction double, target int, val_fold_n int")
    for fast in (False, True):
        got = {r.val_fold_n: r.score for r in M.metric_frame(d, by=("val_fold_n",), fast=fast).collect()}
        assert got[1] is None and got[0] is not None
    none = d.where("target = 0")
    assert M.metric_frame(none).first().score is None and M.auc_exact(none).first().auc is None
    assert {r.fold: r.score is None for r in M.score_by_fold(d).collect()} == {"0": False, "1": True, "mean": False, "pooled": False}


def test_average_rank_keeps_null_scores(spark):
    d = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.5), (4, 0.1)], "id long, p double")
    assert {r.id: r.p_rank for r in M.average_rank(d, "p").collect()} == {1: 2.5, 2: None, 3: 2.5, 4: 1.0}
    two = d.withColumn("q", F.lit(1.0))
    assert {r.id: r.rank_avg is None for r in M.rank_average(two, ["p", "q"]).collect()} == {1: False, 2: True, 3: False, 4: False}


def test_group_statistics_keep_small_values(spark):
    """Group mean and deviation are float32, not rounded to absolute decimals."""
    from panelspark.operators import features as feat
    from panelspark.spec import PanelSpec
    rows = [(i, f"2024-01-{i:02d}", i, i * 1e-9) for i in range(1, 6)]
    d = spark.createDataFrame(rows, "customer_id long, s_2 string, seq long, x double").withColumns({"s_2": F.col("s_2").cast("timestamp"), "dset": F.lit("train")})
    got = feat.group_rel_features(d, PanelSpec(num=("x",), cat=()), important=["x"]).orderBy("customer_id").collect()
    z = [r["x_rel_s_2_mean_mean"] for r in got]
    assert all(abs(a - (i - 3) / 2.5 ** 0.5) < 1e-5 for i, a in enumerate(z, 1))

"""Model operators: what must hold for any fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import metrics as M
from panelspark.operators import models as MD


def test_imputation_fills_nulls_and_keeps_the_rest(spark):
    """b = 2a where known: the missing cells follow it, known cells and row count stay, rows may repeat."""
    rows = [(i % 40, float(i), None if i % 5 == 0 else 2.0 * i) for i in range(120)] + [(0, 0.0, None), (0, 0.0, None)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double")
    out = MD.impute_model(df, ["a", "b"], kind="linear")
    assert out.columns == df.columns and out.count() == 122
    got = out.collect()
    assert all(abs(r.b - 2 * r.a) < 1e-3 for r in got)


def test_single_models_predict_everyone(spark):
    from panelspark.plans import catalog
    from panelspark.plans.queries_ml import training_frames
    catalog.load_all()
    d = "/root/testdata/sf0.001"
    tr, te = training_frames(spark, d)
    want = {r.customer_id for r in tr.select("customer_id").unionAll(te.select("customer_id")).collect()}
    got = catalog.REGISTRY["model_logistic"](spark, d)
    assert {r.customer_id for r in got.collect()} == want
    assert got.where(~F.col("prediction").between(0, 1)).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    """Two informative numbers and two categories; 3 folds."""
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(240):
        a, b, c, d = rnd.normal(), rnd.normal(), "pqr"[rnd.integers(3)], "xy"[rnd.integers(2)] if i % 9 else None
        rows.append((i, float(a), float(b), c, d, int(a + 0.5 * b + (c == "q") + 0.7 * rnd.normal() > 0), i % 3))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, d string, target int, val_fold_n int").cache()


def test_prefix_scores_equal_truncated_models(labelled):
    """The margins after t trees, and the best t, are those of the first t trees scored on their own."""
    a = MD.assemble(labelled, ["a", "b"])
    model = MD.private_outputs(MD.model_gbt(max_iter=6, max_depth=2)).setLabelCol("target").fit(a.where("val_fold_n <> 0"))
    held = a.where("val_fold_n = 0")
    margins = MD.prefix_margins(model, held, ["id", "target"])
    got = {r.n_trees: r.score for r in MD.prefix_scores(margins, "id", "target").collect()}
    trees, weights = model.trees, model.treeWeights
    x = {r.id: (r.features, r.target) for r in held.collect()}
    for t in range(1, 7):
        rows = [(i, int(y), float(sum(w * tree.predict(f) for tree, w in zip(trees[:t], weights)))) for i, (f, y) in x.items()]
        one = labelled.sparkSession.createDataFrame(rows, "id long, target int, prediction double")
        assert M.metric_frame(one).first().score == pytest.approx(got[t], abs=1e-12)
    best = MD.best_prefix(MD.prefix_scores(margins, "id", "target"))
    assert best == (min(t for t in got if got[t] == max(got.values())), max(got.values()))
    # of all trees the margin is the model's own
    own = {r.id: float(r[1][1]) for r in model.transform(held).select("id", MD.RAW).collect()}
    assert all(own[r.id] == pytest.approx(2 * r.margins[-1]) or own[r.id] == pytest.approx(r.margins[-1]) for r in margins.collect())


def test_margins_of_many_trees_are_written_before_they_are_scored(labelled):
    """No tree is left in the plan that reads the margins: a filter inferred there names every subset of the tree columns."""
    a = MD.assemble(labelled, ["a", "b"])
    model = MD.private_outputs(MD.model_gbt(max_iter=20, max_depth=2)).setLabelCol("target").fit(a.where("val_fold_n <> 0"))
    margins = MD.prefix_margins(model, a.where("val_fold_n = 0"), ["id", "target"])
    plan = margins._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and "UDF" not in plan
    assert MD.prefix_scores(margins, "id", "target").count() == len(model.trees)


def test_metric_of_margins_in_sql(labelled, tmp_path):
    """DuckDB's score from the written margins is Spark's."""
    import duckdb
    a = MD.assemble(labelled, ["a", "b"])
    model = MD.private_outputs(MD.model_gbt(max_iter=4, max_depth=2)).setLabelCol("target").fit(a.where("val_fold_n <> 0"))
    margins = MD.prefix_margins(model, a.where("val_fold_n = 0"), ["id", "target"])
    margins.write.parquet(str(tmp_path / "m"))
    sql = """WITH e AS (SELECT id, target, unnest(range(1, len(margins) + 1)) AS t, unnest(margins) AS p FROM read_parquet('{}/m/*.parquet')),
    s AS (SELECT *, CASE WHEN target = 0 THEN 20.0 ELSE 1.0 END AS w FROM e),
    c AS (SELECT *, sum(w) OVER (PARTITION BY t ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS cw, sum(target) OVER (PARTITION BY t ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS ct, sum(w) OVER (PARTITION BY t) AS tw FROM s),
    g AS (SELECT t, sum(w * ct) / sum(target) - (any_value(tw) * any_value(tw) + sum(w * w)) / (2 * any_value(tw)) AS gini, (sum(target) + 1) / 2.0 + 20 * (count(*) - sum(target)) - (any_value(tw) * any_value(tw) + sum(w * w)) / (2 * any_value(tw)) AS most,
      sum(CASE WHEN cw <= floor(0.04 * tw) THEN target ELSE 0 END) / sum(target) AS top FROM c GROUP BY t)
    SELECT t, 0.5 * (gini / most + top) FROM g ORDER BY t""".format(tmp_path)
    got = [(r.n_trees, r.score) for r in MD.prefix_scores(margins, "id", "target").orderBy("n_trees").collect()]
    for (t, x), (u, y) in zip(got, duckdb.sql(sql).fetchall(), strict=True):
        assert t == u and x == pytest.approx(y, abs=1e-12)


@pytest.mark.parametrize("l1_ratio,C", [(0.0, 1.0), (0.5, 0.05), (1.0, 0.02)])
def test_optimality_certificate(labelled, l1_ratio, C):
    n = labelled.count()
    m = MD.private_outputs(MD.model_logistic(C=C, n=n, l1_ratio=l1_ratio, max_iter=500, tol=1e-13)).setLabelCol("target").fit(MD.assemble(labelled, ["a", "b"]))
    w = m.coefficients.toArray()
    gaps = lambda w, b: [r.gap for r in MD.logistic_certificate(labelled, ["a", "b"], w, b, 1 / (C * n), l1_ratio).collect()]
    assert max(gaps(w, m.intercept)) < 1e-6
    # a model off its optimum fails, whatever is off
    assert max(gaps(w + np.array([0.01, 0.0]), m.intercept)) > 1e-4
    assert max(gaps(w, m.intercept + 0.01)) > 1e-4
    assert max(gaps(w * 0, m.intercept)) > 1e-3 or not w.any()


@pytest.mark.parametrize("mode", MD.CAT_MODES)
def test_driver_encodes_with_training_rows_alone(spark, labelled, mode):
    """A level that only the held-out fold has is unseen there, and the fit does not know it."""
    rows = labelled.withColumn("c", F.when(F.col("val_fold_n") == 1, "only here").otherwise(F.col("c")))
    coded = MD.Encoding(rows.where("val_fold_n <> 1"), ["c", "d"], mode)
    out, names = coded.transform(rows)
    if mode == "drop":
        assert names == [] and "c" not in out.columns
        return
    assert coded.levels == {"c": 3, "d": 2}
    held = out.where("val_fold_n = 1")
    if mode == "onehot":
        v = [r[0] for r in held.select("c_onehot").collect()]
        assert all(x.size == 2 and not x.toArray().any() for x in v)
        seen = {tuple(r[0].toArray()) for r in out.where("val_fold_n <> 1").select("c_onehot").collect()}
        assert seen == {(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)}
    else:
        assert {r[0] for r in held.select("c").collect()} == {-1 if mode == "label" else 3}
        assert {r[0] for r in out.where("d IS NULL").select("d").collect()} <= {-1, 2, None}


@pytest.mark.parametrize("mode", MD.CAT_MODES)
def test_cv_with_categories(labelled, mode):
    make = (lambda run: MD.model_gbt(max_iter=2, max_depth=2)) if mode != "onehot" else (lambda run: MD.model_logistic(n=160))
    oof, test, log = MD.train_cv_oof(labelled, labelled.limit(5), "id", ["a", "b"], make, cats=["c", "d"], cat_mode=mode)
    got = {r.id: r for r in oof.collect()}
    assert len(got) == 240 and all(got[r.id].val_fold_n == r.val_fold_n for r in labelled.collect())
    assert test.count() == 5 and all(0 <= r.oof_pred <= 1 for r in got.values())
    names = [f for f, _ in log["Aggregated_FI"]]
    assert len(names) == {"drop": 2, "label": 4, "category": 4, "onehot": 2 + 2 + 1}[mode]


def test_a_stopped_run_resumes(spark, labelled, tmp_path):
    """Killed after two folds, a run started again makes the third fit only; the averages are those of one run."""
    made = []

    def make(run, stop_at=None):
        if stop_at is not None and len(made) == stop_at:
            raise RuntimeError("killed")
        made.append(run)
        return MD.model_gbt(max_iter=2, max_depth=2, seed=28 + run)

    def go(path, **kw):
        return MD.train_cv_oof(labelled, labelled.limit(9), "id", ["a", "b"], lambda run: make(run, **kw), runs_per_fold=2, store=str(path))

    with pytest.raises(RuntimeError):
        go(tmp_path / "s", stop_at=1 + 4)  # one for the note, then two folds of two runs
    before = len(made)
    oof, test, log = go(tmp_path / "s")
    assert len(made) - before == 1 + 2
    made.clear()
    whole, test_2, log_2 = go(tmp_path / "t")
    assert len(made) == 1 + 6
    same = lambda a, b, c: {r.id: r[c] for r in a.collect()} == pytest.approx({r.id: r[c] for r in b.collect()}, abs=1e-12)
    assert same(oof, whole, "oof_pred") and same(test, test_2, "prediction")
    assert dict(log["Aggregated_FI"]) == pytest.approx(dict(log_2["Aggregated_FI"]))
    with pytest.raises(ValueError):
        MD.train_cv_oof(labelled, None, "id", ["a"], lambda run: make(run), store=str(tmp_path / "s"))


def test_bagging_in_sql(spark, labelled, tmp_path):
    import duckdb
    MD.train_cv_oof(labelled, labelled, "id", ["a", "b"], lambda run: MD.model_gbt(max_iter=2, max_depth=2, seed=run), runs_per_fold=2, store=str(tmp_path / "s"))
    store = MD.FitStore(spark, str(tmp_path / "s"), spark.read.text(str(tmp_path / "s/about"), wholetext=True).first()[0])
    got = {r.id: r.prediction for r in MD.bag_predictions(store.predictions([(k, r) for k in range(3) for r in range(2)]).where("split = 'test'"), "id").collect()}
    want = dict(duckdb.sql(f"SELECT id, avg(p) FROM read_parquet('{tmp_path}/s/fits/*/predictions/*.parquet') WHERE split = 'test' GROUP BY id").fetchall())
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 240


def test_imputation_with_categories(spark):
    """b depends on a nominal category: the fit sees it, beats the column mean, and leaves known cells alone."""
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(400):
        c = "wxyz"[rnd.integers(4)]
        b = {"w": 10.0, "x": -5.0, "y": 40.0, "z": 0.0}[c] + float(rnd.normal())
        rows.append((i, float(rnd.normal()), b, None if i % 50 == 7 else c, i % 4 == 0))
    df = spark.createDataFrame([(i, a, None if gone else b, c) for i, a, b, c, gone in rows], "id long, a double, b double, c string")
    out = MD.impute_model(df, ["a", "b"], max_iter=10, cats=["c"])
    assert out.columns == df.columns
    got = {r.id: r for r in out.collect()}
    assert len(got) == 400 and all(got[i].b == b and got[i].c == c for i, _, b, c, gone in rows if not gone)
    missing = [(got[i].b, b) for i, _, b, c, gone in rows if gone and c]
    mean = np.mean([b for _, _, b, _, gone in rows if not gone])
    assert np.mean([abs(x - b) for x, b in missing]) < 0.2 * np.mean([abs(mean - b) for _, b in missing])


def test_imputation_reads_a_matrix_in_pieces(spark, monkeypatch):
    """The pieces of the matrix follow the rows, and a small dictionary costs the rows no exchange; the values stay."""
    rows = [(i, float(i % 7), float(i % 5) if i % 4 else None, "uvw"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string").coalesce(2)
    whole = {r.id: r for r in MD.impute_model(df, ["a", "b"], max_iter=3, cats=["c"]).collect()}
    monkeypatch.setattr(MD, "PIECE_CELLS", 100)
    out = MD.impute_model(df, ["a", "b"], max_iter=3, cats=["c"])
    assert out.rdd.getNumPartitions() == 9
    got = {r.id: r for r in out.collect()}
    assert got.keys() == whole.keys() and all(got[i].b == pytest.approx(whole[i].b) and (got[i].a, got[i].c) == (whole[i].a, whole[i].c) for i in got)
    coded, _ = MD.Encoding(df, ["c"], "category").transform(df, broadcast=True)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(MD, "SMALL_DICTIONARY", 1)
    coded, _ = MD.Encoding(df, ["c"], "category").transform(df, broadcast=True)
    assert "SortMergeJoin" in coded._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("residual", [None, "a"])
def test_cv_makes_its_inputs_once(spark, labelled, residual):
    """What makes the training and the test rows runs once, however many folds and fits read them."""
    from pyspark.ml.regression import GBTRegressor
    seen = {k: spark.sparkContext.accumulator(0) for k in ("train", "test")}

    def noted(df, k):
        at = seen[k]

        @F.udf("double")
        def note(x):
            at.add(1)
            return x

        return df.withColumn("b", note("b"))

    make = (lambda run: GBTRegressor(maxIter=2, maxDepth=2, seed=1)) if residual else (lambda run: MD.model_gbt(max_iter=2, max_depth=2))
    oof, test, log = MD.train_cv_oof(noted(labelled, "train"), noted(labelled.where("id < 9").drop("val_fold_n"), "test"), "id", ["a", "b"], make, runs_per_fold=2, residual_of=residual)
    assert oof.count() == labelled.count() and test.count() == labelled.where("id < 9").count()
    assert len(log["folds"]) > 1 and log["Aggregated_FI"]
    assert {k: v.value for k, v in seen.items()} == {"train": labelled.count(), "test": test.count()}

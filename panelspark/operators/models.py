"""Cross-validated training, stacking, model-based imputation and tree-split
capping on Spark MLlib (§2.11, §2.12).

The fold loop runs on the driver; every fit and transform is a distributed
MLlib job.  Inputs are pinned once, train and test alike, so no fold makes them
again; predictions of all folds are unioned, never collected.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clip, logit
from .ordered import pin
from ..spec import ensure_checkpoint_dir
from . import metrics as M


# ---------------------------------------------------------------- estimators
def model_gbt(max_iter: int = 30, max_depth: int = 4, step: float = 0.1, seed: int = 28, **kw) -> Estimator:
    """model_gbt: gradient-boosted trees (one capability for the reference's three libraries)."""
    return GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed, **kw)


def model_logistic(C: float = 1.0, n: int = 1, l1_ratio: float = 0.0, max_iter: int = 100, tol: float = 1e-6) -> Estimator:
    """model_logistic / model_logistic_elasticnet: sklearn's
    C * sum(loss) + l1_ratio |w|_1 + (1 - l1_ratio)/2 |w|^2 equals Spark's
    mean(loss) + lambda (alpha |w|_1 + (1 - alpha)/2 |w|^2) with
    lambda = 1/(C n), alpha = l1_ratio; no internal standardisation."""
    return LogisticRegression(regParam=1.0 / (C * max(n, 1)), elasticNetParam=l1_ratio,
                              standardization=False, maxIter=max_iter, tol=tol)


def logistic_certificate(rows: DataFrame, features: list[str], coefficients, intercept: float, lam: float, alpha: float = 0.0,
                         target: str = "target", fill: float = -1.0) -> DataFrame:
    """Optimality of a logistic fit with penalty lam (alpha |w|_1 + (1 - alpha)/2 |w|^2) on ``rows``:
    feature, label_moment, fitted_moment, gap (in units of the feature's standard deviation).

    A fit is optimal if and only if for every feature the labels' moment mean(y x) equals the
    predictions' mean(p x) + lam (1 - alpha) w + lam alpha s, where s is the sign of w, or any number in
    -1..1 where w is 0 (the nearest one is taken), and for the intercept mean(y) equals mean(p).  The
    loss is convex, so no second run of the optimiser is needed to know; one aggregate over the rows is."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(fill)) for c in features]
    margin = F.lit(float(intercept))
    for w, c in zip(coefficients, x):
        margin = margin + F.lit(float(w)) * c
    p, y = 1 / (1 + F.exp(-margin)), F.col(target).cast("double")
    aggs = [F.avg(y).alias("y"), F.avg(p).alias("p")]
    for j, c in enumerate(x):
        aggs += [F.avg(y * c).alias(f"y{j}"), F.avg(p * c).alias(f"p{j}"), F.stddev_pop(c).alias(f"s{j}")]
    row = rows.agg(*aggs).first()
    out = [("(intercept)", row.y, row.p, abs(row.y - row.p))]
    for j, (f, w) in enumerate(zip(features, coefficients)):
        unit = row[f"s{j}"] or 1.0
        label, fitted = row[f"y{j}"], row[f"p{j}"] + lam * (1 - alpha) * float(w)
        l1 = lam * alpha
        fitted += l1 * float(np.sign(w)) if w else float(np.clip(label - fitted, -l1, l1))
        out.append((f, label / unit, fitted / unit, abs(label - fitted) / unit))
    return rows.sparkSession.createDataFrame([(f, *map(float, v)) for f, *v in out], "feature string, label_moment double, fitted_moment double, gap double")


def model_mlp(n_features: int, hidden=(32, 16), max_iter: int = 100, seed: int = 28) -> Estimator:
    """model_mlp: dense network (re-aimed to MultilayerPerceptronClassifier)."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], maxIter=max_iter, seed=seed)


# ---------------------------------------------------------------- feature preparation
def assemble(df: DataFrame, features: list[str], fill: float = -1.0, out: str = "features", more: list[str] = ()) -> DataFrame:
    """Nulls -> ``fill`` (the reference fills -1 before boosting), then a vector; ``more`` are encoded columns, taken as they are."""
    d = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill)) for c in features})
    return VectorAssembler(inputCols=[*features, *more], outputCol=out, handleInvalid="keep").transform(d)


PRED, PROB, RAW = "__pred", "__prob", "__raw"


def positive_probability(pred: DataFrame | None = None, col: str = PROB) -> F.Column:
    return vector_to_array(F.col(col))[1]


def private_outputs(est: Estimator) -> Estimator:
    """Route model outputs to private column names (inputs may hold 'prediction')."""
    if est.hasParam("predictionCol"):
        est = est.setPredictionCol(PRED)
    if est.hasParam("probabilityCol"):
        est = est.setProbabilityCol(PROB)
    if est.hasParam("rawPredictionCol"):
        est = est.setRawPredictionCol(RAW)
    return est


def importances(model, features: list[str]) -> dict[str, float]:
    """feature_importance: tree gain share, or |coefficient| for linear models."""
    if hasattr(model, "featureImportances"):
        v = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        v = np.abs(model.coefficients.toArray())
    else:
        return {}
    return {f: float(x) for f, x in zip(features, v)}


# ---------------------------------------------------------------- categories inside the driver
CAT_MODES = ("drop", "label", "category", "onehot")
# A dictionary of at most this many bytes is broadcast (Spark's own default for a small side).
SMALL_DICTIONARY = 10 * 2**20


class Encoding:
    """The category handling of one training set: dictionaries of its rows alone.

    drop      categories are left out
    label     codes of the sorted values; unseen and NULL are -1
    category  the same codes as nominal attributes, so that trees split by sets of them; unseen and
              NULL are one more category
    onehot    one sparse vector per category without its first level (no column per level);
              unseen and NULL are all zeros
    """

    def __init__(self, fit_rows: DataFrame, cats: list[str], mode: str):
        from .encode import ordinal_dictionary
        if mode not in CAT_MODES:
            raise ValueError(f"category mode {mode!r} is none of {CAT_MODES}")
        self.cats, self.mode = list(cats), mode
        self.dictionary = pin(ordinal_dictionary(fit_rows, self.cats)) if cats and mode != "drop" else None
        # one row per category column
        sizes = [F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 64).alias("bytes")]
        said = self.dictionary.groupBy("feature").agg(*sizes).collect() if self.dictionary is not None else []
        self.levels = {r.feature: r.n for r in said}
        self.small = {r.feature for r in said if r.bytes <= SMALL_DICTIONARY}

    def transform(self, rows: DataFrame, broadcast: bool = False) -> tuple[DataFrame, list[str]]:
        """(rows with the encoded columns, names of the columns to assemble); with ``broadcast`` small
        dictionaries cost the rows no exchange."""
        from .encode import encode_ordinal
        if self.dictionary is None:
            return rows.drop(*self.cats), []
        out = encode_ordinal(rows, self.dictionary, self.cats, small=self.small if broadcast else ())
        if self.mode == "label":
            return out, self.cats
        names = []
        for c in self.cats:
            n = self.levels.get(c, 0)
            if self.mode == "category":
                code = F.when(F.col(c) < 0, n).otherwise(F.col(c)).cast("double")
                out = out.withColumn(c, code.alias(c, metadata=nominal(c, n + 1)))
                names.append(c)
            elif n > 1:  # the encoder drops the last index, which is the first level's and the unknown's
                code = F.when(F.col(c) < 1, n - 1).otherwise(F.col(c) - 1).cast("double")
                out = out.withColumn(f"__i_{c}", code.alias(f"__i_{c}", metadata=nominal(c, n)))
                one = OneHotEncoder(inputCols=[f"__i_{c}"], outputCols=[f"{c}_onehot"], dropLast=True)
                out = one.fit(out.limit(0)).transform(out).drop(f"__i_{c}")
                names.append(f"{c}_onehot")
        return out, names

    @staticmethod
    def sizes(df: DataFrame, vector: str) -> list[int]:
        """Numbers of values of the nominal attributes of an assembled column."""
        attrs = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
        return [len(a["vals"]) for a in attrs.get("nominal", [])]

    def width(self, c: str) -> int:
        """Places that a category takes in the assembled vector."""
        if self.dictionary is None:
            return 0
        return max(0, self.levels.get(c, 0) - 1) if self.mode == "onehot" else 1


def nominal(name: str, n: int) -> dict:
    return {"ml_attr": {"type": "nominal", "name": name, "vals": [str(i) for i in range(n)]}}


# ---------------------------------------------------------------- stored fits
class FitStore:
    """Predictions of single fits in one folder of the shared storage, written once each.

    A fit's rows (key, fold, run, split, prediction) are one committed write; a driver that starts again
    with the same name skips the fits that are there.  The first write notes what is being
    fitted, and a store of something else is refused."""

    def __init__(self, spark: SparkSession, path: str, about: str):
        self.spark, self.path, self.about = spark, path.rstrip("/"), about
        if self._there(f"{self.path}/about/_SUCCESS"):
            found = spark.read.text(f"{self.path}/about", wholetext=True).first()[0].strip()
            if found != about.strip():
                raise ValueError(f"the store {path} holds other fits: {found[:200]}")
        else:
            spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/about")

    def _there(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _at(self, fold, run: int) -> str:
        return f"{self.path}/fits/fold-{fold}-run-{run}"

    def done(self, fold, run: int) -> bool:
        return self._there(f"{self._at(fold, run)}/predictions/_SUCCESS")

    def write(self, fold, run: int, predictions: DataFrame, gains: dict[str, float]) -> None:
        """The predictions come last: a fit counts as done once they are committed."""
        at = self._at(fold, run)
        rows = [(f, float(x)) for f, x in gains.items()]
        self.spark.createDataFrame(rows, "feature string, gain double").coalesce(1).write.mode("overwrite").parquet(f"{at}/gains")
        predictions.withColumn("fold", F.lit(fold)).withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{at}/predictions")

    def predictions(self, fits: list[tuple]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self._at(*f)}/predictions" for f in fits])

    def gains(self, fits: list[tuple]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self._at(*f)}/gains" for f in fits])


def bag_predictions(stored: DataFrame, key: str, by: tuple[str, ...] = (), out: str = "prediction") -> DataFrame:
    """bag_predictions: the mean over all stored fits (runs and folds) that predicted a row."""
    return stored.groupBy(key, *by).agg(F.avg("p").alias(out))


# ---------------------------------------------------------------- CV driver
def train_cv_oof(train: DataFrame, test: DataFrame | None, key: str, features: list[str],
                 make_model: Callable[[int], Estimator], target: str = "target", fold_col: str = "val_fold_n",
                 runs_per_fold: int = 1, score_fn: Callable | None = None, validation: bool = False,
                 residual_of: str | None = None, val_filter=None, cats: list[str] = (), cat_mode: str = "drop",
                 store: str | None = None) -> tuple[DataFrame, DataFrame | None, dict]:
    """train_cv_oof: for every fold k fit on the other folds (``runs_per_fold``
    seeds), predict fold k (first copy per key if rows were augmented) and the
    test set.  Returns (oof[key, fold, oof_pred], test[key, prediction], log).

    ``cats``/``cat_mode``: category columns, encoded with the dictionaries of the fold's
    training rows alone (:class:`Encoding`).  A training key may have several rows (statements);
    ``val_filter`` picks the row to predict (default: one per key).
    ``validation``: pass the held-out fold as ``validationIndicatorCol`` (early
    stopping on GBT).  ``residual_of``: fit a regressor on target - base and
    add the base prediction back (model_residual).
    ``store``: folder in which finished fits are kept; called again with it, only missing
    fits are made.  By default a new one in the checkpoint folder."""
    spark = train.sparkSession
    store_path = store or os.path.join(ensure_checkpoint_dir(spark), f"fits-{uuid.uuid4().hex}")
    about = f"key={key} target={target} features={','.join(features)} cats={','.join(cats)} mode={cat_mode} residual_of={residual_of} model={type(make_model(0)).__name__}"
    fits_at = FitStore(spark, store_path, about)
    tr = pin(train)  # every fold's fit and prediction reads these rows, so what makes them runs once
    folds = sorted(r[0] for r in tr.select(fold_col).distinct().collect())
    fits = [(k, run) for k in folds for run in range(runs_per_fold)]
    log = {"features": list(features), "folds": folds}
    te = pin(test) if test is not None and not all(fits_at.done(*f) for f in fits) else None
    for k in folds:
        if all(fits_at.done(k, run) for run in range(runs_per_fold)):
            continue
        coded = Encoding(tr.where(F.col(fold_col) != k), cats, cat_mode)

        def ready(rows, coded=coded):
            rows, more = coded.transform(rows)
            return assemble(rows, features, more=more)

        fit_df = ready(tr.withColumn("__val", F.col(fold_col) == k))
        if not validation:
            fit_df = fit_df.where(~F.col("__val"))
        if residual_of:
            fit_df = fit_df.withColumn("__res", F.col(target).cast("double") - F.col(residual_of))
        held = tr.where(F.col(fold_col) == k)
        held = held.where(val_filter) if val_filter is not None else held.dropDuplicates([key])
        parts = [ready(held).withColumn("split", F.lit("oof"))]
        if te is not None:
            parts.append(ready(te).withColumn("split", F.lit("test")))
        for run in range(runs_per_fold):
            if fits_at.done(k, run):
                continue
            est = private_outputs(make_model(run)).setLabelCol("__res" if residual_of else target)
            if validation:
                est = est.setValidationIndicatorCol("__val")
            model = est.fit(fit_df)
            p = F.col(PRED) + F.col(residual_of) if residual_of else positive_probability(None)
            said = [model.transform(x).select(key, "split", p.alias("p")) for x in parts]
            names = [f for f in features] + [f"{c}[{i}]" for c in cats for i in range(coded.width(c))]
            fits_at.write(k, run, said[0] if len(said) == 1 else said[0].unionByName(said[1]), importances(model, names))
    said = fits_at.predictions(fits)
    oof = bag_predictions(said.where("split = 'oof'"), key, ("fold",), "oof_pred").withColumnRenamed("fold", fold_col)
    test_pred = bag_predictions(said.where("split = 'test'"), key) if test is not None else None
    # importances averaged over the real number of fits; one row per feature
    gains = fits_at.gains(fits).groupBy("feature").agg((F.sum("gain") / len(fits)).alias("gain")).collect()
    if gains:
        log["Aggregated_FI"] = sorted(((r.feature, r.gain) for r in gains), key=lambda x: (-x[1], x[0]))
    if score_fn is not None:
        scored = oof.join(tr.select(key, target).dropDuplicates([key]), key)
        log.update(score_fn(scored))
    return oof, test_pred, log


# ---------------------------------------------------------------- prefix ensembles
def prefix_margins(model, rows: DataFrame, keep: list[str], out: str = "margins") -> DataFrame:
    """``keep`` columns and the array of margins after 1, 2, ..., T trees of a boosted model, in one pass
    (each tree is applied once; a prefix is a running sum of the trees' weighted predictions).

    The margins are pinned: a filter inferred from what reads them would be rewritten by the planner in
    terms of every subset of the tree columns, which no driver can hold."""
    d = rows.select(*keep, "features")
    weights = [float(w) for w in model.treeWeights]
    for i, tree in enumerate(model.trees):
        d = tree.copy().setPredictionCol(f"__tree{i}").transform(d)
    steps, total = [], F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.lit(w) * F.col(f"__tree{i}")
        steps.append(total)
    return pin(d.select(*keep, F.array(*steps).alias(out)))


def prefix_scores(margins: DataFrame, key: str, target: str, col: str = "margins") -> DataFrame:
    """n_trees, score: the ranking score of every prefix ensemble, by running sums grouped on the prefix.

    The score depends on the order alone, so margins rank like probabilities."""
    each = margins.select(F.col(key).alias("id"), F.col(target).alias("target"), F.posexplode(col).alias("__i", "prediction"))
    return M.metric_frame(each.withColumn("n_trees", F.col("__i") + 1), by=("n_trees",)).select("n_trees", "score")


def best_prefix(scored: DataFrame) -> tuple[int, float] | None:
    """(n_trees, score) of the best prefix, the shortest of equal ones; at most one row per tree is read."""
    rows = [r for r in scored.collect() if r.score is not None]
    best = max(rows, key=lambda r: (r.score, -r.n_trees), default=None)
    return (int(best.n_trees), float(best.score)) if best else None


def early_stop_by_metric(train: DataFrame, key: str, features: list[str], make_model: Callable[[], Estimator],
                         target: str = "target", fold_col: str = "val_fold_n") -> DataFrame:
    """early_stop_by_metric: per fold the number of trees with the best ranking score on the held-out
    fold, as the callback that keeps the best iteration does; fold, n_trees, n_fitted, score."""
    a = pin(assemble(train, features).select(key, target, fold_col, "features"))
    out = []
    for k in sorted(r[0] for r in a.select(fold_col).distinct().collect()):
        model = private_outputs(make_model()).setLabelCol(target).fit(a.where(F.col(fold_col) != k))
        margins = prefix_margins(model, a.where(F.col(fold_col) == k), [key, target])
        best = best_prefix(prefix_scores(margins, key, target))
        out.append((k, best[0] if best else None, len(model.trees), best[1] if best else None))
    return train.sparkSession.createDataFrame(out, "fold int, n_trees int, n_fitted int, score double")


def oof_scores(oof_with_target: DataFrame, key: str = "customer_id", fold_col: str = "val_fold_n") -> dict:
    """metric_by_fold on an OOF table -> {'Fold k OOF', 'Total OOF score', 'Average OOF score'}."""
    d = oof_with_target.withColumnRenamed("oof_pred", "prediction").withColumnRenamed(key, "id")
    rows = M.score_by_fold(d, fold=fold_col).collect()
    out = {}
    for r in rows:
        if r["fold"] == "pooled":
            out["Total OOF score"] = r["score"]
        elif r["fold"] == "mean":
            out["Average OOF score"] = r["score"]
        else:
            out[f"Fold {r['fold']} OOF"] = r["score"]
    return out


# ---------------------------------------------------------------- stacking
def meta_features(preds: dict[str, DataFrame], key: str, col: str = "oof_pred") -> DataFrame:
    """meta_features: full-outer alignment of per-model prediction tables,
    columns renamed ``oof_pred_<model>``."""
    out = None
    for name, d in preds.items():
        d = d.select(key, F.col(col).alias(f"oof_pred_{name}"))
        out = d if out is None else out.join(d, key, "full_outer")
    return out


def logit_scale(train: DataFrame, test: DataFrame | None, cols: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """clip -> logit on both splits, then standard scaling fitted on train U test."""
    tr, te = logits(train, cols), logits(test, cols)
    both = tr.select(*cols) if te is None else tr.select(*cols).unionByName(te.select(*cols))
    row = both.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    sc = {c: (F.col(c) - row[f"m_{c}"]) / (row[f"s_{c}"] or 1.0) for c in cols}
    return tr.withColumns(sc), (te.withColumns(sc) if te is not None else None)


def logits(df: DataFrame | None, cols: list[str]) -> DataFrame | None:
    return df.withColumns({c: logit(clip(c, 1e-4, 1 - 1e-4)) for c in cols}) if df is not None else None


def stack(train: DataFrame, test: DataFrame | None, key: str, cols: list[str], kind: str = "logistic",
          C: float = 0.05, l1_ratio: float = 0.0, refit: bool = True, **kw):
    """stack_logistic_l1 / stack_gbt_l1 / stack_logistic_l2: clip -> logit ->
    (scale) -> CV of a logistic or GBT stacker; with ``refit`` the test predictions are those of
    one fit on all training rows, else the mean of the folds'."""
    tr, te = logit_scale(train, test, cols) if kind == "logistic" else (logits(train, cols), logits(test, cols))
    tr = pin(tr)
    n = tr.count()
    if kind == "logistic":
        make = lambda run: model_logistic(C=C, n=n, l1_ratio=l1_ratio)
    else:
        make = lambda run: model_gbt(seed=28 + run, **kw)
    refit = refit and te is not None
    oof, test_pred, log = train_cv_oof(tr, None if refit else te, key, cols, make)
    if refit:
        full = private_outputs(make(0)).setLabelCol("target").fit(assemble(tr, cols))
        log["refit"] = True
        test_pred = pin(full.transform(assemble(te, cols)).select(key, positive_probability(None).alias("prediction")))
    return oof, test_pred, log


# ---------------------------------------------------------------- imputation
# Cells (rows x inputs) in one piece of the matrix; a fit holds 40 to 70 bytes for each.
PIECE_CELLS = 2**20


def impute_model(df: DataFrame, features: list[str], cols: list[str] | None = None, kind: str = "gbt",
                 max_iter: int = 20, seed: int = 28, cats: list[str] = ()) -> DataFrame:
    """impute_model: for every column with NULLs fit a regressor on the rows
    where it is present (inputs: the *original* other columns, NULL -> -1, and the categories
    ``cats`` as nominal attributes) and predict the missing cells.

    All inputs are assembled and written once; a target's fit reads that matrix without its own
    place.  Known cells stay as they are, and no prediction is joined back.  The matrix lies in pieces of a
    bounded number of cells, as many as the rows need: what a task of a fit holds does not grow with them.
    Rows that fill one piece stay in the order of their joins, which the thresholds sampled by MLlib follow."""
    nulls = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in features]).first()
    cols = [c for c in (cols or features) if nulls[c]]
    if not cols:
        return df
    pieces = -(-nulls["__rows"] * (len(features) + len(cats)) // PIECE_CELLS)
    rows = df.repartition(pieces) if pieces > 1 else df
    coded, names = Encoding(df, cats, "category").transform(rows.withColumns({f"__was_{c}": F.col(c) for c in cats}), broadcast=pieces > 1)
    coded = coded.withColumns({f"__in_{f}": F.coalesce(F.col(f).cast("double"), F.lit(-1.0)) for f in features})
    inputs = [f"__in_{f}" for f in features] + names
    whole = VectorAssembler(inputCols=inputs, outputCol="__all", handleInvalid="keep").transform(coded)
    out = pin(whole.drop(*inputs).withColumnsRenamed({f"__was_{c}": c for c in cats}))
    # categories in the matrix keep their attributes through the write: they stand in its metadata
    out = out.withColumn("__all", F.col("__all").alias("__all", metadata=whole.schema["__all"].metadata))
    bins = max([32, *(n + 1 for n in Encoding.sizes(whole, "__all"))])
    for c in cols:
        mine = inputs.index(f"__in_{c}")
        x = VectorSlicer(inputCol="__all", outputCol="__x", indices=[i for i in range(len(inputs)) if i != mine])
        est = (GBTRegressor(featuresCol="__x", labelCol=c, predictionCol="__imp", maxIter=max_iter, maxDepth=4, seed=seed, maxBins=bins)
               if kind == "gbt" else LinearRegression(featuresCol="__x", labelCol=c, predictionCol="__imp"))
        rows = x.transform(out)
        out = est.fit(rows.where(F.col(c).isNotNull())).transform(rows)
        out = out.withColumn(c, F.coalesce(F.col(c), F.col("__imp"))).drop("__x", "__imp")
    return out.select(*df.columns)


# ---------------------------------------------------------------- tree-split capping
def tree_split_values(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """All continuous split thresholds of a fitted tree ensemble as
    (feature, threshold): the model is saved to the shared checkpoint folder
    and its node data read back as a DataFrame."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"tree-model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    s = nodes.select(F.col("nodeData.split.featureIndex").alias("fi"),
                     F.col("nodeData.split.leftCategoriesOrThreshold").alias("t"),
                     F.col("nodeData.split.numCategories").alias("nc"))
    s = s.where((F.col("fi") >= 0) & (F.col("nc") < 0)).select("fi", F.element_at("t", 1).alias("threshold"))
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "fi int, feature string")
    return s.join(F.broadcast(names), "fi").select("feature", "threshold")


def cap_bounds_from_trees(spark: SparkSession, last_rows: DataFrame, features: list[str], target: str = "target",
                          fold_col: str = "val_fold_n", max_iter: int = 30, cats: list[str] = ()) -> dict[str, list[float]]:
    """cap_bounds_from_trees: train a GBT on the last statements (fold 0 held
    out; ``cats`` as nominal inputs), histogram each feature's distinct split values (one bin per
    distinct value); with >= 6 edges keep edges 0, 2, -3, -1.

    The splits are bounded by the model: at most trees x 2^depth values."""
    fit_rows = last_rows.where(F.col(fold_col) != 0)
    rows, names = Encoding(fit_rows, cats, "category").transform(fit_rows)
    a = assemble(rows, features, more=names)
    bins = max([32, *(n + 1 for n in Encoding.sizes(a, "features"))])
    m = model_gbt(max_iter=max_iter, maxBins=bins).setLabelCol(target).fit(a)
    th = tree_split_values(spark, m, [*features, *names]).where(F.col("feature").isin(list(features)))
    per = th.distinct().groupBy("feature").agg(F.sort_array(F.collect_list("threshold")).alias("t")).collect()
    out = {}
    for r in per:
        vals = np.array(r["t"], dtype=float)
        edges = np.histogram(vals, bins=len(vals))[1]
        if len(edges) >= 6:
            out[r["feature"]] = [float(edges[0]), float(edges[2]), float(edges[-3]), float(edges[-1])]
    return out


def standard_scaled_vector(df: DataFrame, features: list[str]) -> DataFrame:
    """Assembled + standard-scaled feature vector (for the MLP)."""
    a = assemble(df, features, out="__x_raw")
    return StandardScaler(inputCol="__x_raw", outputCol="features", withMean=True, withStd=True).fit(a).transform(a)

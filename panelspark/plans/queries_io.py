"""Registered queries: scans and sinks.  Sinks are checked by
reading back what Spark wrote into a fresh folder under the shared
checkpoint dir."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import metrics as M
from ..operators import relational as R
from ..operators import sequences as Q
from ..sources import io as IO
from ..sources.fixtures import DAYS_SPEC as DS
from ..sources.fixtures import ORDERS_SPEC as SP
from ..sources.fixtures import customer_labels, panel_days, panel_orders, scores
from . import oracle as O
from .catalog import register
from .queries_seq import V2_CTES


def W(*ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def _csv_labels(spark, sf):
    """scan_csv_labels: labels written as header CSV, read back with a schema."""
    p = IO.sink_csv(customer_labels(spark, sf).withColumn("target", F.col("target").cast("int")), IO.scratch_path(spark, "labels-csv"))
    return IO.scan_csv(spark, p, IO.LABEL_SCHEMA)


register("scan_csv_labels", W(O.CUSTOMER_LABELS, final="SELECT customer_id, CAST(target AS INTEGER) AS target FROM labels_c"))(_csv_labels)


def _csv_preds(spark, sf):
    """scan_csv_predictions: an externally supplied prediction CSV."""
    preds = panel_orders(spark, sf).groupBy("customer_id").agg((F.avg("p_2") / 500000.0).alias("prediction"))
    p = IO.sink_csv(preds, IO.scratch_path(spark, "preds-csv"))
    return IO.scan_csv(spark, p, IO.PRED_SCHEMA)


register("scan_csv_predictions", W(O.PANEL_ORDERS, "g AS (SELECT customer_id, avg(p_2) / 500000.0 AS prediction FROM panel GROUP BY 1)",
                                   final=O.report(["prediction"], ["customer_id"])))(_csv_preds)
register("sink_csv_predictions", W(O.PANEL_ORDERS, "g AS (SELECT customer_id, avg(p_2) / 500000.0 AS prediction FROM panel GROUP BY 1)",
                                   final=O.report(["prediction"], ["customer_id"])))(_csv_preds)


def _load(spark, sf):
    """load_features: two prediction tables written as Parquet, aligned as meta features."""
    s = scores(spark, sf)
    a = IO.sink_parquet(s.select("id", F.col("prediction").alias("oof_pred")).where("val_fold_n <> 4"), IO.scratch_path(spark, "m1"), ())
    b = IO.sink_parquet(s.select("id", F.col("prediction_2").alias("oof_pred")).where("val_fold_n <> 3"), IO.scratch_path(spark, "m2"), ())
    return IO.load_features(spark, {"m1": a, "m2": b}, "id", is_meta=True)


register("load_features", "WITH " + O.SCORES + ", a AS (SELECT id, prediction AS oof_pred_m1 FROM scores WHERE val_fold_n <> 4), "
         "b AS (SELECT id, prediction_2 AS oof_pred_m2 FROM scores WHERE val_fold_n <> 3), g AS (SELECT * FROM a FULL OUTER JOIN b USING (id)) "
         + O.report(["oof_pred_m1", "oof_pred_m2"], ["id"]))(_load)


def _sink_parquet(spark, sf):
    """sink_parquet: date features of both splits written partitioned by dset, read back."""
    p = panel_orders(spark, sf)
    f = feat.date_features(p, SP).join(p.select("customer_id", "dset").distinct(), "customer_id")
    path = IO.sink_parquet(f, IO.scratch_path(spark, "date-features"), ("dset",))
    return spark.read.parquet(path).select("customer_id", "dset", "month_gap_count", "month_gap_mean")


def _sink_sql():
    from .queries import DATE_SQL
    return ("WITH d AS (" + DATE_SQL + "), " + O.PANEL_ORDERS + ", s AS (SELECT DISTINCT customer_id, dset FROM panel) "
            "SELECT d.customer_id, s.dset, d.month_gap_count, d.month_gap_mean FROM d JOIN s USING (customer_id)")


register("sink_parquet", _sink_sql())(_sink_parquet)


def _log(spark, sf):
    """model_log_json: a run log (features, fold scores, importances) written as
    JSON and the importances read back."""
    p = panel_orders(spark, sf)
    sh = feat.null_shares(p, list(SP.features), SP.sentinel)
    mf = M.metric_frame(scores(spark, sf)).first()
    log = {"model_kwargs": {"kind": "fixture"}, "features": list(SP.features), "Total OOF score": mf["score"],
           "Aggregated_FI": sorted(((c, 1.0 - v) for c, v in sh.items()), key=lambda x: -x[1])}
    path = IO.write_json_rows(IO.model_log_frame(spark, log), IO.scratch_path(spark, "model-log"))
    return IO.read_importances(spark, path)


_imp = " UNION ALL ".join([f"SELECT '{c}' AS feature, 1.0 - avg(CASE WHEN {c} IS NULL OR {c} = -1 THEN 1.0 ELSE 0.0 END) AS importance FROM panel" for c in O.NUM]
                          + [f"SELECT '{c}' AS feature, 1.0 - avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS importance FROM panel" for c in O.CAT])
register("model_log_json", W(O.PANEL_ORDERS, f"g AS ({_imp})", final=O.report(["importance"], ["feature"])))(_log)


def _caps_json(spark, sf):
    """cap_bounds_json: learned split values written as JSON, read back, applied as bounds."""
    from .queries_core import _learned_splits
    sp = _learned_splits(spark, sf)
    path = IO.write_json_rows(IO.cap_bounds_frame(spark, sp), IO.scratch_path(spark, "cap-bounds"))
    back = IO.read_cap_bounds(spark, path)
    b = R.learned_bounds(back)
    return spark.createDataFrame([(k, float(lo), float(hi)) for k, (lo, hi) in sorted(b.items())], "feature string, lo double, hi double")


register("cap_bounds_json", W(O.PANEL_ORDERS, "pc AS (SELECT " + O.clean("p_2") + " AS p_2, " + O.clean("b_1") + " AS b_1 FROM panel WHERE dset = 'train')",
                              "q AS (SELECT quantile_cont(p_2, [0.05, 0.1, 0.9, 0.95]) AS qp, quantile_cont(b_1, [0.05, 0.1, 0.9, 0.95]) AS qb FROM pc)",
                              "g AS (SELECT 'b_1' AS feature, 2 * qb[1] - qb[2] AS lo, 2 * qb[4] - qb[3] AS hi FROM q UNION ALL SELECT 'p_2', 2 * qp[1] - qp[2], 2 * qp[4] - qp[3] FROM q)",
                              final=O.report(["lo", "hi"], ["feature"])))(_caps_json)


def _sink_seq(spark, sf):
    """sink_sequences: keyed sequence rows written to Parquet and read back."""
    path = IO.sink_sequences(Q.sequence_v2(panel_days(spark, sf), DS), IO.scratch_path(spark, "seq-v2"))
    return spark.read.parquet(path)


register("sink_sequences", W(*V2_CTES, final=f"SELECT customer_id, {O.seq_report('seq')} FROM s"))(_sink_seq)


def _drop_low(spark, sf):
    """drop_low_importance: importances read back from a written model log;
    features at or below the threshold (0.5 non-missing share) are dropped."""
    p = panel_orders(spark, sf)
    sh = feat.null_shares(p, list(SP.features), SP.sentinel)
    log = {"features": list(SP.features), "Aggregated_FI": [(c, 1.0 - v) for c, v in sh.items()]}
    path = IO.write_json_rows(IO.model_log_frame(spark, log), IO.scratch_path(spark, "fi-log"))
    imp = IO.read_importances(spark, path)
    return R.drop_low_importance(p, imp, 0.5)


_keep = ", ".join(O.f(c, c) if c in O.NUM else c for c in ["customer_id", "s_2", "seq", "p_2", "b_1", "d_42", "d_63", "d_64", "dset"])
_imp_cte = "imp AS (" + _imp + ")"
register("drop_low_importance", W(O.PANEL_ORDERS, _imp_cte,
                                  final="SELECT customer_id, s_2, seq, " + O.f("p_2", "p_2") + ", " + O.f("b_1", "b_1") + ", d_63, d_64, dset FROM panel "
                                        "WHERE (SELECT importance FROM imp WHERE feature = 'd_42') <= 0.5"))(_drop_low)

"""Scans and sinks (§2.1).

Files are the interface between jobs.  Every sink writes with Spark's
committer into a folder (never a driver-side file), so a lost executor only
re-runs its tasks; scratch folders for round trips are created under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), never a
machine-local temp dir.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import ensure_checkpoint_dir

LABEL_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("target", T.IntegerType())])
PRED_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("prediction", T.DoubleType())])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def scan_panel(spark: SparkSession, path: str) -> DataFrame:
    """scan_panel: whole Parquet table."""
    return spark.read.parquet(path)


def scan_pruned(spark: SparkSession, path: str, cols) -> DataFrame:
    """scan_pruned: only the named columns reach the Parquet reader (ReadSchema)."""
    return spark.read.parquet(path).select(*cols)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """scan_csv_labels / scan_csv_predictions: header CSV with an explicit schema
    (no inferSchema pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def load_features(spark: SparkSession, paths: dict[str, str], key: str, is_meta: bool = False,
                  pred_col: str = "oof_pred") -> DataFrame:
    """load_features: read N feature tables and align them on the key (full
    outer); for meta inputs the prediction column of each is renamed
    ``oof_pred_<name>`` (name = the model / directory name)."""
    out = None
    for name, p in paths.items():
        d = spark.read.parquet(p)
        if is_meta:
            d = d.select(key, F.col(pred_col).alias(f"oof_pred_{name}"))
        out = d if out is None else out.join(d, key, "full_outer")
    return out


def sink_parquet(df: DataFrame, path: str, partition_by=("dset",), mode: str = "overwrite") -> str:
    """sink_parquet: one write per feature family, partitioned by split."""
    w = df.write.mode(mode)
    cols = [c for c in partition_by if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """sink_csv_predictions: header CSV, no index column."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """model_log_json / cap_bounds_json: JSON lines written by Spark."""
    df.write.mode(mode).json(path)
    return path


def model_log_frame(spark: SparkSession, log: dict) -> DataFrame:
    """A run log (kwargs, features, fold scores, importances) as one row."""
    fi = [(str(k), float(v)) for k, v in log.get("Aggregated_FI", [])]
    scores = {k: float(v) for k, v in log.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
    row = (str(log.get("model_kwargs", "")), [str(f) for f in log.get("features", [])], scores, fi)
    schema = ("model_kwargs string, features array<string>, scores map<string,double>, "
              "Aggregated_FI array<struct<feature:string,importance:double>>")
    return spark.createDataFrame([row], schema)


def read_importances(spark: SparkSession, path: str) -> DataFrame:
    """Read importances back from a model log (explode the pair list)."""
    return spark.read.json(path).select(F.explode("Aggregated_FI").alias("f")).select("f.feature", "f.importance")


def cap_bounds_frame(spark: SparkSession, bounds: dict[str, list[float]]) -> DataFrame:
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in sorted(bounds.items())],
                                 "feature string, splits array<double>")


def read_cap_bounds(spark: SparkSession, path: str) -> dict[str, list[float]]:
    """The bounds table is one row per feature (bounded by the schema)."""
    return {r["feature"]: list(r["splits"]) for r in spark.read.json(path).collect()}


def sink_sequences(seqs: DataFrame, path: str, mode: str = "overwrite") -> str:
    """sink_sequences: sequences stay keyed rows (key + array columns) in Parquet."""
    seqs.write.mode(mode).parquet(path)
    return path


def sink_documents(chunks: DataFrame, path: str, entity: str, mode: str = "overwrite") -> None:
    """sink of chunked documents: Parquet, range-partitioned and sorted by (entity, chunk), so that a reader streams
    a document's chunks in order and a document of any length lies in several files."""
    order = [F.col(entity).asc(), F.col("chunk").asc()]
    chunks.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)

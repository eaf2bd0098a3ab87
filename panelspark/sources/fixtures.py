"""Panels derived from the provided test tables (FIXTURES.md §2).

Each builder reads only the columns it needs (Parquet column pruning) and
returns a panel DataFrame; the matching SQL CTE text lives in
:mod:`panelspark.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import PanelSpec

ORDERS_SPEC = PanelSpec(entity="customer_id", ts="s_2", tiebreak="seq",
                        num=("p_2", "b_1", "d_42"), cat=("d_63", "d_64"),
                        sentinel=-1.0, max_periods=13, period="month")

DAYS_SPEC = PanelSpec(entity="customer_id", ts="s_2", tiebreak=None,
                      num=("p_2", "b_1", "d_39"), cat=(), sentinel=None,
                      max_periods=13, period="day")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def panel_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular monthly-ish panel with ties, -1 sentinels, a >=90%-missing
    column, a nullable category and a train/test tag."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("double")
    key = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("s_2"),
        key.alias("seq"),
        price.alias("p_2"),
        F.when(key % 7 == 0, F.lit(-1.0)).otherwise(price).alias("b_1"),
        F.when(key % 13 != 0, F.lit(-1.0)).otherwise(price).alias("d_42"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("d_63"),
        F.col("o_orderpriority").alias("d_64"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("dset"),
    )


def panel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regular daily panel from all events (period unit = day) with a NULL-able
    purchase column; users without events on a day have gaps."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("customer_id"), F.col("ts").cast("date").alias("s_2"))
             .agg(F.round(F.sum("value"), 4).alias("p_2"),
                  F.count(F.lit(1)).cast("double").alias("b_1"),
                  F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), 4).alias("d_39")))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table for metrics/folds/stacking (one row per order)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
        ((k * 7919) % 10007 / F.lit(10007.0)).alias("prediction"),
        (F.col("o_totalprice") / F.lit(500000.0)).alias("prediction_2"),
        (k % 5).alias("val_fold_n"),
    )


def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer learnable target (FIXTURES §2): avg order price > 250000."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("customer_id"))
             .agg(F.when(F.avg("o_totalprice") > 250000, 1).otherwise(0).alias("target")))

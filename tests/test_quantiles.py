"""Exact order statistics: histogram selection, per-entity medians, modes and distinct counts
against plain sorting, on ties, infinities, NaN, nulls and a hot entity."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import aggregates as A
from panelspark.operators import quantiles as Q
from panelspark.operators.relational import fill_col_stat
from panelspark.spec import PanelSpec

INF, NAN = float("inf"), float("nan")
order = lambda x: (math.isnan(x), 0 if math.isnan(x) else x)


def quantile(values, p):
    v = values if isinstance(values, np.ndarray) else sorted((x for x in values if x is not None), key=order)
    if not len(v):
        return None
    at = p * (len(v) - 1)
    lo, hi, w = v[math.floor(at)], v[math.ceil(at)], at - math.floor(at)
    return lo if w == 0 or lo == hi else (1 - w) * lo + w * hi


def alike(a, b):
    if a is None or b is None:
        return a is b
    return a == b or math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12)


@pytest.mark.parametrize("name", ["uniform", "wide", "ties", "tiny", "special", "steps", "one", "none", "huge"])
def test_column_quantiles(spark, name):
    rnd = random.Random(3)
    values = {
        "uniform": [rnd.uniform(-1, 1) for _ in range(4000)],
        "wide": [rnd.choice((-1, 1)) * 10 ** rnd.uniform(-300, 300) for _ in range(3000)],
        "ties": [float(rnd.randint(0, 5)) for _ in range(3000)] + [None] * 500,
        "tiny": [1e15 + rnd.randint(0, 50) * 0.125 for _ in range(3000)],
        "special": [rnd.choice((INF, -INF, NAN, 0.0, 1.0, -0.5, None)) for _ in range(2000)],
        "steps": [2.0 ** -k for k in range(1000)],
        "one": [7.5], "none": [None, None],
        "huge": [1.7e308, -1.7e308, 1e308, -1e308, 0.0, 5e-324] * 50,
    }[name]
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 0.951, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = Q.exact_quantiles(df, {"x": probs})["x"]
    want = [quantile(values, p) for p in probs]
    assert all(alike(a, b) for a, b in zip(got, want)), (got, want)


def test_many_distinct_values_need_few_rounds(spark, monkeypatch):
    df = spark.range(2_000_000).select((F.rand(1) * 1e6 - 3e5).alias("x"), F.exp(F.randn(2) * 20).alias("y"))
    rounds = []
    bucket = Q._bucket
    monkeypatch.setattr(Q, "_bucket", lambda *a: rounds.append(a) or bucket(*a))
    got = Q.exact_quantiles(df, {"x": [0.5], "y": [0.1, 0.9]})
    data = df.toArrow()
    x, y = (np.sort(data.column(c).to_numpy()) for c in "xy")
    want = [quantile(x, 0.5), quantile(y, 0.1), quantile(y, 0.9)]
    assert [got["x"][0], *got["y"]] == want
    assert len(rounds) <= 6 * 4


def panel(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(6000):
        e = -1 if i % 3 == 0 else None if i % 50 == 1 else rnd.randint(0, 40)
        rows.append((e, i, rnd.choice([None, NAN, rnd.uniform(-5, 5), float(rnd.randint(0, 3))]), rnd.choice([None, "a", "b", "c", "dd"]), rnd.randint(0, 2), None))
    df = spark.createDataFrame(rows, "customer_id long, seq long, x double, s string, k int, empty double").withColumn("s_2", F.timestamp_seconds("seq"))
    return rows, df


def test_entity_medians_modes_and_distinct_counts(spark):
    rows, df = panel(spark)
    spec = PanelSpec(num=("x", "empty"), cat=("s", "k"))
    out = A.entity_agg(A.with_order_key(df, spec), spec, [(("x", "empty"), ("mean", "median", "count")), (("s", "k"), ("mode", "last", "nunique"))], [F.count(F.lit(1)).alias("n")])
    assert out.columns == ["customer_id", "x_mean", "x_median", "x_count", "empty_mean", "empty_median", "empty_count", "s_mode", "s_last", "s_nunique", "k_mode", "k_last", "k_nunique", "n"]
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    got = {r.customer_id: r for r in A.agg_panel(df, spec, ["x", "empty"], ["median", "count"]).collect()}
    assert set(got) == set(by)
    for e, own in by.items():
        assert alike(got[e].x_median, quantile([r[2] for r in own], 0.5)) and got[e].empty_median is None
    got = {r.customer_id: r for r in A.agg_panel(df, spec, ["s", "k"], ["mode", "nunique"]).collect()}
    for e, own in by.items():
        for j, c in ((3, "s"), (4, "k")):
            n = Counter(r[j] for r in own if r[j] is not None)
            assert got[e][f"{c}_nunique"] == len(n)
            assert got[e][f"{c}_mode"] == (min(n, key=lambda v: (-n[v], v)) if n else None)


def test_entity_without_any_value(spark):
    spec = PanelSpec(num=("x",), cat=("s",))
    df = spark.createDataFrame([(1, None, None), (2, 3.0, "a"), (None, 1.0, "b")], "customer_id long, x double, s string")
    got = {r.customer_id: tuple(r)[1:] for r in A.entity_agg(df, spec, [(["x"], ["median"]), (["s"], ["mode", "nunique"])]).collect()}
    assert got == {1: (None, None, 0), 2: (3.0, "a", 1), None: (1.0, "b", 1)}


def test_no_unbounded_buffers_in_plans(spark):
    from panelspark.plans import catalog
    catalog.load_all()
    keys = ["agg_median", "agg_panel", "agg_mode", "agg_nunique", "agg_column_profile", "fill_col_stat", "clip_learned_bounds",
            "basic_agg_features", "null_handled_agg_features", "refined_agg_features", "sequence_branched", "sequence_capped"]
    for key in keys:
        plan = catalog.REGISTRY[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert not any(f in plan for f in ("median(", "percentile(", "collect_set(", "mode(")), key


def test_hot_entity_medians_are_spread(spark):
    """The values of one entity with a third of all rows lie in many range partitions."""
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("e"), F.rand(4).alias("x"))
    counts = Q.value_counts(df, ["e"], ["x"], "double")
    spread = counts.repartitionByRange(16, "e", "__c", "__v").where("e = -1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread >= 4
    got = Q.keyed_quantiles(df, ["e"], ["x"]).where("e = -1").first()
    assert got.x_median == df.where("e = -1").agg(F.median("x")).first()[0]


def test_fill_with_median_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    out, vals = fill_col_stat(df, ["x", "y"], "median")
    assert vals == {"x": None, "y": 1.5} and out.count() == 2

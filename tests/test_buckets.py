"""Greedy class-balanced buckets: the composed walk against walking row by row."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import folds as FO


def walk(flags, n, state=(0, 0)):
    q, bucket, out = list(state), 0, []
    for f in flags:
        out.append(bucket)
        if f < 2:
            q[f] += 1
        if q[0] >= n and q[1] >= n:
            q, bucket = [0, 0], bucket + 1
    return out, bucket, tuple(min(n, x) for x in q)


@pytest.mark.parametrize("share", [0.5, 0.1, 0.97])
def test_every_entering_state(share):
    rnd = random.Random(2)
    for size in (0, 1, 5, 60, 400):
        flags = [2 if rnd.random() < 0.05 else int(rnd.random() < share) for _ in range(size)]
        w = FO._Walk(np.array(flags, np.int8), 3)
        for state in [(a, b) for a in range(4) for b in range(4) if a < 3 or b < 3]:
            want, bucket, left = walk(flags, 3, state)
            assert w.leave(state) == (bucket, left)
            got = w.buckets(state)
            assert got[0].tolist() == want and got[1:] == (bucket, left)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_buckets_over_pieces(spark, parts):
    rnd = random.Random(parts)
    rows = [(i, None if i % 37 == 0 else float(rnd.randint(0, 40)), None if i % 101 == 0 else int(rnd.random() < 0.3)) for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "id long, v double, target int")
        got = {r.id: (r.pos, r.bucket) for r in FO.greedy_buckets(df, "id", "v", n=4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    want, _, _ = walk([2 if r[2] is None else r[2] for r in order], 4)
    assert got == {r[0]: (k, b) for k, (r, b) in enumerate(zip(order, want))}


def test_empty_and_one_class(spark):
    df = spark.createDataFrame([(i, float(i), 1) for i in range(50)], "id long, v double, target int")
    assert FO.greedy_buckets(df.where("id < 0"), "id", "v").count() == 0
    assert FO.greedy_buckets(df, "id", "v").agg(F.max("bucket")).first()[0] == 0


def test_number_of_jobs_does_not_depend_on_the_rows(spark):
    def jobs(n):
        df = spark.range(n).select("id", F.rand(1).alias("v"), (F.rand(2) < 0.5).cast("int").alias("target"))
        spark.sparkContext.setJobGroup(f"buckets{n}", "count jobs")
        try:
            FO.greedy_buckets(df, "id", "v").count()
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"buckets{n}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs(100_000) <= jobs(500) + 1

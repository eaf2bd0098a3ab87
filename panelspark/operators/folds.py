"""Fold assignment (§2.12): stratified k folds and class-balanced buckets.

Ranks inside a class come from the two-level running sum of
:mod:`.metrics` -- ``row_number() OVER (PARTITION BY target ...)`` would put
each class (half the table or more) into a single task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metrics import running_sums
from .ordered import pin

# Fold count and seed of the reference's fold files.
N_FOLDS = 5
SEED = 28


def shuffle_key(key: str, seed: int = SEED):
    """Deterministic pseudo-random order: md5 of 'key:seed' (same in DuckDB)."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_folds(labels: DataFrame, key: str, stratum: str = "target", k: int = N_FOLDS,
                     seed: int = SEED, out: str = "val_fold_n") -> DataFrame:
    """Shuffled stratified folds: within each stratum, entities in md5 order
    are dealt round-robin to folds, so per-class fold sizes differ by <= 1.
    (Same guarantee as a shuffled StratifiedKFold, not the same assignment.)"""
    d = labels.withColumns({"__h": shuffle_key(key, seed), "__one": F.lit(1.0)})
    r = running_sums(d, [F.col("__h").asc(), F.col(key).asc()], ["__one"], by=(stratum,))
    return r.withColumn(out, (F.pmod(F.col("cum___one").cast("long") - 1, F.lit(k))).cast("int")).drop(
        "__h", "__one", "cum___one")


class _Walk:
    """The greedy walk over one piece of the rows (flags: 0 and 1 are the classes, 2 neither).

    A state is the open bucket's count of each class, at most n (more never matters); both
    at n is no state, as the bucket closes there."""

    def __init__(self, flags: np.ndarray, n: int):
        self.n, self.size = n, len(flags)
        self.at = [np.flatnonzero(flags == k) for k in (0, 1)]
        self.before = [np.r_[0, np.cumsum(flags == k)] for k in (0, 1)]
        self.known: dict[int, tuple[int, tuple[int, int]]] = {}

    def close(self, s: int, state: tuple[int, int]) -> int | None:
        """The row at which the bucket closes that is in ``state`` before row s."""
        out = s
        for at, before, have in zip(self.at, self.before, state):
            need = before[s] + self.n - have
            if have < self.n:
                if need > len(at):
                    return None
                out = max(out, int(at[need - 1]))
        return out

    def left(self, s: int, state: tuple[int, int]) -> tuple[int, int]:
        return tuple(min(self.n, have + int(before[-1] - before[s])) for before, have in zip(self.before, state))

    def leave(self, state: tuple[int, int]) -> tuple[int, tuple[int, int]]:
        """(buckets closed, state after the last row) for an entering state; walks that meet go on as one."""
        s, path = 0, []
        while s not in self.known or not path:
            end = self.close(s, state if not path else (0, 0))
            if end is None:
                tail = (0, self.left(s, state if not path else (0, 0)))
                break
            path.append(s)
            s = end + 1
        else:
            tail = self.known[s]
        if path:
            self.known.setdefault(s, tail)
        for k, at in enumerate(reversed(path), 1):
            if at != path[0]:
                self.known[at] = (tail[0] + k, tail[1])
        return tail[0] + len(path), tail[1]

    def buckets(self, state: tuple[int, int]) -> tuple[np.ndarray, int, tuple[int, int]]:
        """Number of buckets closed before each row, in all, and the state after the last row."""
        ends, s, now = [], 0, state
        while (end := self.close(s, now)) is not None:
            ends.append(end)
            s, now = end + 1, (0, 0)
        closed = np.zeros(self.size + 1, np.int64)
        closed[np.array(ends, np.int64) + 1] = 1
        return np.cumsum(closed)[:-1], len(ends), self.left(s, now)


def greedy_buckets(df: DataFrame, key: str, value: str, target: str = "target", n: int = 10) -> DataFrame:
    """win_greedy_buckets: walk the rows in ``value`` order (descending, NULLs
    last, then key) and close a bucket as soon as it holds >= n rows of each class.

    A scan of composed transition tables, in a number of jobs that does not depend on the rows:

    1. the rows are range-partitioned in walking order and pinned;
    2. every piece computes, for each of the (n + 1)^2 - 1 states in which the walk may enter it, the
       state in which it leaves and how many buckets it closed;
    3. these tables (one row per piece) are composed once in order of the pieces;
    4. every piece walks on from its entering state and numbers its rows.

    Returns key, value, target, pos, bucket (raw greedy id)."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = F.col(target).cast("int")
    order = [F.col(value).desc_nulls_last(), F.col(key).asc()]
    flag = F.when(t.isin(0, 1), t).otherwise(2).cast("byte").alias("__flag")
    d = df.select(key, value, target, flag).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    d = pin(d.withColumn("__pid", F.spark_partition_id()))
    states = [(a, b) for a in range(n + 1) for b in range(n + 1) if a < n or b < n]

    def tables(batches):
        pid, rows, now = None, 0, {s: (0, s) for s in states}
        for b in batches:
            if b.num_rows:
                pid, rows = b.column(1)[0].as_py(), rows + b.num_rows
                walk = _Walk(b.column(0).to_numpy(), n)
                step = {s: walk.leave(s) for s in {x for _, x in now.values()}}
                now = {s: (k + step[x][0], step[x][1]) for s, (k, x) in now.items()}
        if pid is not None:
            flat = [v for s in states for v in (now[s][0], *now[s][1])]
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([rows], pa.int64()), pa.array([flat], pa.list_(pa.int64()))], names=["pid", "rows", "table"])

    got = d.select("__flag", "__pid").mapInArrow(tables, "pid int, rows bigint, table array<bigint>").collect()  # one row for each piece
    enter, state, bucket, pos = {}, (0, 0), 0, 0
    for r in sorted(got, key=lambda r: r.pid):
        enter[r.pid] = (*state, bucket, pos)
        i = 3 * states.index(state)
        bucket, state, pos = bucket + r.table[i], (r.table[i + 1], r.table[i + 2]), pos + r.rows
    shared = spark.sparkContext.broadcast(enter)  # one entry for each piece
    fields = [f for f in d.schema if not f.name.startswith("__")]
    schema = T.StructType([*fields, T.StructField("pos", T.LongType()), T.StructField("bucket", T.LongType())])

    def number(batches):
        now = None
        for b in batches:
            if b.num_rows:
                pid = b.column(len(fields) + 1)[0].as_py()
                a, z, bucket, pos = now or shared.value[pid]
                closed, count, left = _Walk(b.column(len(fields)).to_numpy(), n).buckets((a, z))
                now = (*left, bucket + count, pos + b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns[:len(fields)], pa.array(pos + np.arange(b.num_rows)), pa.array(bucket + closed)], names=schema.names)

    return d.mapInArrow(number, schema)


def bucket_strata(buckets: DataFrame, value: str, target: str = "target") -> DataFrame:
    """Post-steps of the bucket trick: NULL value -> -1, bucket 0 -> 1, the last
    bucket merged into the one before; stratum = bucket + target * 10^6."""
    b = F.when(F.col(value).isNull(), F.lit(-1)).otherwise(F.col("bucket"))
    b = F.when(b == 0, F.lit(1)).otherwise(b)
    out = buckets.withColumn("bucket_id", b.cast("long"))
    mx = out.agg(F.max("bucket_id")).first()[0]
    out = out.withColumn("bucket_id", F.when(F.col("bucket_id") == mx, F.lit(mx - 1)).otherwise(F.col("bucket_id")))
    return out.withColumn("stratum", F.col("bucket_id") + F.col(target).cast("long") * 10**6)


def bucket_stratified_folds(labels: DataFrame, key: str, value: str, target: str = "target", k: int = 10,
                            n: int | None = None, seed: int = SEED) -> DataFrame:
    """bucket_stratified_folds: class-balanced buckets of ``value`` x class ->
    stratified k folds (the buckets need >= k rows per class)."""
    st = bucket_strata(greedy_buckets(labels, key, value, target, n or k), value, target)
    f = stratified_folds(st.select(key, target, "stratum"), key, "stratum", k=k, seed=seed)
    return f.select(key, target, "stratum", "val_fold_n")

"""Panel specification and session defaults.

A *panel* is a long table with one row per entity per period (customer x
statement, user x day).  Every order-dependent operator in this package takes
its total order from a :class:`PanelSpec` -- Spark has no row order, so
``last``/``first``/``lag``/``ffill`` are always defined by ``(ts, tiebreak)``.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a panel table.

    entity      key column (customer)
    ts          statement date / timestamp
    tiebreak    second order column for rows sharing a ts (None if ts is unique)
    num, cat    numeric and categorical feature columns
    sentinel    value that encodes "missing" in the raw data (None: no sentinel)
    max_periods history length of the sequence operators (13 statements)
    period      'month' (calendar months, year*12+month) or 'day'
    """

    entity: str = "customer_id"
    ts: str = "s_2"
    tiebreak: str | None = "seq"
    num: tuple[str, ...] = ()
    cat: tuple[str, ...] = ()
    sentinel: float | None = -1.0
    max_periods: int = 13
    period: str = "month"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)

    # -- ordering --------------------------------------------------------
    def order_cols(self, desc: bool = False) -> list[Column]:
        cols = [self.ts] + ([self.tiebreak] if self.tiebreak else [])
        return [F.col(c).desc() if desc else F.col(c).asc() for c in cols]

    def window(self, desc: bool = False) -> WindowSpec:
        """W = partitionBy(entity).orderBy(ts, tiebreak) (rows frame)."""
        return Window.partitionBy(self.entity).orderBy(*self.order_cols(desc))

    def whole(self) -> WindowSpec:
        """Whole-partition frame per entity (no ordering needed)."""
        return Window.partitionBy(self.entity)

    def order_key(self) -> Column:
        """One fixed-width value that sorts like ``(ts, tiebreak)``.

        ``max_by``/``min_by`` with a struct ordering have a variable-width
        buffer, which forces a SortAggregate.  Packing the order into a
        DECIMAL(38,0) (micros * 10^20 + tiebreak + 2^63) keeps the buffer
        mutable, so the aggregate stays a (partial, map-side) hash aggregate.
        """
        micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
        if not self.tiebreak:
            return micros
        hi = micros.cast(T.DecimalType(38, 0)) * F.lit("100000000000000000000").cast(T.DecimalType(38, 0))
        lo = F.col(self.tiebreak).cast(T.DecimalType(38, 0)) + F.lit(str(2**63)).cast(T.DecimalType(38, 0))
        return (hi + lo).cast(T.DecimalType(38, 0))

    def period_index(self, c: str | Column | None = None) -> Column:
        """Integer period number: months since year 0, or days since epoch."""
        col = F.col(c) if isinstance(c, str) else (c if c is not None else F.col(self.ts))
        if self.period == "day":
            return F.unix_date(col.cast("date"))
        return F.year(col) * 12 + F.month(col)

    @property
    def features(self) -> list[str]:
        return list(self.num) + list(self.cat)


# Non-feature columns that a name rule must exclude (role selection).
NON_FEATURES = ("customer_id", "s_2", "seq", "dset", "val_fold_n", "target")


def session_conf(shuffle_partitions: int = 8) -> dict[str, str]:
    """Spark conf used by tests and the bench (no UI, UTC, AQE on)."""
    return {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot key's rows even if that costs one more exchange above the join
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # wide feature plans: keep codegen on for many aggregate expressions
        "spark.sql.codegen.maxFields": "2000",
        # pinned range partitions are checkpointed per call: remove them once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def get_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    b = SparkSession.builder.appName("panelspark")
    if master:
        b = b.master(master)
    for k, v in session_conf(shuffle_partitions).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint dir; where it is unset, a scratch one is set,
    but only for a local master: other machines would not see it."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="panelspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d

"""Skew-safe ordered scans inside an entity (lag, forward fill, running
non-null count, row number).

``Window.partitionBy(entity).orderBy(ts)`` puts a whole entity history into
one task; a hot entity holding a third of the rows would then be one task.
AQE splits skewed joins, not windows.  The scan here is one plan for all sizes:

1. ``repartitionByRange(n, entity, order)`` numbers the rows' partitions.  The
   range bounds include the order, so a hot entity is cut into contiguous
   pieces, one per partition;
2. plain windows run over (entity, piece), never over a whole entity;
3. the result is pinned, and the last row of every piece gives the state it
   hands on.  A window over these rows (one per piece) chains the pieces of an
   entity.  Only pieces that continue an entity need the carry: at most one
   per partition, so that table is broadcast back.

All values stay in the JVM and keep their types (NaN, far timestamps, exact
integers), and workers need no package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PanelSpec


def pin(d: DataFrame) -> DataFrame:
    """Materialise a per-partition result with a reliable ``checkpoint()``
    into the session's shared checkpoint folder.

    Used on the output of a scan over range partitions, whose ``__pid`` was
    taken in the same stage.  Several branches (rows, partition edges) read
    it.  Re-planned separately, each branch would run the Python pass again,
    and its range exchange could re-sample the bounds (when the input is
    cached, or exchange reuse is off).  The ids would then disagree; read from
    one checkpoint they cannot.  The checkpoint also cuts the lineage, so a
    lost executor does not recompute the shuffle.  An eager checkpoint runs its plan once
    (``tests/test_skew.py`` counts), so nothing is persisted for it."""
    from ..spec import ensure_checkpoint_dir
    ensure_checkpoint_dir(d.sparkSession)
    return d.checkpoint(eager=True)


def entity_scan(df: DataFrame, spec: PanelSpec, lag: dict | None = None, ffill: dict | None = None,
                count_nonnull: dict | None = None, row_number: str | None = None,
                n_parts: int | None = None) -> DataFrame:
    """Adds ordered-scan columns per entity in ``(ts, tiebreak)`` order.

    lag            {out: col}  previous row's value (NULL on the entity's first row)
    ffill          {out: col}  last non-null value at or before the row
    count_nonnull  {out: col}  number of non-null values at or before the row
    row_number     out name    1-based position in the entity
    Every input row is kept; the output has the input columns plus the outputs.
    NULL entities form one group, as in a window.
    """
    lag, ffill, cnt = dict(lag or {}), dict(ffill or {}), dict(count_nonnull or {})
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ent, rn = spec.entity, row_number or "__rn_scan"
    w = Window.partitionBy(ent, "__pid").orderBy(*spec.order_cols())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loc = pin(
        df.repartitionByRange(n, F.col(ent).asc(), *spec.order_cols()).withColumn("__pid", F.spark_partition_id())
        .withColumns({o: F.lag(c).over(w) for o, c in lag.items()}
                     | {o: F.last(F.col(c), ignorenulls=True).over(upto) for o, c in ffill.items()}
                     | {o: F.count(F.col(c)).over(upto) for o, c in cnt.items()}
                     | {rn: F.row_number().over(w).cast("long"), "__tail": F.lead(F.lit(1)).over(w).isNull()}))
    earlier = Window.partitionBy(ent).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sources = sorted(set(lag.values()))
    carry = (loc.where("__tail").select(
        F.col(ent).alias("__ent"), F.col("__pid").alias("__piece"), F.sum(rn).over(earlier).alias("__rows"),
        *[F.last(F.struct(F.col(c).alias("v"))).over(earlier)["v"].alias(f"__carry_lag_{c}") for c in sources],
        *[F.last(o, ignorenulls=True).over(earlier).alias(f"__carry_fill_{o}") for o in ffill],
        *[F.sum(o).over(earlier).alias(f"__carry_count_{o}") for o in cnt]).where("__rows IS NOT NULL"))
    out = loc.join(F.broadcast(carry), F.col(ent).eqNullSafe(F.col("__ent")) & (F.col("__pid") == F.col("__piece")), "left")
    later = F.col("__rows").isNotNull()
    out = out.withColumns(
        {o: F.when(later & (F.col(rn) == 1), F.col(f"__carry_lag_{c}")).otherwise(F.col(o)) for o, c in lag.items()}
        | {o: F.coalesce(F.col(o), F.col(f"__carry_fill_{o}")) for o in ffill}
        | {o: F.col(o) + F.coalesce(F.col(f"__carry_count_{o}"), F.lit(0)) for o in cnt}
        | {rn: F.col(rn) + F.coalesce(F.col("__rows"), F.lit(0))})
    return out.select(*df.columns, *lag, *ffill, *cnt, *([row_number] if row_number else []))

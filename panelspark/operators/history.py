"""Window and order-dependent operators (§2.5) and calendar completion (§2.9).

Every window is partitioned by the entity, so it shares the hash partitioning
with the entity ``groupBy`` that usually follows (one exchange per job).
"Last n" filters use ``row_number() <= n``: Spark inserts a partial
``WindowGroupLimit`` below the exchange, so at most n rows per entity and map
task are shuffled -- a hot entity cannot flood one reducer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec
from .ordered import entity_scan
from .relational import join_small


def per_entity(df: DataFrame, spec: PanelSpec, aggs: dict) -> DataFrame:
    """Whole-history per-entity aggregates on every row: a partial
    ``groupBy(entity)`` joined back, where AQE can split a hot entity's rows
    (a window would put the whole entity into one task)."""
    g = df.groupBy(spec.entity).agg(*[v.alias(k) for k, v in aggs.items()])
    return join_small(df, g, spec.entity)


def last_broadcast(df: DataFrame, spec: PanelSpec, col: str | None = None, name: str = "last_ts") -> DataFrame:
    """win_last_broadcast: the entity's last ``ts`` on every row."""
    return per_entity(df, spec, {name: F.max(col or spec.ts)})


def lag_diff(df: DataFrame, spec: PanelSpec, cols, suffix: str = "_diff") -> DataFrame:
    """win_lag_diff: c - previous row's c (NULL on the first row); ordered
    scan, so a hot entity is split over range partitions."""
    out = entity_scan(df, spec, lag={f"__lag_{c}": c for c in cols})
    return out.withColumns({f"{c}{suffix}": F.col(c) - F.col(f"__lag_{c}") for c in cols}).drop(
        *[f"__lag_{c}" for c in cols])


def rank_desc(df: DataFrame, spec: PanelSpec, name: str = "rd") -> DataFrame:
    return df.withColumn(name, F.row_number().over(spec.window(desc=True)))


def nth_from_end(df: DataFrame, spec: PanelSpec, i: int) -> DataFrame:
    """win_nth_from_end: the i-th last row (absent if the history is shorter)."""
    return rank_desc(df, spec, "__rd").where(F.col("__rd") == i).drop("__rd")


def tail_n(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """win_tail_n: the last n rows of every entity."""
    return rank_desc(df, spec, "__rd").where(F.col("__rd") <= n).drop("__rd")


def ffill(df: DataFrame, spec: PanelSpec, cols, within: Column | None = None) -> DataFrame:
    """win_ffill: forward fill within the entity (last non-null up to the row).
    ``within`` restricts the sources (e.g. present statements only)."""
    if within is not None:
        df = df.withColumns({f"__src_{c}": F.when(within, F.col(c)) for c in cols})
    src = (lambda c: c) if within is None else (lambda c: f"__src_{c}")
    out = entity_scan(df, spec, ffill={f"__ff_{c}": src(c) for c in cols})
    out = out.withColumns({c: F.col(f"__ff_{c}") for c in cols}).drop(*[f"__ff_{c}" for c in cols])
    return out if within is None else out.drop(*[f"__src_{c}" for c in cols])


def leading_null_flags(df: DataFrame, spec: PanelSpec, cols, suffix: str = "_leading_null") -> DataFrame:
    """win_leading_null: True for NULLs before the entity's first non-null value."""
    out = entity_scan(df, spec, count_nonnull={f"__nn_{c}": c for c in cols})
    return out.withColumns({f"{c}{suffix}": F.col(f"__nn_{c}") == 0 for c in cols}).drop(
        *[f"__nn_{c}" for c in cols])


def months_ago(df: DataFrame, spec: PanelSpec, name: str = "months_ago") -> DataFrame:
    """win_months_ago: calendar periods between a row and the entity's last row
    (whole months by year*12+month, not months_between)."""
    p = spec.period_index()
    out = per_entity(df.withColumn("__pi", p), spec, {"__pmax": F.max("__pi")})
    return out.withColumn(name, F.col("__pmax") - F.col("__pi")).drop("__pi", "__pmax")


def days_ago(df: DataFrame, spec: PanelSpec, name: str = "days_ago") -> DataFrame:
    """win_days_ago: days between a row and the entity's last row."""
    out = per_entity(df, spec, {"__tsmax": F.max(spec.ts)})
    return out.withColumn(name, F.datediff(F.col("__tsmax"), F.col(spec.ts))).drop("__tsmax")


def sequence_num(df: DataFrame, spec: PanelSpec, ago: str = "months_ago", name: str = "sequence_num") -> DataFrame:
    """win_sequence_num: position from the first period inside the history
    window: max valid periods-ago minus periods-ago (negative before history)."""
    out = per_entity(df, spec, {"__vmax": F.max(F.when(F.col(ago) < spec.max_periods, F.col(ago)))})
    return out.withColumn(name, F.col("__vmax") - F.col(ago)).drop("__vmax")


def except_last(df: DataFrame, spec: PanelSpec, n: int = 1) -> DataFrame:
    """except_last: drop every row on the entity's last date, n times
    (= keep rows older than the entity's n-th last distinct date).

    The n last distinct dates come from a top-n (partial WindowGroupLimit, at
    most n dates per entity and map task are shuffled); the cut is joined back.
    An entity with fewer than n+1 distinct dates loses all rows."""
    dates = df.select(spec.entity, spec.ts).distinct()
    top = dates.withColumn("__r", F.row_number().over(Window.partitionBy(spec.entity).orderBy(F.col(spec.ts).desc())))
    cut = (top.where(F.col("__r") <= n).groupBy(spec.entity)
           .agg(F.min(spec.ts).alias("__cut"), F.count(F.lit(1)).alias("__nd")).where(F.col("__nd") == n))
    return join_small(df, cut, spec.entity).where(F.col(spec.ts) < F.col("__cut")).drop("__cut", "__nd")


def last_n_statements(df: DataFrame, spec: PanelSpec, n: int = 1) -> DataFrame:
    """union_all_nth: 1st-last .. n-th-last statements stacked (one filter)."""
    return tail_n(df, spec, n)


def apply_panel(df: DataFrame, spec: PanelSpec, fn, schema, n: int | None = None) -> DataFrame:
    """apply_panel: a function pandas frame -> pandas frame per entity, for what no expression can say.

    It sees an entity's last ``n`` rows (``max_periods`` by default) in order: a top-n with a partial
    WindowGroupLimit below the exchange cuts the history first, so a hot entity is a group like any other,
    and the groups use the window's partitioning without a further exchange.  A NULL entity is one group.

    Entities go to Python in batches of many, cut where the rank starts anew, so that an entity costs a
    slice and a call, not a transfer of its own.  Integers and booleans travel with a flag for NULL: an
    entity without one keeps their type, whatever the others of its batch hold."""
    order = [spec.ts] + ([spec.tiebreak] if spec.tiebreak else [])
    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    columns = df.columns
    kinds = {f.name: "object" if isinstance(f.dataType, T.BooleanType) else "float64" for f in df.schema
             if f.nullable and isinstance(f.dataType, (T.IntegralType, T.BooleanType))}
    flag = {c: f"__null_{i}" for i, c in enumerate(kinds)}
    keys = ["__entity", *[k for c in order for k in ((flag[c], c) if c in flag else (c,))]]
    fields = {f.name: f.dataType for f in df.schema}
    ranked = rank_desc(df, spec, "__rd").where(F.col("__rd") <= (n or spec.max_periods)).select(
        *[F.coalesce(F.col(c), F.lit(0).cast(fields[c])).alias(c) if c in flag else F.col(c) for c in columns],
        *[F.col(c).isNull().alias(k) for c, k in flag.items()], "__rd")

    def whole(batches):
        """Frames that end where an entity ends."""
        held = []
        for b in batches:
            starts = np.flatnonzero(b["__rd"].to_numpy() == 1)
            if held and len(starts):
                held.append(b.iloc[:starts[-1]])
                yield pd.concat(held, ignore_index=True)
                held, b = [], b.iloc[starts[-1]:]
            elif len(starts) and starts[-1]:
                yield b.iloc[:starts[-1]]
                b = b.iloc[starts[-1]:]
            if len(b):
                held.append(b)
        if held:
            yield pd.concat(held, ignore_index=True)

    def named(out):
        if list(out.columns) == names:
            return out
        if any(isinstance(c, str) for c in out.columns):
            if set(out.columns) != set(names):
                raise ValueError(f"apply_panel: the function returns the columns {list(out.columns)}, the schema says {names}")
            return out[names]
        if len(out.columns) != len(names):
            raise ValueError(f"apply_panel: the function returns {len(out.columns)} columns, the schema has {len(names)}")
        return out.set_axis(names, axis=1)

    def run(batches):
        for d in whole(batches):
            d = d.assign(__entity=np.cumsum(d["__rd"].to_numpy() == 1)).sort_values(keys, kind="stable", ignore_index=True)
            starts = np.flatnonzero(np.diff(d["__entity"].to_numpy(), prepend=0))
            missing = {c: d[k].to_numpy(dtype=bool) for c, k in flag.items()}
            holes = {c: np.logical_or.reduceat(m, starts) for c, m in missing.items() if m.any()}
            d = d[columns]
            said = {}  # results of one type per column can be joined as they are
            for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(d)])):
                pdf = d.iloc[a:b].reset_index(drop=True)
                for c, at in holes.items():
                    if at[i]:
                        pdf[c] = pdf[c].astype(kinds[c]).mask(missing[c][a:b], None if kinds[c] == "object" else np.nan)
                out = fn(pdf)
                if len(out.columns) or len(out):
                    out = named(out)
                    said.setdefault(tuple(out.dtypes), []).append(out)
            for outs in said.values():
                yield pd.concat(outs, ignore_index=True)

    return ranked.mapInPandas(run, schema)


def dedup_keep_first(df: DataFrame, key, order) -> DataFrame:
    """dedup_keep_first: one row per key, the first by ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


# --------------------------------------------------------------- calendar
def complete_calendar(df: DataFrame, spec: PanelSpec, ago: str = "months_ago",
                      flag: str = "missing_statement") -> DataFrame:
    """complete_calendar: one row per entity x periods-ago 0..max_periods-1.

    The calendar is generated per entity with ``explode(sequence(...))`` (no
    cross join) and left-joined to the panel rows on (entity, periods-ago);
    both sides are partitioned by the entity.  The panel is first reduced to
    the last row of each period (one row per entity-period)."""
    rows = months_ago(df, spec, ago) if ago not in df.columns else df
    rows = rows.where(F.col(ago) < spec.max_periods)
    w = Window.partitionBy(spec.entity, ago).orderBy(*spec.order_cols(desc=True))
    rows = rows.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")
    cal = (rows.select(spec.entity).distinct()
           .select(spec.entity, F.explode(F.sequence(F.lit(0), F.lit(spec.max_periods - 1))).alias(ago)))
    out = cal.join(rows, [spec.entity, ago], "left")
    return out.withColumn(flag, F.col(spec.ts).isNull().cast("int"))


def gap_vs_prehistory(df: DataFrame, spec: PanelSpec, ago: str = "months_ago",
                      flag: str = "missing_statement") -> DataFrame:
    """gap_vs_prehistory: split missing periods into a gap inside the history
    (``missing_gap``) and periods before the first statement (``prehistory``)."""
    vmax = F.max(F.when(F.col(flag) == 0, F.col(ago))).over(spec.whole())
    df = df.withColumn("valid_max", vmax)
    return df.withColumns({
        "missing_gap": ((F.col(flag) == 1) & (F.col(ago) < F.col("valid_max"))).cast("int"),
        "prehistory": ((F.col(flag) == 1) & (F.col(ago) > F.col("valid_max"))).cast("int"),
    })

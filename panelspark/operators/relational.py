"""Projections, column selection, joins and set operations (§2.2, §2.3, §2.7)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import NON_FEATURES, PanelSpec

# The reference's exclusion list for sequence inputs.
DROP_ALWAYS = ("D_103", "D_139", "B_29")



# ---------------------------------------------------------------- columns
def project_drop(df: DataFrame, cols) -> DataFrame:
    """project_drop: drop columns that exist (case-insensitive names)."""
    lower = {c.lower() for c in cols}
    return df.select(*[F.col(c) for c in df.columns if c.lower() not in lower])


def select_features_by_role(df: DataFrame, cat=(), non_features=NON_FEATURES) -> tuple[list[str], list[str]]:
    """numeric = every column - categories - non-features."""
    num = [c for c in df.columns if c not in cat and c not in non_features]
    return num, [c for c in df.columns if c in cat]


def select_by_name_pattern(df: DataFrame, pattern: str, keep=()) -> DataFrame:
    """select_by_name_pattern: suffix/substring/prefix selection via a regex."""
    rx = re.compile(pattern)
    return df.select(*keep, *[c for c in df.columns if rx.search(c) and c not in keep])


def drop_low_importance(df: DataFrame, importances: DataFrame, threshold: float,
                        feature_col: str = "feature", value_col: str = "importance") -> DataFrame:
    """drop_low_importance: drop features whose importance <= threshold.
    The importance table has one row per feature (bounded by the schema)."""
    low = [r[0] for r in importances.where(F.col(value_col) <= threshold).select(feature_col).collect()]
    return df.drop(*low)


def rename_suffix(df: DataFrame, suffix: str, keep=()) -> DataFrame:
    """rename_suffix: add a suffix to all columns but the keys."""
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in keep})


def cast_restore(df: DataFrame, schema: T.StructType) -> DataFrame:
    """cast_restore: re-apply captured column types after fills."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def reorder_cols(df: DataFrame, first=(), last=()) -> DataFrame:
    """reorder_cols: given columns first / last, others in between."""
    mid = [c for c in df.columns if c not in first and c not in last]
    return df.select(*first, *mid, *last)


def fill_const(df: DataFrame, value, cols=None) -> DataFrame:
    """fill_const: missing -> constant."""
    return df.fillna(value, subset=list(cols) if cols else None)


def fill_col_stat(df: DataFrame, cols, stat: str = "median", k: float = 0.0, stats_df: DataFrame | None = None):
    """fill_col_stat: fill with a column statistic: median, or min - k*std.
    Medians by histogram selection, the rest in one global aggregate."""
    from .quantiles import exact_quantiles
    src = stats_df if stats_df is not None else df
    if stat == "median":
        vals = {c: v[0] for c, v in exact_quantiles(src, {c: [0.5] for c in cols}).items()}
    else:
        row = src.agg(*[(F.min(c) - k * F.stddev_samp(c)).alias(c) for c in cols]).first()
        vals = {c: row[c] for c in cols}
    return df.fillna({c: v for c, v in vals.items() if v is not None}), vals


def inf_to_const(df: DataFrame, cols, value: float = -1.0) -> DataFrame:
    """inf_to_const: +-inf (and NaN) -> constant."""
    inf = float("inf")
    return df.withColumns({c: F.when(F.col(c).isin(inf, -inf) | F.isnan(c), F.lit(value)).otherwise(F.col(c))
                           for c in cols})


def masked_update(df: DataFrame, mask: Column, cols, value) -> DataFrame:
    """masked_update: set listed columns to a constant where the mask holds."""
    return df.withColumns({c: F.when(mask, F.lit(value)).otherwise(F.col(c)) for c in cols})


def clip_bounds(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """clip_fixed_bounds: per-column [lo, hi] (None = open); NULL stays NULL."""
    out = {}
    for c, (lo, hi) in bounds.items():
        x = F.col(c)
        if lo is not None:
            x = F.when(x.isNull(), None).otherwise(F.greatest(x, F.lit(lo)))
        if hi is not None:
            x = F.when(x.isNull(), None).otherwise(F.least(x, F.lit(hi)))
        out[c] = x
    return df.withColumns(out)


def learned_bounds(splits: dict[str, list[float]]) -> dict[str, tuple]:
    """clip_learned_bounds: [2*s0 - s1, 2*s3 - s2] from four split values."""
    return {c: (2 * s[0] - s[1], 2 * s[3] - s[2]) for c, s in splits.items()}


# ---------------------------------------------------------------- joins
def opaque(df: DataFrame, on) -> DataFrame:
    """The same rows with keys whose partitioning the planner no longer knows.

    An aggregate joined back on its own key needs no exchange, and AQE splits a
    hot key's rows only where both sides of a join have one.  Here the (small)
    side gets its exchange, and the join can be split."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.withColumns({k: F.element_at(F.array_repeat(F.col(k), 1), 1) for k in keys})


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a data-derived side (group statistics, dictionaries).

    No side is broadcast by hand: Spark broadcasts it if its size in bytes, at
    run time, is below the session's threshold; else the join shuffles, and AQE
    can split the rows of a hot key."""
    return big.join(opaque(small, on), on, how)


def join_features_outer(dfs: list[DataFrame], key: str) -> DataFrame:
    """join_features_outer: N-way full outer alignment on the key."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), dfs)


def join_outer_indicator(left: DataFrame, right: DataFrame, on, name: str = "_merge") -> DataFrame:
    """join_outer_indicator: full outer join + provenance (both/left_only/right_only)."""
    lm, rm = "__lm", "__rm"
    j = left.withColumn(lm, F.lit(1)).join(right.withColumn(rm, F.lit(1)), on, "full_outer")
    ind = (F.when(F.col(lm).isNotNull() & F.col(rm).isNotNull(), "both")
           .when(F.col(lm).isNotNull(), "left_only").otherwise("right_only"))
    return j.withColumn(name, ind).drop(lm, rm)


def entity_periods(df: DataFrame, key: str, n: int, name: str = "months_ago") -> DataFrame:
    """join_cross_calendar: entities x {0..n-1} by explode(sequence) (no cross join)."""
    return df.select(key).distinct().select(key, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name))


def join_map_lookup(df: DataFrame, stats: DataFrame, key: str, how: str = "left") -> DataFrame:
    """join_map_lookup: dictionary lookup of a group statistic; unknown -> NULL."""
    return join_small(df, stats, key, how)


def union_tagged(a: DataFrame, b: DataFrame, tags=("train", "test"), col: str = "dset") -> DataFrame:
    """union_tagged: a U b with a split tag (for shared statistics)."""
    return a.withColumn(col, F.lit(tags[0])).unionByName(b.withColumn(col, F.lit(tags[1])))


def union_augment(a: DataFrame, b: DataFrame) -> DataFrame:
    """union_augment: two feature views of the same entities stacked as rows."""
    return a.unionByName(b, allowMissingColumns=True)


def split_half_by_entity(df: DataFrame, key: str, parts: int = 2, seed: int = 0) -> list[DataFrame]:
    """split_half_by_entity: deterministic hash split of entities."""
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(parts))
    return [df.where(h == i) for i in range(parts)]


def distinct_entities(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.select(spec.entity).distinct()

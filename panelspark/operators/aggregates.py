"""Generic panel aggregation (§2.4): features x functions in ONE groupBy.

``agg_panel(df, spec, features, funcs)`` is the DataFrame form of a pandas
``groupby(entity)[features].agg(funcs)`` with ``feature_func`` column names.
All requested expressions go into a single ``groupBy(entity).agg(...)`` so the
panel is shuffled once and partially aggregated map-side (skew-safe for the
algebraic aggregates: a hot entity becomes one buffer per map task).

Order-dependent aggregates (``last``/``first``) use ``max_by``/``min_by`` over
the packed order key of :meth:`PanelSpec.order_key` -- no window, no sort.

``median``, ``mode`` and ``nunique`` would keep every distinct value of an entity in
one buffer.  :func:`entity_agg` takes them from (entity, feature, value) counts
instead (:mod:`.quantiles`) and joins them to the one ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec

OK = "__ok"  # packed (ts, tiebreak) order key column


def _nn(c: Column) -> Column:
    return F.when(c.isNotNull(), F.col(OK))


def _last(c: Column) -> Column:
    """last non-null value by (ts, tiebreak) (pandas groupby 'last')."""
    return F.max_by(c, _nn(c))


def _first(c: Column) -> Column:
    """first non-null value by (ts, tiebreak) (pandas groupby 'first')."""
    return F.min_by(c, _nn(c))


def _std(c: Column) -> Column:
    return F.stddev_samp(c)


def _sum0(c: Column) -> Column:
    """sum skipping missing; all-missing -> 0 (pandas semantics)."""
    return F.coalesce(F.sum(c), F.lit(0))


# name -> Column builder (input column -> aggregate); names are the suffixes
AGG_FUNCS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": _std,
    "min": F.min,
    "max": F.max,
    "last": _last,
    "first": _first,
    "last_row": lambda c: F.max_by(c, F.col(OK)),
    "first_row": lambda c: F.min_by(c, F.col(OK)),
    "sum": _sum0,
    "count": lambda c: F.count(c),
    # all values in one buffer: of the last n rows of an entity alone; entity_agg takes another way
    "median": F.median,
    "nunique": lambda c: F.size(F.collect_set(c)).cast("long"),
    "mode": lambda c: F.mode(c, True),
}

#: Functions of an entity's value counts.
VALUE_FUNCS = ("median", "mode", "nunique")

ORDERED = {"last", "first", "last_row", "first_row"}


def needs_order(funcs) -> bool:
    return any((f if isinstance(f, str) else f[0]) in ORDERED for f in funcs)


def agg_exprs(features, funcs, fmt: str = "{c}_{f}", where: Column | None = None) -> list[Column]:
    """Aggregate expressions for features x funcs.

    funcs items are names from AGG_FUNCS or (name, Column->Column) pairs
    (the named-callable UDAF surface).  ``where`` restricts the rows seen by
    the aggregate (SQL ``FILTER``), e.g. "last 5 statements" inside the same
    groupBy.
    """
    out = []
    for c in features:
        for f in funcs:
            name, fn = (f, AGG_FUNCS[f]) if isinstance(f, str) else f
            x = F.col(c) if where is None else F.when(where, F.col(c))
            out.append(fn(x).alias(fmt.format(c=c, f=name)))
    return out


def with_order_key(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df if OK in df.columns else df.withColumn(OK, spec.order_key())


def entity_agg(df: DataFrame, spec: PanelSpec, blocks, extra: list[Column] | None = None) -> DataFrame:
    """One row per entity for blocks of (features, funcs) or (features, funcs, name format).

    All algebraic functions go into one ``groupBy``; medians, modes and distinct counts
    come from value counts, so no buffer grows with an entity's history."""
    from .quantiles import join_keys, keyed_modes, keyed_quantiles
    blocks = [(list(b[0]), list(b[1]), b[2] if len(b) > 2 else "{c}_{f}") for b in blocks]
    plain, names, wanted = [], [], {f: {} for f in VALUE_FUNCS}
    for features, funcs, fmt in blocks:
        for c in features:
            for f in funcs:
                name = fmt.format(c=c, f=f if isinstance(f, str) else f[0])
                names.append(name)
                if f in VALUE_FUNCS:
                    wanted[f][c] = name
                else:
                    plain += agg_exprs([c], [f], fmt)
    extra = list(extra or [])
    out = df.groupBy(spec.entity).agg(*plain, *extra) if plain or extra else df.select(spec.entity).distinct()
    more = [c for c in out.columns if c != spec.entity and c not in names]
    if wanted["median"]:
        out = join_keys(out, keyed_quantiles(df, [spec.entity], list(wanted["median"]), fmt="__{c}_median"), [spec.entity])
    if wanted["mode"] or wanted["nunique"]:
        out = join_keys(out, keyed_modes(df, [spec.entity], list(wanted["mode"]), list(wanted["nunique"]), fmt="__{c}_{f}"), [spec.entity])
    made = {name: F.col(f"__{c}_{f}") if f != "nunique" else F.coalesce(f"__{c}_{f}", F.lit(0)) for f in VALUE_FUNCS for c, name in wanted[f].items()}
    return out.select(spec.entity, *(made[x].alias(x) if x in made else F.col(x) for x in names), *more)


def agg_panel(df: DataFrame, spec: PanelSpec, features, funcs, fmt: str = "{c}_{f}",
              extra: list[Column] | None = None) -> DataFrame:
    """get_agg_features: one row per entity, columns ``feature_func``."""
    if needs_order(funcs):
        df = with_order_key(df, spec)
    return entity_agg(df, spec, [(features, funcs, fmt)], extra)


def agg_null_stats(features, fmt: str = "{c}_is_null_{f}") -> list[Column]:
    """agg_null_stats: mean / sum / last of 0-1 null flags (flag columns given)."""
    out = []
    for c in features:
        flag = F.col(c).cast("int")
        out += [F.avg(flag).alias(fmt.format(c=c, f="mean")),
                F.sum(flag).cast("long").alias(fmt.format(c=c, f="sum")),
                F.max_by(flag, F.col(OK)).alias(fmt.format(c=c, f="last"))]
    return out

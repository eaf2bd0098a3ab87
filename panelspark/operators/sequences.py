"""Panel -> fixed-length sequence operators (§2.9).

A sequence is one row per entity with ``seq`` = array<array<double>> of
``max_periods`` steps (oldest first) x features, kept *beside* the key (no
positional side table).  All variants share one plan:

  rows   = last row per (entity, period) among the last ``max_periods`` periods
  cal    = entities x {0..n-1}        (explode(sequence), no cross join)
  dense  = cal LEFT JOIN rows ON (entity, periods_ago)
  seq    = groupBy(entity).agg(array_sort(collect_list(struct(step, vector))))

Windows, join and aggregate are all keyed by the entity, so the job has one
exchange; per-entity arrays are bounded by ``max_periods`` whatever the skew.
Variants differ only in the sentinel / fill policy of the vector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec
from . import history as H
from .quantiles import exact_quantiles
from .relational import join_small

# Sentinel codes of the sequence tensors.
MISSING_STATEMENT = -3.0
LEADING_NULL = -2.0
RANDOM_NULL = -1.0
INDICATORS = ("months_ago_valid_max", "customer_sequence_num", "pre_history", "missing_statement", "months_ago")


def _last_in_period(df: DataFrame, spec: PanelSpec, seen_cols=()) -> DataFrame:
    """One row per (entity, period) for the last ``max_periods`` periods: the
    last statement of the period, columns ``months_ago`` + the panel columns.

    Skew-safe plan (no unbounded window over an entity's history):
      1. per entity (partial aggregate): last period, last ts, and for each
         ``seen_cols`` column the order key of its first non-null value;
      2. joined back on the entity by ``join_small`` (AQE splits a hot entity's rows);
      3. rows of the last max_periods periods reduced per (entity, period) by
         ``max_by(row, order key)`` -- a partial aggregate, so each entity
         keeps at most max_periods rows whatever its raw history length.
    ``__seen_<c>`` = a non-null value of c exists at or before the row."""
    ok = spec.order_key()
    p = spec.period_index()
    base = df.withColumns({"__p": p, "__ok": ok})
    per = base.groupBy(spec.entity).agg(
        F.max("__p").alias("__pmax"), F.max(spec.ts).alias("__tsmax"),
        *[F.min(F.when(F.col(c).isNotNull(), F.col("__ok"))).alias(f"__first_{c}") for c in seen_cols])
    rows = join_small(base, per, spec.entity).withColumn("months_ago", F.col("__pmax") - F.col("__p"))
    rows = rows.where(F.col("months_ago") < spec.max_periods)
    keep = [c for c in rows.columns if c not in (spec.entity, "months_ago")]
    red = rows.groupBy(spec.entity, "months_ago").agg(F.max_by(F.struct(*keep), F.col("__ok")).alias("__r"))
    out = red.select(spec.entity, "months_ago", "__r.*")
    if seen_cols:
        out = out.withColumns({f"__seen_{c}": F.coalesce(F.col(f"__first_{c}") <= F.col("__ok"), F.lit(False))
                               for c in seen_cols})
    return out


class Step:
    """One calendar step inside ``transform``: ``a`` = periods ago."""

    def __init__(self, a: Column):
        self.a = a
        self.e = F.try_element_at(F.col("__m"), a)
        self.present = self.e.isNotNull()
        self.vmax = F.col("__vmax")
        self.missing = (~self.present) & (a < self.vmax)
        self.pre = (~self.present) & (a > self.vmax)
        self.seqnum = self.vmax - a

    def v(self, c: str) -> Column:
        return self.e[c]


def period_map(rows: DataFrame, spec: PanelSpec, cols: list[str]) -> DataFrame:
    """groupBy(entity): map periods-ago -> struct(cols) (<= max_periods entries)
    and the valid max; the only exchange of a sequence job."""
    g = rows.groupBy(spec.entity).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("months_ago"), F.struct(*cols)))).alias("__m"))
    return g.withColumn("__vmax", F.array_max(F.map_keys("__m")))


def steps(spec: PanelSpec, vec) -> Column:
    """array of max_periods step vectors, oldest first: vec(Step) -> list[Column]."""
    n = spec.max_periods
    return F.transform(F.sequence(F.lit(n - 1), F.lit(0), F.lit(-1)), lambda a: F.array(*vec(Step(a))))


def _dbl(c: Column) -> Column:
    return c.cast("double")


def sequence_v1(df: DataFrame, spec: PanelSpec, cols=None) -> DataFrame:
    """-3 missing statement, -2 null before the first non-null of that feature
    (over the whole history), -1 other nulls; categories first.  Text categories
    become their ordinal codes (sorted values, from 0)."""
    from .encode import ordinal_dictionary
    cols = list(cols or (list(spec.cat) + list(spec.num)))
    texts = [c for c in cols if df.schema[c].dataType.typeName() == "string"]
    dic = ordinal_dictionary(df, texts) if texts else None
    for c in texts:
        m = dic.where(F.col("feature") == c).select(F.col("value").alias("__v"), F.col("code").alias("__code"))
        df = join_small(df.withColumn("__v", F.col(c)), m, "__v", "left").withColumn(c, F.col("__code")).drop("__v", "__code")
    pre = [f"__seen_{c}" for c in cols]
    g = period_map(_last_in_period(df, spec, seen_cols=cols), spec, cols + pre)

    def vec(s: Step):
        return [F.when(~s.present, F.lit(MISSING_STATEMENT)).when(s.v(c).isNotNull(), _dbl(s.v(c)))
                 .when(s.v(f"__seen_{c}"), F.lit(RANDOM_NULL)).otherwise(F.lit(LEADING_NULL)) for c in cols]
    return g.select(spec.entity, steps(spec, vec).alias("seq"))


def sequence_v2(df: DataFrame, spec: PanelSpec, cols=None) -> DataFrame:
    """Imputed-style input (NULL -> -1), -3 for missing steps, then the
    ``missing_statement`` (any absent period) and ``months_ago`` features last."""
    cols = list(cols or spec.num)
    g = period_map(_last_in_period(df, spec), spec, cols)

    def vec(s: Step):
        return ([F.when(~s.present, F.lit(MISSING_STATEMENT)).otherwise(F.coalesce(_dbl(s.v(c)), F.lit(RANDOM_NULL)))
                 for c in cols] + [(~s.present).cast("double"), _dbl(s.a)])
    return g.select(spec.entity, steps(spec, vec).alias("seq"))


def column_stats(df: DataFrame, cols, k_missing: float = 2.0, k_leading: float = 1.0) -> dict[str, tuple]:
    """min - k*std offsets per column in one global aggregate (tiny result)."""
    row = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.stddev_samp(c).alias(f"sd_{c}") for c in cols]).first()
    return {c: (row[f"mn_{c}"] - k_missing * row[f"sd_{c}"], row[f"mn_{c}"] - k_leading * row[f"sd_{c}"]) for c in cols}


def _ffill_present(rows: DataFrame, spec: PanelSpec, cols) -> DataFrame:
    """Forward fill over the kept (present, one-per-period) rows only
    (at most max_periods rows per entity)."""
    w = Window.partitionBy(spec.entity).orderBy(F.col("months_ago").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def sequence_v3(df: DataFrame, spec: PanelSpec, cols=None, zero_fill=("p_2",)) -> DataFrame:
    """``zero_fill`` columns NULL -> 0; present rows forward-filled from present
    rows only; leading nulls -> min - 1 std; missing steps -> min - 2 std."""
    cols = list(cols or spec.num)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero_fill if c in cols})
    stats = column_stats(df, cols)
    g = period_map(_ffill_present(_last_in_period(df, spec), spec, cols), spec, cols)

    def vec(s: Step):
        return [F.when(~s.present, F.lit(stats[c][0])).otherwise(F.coalesce(s.v(c), F.lit(stats[c][1]))) for c in cols]
    return g.select(spec.entity, steps(spec, vec).alias("seq"))


def sequence_branched(df: DataFrame, spec: PanelSpec, branches: dict[str, list[str]]) -> DataFrame:
    """Forward fill (present rows), missing steps -3, leading nulls -> column
    median; one array per branch (feature-name prefix) in a struct."""
    cols = [c for v in branches.values() for c in v]
    med = {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in cols}).items()}
    g = period_map(_ffill_present(_last_in_period(df, spec), spec, cols), spec, cols)
    out = [spec.entity]
    for b, cs in branches.items():
        def vec(s: Step, cs=cs):
            return [F.when(~s.present, F.lit(MISSING_STATEMENT))
                     .otherwise(F.coalesce(s.v(c), F.lit(float(med[c]) if med[c] is not None else 0.0))) for c in cs]
        out.append(steps(spec, vec).alias(b))
    g = g.select(*out)
    return g.select(spec.entity, F.struct(*[F.col(b) for b in branches]).alias("branches"))


def sequence_capped(df: DataFrame, spec: PanelSpec, bounds: dict[str, tuple], cols=None,
                    flag_cols=None) -> DataFrame:
    """Learned capping, NULL -> -1, -3 for gap and pre-history steps, five
    indicator features last, plus a parallel null-flag tensor (missing
    statements count as null)."""
    cols = list(cols or spec.num)
    flag_cols = list(flag_cols or [])
    df = df.withColumns({f"__isnull_{c}": F.col(c).isNull() for c in flag_cols})
    clip = {c: F.when(F.col(c).isNull(), None).otherwise(F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))
            for c, (lo, hi) in bounds.items()}
    df = df.withColumns(clip)
    g = period_map(_last_in_period(df, spec), spec, cols + [f"__isnull_{c}" for c in flag_cols])

    def vec(s: Step):
        return ([F.when(~s.present, F.lit(MISSING_STATEMENT)).otherwise(F.coalesce(_dbl(s.v(c)), F.lit(RANDOM_NULL)))
                 for c in cols]
                + [_dbl(s.vmax), _dbl(s.seqnum), _dbl(s.pre.cast("int")), _dbl(s.missing.cast("int")), _dbl(s.a)])
    out = [spec.entity, steps(spec, vec).alias("seq")]
    if flag_cols:
        out.append(steps(spec, lambda s: [F.coalesce(s.v(f"__isnull_{c}"), F.lit(True)) for c in flag_cols]).alias("null_flags"))
    return g.select(*out)


def sequence_p2_first(df: DataFrame, spec: PanelSpec, bounds: dict[str, tuple], first: str = "p_2", cols=None) -> DataFrame:
    """As ``sequence_capped`` without flags, with the target-like feature first."""
    cols = list(cols or spec.num)
    order = [first] + [c for c in cols if c != first]
    return sequence_capped(df, spec, bounds, order, flag_cols=[])


def sequence_ordinal_cats(df: DataFrame, spec: PanelSpec, dictionary: DataFrame | None = None, cols=None) -> DataFrame:
    """Categories as ordinal+1 (NULL category coded '999' before encoding,
    0 = missing statement) first, numerics (-3 missing, -1 null) after, and
    ``days_ago`` (days since the entity's last statement, -3 when missing)."""
    from .encode import ordinal_dictionary
    cats, nums = list(spec.cat), list(cols or spec.num)
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("999")) for c in cats})
    dic = dictionary if dictionary is not None else ordinal_dictionary(df, cats)
    for c in cats:
        m = dic.where(F.col("feature") == c).select(F.col("value").alias(c), (F.col("code") + 1).alias(f"__code_{c}"))
        df = join_small(df, m, c, "left")
    rows = _last_in_period(df, spec).withColumn("days_ago", F.datediff(F.col("__tsmax"), F.col(spec.ts)))
    keep = [f"__code_{c}" for c in cats] + nums + ["days_ago"]
    g = period_map(rows, spec, keep)

    def vec(s: Step):
        return ([F.when(~s.present, F.lit(0.0)).otherwise(F.coalesce(_dbl(s.v(f"__code_{c}")), F.lit(0.0))) for c in cats]
                + [F.when(~s.present, F.lit(MISSING_STATEMENT)).otherwise(F.coalesce(_dbl(s.v(c)), F.lit(RANDOM_NULL))) for c in nums]
                + [F.when(~s.present, F.lit(MISSING_STATEMENT)).otherwise(_dbl(s.v("days_ago")))])
    return g.select(spec.entity, steps(spec, vec).alias("seq"))


# ------------------------------------------------------------------ array operators
def shift_pad(seq: Column, pad: float = MISSING_STATEMENT, width: int | None = None) -> Column:
    """fn_array_shift_pad: drop the last step, prepend one pad step."""
    first = F.element_at(seq, 1)
    pad_step = F.transform(first, lambda _: F.lit(pad).cast("double"))
    return F.concat(F.array(pad_step), F.slice(seq, 1, F.size(seq) - 1))


def array_get(seq: Column, step: int, feature: int) -> Column:
    """fn_array_get: X[:, step, feature] (1-based, negative from the end; NULL if out of range)."""
    return F.element_at(F.element_at(seq, step), feature) if step != 0 else F.lit(None)


def array_drop_feature(seq: Column, feature: int) -> Column:
    """fn_array_slice: remove one feature (1-based) from every step."""
    return F.transform(seq, lambda x: F.concat(F.slice(x, 1, feature - 1), F.slice(x, feature + 1, 1 << 20)))


def array_sum_feature(seq: Column, feature: int) -> Column:
    """fn_array_sum: sum of one feature over the steps."""
    return F.aggregate(seq, F.lit(0.0), lambda acc, x: acc + F.element_at(x, feature))


def array_concat_features(a: Column, b: Column) -> Column:
    """fn_array_concat_features: append b's features to a's per step."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda z: F.concat(z["a"], z["b"]))


def augment_shift(seqs: DataFrame, col: str = "seq", n_features: int | None = None,
                  eligible: Column | None = None, n_steps: int = 13) -> DataFrame:
    """augment_shift: a copy of each eligible sequence without its last statement, a -3 pad step in front
    (``aug = 1`` rows, unioned with the originals as ``aug = 0``).

    With ``n_features`` (data features before the five indicators of
    ``sequence_capped``) the indicators are repaired: every real step is one
    period older in the shifted view (months_ago - 1, valid max - 1) and the
    pad step is pre-history.  ``eligible``: default = at least two present
    statements (missing + pre-history steps <= n - 2)."""
    base = seqs.withColumn("aug", F.lit(0))
    if eligible is None and n_features is not None:
        k = n_features
        gaps = F.aggregate(F.col(col), F.lit(0.0),
                           lambda acc, x: acc + F.element_at(x, k + 3) + F.element_at(x, k + 4))
        eligible = gaps <= F.lit(float(n_steps - 2))
    cand = seqs if eligible is None else seqs.where(eligible)
    sh = cand.withColumn(col, shift_pad(F.col(col)))
    if n_features is not None:
        k = n_features
        vm = F.element_at(F.element_at(F.col(col), -1), k + 1) - 1  # new valid max (from the kept last step)

        def fix(x, i):
            pad = i == 0
            ma = F.element_at(x, k + 5) - 1
            return F.concat(F.slice(x, 1, k), F.array(
                vm,
                F.when(pad, vm - F.lit(float(n_steps - 1))).otherwise(vm - ma),
                F.when(pad, F.lit(1.0)).otherwise(F.element_at(x, k + 3)),
                F.when(pad, F.lit(0.0)).otherwise(F.element_at(x, k + 4)),
                F.when(pad, F.lit(float(n_steps - 1))).otherwise(ma)))
        sh = sh.withColumn(col, F.transform(F.col(col), fix))
    return base.unionByName(sh.withColumn("aug", F.lit(1)))


def _set_last(x: Column, *values: Column) -> Column:
    """The step vector with its last ``len(values)`` features replaced."""
    return F.concat(F.slice(x, 1, F.size(x) - len(values)), F.array(*values))


def augment_shift_flag(seqs: DataFrame, col: str = "seq", flags: str = "null_flags", n_steps: int = 13) -> DataFrame:
    """augment_shift_flag: as ``augment_shift``, for sequences whose step vectors
    end in (missing flag, months ago), and their null-flag tensor with them.

    A sequence is eligible unless its second-to-last step is missing.  Both
    tensors are shifted by one -3 pad step; in the data tensor months ago of
    the real steps falls by one, and the pad step is missing and the oldest."""
    seqs = seqs.withColumn(flags, F.transform(flags, lambda x: F.transform(x, lambda v: v.cast("double"))))
    missing = F.element_at(F.element_at(F.col(col), -2), -2)
    sh = seqs.where(missing != 1).withColumns({col: shift_pad(F.col(col)), flags: shift_pad(F.col(flags))})
    real = lambda x: _set_last(x, F.element_at(x, -1) - 1)
    pad = lambda x: _set_last(x, F.lit(1.0), F.lit(float(n_steps - 1)))
    sh = sh.withColumn(col, F.transform(F.col(col), lambda x, i: F.when(i == 0, pad(x)).otherwise(real(x))))
    return seqs.withColumn("aug", F.lit(0)).unionByName(sh.withColumn("aug", F.lit(1)))


def augment_shift_all(seqs: DataFrame, branches: list[str]) -> DataFrame:
    """augment_shift_all: every branch of every sequence shifted by one -3 pad
    step; months ago, the last feature of the last branch, falls by one on all
    steps (the pad step too, as in the reference)."""
    sh = seqs.withColumns({b: shift_pad(F.col(b)) for b in branches})
    sh = sh.withColumn(branches[-1], F.transform(branches[-1], lambda x: _set_last(x, F.element_at(x, -1) - 1)))
    return seqs.withColumn("aug", F.lit(0)).unionByName(sh.withColumn("aug", F.lit(1)))


def next_value_target(seqs: DataFrame, col: str = "seq", feature: int = 1, name: str = "next_target") -> DataFrame:
    """next_value_target: the last step's value of ``feature`` becomes the
    target and the feature is dropped from the inputs."""
    tgt = F.element_at(F.element_at(F.col(col), -1), feature)
    return seqs.withColumn(name, tgt).withColumn(col, array_drop_feature(F.col(col), feature))


def scale_sequences(seqs: DataFrame, key: str, col: str = "seq", skip_first: int = 0) -> DataFrame:
    """scale_sequences: per-feature standardisation over all (entity, step)
    cells with population std (std 0 -> 1); the first ``skip_first`` features
    are left as they are.  Statistics: one aggregate over the exploded cells."""
    cells = seqs.select(F.explode(F.col(col)).alias("x")).select(F.posexplode("x").alias("f", "v"))
    st = cells.groupBy("f").agg(F.avg("v").alias("mu"), F.stddev_pop("v").alias("sd")).orderBy("f").collect()
    mus = [float(r["mu"]) for r in st]
    sds = [float(r["sd"]) if r["sd"] else 1.0 for r in st]
    mu_a = F.array(*[F.lit(m) for m in mus])
    sd_a = F.array(*[F.lit(s) for s in sds])

    def scale_step(x):
        return F.transform(x, lambda v, i: F.when(i < skip_first, v).otherwise(
            (v - F.element_at(mu_a, i + 1)) / F.element_at(sd_a, i + 1)))
    return seqs.withColumn(col, F.transform(F.col(col), scale_step))

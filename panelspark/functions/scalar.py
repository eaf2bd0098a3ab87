"""Scalar column functions (§2.8).  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str | None = None) -> Column:
    """fn_parse_date: text or timestamp -> DATE."""
    return F.to_date(_c(c), fmt) if fmt else _c(c).cast("date")


def month(c) -> Column:
    """fn_month: month of year 1..12."""
    return F.month(_c(c))


def period_month(c) -> Column:
    """fn_period_month: first day of the calendar month (month bucket)."""
    return F.trunc(_c(c), "MM")


def ratio(a, b) -> Column:
    """fn_ratio: a / b, NULL when b is 0 or NULL (never inf, never an ANSI error)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def diff(a, b) -> Column:
    """fn_diff: a - b."""
    return _c(a) - _c(b)


def pmod(a, n) -> Column:
    """fn_modulo: non-negative modulo (Python ``%`` semantics)."""
    return F.pmod(_c(a), F.lit(n) if not isinstance(n, Column) else n)


def zscore(x, mu, sd) -> Column:
    """fn_zscore: (x - mu) / sd; NULL for sd = 0 or NULL."""
    return F.try_divide(_c(x) - _c(mu), _c(sd))


def round2(c, digits: int = 2) -> Column:
    """fn_round2: round half-even to ``digits`` (numpy/pandas ``round``)."""
    return F.bround(_c(c), digits)


def clip(c, lo, hi) -> Column:
    """fn_clip: clip to [lo, hi]; NULL stays NULL."""
    x = _c(c)
    return F.when(x.isNull(), None).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def logit(p, eps: float = 1e-4) -> Column:
    """fn_logit: log(p / (1 - p)) after clipping p to [eps, 1 - eps]."""
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (F.lit(1.0) - q))


def log1p_shift(c, lo) -> Column:
    """fn_log1p_shift: log1p(x - min) (right skew)."""
    return F.log1p(_c(c) - lo)


def log1p_reflect(c, hi) -> Column:
    """fn_log1p_shift (left skew): log1p(max - x)."""
    return F.log1p(F.lit(hi) - _c(c) if not isinstance(hi, Column) else hi - _c(c))


def cast_string(c) -> Column:
    """fn_cast_string."""
    return _c(c).cast("string")


def join_string(arr, sep: str = " ") -> Column:
    """fn_join_string: array -> 'a b c'."""
    return F.array_join(_c(arr), sep)


def chars(c) -> Column:
    """fn_chars: lower-cased characters of a string as an array (no trailing '')."""
    return F.split(F.lower(_c(c)), "")


def is_null_or_sentinel(c, sentinel=-1) -> Column:
    """fn_is_null_or_sentinel: NULL, NaN (numeric) or the sentinel value."""
    x = _c(c)
    cond = x.isNull()
    if sentinel is not None:
        cond = cond | (x == F.lit(sentinel))
    return F.coalesce(cond, F.lit(True))


def is_null_or_sentinel_num(c, sentinel=-1) -> Column:
    x = _c(c)
    return F.coalesce(x.isNull() | F.isnan(x) | (x == F.lit(sentinel)), F.lit(True))


def row_null_count(cols: list, sentinel=-1) -> Column:
    """fn_row_null_count: number of missing cells per row."""
    flags = [is_null_or_sentinel(c, sentinel).cast("int") for c in cols]
    out = flags[0]
    for f in flags[1:]:
        out = out + f
    return out


def sentinel_to_null(c, sentinel=-1, numeric: bool = True) -> Column:
    """sentinel_to_null: sentinel (and NaN) -> NULL."""
    x = _c(c)
    bad = x == F.lit(sentinel) if sentinel is not None else F.lit(False)
    if numeric:
        bad = bad | F.isnan(x)
    return F.when(bad, F.lit(None)).otherwise(x)


def stable_float(c) -> Column:
    """Single-precision value after half-up rounding to 8 decimals done with
    IEEE arithmetic (floor(x*1e8 + 0.5)/1e8); |x| >= 1e10 is only cast.
    Used where a value is stored as float32 and for cross-engine reports."""
    x = _c(c).cast("double")
    return F.when(F.abs(x) < 1e10, F.floor(x * F.lit(1e8) + F.lit(0.5)) / F.lit(1e8)).otherwise(x).cast("float")

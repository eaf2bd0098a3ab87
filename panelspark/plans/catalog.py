"""Query registry: key -> (Spark callable, oracle SQL or None).

Every registered query reads the provided tables (or panels Spark derives
from them) in full.  ``report`` is the common sink projection: internal
columns dropped, doubles reported as FLOAT (see :mod:`.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(spark, sf_dir))

        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        REGISTRY[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


from ..functions.scalar import stable_float as stable  # noqa: E402


def report(df: DataFrame) -> DataFrame:
    """Drop internal ``__`` columns; fractional numbers (and arrays of them) -> stable FLOAT."""
    cols = []
    for fld in df.schema.fields:
        if fld.name.startswith("__"):
            continue
        c = F.col(f"`{fld.name}`")
        dt = fld.dataType
        if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = stable(c)
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.DoubleType, T.FloatType)):
            c = F.transform(c, stable)
        elif (isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.ArrayType)
              and isinstance(dt.elementType.elementType, (T.DoubleType, T.FloatType))):
            c = F.transform(c, lambda x: F.transform(x, stable))
        cols.append(c.alias(fld.name))
    return df.select(*cols)


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries, queries_core, queries_metrics, queries_seq, queries_ml, queries_io  # noqa: F401

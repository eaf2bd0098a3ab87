"""DuckDB-runnable oracle SQL for the registered queries.

Only the raw tables are registered as views on the oracle side, so every
statement inlines its panel CTE.  Doubles are reported as
``FLOAT(floor(x * 1e8 + 0.5) / 1e8)`` on both sides.  Summation order differs
between engines (a few ulps); the half-up step maps results whose exact value
has <= 8 decimals (means of cent amounts, which can sit exactly on a float32
midpoint) to the same double, and it is plain IEEE arithmetic, so identical
inputs give identical outputs in both engines (decimal ``round`` does not:
Spark rounds the shortest decimal string, DuckDB the binary value).  The FLOAT
cast then absorbs the generic ulp noise (it only differs when a float midpoint
falls inside the noise, ~1e-8 per value).
"""

from __future__ import annotations

PANEL_ORDERS = """panel AS (
  SELECT o_custkey AS customer_id,
         o_orderdate AS s_2,
         o_orderkey AS seq,
         CAST(o_totalprice AS DOUBLE) AS p_2,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS b_1,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS d_42,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS d_63,
         o_orderpriority AS d_64,
         CASE WHEN o_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS dset
  FROM orders)"""

PANEL_DAYS = """panel AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS s_2,
         round(SUM(value), 4) AS p_2, CAST(COUNT(*) AS DOUBLE) AS b_1,
         round(SUM(CASE WHEN event_type = 'purchase' THEN value END), 4) AS d_39
  FROM events
  GROUP BY user_id, CAST(ts AS DATE))"""

SCORES = """scores AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
         (o_orderkey * 7919 % 10007) / CAST(10007 AS DOUBLE) AS prediction,
         o_totalprice / CAST(500000 AS DOUBLE) AS prediction_2,
         o_orderkey % 5 AS val_fold_n
  FROM orders)"""

CUSTOMER_LABELS = """labels_c AS (
  SELECT o_custkey AS customer_id,
         CASE WHEN avg(o_totalprice) > 250000 THEN 1 ELSE 0 END AS target
  FROM orders GROUP BY o_custkey)"""

NUM = ("p_2", "b_1", "d_42")
CAT = ("d_63", "d_64")
DAYS_NUM = ("p_2", "b_1", "d_39")


def stable(expr: str) -> str:
    """FLOAT(half-up to 8 decimals by IEEE arithmetic), as ``catalog.stable``."""
    return (f"CAST(CASE WHEN abs({expr}) < 1e10 THEN floor(({expr}) * CAST(1e8 AS DOUBLE) + 0.5) / CAST(1e8 AS DOUBLE) "
            f"ELSE ({expr}) END AS FLOAT)")


def f(expr: str, name: str) -> str:
    """FLOAT-reported output column."""
    return f"{stable(expr)} AS {name}"


def report(floats, others=(), src: str = "g") -> str:
    """Outer projection: FLOAT for the double columns, others unchanged."""
    cols = list(others) + [f(c, c) for c in floats]
    return f"SELECT {', '.join(cols)} FROM {src}"


def clean(c: str) -> str:
    """-1 sentinel (and NaN) -> NULL."""
    return f"CASE WHEN {c} = -1 OR isnan({c}) THEN NULL ELSE {c} END"


def desc(order: str) -> str:
    return ", ".join(f"{p.strip()} DESC" for p in order.split(","))


def ranked(src: str = "panel", order: str = "s_2, seq") -> str:
    """Row numbers ascending (rn) and descending (rd) per customer."""
    return (f"SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {order}) AS rn, "
            f"row_number() OVER (PARTITION BY customer_id ORDER BY {desc(order)}) AS rd FROM {src}")


def num_aggs(c: str, funcs=("mean", "std", "min", "max", "last", "first"),
             name: str | None = None, cond: str | None = None) -> tuple[list[str], list[str]]:
    """Raw SQL aggregates of column ``c`` (last/first = non-null by rn).

    Returns (select items, names of the double outputs)."""
    n = name or c
    filt = f" AND {cond}" if cond else ""
    where = f" FILTER (WHERE {cond})" if cond else ""
    sql = {
        "mean": f"avg({c}){where}",
        "std": f"stddev_samp({c}){where}",
        "min": f"min({c}){where}",
        "max": f"max({c}){where}",
        "last": f"arg_max({c}, rn) FILTER (WHERE {c} IS NOT NULL{filt})",
        "first": f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL{filt})",
        "median": f"median({c}){where}",
        "sum": f"coalesce(sum({c}){where}, 0)",
    }
    return [f"{sql[k]} AS {n}_{k}" for k in funcs], [f"{n}_{k}" for k in funcs]


def cat_aggs(c: str, funcs=("last", "first", "nunique")) -> list[str]:
    """Category aggregates (mode is a separate CTE joined back)."""
    sql = {
        "last": f"arg_max({c}, rn) FILTER (WHERE {c} IS NOT NULL) AS {c}_last",
        "first": f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL) AS {c}_first",
        "nunique": f"CAST(count(DISTINCT {c}) AS BIGINT) AS {c}_nunique",
    }
    return [sql[k] for k in funcs]


def mode_cte(c: str, src: str = "panel") -> str:
    """Most frequent non-null value per customer; ties -> smallest value."""
    return (f"mode_{c} AS (SELECT customer_id, {c} AS {c}_mode FROM ("
            f"SELECT customer_id, {c}, row_number() OVER (PARTITION BY customer_id "
            f"ORDER BY count(*) DESC, {c}) AS k FROM {src} WHERE {c} IS NOT NULL "
            f"GROUP BY customer_id, {c}) t WHERE k = 1)")


def seq_report(col: str) -> str:
    """FLOAT report of a list-of-lists column."""
    return f"list_transform({col}, lambda x: list_transform(x, lambda y: {stable('y')})) AS {col}"


def vec_report(col: str) -> str:
    return f"list_transform({col}, lambda y: {stable('y')}) AS {col}"

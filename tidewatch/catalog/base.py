"""Registry of checkable queries: each name has a Spark callable
``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, a DuckDB twin.

Both sides present results the same way: doubles snapped to a 1e-9 grid (which
absorbs last-ulp noise from summation order) and then rounded to 6 places, both
steps by the same IEEE arithmetic (round(x * 10^k) / 10^k, bit-identical in
both engines), -0.0 folded into 0.0; integers as bigint; strings as strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def fin(df: DataFrame) -> DataFrame:
    """Normalise output types: double rounded to 6 (+0.0), ints -> bigint."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            x9 = F.round(c.cast("double") * F.lit(1e9), 0) / F.lit(1e9)
            c = F.round(x9 * F.lit(1e6), 0) / F.lit(1e6) + F.lit(0.0)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, T.BooleanType):
            c = c.cast("bigint")
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def r6(expr: str) -> str:
    """SQL side of ``fin`` for one double expression."""
    x9 = f"(round(CAST({expr} AS DOUBLE) * 1e9) / 1e9)"
    return f"(round({x9} * 1e6) / 1e6 + 0.0)"


def sql_fin(inner: str, doubles=(), ints=(), keep_order=None) -> str:
    """Wrap a SELECT so its double / integer columns match ``fin``."""
    repl = [f"{r6(_q(c))} AS {_q(c)}" for c in doubles] + \
           [f"CAST({_q(c)} AS BIGINT) AS {_q(c)}" for c in ints]
    if not repl:
        return f"SELECT * FROM ({inner}) AS fin_q"
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({inner}) AS fin_q"


def _q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


# ---------------------------------------------------------------------------
# The connections adapter as SQL (FIXTURES.md §4), prepended to every oracle
# over connection records.
CONN_CTE = """
lines AS (
  SELECT l_orderkey,
         sum(l_quantity) AS duration,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS src_bytes,
         count(*) AS n,
         count(DISTINCT l_suppkey) AS srv_count,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
         sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS n_a,
         sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_f
  FROM lineitem GROUP BY l_orderkey
),
conn0 AS (
  SELECT o.o_orderkey AS conn_id,
         o.o_orderdate AS ts,
         l.duration,
         CASE o.o_orderstatus WHEN 'F' THEN 'tcp' WHEN 'O' THEN 'udp'
                              WHEN 'P' THEN 'icmp' END AS protocol_type,
         o.o_orderpriority AS service,
         c.c_mktsegment AS flag,
         l.src_bytes,
         o.o_totalprice AS dst_bytes,
         CAST(l.n AS INTEGER) AS "count",
         CAST(l.srv_count AS INTEGER) AS srv_count,
         CAST(l.n_r AS DOUBLE) / l.n AS serror_rate,
         CAST(l.n_a AS DOUBLE) / l.n AS rerror_rate,
         CAST(l.n_f AS DOUBLE) / l.n AS same_srv_rate,
         1.0 - CAST(l.n_f AS DOUBLE) / l.n AS diff_srv_rate
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey
),
connections AS (
  SELECT *,
         CASE WHEN coalesce(serror_rate, 0) >= 0.75 THEN 'dos'
              WHEN coalesce(rerror_rate, 0) >= 0.75 THEN 'probe'
              ELSE 'normal' END AS attack_type,
         CASE WHEN coalesce(serror_rate, 0) >= 0.75 OR coalesce(rerror_rate, 0) >= 0.75
              THEN 1 ELSE 0 END AS is_attack
  FROM conn0
)"""

# Rule-based stand-in probability, then the scored table.
SCORED_CTE = CONN_CTE + """,
risk AS (
  SELECT *, round((0.8 * greatest(coalesce(serror_rate, 0), coalesce(rerror_rate, 0))
                  + 0.2 * coalesce(diff_srv_rate, 0)) * 1e4) / 1e4 AS probability
  FROM connections
),
scored AS (
  SELECT *,
         CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN probability >= 0.5 THEN 'Attack' ELSE 'Normal' END AS prediction_label,
         CASE WHEN abs(probability - 0.5) >= 0.4 THEN 'High'
              WHEN abs(probability - 0.5) >= 0.2 THEN 'Medium' ELSE 'Low' END AS confidence,
         CASE WHEN probability >= 0.8 THEN 'Critical' WHEN probability >= 0.6 THEN 'High'
              WHEN probability >= 0.4 THEN 'Medium' WHEN probability >= 0.2 THEN 'Low'
              ELSE 'Minimal' END AS threat_level
  FROM risk
)"""


def with_cte(cte: str, body: str) -> str:
    return "WITH " + cte + "\n" + body

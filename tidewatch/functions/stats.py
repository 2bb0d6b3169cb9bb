"""Statistics helpers shared by the profiling, imputation and fence operators.

Per-column statistics are computed in long form — explode ``(column, value)``
and ``groupBy(column)`` — so one scan serves every column and the aggregate
stays inside whole-stage codegen.

Quantile methods (all linear interpolation = pandas / DuckDB ``quantile_cont``):
  * ``exact`` (default) – radix selection (functions/radix.py): one path at any
    size, memory and shuffle bounded by buckets, not by rows.
  * ``approx`` – Spark's sketch alone (rank error n / APPROX_ACCURACY).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, scratch_scope
from .radix import key_double, select_ranks, with_double_key

APPROX_ACCURACY = 100000


def sketch_quantiles(c: str, probs) -> Column:
    """Array of approximate quantiles: one aggregate expression."""
    return F.percentile_approx(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in probs]), APPROX_ACCURACY)


def long_values(df: DataFrame, columns) -> DataFrame:
    """(column, x double): every listed column as rows (Spark's ``unpivot``, one
    ``Expand``). Per-column statistics then become a ``groupBy('column')`` with
    a handful of aggregate functions, which stays inside whole-stage codegen,
    where one wide aggregate with dozens of moment buffers per column falls
    back to interpreted mode."""
    cols = list(columns)
    # NaN counts as missing (pandas semantics) even on un-normalised input
    typed = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
                        for c in cols])
    return typed.unpivot([], cols, "column", "x")


def quantile_table(df: DataFrame, columns, probs, method: str = "exact") -> DataFrame:
    """Long table (column, q, threshold), one row per column and probability."""
    spark = df.sparkSession
    vals = quantiles(df, columns, probs, method)
    rows = [(c, float(p), (None if v[i] is None else float(v[i])))
            for c, v in vals.items() for i, p in enumerate(probs)]
    return spark.createDataFrame(rows, "column string, q double, threshold double")


def quantiles(df: DataFrame, columns, probs, method: str = "exact") -> dict:
    """{column: [value per prob]} (None for an all-NULL column)."""
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method {method!r}")
    columns = list(columns)
    if not columns:
        return {}
    if method == "exact":
        return exact_quantiles(df, columns, probs)
    rows = long_values(df, columns).groupBy("column").agg(sketch_quantiles("x", probs).alias("v")).collect()
    got = {r["column"]: r["v"] for r in rows}
    return {c: (list(got[c]) if got.get(c) is not None else [None] * len(probs)) for c in columns}


def _interpolate(pos: float, v0: float, v1: float) -> float:
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi or v0 == v1:        # weights of equal values may not add up to 1
        return v0
    return (hi - pos) * v0 + (pos - lo) * v1   # the same formula as Spark's percentile


def exact_quantiles(df: DataFrame, columns, probs) -> dict:
    """Exact linear-interpolated quantiles of all columns together. The source is
    evaluated once: its values are saved as (column, 64-bit key), and up to four
    scans of that table, each one bounded count, find the wanted ranks. NULL and
    NaN are no values; an infinite neighbour gives what the interpolation gives."""
    probs = [float(p) for p in probs]
    columns = list(columns)
    name = {f"k{i}": c for i, c in enumerate(columns)}
    with scratch_scope(df.sparkSession):
        values = df.select(*[F.col(f"`{c}`").cast("double").alias(k) for k, c in name.items()])
        long = values.unpivot([], list(name), "g", "x").where("x IS NOT NULL AND NOT isnan(x)")
        keys = cut_lineage(with_double_key(long, "x").select("g", "k"), "keys")
        at = [F.col("n").cast("double") - 1] * len(probs)
        ranks = [f(x * F.lit(p)) for x, p in zip(at, probs) for f in (F.floor, F.ceil)]
        found = {(r["g"], r["i"]): r for r in select_ranks(keys, ranks).collect()}
    out = {}
    for k, c in name.items():
        out[c] = [None] * len(probs)
        for i, p in enumerate(probs):
            lo, hi = found.get((k, 2 * i)), found.get((k, 2 * i + 1))
            if lo is not None:
                out[c][i] = _interpolate((lo["n"] - 1) * p, key_double(lo["k"]), key_double(hi["k"]))
    return out


def numeric_summary(df: DataFrame, columns, probs=(0.25, 0.5, 0.75),
                    method: str = "exact") -> DataFrame:
    """Long table, one row per column: n, mean, std (sample), skewness /
    kurtosis (bias-corrected, as pandas), min, max, and the quantiles ``q``."""
    x = F.col("x")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            sample_skewness("x").alias("skewness"), sample_kurtosis("x").alias("kurtosis"),
            F.min(x).alias("min"), F.max(x).alias("max")]
    if method != "exact":
        aggs.append(sketch_quantiles("x", probs).alias("q"))
    g = long_values(df, columns).groupBy("column").agg(*aggs)
    if method == "exact":
        q = quantiles(df, columns, probs, "exact")   # bounded one row per column
        m = F.create_map(*[v for c in columns for v in (
            F.lit(c), F.array(*[F.lit(x).cast("double") for x in q[c]]))])
        g = g.withColumn("q", F.try_element_at(m, F.col("column")))
    return g


def sample_skewness(c: str) -> Column:
    """Bias-corrected G1 (pandas / DuckDB): g1 * sqrt(n(n-1)) / (n-2); n<3 -> NULL,
    zero variance -> 0."""
    x = F.col(c).cast("double")
    n = F.count(x).cast("double")
    m2 = F.var_pop(x)
    g1 = F.skewness(x)
    return F.when(n < 3, F.lit(None).cast("double")) \
        .when(m2 == 0, F.lit(0.0)) \
        .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis G2: (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)."""
    x = F.col(c).cast("double")
    n = F.count(x).cast("double")
    m2 = F.var_pop(x)
    g2 = F.kurtosis(x)
    return F.when(n < 4, F.lit(None).cast("double")) \
        .when(m2 == 0, F.lit(0.0)) \
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))

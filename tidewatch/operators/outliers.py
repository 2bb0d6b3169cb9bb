"""Outlier fences (IQR and z-score) with fitted bounds.

``joint``: every bound from ONE aggregate over the fit table, one conjunctive
filter. ``sequential`` (the reference's definition): each column's bounds are
computed on the rows that survived the previous columns — one small job per
column. Both return bounds as a state table ``(column, lower, upper)``; the
filter uses the bounds as literals, so Catalyst pushes it into the parquet
scan. A NULL fails the filter (a NaN comparison is false in pandas); in Spark
NaN sorts above every number, so NaN fails ``x <= upper`` too — the filter may
therefore run on raw scan columns, before any NaN->NULL projection, which is
what lets the bounds reach the reader. Fits ignore NaN (long-form statistics
treat it as missing).

At scoring time use ``flag`` instead of ``apply``: rows are marked, not dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stats import long_values, quantiles
from ..schemas import numeric_columns

STATE_SCHEMA = "column string, lower double, upper double"


def _iqr_bounds(q1, q3, k):
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def _z_stats(df: DataFrame, cols):
    got = {r["column"]: (r["m"], r["s"]) for r in long_values(df, cols).groupBy("column")
           .agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect()}
    return {c: got.get(c, (None, None)) for c in cols}


def fit_iqr(df: DataFrame, columns=None, k: float = 1.5, mode: str = "joint",
            exclude=("is_attack",), method: str = "exact") -> DataFrame:
    cols = columns if columns is not None else numeric_columns(df, exclude)
    rows = []
    if mode == "joint":
        q = quantiles(df, cols, [0.25, 0.75], method)
        rows = [(c, *_iqr_bounds(q[c][0], q[c][1], k)) for c in cols]
    elif mode == "sequential":
        cur = df
        for c in cols:
            q1, q3 = quantiles(cur, [c], [0.25, 0.75], method)[c]
            lo, hi = _iqr_bounds(q1, q3, k)
            rows.append((c, lo, hi))
            cur = cur.filter(_keep(c, lo, hi))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.sparkSession.createDataFrame(rows, STATE_SCHEMA)


def fit_zscore(df: DataFrame, columns=None, threshold: float = 3.0, mode: str = "joint",
               exclude=("is_attack",)) -> DataFrame:
    """Bounds mean -/+ threshold * sample std, strict (|z| < threshold).
    A zero-variance column is skipped (pandas would drop every row)."""
    cols = columns if columns is not None else numeric_columns(df, exclude)
    rows = []
    if mode == "joint":
        st = _z_stats(df, cols)
        for c in cols:
            m, s = st[c]
            if s is not None and s > 0:
                rows.append((c, m, s))
    else:
        cur = df
        for c in cols:
            m, s = _z_stats(cur, [c])[c]
            if s is not None and s > 0:
                rows.append((c, m, s))
                cur = cur.filter(_keep_z(c, m, s, threshold))
    out = [(c, m, s) for c, m, s in rows]
    return df.sparkSession.createDataFrame(out, "column string, mean double, std double") \
        .withColumn("threshold", F.lit(float(threshold)))


def _keep(c: str, lo, hi) -> Column:
    if lo is None:
        return F.col(c).isNotNull() & F.lit(False)
    x = F.col(c).cast("double")
    return (x >= F.lit(lo)) & (x <= F.lit(hi))


def _keep_z(c: str, mean, std, threshold) -> Column:
    """The reference's test |(x - mean) / sd| < t, plus a slightly widened
    range on the raw column: it never drops a row the exact test keeps, but
    it is a plain comparison that the parquet reader can apply."""
    z = F.abs((F.col(c).cast("double") - F.lit(mean)) / F.lit(std))
    half = float(threshold) * std
    slack = 1e-9 * (abs(mean) + half) + 1e-300
    wide = (F.col(c) >= F.lit(mean - half - slack)) & (F.col(c) <= F.lit(mean + half + slack))
    return wide & (z < F.lit(float(threshold)))


def keep_condition(state: DataFrame, columns=None) -> Column:
    """Conjunction of all fences in a state table (IQR or z-score)."""
    cond = F.lit(True)
    for r in state.collect():  # bounded: one row per column
        if columns is not None and r["column"] not in columns:
            continue
        if "lower" in r.asDict():
            cond = cond & _keep(r["column"], r["lower"], r["upper"])
        else:
            cond = cond & _keep_z(r["column"], r["mean"], r["std"], r["threshold"])
    return cond


def apply(df: DataFrame, state: DataFrame) -> DataFrame:
    return df.filter(keep_condition(state, df.columns))


def flag(df: DataFrame, state: DataFrame, name: str = "is_outlier") -> DataFrame:
    return df.withColumn(name, F.coalesce((~keep_condition(state, df.columns)).cast("int"),
                                          F.lit(1)))


def remove_outliers(df: DataFrame, method: str = "iqr", columns=None, mode: str = "sequential",
                    threshold: float = 3.0, enabled: bool = True,
                    exclude=("is_attack",)) -> DataFrame:
    """Fit-and-filter on one table (the reference's switchable step)."""
    if not enabled:
        return df
    if method == "iqr":
        state = fit_iqr(df, columns, 1.5, mode, exclude)
    elif method == "zscore":
        state = fit_zscore(df, columns, threshold, mode, exclude)
    else:
        raise ValueError(f"unknown method {method!r}")
    return apply(df, state)

"""Distribution drift (population stability index) and feature correlation.

PSI: bucket edges are fitted on the reference table (deciles, bounded exact
quantiles); both tables are counted per (column, bucket) in long form — one
grouped count each — and the two small count tables are joined:
PSI = sum (a - e) * ln(a / e) over buckets, proportions floored at ``eps``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.stats import quantiles

PSI_EPS = 1e-4


def fit_psi_edges(reference: DataFrame, columns, n_bins: int = 10) -> dict:
    probs = [i / n_bins for i in range(1, n_bins)]
    q = quantiles(reference, columns, probs, "exact")
    return {c: sorted({v for v in q[c] if v is not None}) for c in columns}


def _bucket_counts(df: DataFrame, edges: dict) -> DataFrame:
    items = []
    for c, e in edges.items():
        x = F.col(c).cast("double")
        b = F.lit(0)
        for v in e:
            b = b + (x > F.lit(v)).cast("int")
        items.append(F.struct(F.lit(c).alias("column"), F.when(x.isNotNull(), b).alias("bucket")))
    return (df.select(F.explode(F.array(*items)).alias("s"))
            .filter(F.col("s.bucket").isNotNull())
            .groupBy(F.col("s.column").alias("column"), F.col("s.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def psi(reference: DataFrame, current: DataFrame, columns, n_bins: int = 10,
        eps: float = PSI_EPS, edges: dict | None = None) -> DataFrame:
    """(column, psi, severity): > 0.25 'drift', > 0.1 'warning', else 'metric'."""
    edges = edges if edges is not None else fit_psi_edges(reference, columns, n_bins)
    e = _bucket_counts(reference, edges).withColumnRenamed("n", "n_ref")
    a = _bucket_counts(current, edges).withColumnRenamed("n", "n_cur")
    j = e.join(a, ["column", "bucket"], "full_outer").fillna(0, ["n_ref", "n_cur"])
    tot = j.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    j = j.join(tot, "column")   # one row per column
    pe = F.greatest(F.col("n_ref") / F.col("t_ref"), F.lit(eps))
    pa = F.greatest(F.col("n_cur") / F.col("t_cur"), F.lit(eps))
    out = j.groupBy("column").agg(F.sum((pa - pe) * F.log(pa / pe)).alias("psi"))
    return out.withColumn("severity", F.when(F.col("psi") > 0.25, "drift")
                          .when(F.col("psi") > 0.1, "warning").otherwise("metric"))


def correlation(df: DataFrame, columns, method: str = "pearson") -> DataFrame:
    """Long-form correlation matrix (a, b, corr), each pair over the rows where
    both are there (NaN counts as missing): Pearson for all pairs in one
    aggregate, Spearman pair by pair with Spark ML. 1 on the diagonal; NULL for
    a pair without rows, NaN where one side is constant."""
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown correlation method {method!r}")
    typed = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    got = _pearson(typed, columns, pairs) if method == "pearson" else _spearman(typed, columns, pairs)
    rows = [(a, b, 1.0 if i == j else got[max(i, j), min(i, j)])
            for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def _pearson(df: DataFrame, columns, pairs) -> dict:
    if not pairs:
        return {}
    items = []
    for i, j in pairs:
        a, b = F.col(columns[i]), F.col(columns[j])
        both = a.isNotNull() & b.isNotNull()
        items.append(F.struct(F.count_if(both).alias("n"), F.covar_pop(a, b).alias("c"),
                              F.var_pop(F.when(both, a)).alias("va"), F.var_pop(F.when(both, b)).alias("vb"))
                     .alias(f"p_{i}_{j}"))
    row = df.agg(*items).first()
    out = {}
    for i, j in pairs:
        r = row[f"p_{i}_{j}"]
        sd = math.sqrt(r["va"]) * math.sqrt(r["vb"]) if r["n"] else 0.0
        out[i, j] = None if not r["n"] else r["c"] / sd if sd else math.nan
    return out


def _spearman(df: DataFrame, columns, pairs) -> dict:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    out = {}
    for i, j in pairs:
        two = df.select(F.col(columns[i]).alias("x"), F.col(columns[j]).alias("y")).dropna()
        if two.isEmpty():
            out[i, j] = None
            continue
        vec = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(two).select("v")
        out[i, j] = float(Correlation.corr(vec, "v", "spearman").first()[0].toArray()[0, 1])
    return out


def correlated_pairs(corr: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Pairs (a < b) with |corr| above the threshold: candidates to drop."""
    return corr.filter((F.col("a") < F.col("b")) & (F.abs(F.col("corr")) > threshold))

"""Univariate feature scoring and top-k selection.

* ANOVA F: one grouped aggregate of (count, mean, var_pop) per (class,
  feature) in long form, then the F statistic from that small table:
  F = (sum n_g (m_g - m)^2 / (k - 1)) / (sum n_g var_g / (n - k)).
* Mutual information (binned): continuous features are cut at fitted deciles,
  integer features use their values; one grouped count over
  (feature, bin, label) in long form, then the plug-in estimate
  sum p(x,y) ln(p(x,y) / (p(x) p(y))). (The reference's k-NN estimator is
  random and neither reproducible nor scalable; this is the documented
  deviation.)

Scores are a table (feature, score); ``select_kbest`` ranks by score desc,
name asc, NULL (undefined) last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.stats import quantiles
from ..schemas import numeric_columns


def anova_f(df: DataFrame, features: list[str], label: str = "is_attack") -> DataFrame:
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                      for c in features])
    long = (df.filter(F.col(label).isNotNull())
            .select(F.col(label).alias("y"), F.explode(items).alias("s"))
            .groupBy("y", F.col("s.feature").alias("feature"))
            .agg(F.count("s.x").alias("n"), F.avg("s.x").alias("m"), F.var_pop("s.x").alias("v"))
            .filter(F.col("n") > 0))
    g = long.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"),
        F.collect_list(F.struct("n", "m", "v")).alias("groups"))  # one entry per class
    ssb = F.aggregate(F.col("groups"), F.lit(0.0),
                      lambda acc, s: acc + s["n"] * (s["m"] - F.col("gm")) * (s["m"] - F.col("gm")))
    ssw = F.aggregate(F.col("groups"), F.lit(0.0), lambda acc, s: acc + s["n"] * s["v"])
    score = F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("n") - F.col("k")))
    return g.select("feature", F.when(F.col("k") > 1, score).alias("score"))


def _bin_expr(c: str, edges: list[float] | None) -> Column:
    x = F.col(c)
    if edges is None:
        return x.cast("double")
    b = F.lit(0)
    for e in edges:
        b = b + (x.cast("double") > F.lit(e)).cast("int")
    return b.cast("double")


def fit_mi_bins(df: DataFrame, features: list[str], n_bins: int = 10,
                method: str = "exact") -> dict:
    """{feature: distinct decile edges}, for whole numbers as for others: a bin a
    value would give a key column more mutual information than any real feature."""
    probs = [i / n_bins for i in range(1, n_bins)]
    q = quantiles(df, features, probs, method)
    return {c: sorted({v for v in q[c] if v is not None}) for c in features}


def mutual_info(df: DataFrame, features: list[str], label: str = "is_attack",
                bins: dict | None = None) -> DataFrame:
    bins = bins if bins is not None else fit_mi_bins(df, features)
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               F.coalesce(_bin_expr(c, bins.get(c)), F.lit(float("nan")))
                               .alias("x")) for c in features])
    cnt = (df.filter(F.col(label).isNotNull())
           .select(F.col(label).alias("y"), F.explode(items).alias("s"))
           .groupBy(F.col("s.feature").alias("feature"), F.col("s.x").alias("x"), "y")
           .agg(F.count(F.lit(1)).alias("nxy")))
    nx = cnt.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    ny = cnt.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))
    n = cnt.groupBy("feature").agg(F.sum("nxy").alias("n"))
    # all four tables are small (features x bins x classes)
    j = cnt.join(nx, ["feature", "x"]).join(ny, ["feature", "y"]).join(n, ["feature"])
    term = (F.col("nxy") / F.col("n")) * F.log(
        (F.col("nxy").cast("double") * F.col("n")) / (F.col("nx").cast("double") * F.col("ny")))
    return j.groupBy("feature").agg(F.sum(term).alias("score"))


def scores(df: DataFrame, method: str = "anova", label: str = "is_attack",
           features=None, exclude=("conn_id",)) -> DataFrame:
    feats = features if features is not None else numeric_columns(df, (label, *exclude))
    if method in ("anova", "f_classif"):
        return anova_f(df, feats, label)
    if method in ("mutual_info", "mi"):
        return mutual_info(df, feats, label)
    raise ValueError(f"unknown selection method {method!r}")


def rank_scores(score_table: DataFrame, k: int) -> DataFrame:
    """Adds rank (score desc, feature asc, undefined last) and selected flag.
    Scores equal to 6 decimals are ties (e.g. a feature and its complement
    have the same F up to float noise) and go by name. The table has one row
    per feature, so the ordering is over a bounded set."""
    from pyspark.sql import Window
    key = F.round(F.col("score") * F.lit(1e6), 0)
    w = Window.orderBy(key.desc_nulls_last(), F.col("feature").asc())
    r = score_table.withColumn("rank", F.row_number().over(w))
    return r.withColumn("selected", (F.col("rank") <= k).cast("int"))


def select_kbest(df: DataFrame, k: int = 50, method: str = "mutual_info",
                 label: str = "is_attack", features=None,
                 exclude=("conn_id",)) -> tuple[list[str], DataFrame]:
    """(selected feature names, ranked score table)."""
    st = rank_scores(scores(df, method, label, features, exclude), k)
    chosen = [r["feature"] for r in st.filter(F.col("selected") == 1).orderBy("rank").collect()]
    return chosen, st


def feature_scores(score_table: DataFrame, top: int = 20) -> DataFrame:
    key = F.round(F.col("score") * F.lit(1e6), 0)
    return score_table.orderBy(key.desc_nulls_last(), F.col("feature")).limit(top)

"""Derived-column operators (§ projections). Each is one ``withColumns`` so the
whole feature block stays a single codegen'd projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.expressions import flag, safe_divide
from ..functions.stats import quantile_table
from ..schemas import TARGETS, numeric_columns

# Domain interaction pairs, in priority order.
INTERACTION_PAIRS = [
    ("serror_rate", "srv_serror_rate"),
    ("rerror_rate", "srv_rerror_rate"),
    ("same_srv_rate", "diff_srv_rate"),
    ("dst_host_same_srv_rate", "dst_host_diff_srv_rate"),
    ("count", "srv_count"),
    ("src_bytes", "dst_bytes"),
]
PERCENTILES = [25, 50, 75, 90]


def network_feature_columns(columns) -> dict:
    cols = set(columns)
    c = F.col
    out = {}
    if {"src_bytes", "dst_bytes"} <= cols:
        out["bytes_ratio"] = safe_divide("src_bytes", c("dst_bytes") + F.lit(1))
        if "duration" in cols:
            out["bytes_per_second"] = safe_divide(c("src_bytes") + c("dst_bytes"),
                                                  c("duration") + F.lit(1))
    if {"count", "srv_count"} <= cols:
        out["srv_connection_ratio"] = safe_divide("srv_count", c("count") + F.lit(1))
    if {"serror_rate", "rerror_rate"} <= cols:
        out["total_error_rate"] = c("serror_rate") + c("rerror_rate")
        out["error_rate_diff"] = F.abs(c("serror_rate") - c("rerror_rate"))
    if {"dst_host_count", "dst_host_srv_count"} <= cols:
        out["host_connection_density"] = safe_divide(
            "dst_host_srv_count", c("dst_host_count") + F.lit(1))
    if {"same_srv_rate", "diff_srv_rate"} <= cols:
        out["srv_diversity"] = F.lit(1.0) - c("same_srv_rate")
        out["srv_anomaly"] = c("diff_srv_rate") * (F.lit(1.0) - c("same_srv_rate"))
    if "duration" in cols:
        # log1p(x <= -1) is NULL here (NaN / -inf in NumPy)
        d = c("duration").cast("double")
        out["duration_log"] = F.when(d > F.lit(-1.0), F.log1p(d))
        out["is_short_connection"] = flag(d < F.lit(1.0))
        out["is_long_connection"] = flag(d > F.lit(100.0))
    return out


def network_features(df: DataFrame) -> DataFrame:
    return df.withColumns(network_feature_columns(df.columns))


def interaction_columns(columns, max_interactions: int = 10,
                        pairs=INTERACTION_PAIRS) -> dict:
    cols = set(columns)
    out, made = {}, 0
    for a, b in pairs:
        if made >= max_interactions:
            break
        if a in cols and b in cols:
            out[f"{a}_x_{b}"] = F.col(a).cast("double") * F.col(b).cast("double")
            out[f"{a}_div_{b}"] = safe_divide(a, F.col(b) + F.lit(1e-8))
            made += 2
    return out


def interactions(df: DataFrame, max_interactions: int = 10) -> DataFrame:
    return df.withColumns(interaction_columns(df.columns, max_interactions))


# --- percentile flags: fit on one table, apply to any -----------------------

def fit_percentile_flags(df: DataFrame, columns=None, n_columns: int = 5,
                         exclude=("is_attack",), method: str = "exact") -> DataFrame:
    """State table (column, p, threshold) for x > p-th percentile flags."""
    if columns is None:
        columns = numeric_columns(df, exclude)[:n_columns]
    return quantile_table(df, columns, [p / 100 for p in PERCENTILES], method) \
        .withColumn("p", F.round(F.col("q") * 100).cast("int")).drop("q")


def apply_percentile_flags(df: DataFrame, state: DataFrame) -> DataFrame:
    rows = state.collect()  # bounded: columns x 4 rows
    exprs = {}
    for r in rows:
        if r["column"] in df.columns:
            exprs[f"{r['column']}_above_p{r['p']}"] = flag(
                F.col(r["column"]) > F.lit(r["threshold"]))
    return df.withColumns(dict(sorted(exprs.items(), key=lambda kv: kv[0])))


def drop_targets(df: DataFrame, targets=TARGETS) -> DataFrame:
    return df.drop(*targets)


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs -> flat columns named parent<sep>child (recursively)."""
    def walk(prefix, dtype, path):
        out = []
        for f in dtype.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            ref = path.getField(f.name) if path is not None else F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StructType):
                out.extend(walk(name, f.dataType, ref))
            else:
                out.append(ref.alias(name))
        return out
    return df.select(*walk("", df.schema, None))


def parse_json_column(df: DataFrame, column: str, schema) -> DataFrame:
    return df.withColumn(column, F.from_json(F.col(column), schema))

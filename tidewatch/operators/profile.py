"""Profiling and validation checks as long-form check tables.

Every check returns rows ``(check, column, metric, value, text, severity)``;
severity is ``error`` / ``warning`` / ``metric``. A result is valid when it has
no ``error`` row.

Scalar metrics of any number of checks are evaluated in ONE aggregate (one
scan with map-side partial aggregation) and exploded into rows; only the
categorical profile (grouped counts per column, long form) and the duplicate
count (group by all columns) need their own shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.stats import numeric_summary
from ..schemas import numeric_columns, string_columns
from ..session import cut_lineage
from .windows import join_small

CHECK_COLUMNS = ["check", "column", "metric", "value", "text", "severity"]
CHECK_DDL = "check string, column string, metric string, value double, text string, severity string"

# Domain expectations.
EXPECTED_FEATURES = ["duration", "src_bytes", "dst_bytes", "count", "srv_count",
                     "serror_rate", "rerror_rate", "same_srv_rate", "diff_srv_rate"]
EXPECTED_PROTOCOLS = ["tcp", "udp", "icmp"]
NON_NEGATIVE = ["duration", "src_bytes", "dst_bytes", "count"]
MAX_SERVICES = 100
MAX_STRING_COLUMNS = 20


class Metric(NamedTuple):
    check: str
    column: str
    metric: str
    value: Column                   # aggregate (or literal) expression
    severity: Column | None = None  # expression over aggregates; None -> 'metric'
    text: Column | None = None


def _lit_s(x):
    return F.lit(x).cast("string")


def run_metrics(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    spark = df.sparkSession
    if not metrics:
        return spark.createDataFrame([], CHECK_DDL)
    structs = [F.struct(
        F.lit(m.check).alias("check"), F.lit(m.column).alias("column"),
        F.lit(m.metric).alias("metric"), m.value.cast("double").alias("value"),
        (m.text if m.text is not None else F.lit(None).cast("string")).alias("text"),
        (m.severity if m.severity is not None else F.lit("metric")).alias("severity"))
        for m in metrics]
    return df.agg(F.array(*structs).alias("m")).select(F.explode("m").alias("m")) \
        .select(*[F.col(f"m.{c}").alias(c) for c in CHECK_COLUMNS])


def static_rows(spark, rows) -> DataFrame:
    """Schema-level findings that need no scan."""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], float(r[3]) if r[3] is not None else None, r[4], r[5])
         for r in rows], CHECK_DDL)


def _n() -> Column:
    return F.count(F.lit(1))


def _sev(cond: Column, level: str) -> Column:
    return F.when(cond, F.lit(level)).otherwise(F.lit("metric"))


def round2(x: Column) -> Column:
    return F.round(x * F.lit(100.0), 0) / F.lit(100.0)


# --- null profile -----------------------------------------------------------------

def null_metrics(df: DataFrame, check: str = "null_profile") -> list[Metric]:
    out = []
    n = _n()
    pcts, ncs = [], []
    for c in df.columns:
        nc = n - F.count(F.col(f"`{c}`"))
        pct = round2(F.try_divide(nc * F.lit(100.0), n))
        ncs.append(nc)
        pcts.append(pct)
        out.append(Metric(check, c, "null_count", nc))
        out.append(Metric(check, c, "null_pct", pct,
                          F.when(pct > 90, "error").when(pct > 50, "warning").otherwise("metric")))
    if df.columns:
        total = ncs[0]
        for x in ncs[1:]:
            total = total + x
        affected = F.lit(0)
        for x in ncs:
            affected = affected + (x > 0).cast("int")
        mx = F.greatest(*pcts) if len(pcts) > 1 else pcts[0]
        out += [Metric(check, "*", "total_missing", total),
                Metric(check, "*", "columns_with_missing", affected),
                Metric(check, "*", "max_missing_percentage", mx)]
    return out


def null_profile(df: DataFrame) -> DataFrame:
    return run_metrics(df, null_metrics(df))


# --- duplicates ------------------------------------------------------------------

def repeated_rows(df: DataFrame) -> DataFrame:
    """(n): how often each row occurs that occurs more than once (NULLs equal),
    exact. Rows are counted by a 64-bit hash, combined in each task, which sends 16
    bytes a row instead of whole rows; only rows whose hash occurs twice are grouped
    by all of their columns, again combined in each task first, so equal rows that
    are a third of the table are a row a task."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.select(*cols, F.xxhash64(*cols).alias("__h"))
    twice = cut_lineage(hashed.groupBy("__h").agg(_n().alias("__m")).where("__m > 1").select("__h"), "twice")
    rows = join_small(hashed, twice, ["__h"], "left_semi")
    return rows.groupBy("__h", *cols).agg(_n().alias("n")).where("n > 1").select("n")


def duplicate_rows(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Rows equal to an earlier row (NULLs equal), by ``repeated_rows``. The table is
    read three times, for its count, its hashes and its repeated rows."""
    dup, n = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)), F.lit(df.count())
    return run_metrics(repeated_rows(df), [
        Metric("duplicate_rows", "*", "duplicate_count", dup, _sev(dup > n * threshold, "warning")),
        Metric("duplicate_rows", "*", "duplicate_pct",
               F.try_divide(dup * F.lit(100.0), n), _sev(dup > n * threshold, "warning")),
    ])


# --- infinities, empty and constant columns --------------------------------------

def infinite_metrics(df: DataFrame, check: str = "infinite_values") -> list[Metric]:
    out = []
    for c in df.columns:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            k = F.count_if(F.abs(F.col(c)) == F.lit(float("inf")))
            out.append(Metric(check, c, "infinite_count", k, _sev(k > 0, "error")))
    return out


def infinite_columns(df: DataFrame) -> DataFrame:
    return run_metrics(df, infinite_metrics(df))


def empty_metrics(df: DataFrame, check: str = "empty_columns") -> list[Metric]:
    out = []
    for c in df.columns:
        k = F.count(F.col(f"`{c}`"))
        out.append(Metric(check, c, "non_null_count", k, _sev((k == 0) & (_n() > 0), "error")))
    return out


def empty_columns(df: DataFrame) -> DataFrame:
    return run_metrics(df, empty_metrics(df))


def constant_metrics(df: DataFrame, check: str = "constant_columns") -> list[Metric]:
    """One distinct non-null value <=> min = max (one pass, no Expand)."""
    out = []
    for c in numeric_columns(df):
        x = F.col(c)
        is_const = (F.count(x) > 0) & (F.min(x) == F.max(x))
        out.append(Metric(check, c, "is_constant", is_const.cast("int"), _sev(is_const, "warning")))
    return out


def constant_columns(df: DataFrame) -> DataFrame:
    return run_metrics(df, constant_metrics(df))


# --- schema ------------------------------------------------------------------------

def _dtype_name(t) -> str:
    return t.simpleString()


def schema_metrics(df: DataFrame, expected=None) -> tuple[list[Metric], list[tuple]]:
    n = _n()
    mets = [Metric("schema", "*", "num_rows", n, _sev(n == 0, "error"))]
    static = [("schema", "*", "num_columns", len(df.columns), None, "metric")]
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[_dtype_name(f.dataType)] = counts.get(_dtype_name(f.dataType), 0) + 1
    for t, k in sorted(counts.items()):
        static.append(("schema", "*", "dtype_count", k, t, "metric"))
    if expected:
        for c in sorted(set(expected) - set(df.columns)):
            static.append(("schema", c, "missing_column", 1, None, "error"))
        for c in sorted(set(df.columns) - set(expected)):
            static.append(("schema", c, "extra_column", 1, None, "warning"))
    mets += empty_metrics(df, "schema") + constant_metrics(df, "schema")
    return mets, static


def schema_check(df: DataFrame, expected=None) -> DataFrame:
    mets, static = schema_metrics(df, expected)
    return run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static))


# --- target -------------------------------------------------------------------------

def target_check(df: DataFrame, target: str = "is_attack") -> DataFrame:
    spark = df.sparkSession
    if target not in df.columns:
        return static_rows(spark, [("target", target, "missing_target", 1, None, "error")])
    return _target_rows(long_counts(df, [target]), target)


def _target_rows(counts: DataFrame, target: str) -> DataFrame:
    """From ``long_counts``; a minority under 5 % is marked severe, under 10 % imbalanced."""
    counts = counts.where(F.col("column") == target).select(F.col("value").alias("v"), F.col("n").alias("k"))
    nn = F.col("v").isNotNull()
    uniq = F.count_if(nn)
    missing = F.coalesce(F.sum(F.when(~nn, F.col("k"))), F.lit(0))
    kmin = F.min(F.when(nn, F.col("k")))
    kmax = F.max(F.when(nn, F.col("k")))
    tot = F.sum(F.when(nn, F.col("k")))
    minority = F.when(uniq == 2, kmin / tot)
    summary = run_metrics(counts, [
        Metric("target", target, "unique_values", uniq, _sev(uniq != 2, "warning")),
        Metric("target", target, "missing_values", missing, _sev(missing > 0, "error")),
        Metric("target", target, "minority_class_ratio", minority,
               F.when(minority < 0.1, "warning").otherwise("metric"),
               F.when(minority < 0.05, "severe").when(minority < 0.1, "imbalanced")),
        Metric("target", target, "imbalance_ratio", F.when(uniq == 2, kmax / kmin)),
    ])
    per_value = counts.filter(nn).select(
        F.lit("target").alias("check"), F.lit(target).alias("column"),
        F.lit("value_count").alias("metric"), F.col("k").cast("double").alias("value"),
        F.col("v").cast("string").alias("text"), F.lit("metric").alias("severity"))
    return summary.unionByName(per_value)


# --- distributions --------------------------------------------------------------------

def distribution_profile(df: DataFrame, exclude=("is_attack",), method: str = "exact",
                         check: str = "distribution") -> DataFrame:
    """mean, std, skewness, kurtosis, min, max, q25/q50/q75 per numeric column
    (one scan, grouped by column); warnings for |skew| > 3 and |kurtosis| > 10,
    errors for negative values in columns that must not have them."""
    cols = numeric_columns(df, exclude)
    if not cols:
        return df.sparkSession.createDataFrame([], CHECK_DDL)
    s = numeric_summary(df, cols, (0.25, 0.5, 0.75), method)
    has = F.col("n") > 0
    neg_ok = F.col("column").isin(*NON_NEGATIVE)
    items = [
        ("mean", F.col("mean"), None), ("std", F.col("std"), None),
        ("skewness", F.col("skewness"), has & (F.abs(F.col("skewness")) > 3)),
        ("kurtosis", F.col("kurtosis"), has & (F.abs(F.col("kurtosis")) > 10)),
        ("min", F.col("min"), None), ("max", F.col("max"), None),
        ("q25", F.col("q").getItem(0), None), ("q50", F.col("q").getItem(1), None),
        ("q75", F.col("q").getItem(2), None),
    ]
    structs = []
    for name, v, warn in items:
        if name == "min":
            sev = F.when(has & neg_ok & (F.col("min") < 0), "error").otherwise("metric")
        elif warn is not None:
            sev = F.when(warn, "warning").otherwise("metric")
        else:
            sev = F.lit("metric")
        structs.append(F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"),
                                sev.alias("severity")))
    return s.select("column", F.explode(F.array(*structs)).alias("m")).select(
        F.lit(check).alias("check"), "column", F.col("m.metric").alias("metric"),
        F.col("m.value").alias("value"), F.lit(None).cast("string").alias("text"),
        F.col("m.severity").alias("severity"))


# --- categorical ------------------------------------------------------------------------

def long_counts(df: DataFrame, columns) -> DataFrame:
    """(column, value as text, n): every value of the columns and how often it
    occurs, NULL among them. One shuffle for all columns, combined in each task
    first, so a value that most rows hold is a row a task."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(pairs).alias("s")).select("s.column", "s.value")
            .groupBy("column", "value").agg(_n().alias("n")))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """Top-k rows per group without putting a whole group in one task:
    rank inside each input partition first (bounded by the partition), keep k
    per (partition, group), then rank the <= k * partitions candidates."""
    pid = "__pid"
    w1 = Window.partitionBy(pid, *group).orderBy(*order)
    cand = (df.withColumn(pid, F.spark_partition_id())
            .withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k)
            .drop("__r", pid))
    w2 = Window.partitionBy(*group).orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


def categorical_profile(df: DataFrame, columns=None, top: int = 10,
                        check: str = "categorical") -> DataFrame:
    """Distinct values, the most frequent one, values that occur once and the top
    values of each text column; a column of NULLs has 0 of the first and third."""
    cols = columns if columns is not None else string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], CHECK_DDL)
    return _categorical_rows(long_counts(df, cols), cols, top, check)


def _categorical_rows(counts: DataFrame, cols, top: int = 10, check: str = "categorical") -> DataFrame:
    counts = counts.where(F.col("column").isin(*cols))
    there = F.col("value").isNotNull()
    per = counts.groupBy("column").agg(
        F.count("value").alias("unique_count"), F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("non_null"),
        F.count_if(there & (F.col("n") == 1)).alias("rare"),
        F.min(F.when(there, F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))).alias("mode"))
    counts = counts.where(there)
    rows = per.select(F.explode(F.array(
        F.struct(F.lit("unique_count").alias("metric"),
                 F.col("unique_count").cast("double").alias("value"),
                 F.lit(None).cast("string").alias("text"),
                 _sev_col(F.col("unique_count") > F.col("non_null") * 0.8, "warning").alias("severity")),
        F.struct(F.lit("most_frequent").alias("metric"), (-F.col("mode.neg")).cast("double").alias("value"),
                 F.col("mode.value").alias("text"), F.lit("metric").alias("severity")),
        F.struct(F.lit("rare_categories").alias("metric"), F.col("rare").cast("double").alias("value"),
                 F.lit(None).cast("string").alias("text"),
                 _sev_col(F.col("rare") > F.col("unique_count") * 0.5, "warning").alias("severity")),
    )).alias("s"), "column").select(F.lit(check).alias("check"), "column", "s.metric", "s.value",
                                    "s.text", "s.severity").where("metric <> 'most_frequent' OR value IS NOT NULL")
    topk = top_k_per_group(counts, ["column"], [F.col("n").desc(), F.col("value").asc()], top) \
        .select(F.lit(check).alias("check"), "column", F.lit("top_value").alias("metric"),
                F.col("n").cast("double").alias("value"), F.col("value").alias("text"),
                F.lit("metric").alias("severity"))
    return rows.unionByName(topk)


def _sev_col(cond: Column, level: str) -> Column:
    return F.when(cond, F.lit(level)).otherwise(F.lit("metric"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    g = df.groupBy(F.col(column).alias("value")).agg(_n().alias("n"))
    if top is not None:
        g = g.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(top)
    return g


# --- domain -------------------------------------------------------------------------------

def domain_metrics(df: DataFrame, check: str = "domain", services: bool = True) -> tuple[list[Metric], list[tuple]]:
    """``services``: with the count of distinct services, which expands the rows of
    the aggregate; a caller that has ``long_counts`` takes it from there."""
    cols = df.columns
    static = [(check, f, "missing_feature", 1, None, "warning")
              for f in EXPECTED_FEATURES if f not in cols]
    mets = []
    for c in cols:
        if "rate" in c.lower() and isinstance(df.schema[c].dataType, T.NumericType):
            mn, mx = F.min(F.col(c)), F.max(F.col(c))
            bad = (mn < 0) | (mx > 1)
            mets += [Metric(check, c, "rate_min", mn, _sev(bad, "error")),
                     Metric(check, c, "rate_max", mx, _sev(bad, "error"))]
    if services and "service" in cols:
        k = F.count_distinct(F.col("service"))
        mets.append(Metric(check, "service", "distinct_services", k, _sev(k > MAX_SERVICES, "warning")))
    if {"src_bytes", "dst_bytes", "duration"} <= set(cols):
        z = zero_duration_with_bytes_condition()
        k = F.count_if(z)
        mets.append(Metric(check, "*", "zero_duration_with_bytes", k, _sev(k > 0, "warning")))
    if {"is_attack", "attack_type"} <= set(cols):
        k = F.count_if(inconsistent_labels_condition())
        mets.append(Metric(check, "*", "inconsistent_labels", k, _sev(k > 0, "error")))
    return mets, static


def zero_duration_with_bytes_condition() -> Column:
    return (F.col("duration") == 0) & ((F.col("src_bytes") > 0) | (F.col("dst_bytes") > 0))


def inconsistent_labels_condition() -> Column:
    normal = F.col("attack_type").eqNullSafe(F.lit("normal"))
    return ((F.col("is_attack") == 1) & normal) | ((F.col("is_attack") == 0) & ~normal)


def protocol_rows(df: DataFrame, check: str = "domain") -> DataFrame:
    """Protocol distribution; values outside the expected set are warnings."""
    return _protocol_rows(long_counts(df, ["protocol_type"]), check)


def _protocol_rows(counts: DataFrame, check: str = "domain") -> DataFrame:
    g = counts.where(F.col("column") == "protocol_type").select(F.col("value").alias("text"), F.col("n").alias("k"))
    bad = ~F.col("text").isin(*EXPECTED_PROTOCOLS) | F.col("text").isNull()
    return g.select(F.lit(check).alias("check"), F.lit("protocol_type").alias("column"),
                    F.when(bad, "unexpected_protocol").otherwise("protocol_count").alias("metric"),
                    F.col("k").cast("double").alias("value"), "text",
                    _sev_col(bad, "warning").alias("severity"))


def domain_check(df: DataFrame) -> DataFrame:
    mets, static = domain_metrics(df)
    out = run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static))
    if "protocol_type" in df.columns:
        out = out.unionByName(protocol_rows(df))
    return out


# --- model input / quick checks -------------------------------------------------------------

def input_check(df: DataFrame, target: str | None = "is_attack") -> DataFrame:
    features = [c for c in df.columns if c != target]
    X = df.select(*features)
    static = [("input", c, "non_numeric", 1, X.schema[c].dataType.simpleString(), "error")
              for c in features if not isinstance(X.schema[c].dataType, T.NumericType)]
    static.append(("input", "*", "num_features", len(features), None, "metric"))
    n = _n()
    mets = [Metric("input", "*", "num_samples", n, _sev(n == 0, "error"))]
    for c in features:
        k = n - F.count(F.col(f"`{c}`"))
        mets.append(Metric("input", c, "null_count", k, _sev(k > 0, "error")))
    mets += infinite_metrics(X, "input")
    if target is not None and target in df.columns:
        counts = cut_lineage(long_counts(df, [target]), "targets")
        values = counts.where("value IS NOT NULL").select(
            F.lit("input").alias("check"), "column", F.lit("value_count").alias("metric"),
            F.col("n").cast("double").alias("value"), F.col("value").alias("text"), F.lit("metric").alias("severity"))
        unique = run_metrics(counts, [Metric("input", target, "unique_values", F.count("value"))])
        return run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static)).unionByName(
            unique).unionByName(values)
    return run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static))


def quick_check(df: DataFrame, required=None) -> DataFrame:
    static = [("quick", c, "missing_column", 1, None, "error")
              for c in sorted(set(required or []) - set(df.columns))]
    k = len(string_columns(df))
    static.append(("quick", "*", "string_columns", k, None,
                   "error" if k > MAX_STRING_COLUMNS else "metric"))
    n = _n()
    mets = [Metric("quick", "*", "num_rows", n, _sev(n == 0, "error"))]
    for c in df.columns:
        pct = F.try_divide((n - F.count(F.col(f"`{c}`"))) * F.lit(100.0), n)
        mets.append(Metric("quick", c, "missing_pct", pct, _sev(pct > 50, "error")))
    return run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static))


# --- summary and the full validation ------------------------------------------------------------

def summary(df: DataFrame) -> DataFrame:
    n = _n()
    mets = [Metric("summary", "*", "num_rows", n)]
    static = [("summary", "*", "num_columns", len(df.columns), None, "metric")]
    num = set(numeric_columns(df))
    strs = set(string_columns(df))
    for c in df.columns:
        kind = "numeric" if c in num else "categorical" if c in strs else "other"
        static.append(("summary", c, "dtype", None, df.schema[c].dataType.simpleString(), "metric"))
        static.append(("summary", c, "kind", None, kind, "metric"))
        k = n - F.count(F.col(f"`{c}`"))
        mets += [Metric("summary", c, "missing", k),
                 Metric("summary", c, "missing_pct", F.try_divide(k * F.lit(100.0), n))]
    out = run_metrics(df, mets).unionByName(static_rows(df.sparkSession, static))
    for t in ("is_attack", "attack_type"):
        if t in df.columns:
            out = out.unionByName(value_counts(df, t).select(
                F.lit("summary").alias("check"), F.lit(t).alias("column"),
                F.lit("distribution").alias("metric"), F.col("n").cast("double").alias("value"),
                F.col("value").cast("string").alias("text"), F.lit("metric").alias("severity")))
    return out


def validate_all(df: DataFrame, expected=None, target: str = "is_attack",
                 method: str = "exact") -> DataFrame:
    """All checks. Scalar metrics of the schema, quality and domain checks share ONE
    aggregate; one saved table of (column, value) counts feeds the target, protocol,
    service and categorical checks; distributions and duplicates read the data for
    themselves."""
    s_mets, s_static = schema_metrics(df, expected)
    d_mets, d_static = domain_metrics(df, services=False)
    mets = s_mets + null_metrics(df, "quality") + infinite_metrics(df, "quality") + d_mets
    parts = run_metrics(df, mets).unionByName(static_rows(df.sparkSession, s_static + d_static))
    strings = string_columns(df)
    counted = [*strings, *([target] if target in df.columns and target not in strings else [])]
    if counted:
        counts = cut_lineage(long_counts(df, counted), "values")
        if "service" in strings:
            k = F.count("value")
            parts = parts.unionByName(run_metrics(counts.where("column = 'service'"), [
                Metric("domain", "service", "distinct_services", k, _sev(k > MAX_SERVICES, "warning"))]))
        if "protocol_type" in strings:
            parts = parts.unionByName(_protocol_rows(counts))
        if strings:
            parts = parts.unionByName(_categorical_rows(counts, strings))
    parts = parts.unionByName(_target_rows(counts, target) if target in df.columns else target_check(df, target))
    parts = parts.unionByName(distribution_profile(df, (target,), method))
    return parts.unionByName(duplicate_rows(df).withColumn("check", F.lit("quality")))


def overall(checks: DataFrame) -> DataFrame:
    """errors, warnings, is_valid from a check table."""
    return checks.agg(F.count_if(F.col("severity") == "error").alias("errors"),
                      F.count_if(F.col("severity") == "warning").alias("warnings"),
                      (F.count_if(F.col("severity") == "error") == 0).cast("int").alias("is_valid"))

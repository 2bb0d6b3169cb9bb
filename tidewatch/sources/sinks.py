"""Sinks: predictions / processed tables (csv, json, parquet), reports, model
capture. Targets are URIs (local, HDFS, object stores alike)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FORMATS = ("csv", "json", "parquet")


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by=None) -> str:
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def read_table(spark, path: str, fmt: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    if fmt == "json":
        return r.json(path)
    return r.parquet(path)


def save_processed(df: DataFrame, base: str, name: str, fmt: str = "csv") -> str:
    """Processed table under ``<base>/processed/<name>``."""
    return write_table(df, f"{base.rstrip('/')}/processed/{name}", fmt)


def write_report(checks: DataFrame, path: str) -> str:
    """Check / metric tables as JSON lines."""
    return write_table(checks, path, "json")


def capture(scored: DataFrame, path: str, ts: str = "timestamp",
            fraction: float = 1.0, seed: int = 42, by_month: bool = False) -> str:
    """Append scored rows (inputs + outputs) with their capture date, in one
    folder a date or, for long spans, a month (``capture_month``); ``fraction``
    < 1 samples (the sampling is the feature here)."""
    out = scored if fraction >= 1.0 else scored.sample(False, fraction, seed)
    out = out.withColumn("capture_date", F.to_date(F.col(ts)))
    if by_month:
        out = out.withColumn("capture_month", F.date_format("capture_date", "yyyy-MM"))
    out.write.mode("append").partitionBy("capture_month" if by_month else "capture_date").parquet(path)
    return path

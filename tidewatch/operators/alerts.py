"""Scores -> bands -> alerts, prediction statistics, and the windowed alarm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions.expressions import (CONFIDENCE_LEVELS, THREAT_LEVELS, confidence_band,
                                      prediction_from_probability, prediction_label,
                                      recommended_action, threat_level)

ALERT_THRESHOLD = 0.7


def apply_bands(df: DataFrame, p: str = "probability", threshold: float = 0.5,
                pred: str | None = None) -> DataFrame:
    """Adds prediction, prediction_label, confidence, threat_level."""
    out = df
    if pred is None:
        out = out.withColumn("prediction", prediction_from_probability(p, threshold))
        pred = "prediction"
    return out.withColumns({
        "prediction_label": prediction_label(pred),
        "confidence": confidence_band(p),
        "threat_level": threat_level(p),
    })


def valid_predictions(df: DataFrame, pred: str = "prediction") -> DataFrame:
    return df.filter(F.col(pred).isNotNull())


def round_half_even(x: Column) -> Column:
    """Exact half-to-even rounding to an integer (same arithmetic in SQL)."""
    f = F.floor(x)
    d = x - f
    return (F.when(d > 0.5, f + 1).when(d < 0.5, f)
            .otherwise(f + F.pmod(f, F.lit(2)))).cast("bigint")


def percent_text(p: Column) -> Column:
    """p as a percentage with one decimal, e.g. 0.8125 -> '81.2'."""
    t = round_half_even(p * F.lit(1000.0))
    return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."),
                    F.pmod(t, F.lit(10)).cast("string"))


def alert_filter(df: DataFrame, threshold: float = ALERT_THRESHOLD,
                 p: str = "probability") -> DataFrame:
    """Rows at or above the alert threshold; a NULL probability never alerts."""
    return df.filter(F.col(p).isNotNull() & (F.col(p) >= F.lit(threshold)))


def alerts(df: DataFrame, key: str = "conn_id", ts: str = "timestamp",
           p: str = "probability", threshold: float = ALERT_THRESHOLD,
           model_version: str | Column = "unknown") -> DataFrame:
    """Alert records for rows with p >= threshold. ``alert_id`` carries the
    time and the row key, so alerts within one second do not collide."""
    mv = model_version if isinstance(model_version, Column) else F.lit(model_version)
    level = F.col("threat_level") if "threat_level" in df.columns else threat_level(p)
    conf = F.col("confidence") if "confidence" in df.columns else confidence_band(p)
    hits = alert_filter(df, threshold, p)
    return hits.select(
        F.concat(F.lit("THREAT_"), F.date_format(F.col(ts), "yyyyMMdd_HHmmss"),
                 F.lit("_"), F.col(key).cast("string")).alias("alert_id"),
        F.col(key).alias(key),
        level.alias("severity"),
        F.col(p).alias("probability"),
        conf.alias("confidence"),
        F.col(ts).alias("timestamp"),
        F.concat(F.lit("High-risk threat detected with "), percent_text(F.col(p)),
                 F.lit("% probability")).alias("description"),
        recommended_action(level).alias("recommended_action"),
        mv.alias("model_version"),
    )


def prediction_stats(df: DataFrame, p: str = "probability",
                     pred: str = "prediction", method: str = "exact") -> DataFrame:
    """One row: totals, class counts, distribution of p (population std) and
    zero-filled counts per confidence band and threat level. One aggregate,
    plus the median of p (radix selection, or the sketch for ``approx``)."""
    from ..functions.stats import quantiles
    valid = F.col(pred).isNotNull()
    pv = F.when(valid, F.col(p))
    med = quantiles(df.select(pv.alias("__pv")), ["__pv"], [0.5], method)["__pv"][0]
    median = F.lit(med).cast("double")
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(valid).alias("valid_predictions"),
        F.coalesce(F.sum(F.when(valid, F.col(pred))), F.lit(0)).alias("attack_predictions"),
        F.count_if(valid & (F.col(pred) == 0)).alias("normal_predictions"),
        (F.sum(F.when(valid, F.col(pred))).cast("double") * 100.0
         / F.count_if(valid)).alias("attack_rate"),
        F.avg(pv).alias("probability_mean"),
        median.alias("probability_median"),
        F.stddev_pop(pv).alias("probability_std"),
        F.min(pv).alias("probability_min"),
        F.max(pv).alias("probability_max"),
    ]
    band = confidence_band(p)
    for c in CONFIDENCE_LEVELS:
        aggs.append(F.count_if(valid & (band == c)).alias(f"confidence_{c.lower()}"))
    lvl = threat_level(p)
    for lv in THREAT_LEVELS:
        aggs.append(F.count_if(valid & (lvl == lv)).alias(f"threat_{lv.lower()}"))
    return df.agg(*aggs)


def _stat(statistic: str, m: Column) -> Column:
    aggs = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}
    if statistic not in aggs:
        raise ValueError(f"unknown statistic {statistic!r}")
    return aggs[statistic](m)


def period_metrics(df: DataFrame, ts: str, metric: Column | None = None,
                   period: str = "5 minutes", statistic: str = "sum", keys=()) -> DataFrame:
    """(keys..., period_start, period_end, metric) per tumbling period with data."""
    m = F.lit(1.0) if metric is None else metric
    return (df.groupBy(*keys, F.window(F.col(ts), period).alias("w"))
            .agg(_stat(statistic, m).cast("double").alias("metric"))
            .select(*keys, F.col("w.start").alias("period_start"),
                    F.col("w.end").alias("period_end"), "metric"))


def alarm_from_periods(per: DataFrame, period_seconds: int = 300, threshold: float = 0.0,
                       comparison: str = ">", evaluation_periods: int = 2,
                       keys=()) -> DataFrame:
    """Breach flag, run length and alarm state over a per-period table.

    A period is in alarm when it and the ``evaluation_periods - 1`` periods
    right before it all breach; a period with no data does not breach. Runs
    are gaps-and-islands over period indices (index - row_number is constant
    inside a run of adjacent breaching periods). The windows run over the
    per-period table — one row per period and key — never over raw rows.
    """
    cmp = {">": F.col("metric") > threshold, ">=": F.col("metric") >= threshold,
           "<": F.col("metric") < threshold, "<=": F.col("metric") <= threshold}[comparison]
    idx = F.floor(F.unix_micros(F.col("period_start").cast("timestamp"))
                  / F.lit(period_seconds * 1_000_000)).cast("bigint")
    per = per.withColumn("breaching", F.coalesce(cmp.cast("int"), F.lit(0))) \
             .withColumn("period_index", idx)
    w_b = Window.partitionBy(*keys, "breaching").orderBy("period_index")
    run = per.withColumn("island", F.col("period_index") - F.row_number().over(w_b))
    w_i = Window.partitionBy(*keys, "breaching", "island").orderBy("period_index") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = run.withColumn("run_length", F.when(F.col("breaching") == 1,
                                              F.count(F.lit(1)).over(w_i)).otherwise(0))
    return run.withColumn("alarm", (F.col("run_length") >= evaluation_periods).cast("int")) \
        .drop("island")


def windowed_alarm(df: DataFrame, ts: str, metric: Column | None = None,
                   period: str = "5 minutes", period_seconds: int = 300,
                   statistic: str = "sum", threshold: float = 0.0,
                   comparison: str = ">", evaluation_periods: int = 2,
                   keys=()) -> DataFrame:
    """Metric per period (one grouped aggregate), then the alarm state."""
    per = period_metrics(df, ts, metric, period, statistic, keys)
    return alarm_from_periods(per, period_seconds, threshold, comparison,
                              evaluation_periods, keys)

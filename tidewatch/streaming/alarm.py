"""Streaming alarm: per-period metric with a watermark, alarm over periods.

The stream keeps one state row per open period (bounded by the watermark). When
the watermark passes its end a period is closed, and the micro-batch that closes it
emits its alarm state at once: ``alarm_from_periods`` over the closed periods, with
the run of breaches that each key had before carried over from one small table a
batch. Both are written to folders of the batch's number, so a replayed batch
replaces its own output. Events later than the watermark are dropped, and a period
stays open until a later event (a heartbeat will do) moves the watermark past it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import alarm_from_periods, period_metrics
from ..operators.windows import join_small


def start_period_stream(stream: DataFrame, ts: str, sink: str, checkpoint: str,
                        metric: Column | None = None, period: str = "5 minutes",
                        watermark: str = "1 hour", statistic: str = "sum",
                        keys=(), available_now: bool = True) -> StreamingQuery:
    """Every micro-batch upserts the periods it changed, open ones too (``update``
    mode, a folder a batch): the live view that ``current_periods`` reads."""
    # watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session runs in UTC
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    m = F.lit(1.0) if metric is None else metric
    aggs = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}
    per = (s.groupBy(*keys, F.window(F.col(ts), period).alias("w"))
           .agg(aggs[statistic](m).cast("double").alias("metric"))
           .select(*keys, F.col("w.start").cast("timestamp_ntz").alias("period_start"),
                   F.col("w.end").cast("timestamp_ntz").alias("period_end"), "metric"))

    def upsert(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .parquet(f"{sink}/batch_id={batch_id}")

    w = per.writeStream.outputMode("update").foreachBatch(upsert) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def current_periods(spark: SparkSession, sink: str, keys=()) -> DataFrame:
    """Latest value of every period across the upsert folders."""
    t = spark.read.parquet(sink)
    w = Window.partitionBy(*keys, "period_start").orderBy(F.col("batch_id").desc())
    return (t.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1)
            .drop("__r", "batch_id"))


def closed_periods(stream: DataFrame, ts: str, metric: Column | None = None, period: str = "5 minutes",
                   watermark: str = "1 hour", statistic: str = "sum", keys=()) -> DataFrame:
    """(keys..., period_start, period_end, metric), each once, when it is closed."""
    # watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session runs in UTC
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    per = period_metrics(s, ts, metric, period, statistic, keys)
    return per.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("period_start", "period_end")})


def carry_runs(now: DataFrame, before: DataFrame | None, evaluation_periods: int, keys=()) -> DataFrame:
    """``alarm_from_periods`` rows of one batch, with the runs that go on from the
    batch before: ``before(keys..., period_index, run_length)``, the last period of
    each key."""
    if before is None:
        return now
    named = before.select(*keys, F.col("period_index").alias("__at"), F.col("run_length").alias("__run"))
    if keys:
        out = join_small(now, named, list(keys), "left")
    else:
        out = now.join(F.broadcast(named), F.lit(True), "left")       # one row at most
    goes_on = (F.col("breaching") == 1) & (F.col("period_index") - F.col("run_length") == F.col("__at"))
    run = F.col("run_length") + F.when(goes_on, F.col("__run")).otherwise(0)
    return (out.withColumn("run_length", F.coalesce(run, F.col("run_length")))
            .withColumn("alarm", (F.col("run_length") >= evaluation_periods).cast("int")).drop("__at", "__run"))


def start_alarm_stream(stream: DataFrame, ts: str, sink: str, checkpoint: str, metric: Column | None = None,
                       period: str = "5 minutes", period_seconds: int = 300, threshold: float = 0.0,
                       comparison: str = ">", evaluation_periods: int = 2, watermark: str = "1 hour",
                       statistic: str = "sum", keys=(), available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``read_alarms`` sees the alarm of every closed period as
    soon as the batch that closed it has ended."""
    keys = list(keys)
    per = closed_periods(stream, ts, metric, period, watermark, statistic, keys)

    def close(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        before = spark.read.parquet(f"{sink}/runs/batch_id={batch_id - 1}") if batch_id else None
        now = alarm_from_periods(batch, period_seconds, threshold, comparison, evaluation_periods, keys)
        path = f"{sink}/alarms/batch_id={batch_id}"
        carry_runs(now, before, evaluation_periods, keys).write.mode("overwrite").parquet(path)
        last = spark.read.parquet(path).select(*keys, "period_index", "run_length")
        if before is not None:
            last = last.unionByName(before)
        latest = F.max(F.struct("period_index", "run_length")).alias("l")
        runs = last.groupBy(*keys).agg(latest) if keys else last.agg(latest).where("l IS NOT NULL")
        runs.select(*keys, "l.period_index", "l.run_length").write.mode("overwrite").parquet(
            f"{sink}/runs/batch_id={batch_id}")

    w = per.writeStream.outputMode("append").foreachBatch(close).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_alarms(spark: SparkSession, sink: str) -> DataFrame:
    """The alarm state of every period closed so far."""
    return spark.read.parquet(f"{sink}/alarms").drop("batch_id")

"""Windowed alarm (batch) and the streaming queries. Stream inputs are files
Spark writes from the driver tables; each stream's result must equal the
batch query's SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as AL
from ..operators import windows as WI
from ..schemas import kdd_schema
from ..session import scratch_path
from ..sources.tables import connections, events, kdd_layout, risk_probability
from ..streaming import alarm as SA
from ..streaming import rolling as SR
from ..streaming import scoring as SS
from .base import SCORED_CTE, fin, register, sql_fin, with_cte
from .q_core import ALERT_SQL
from .q_eval import _roll_sql
from .q_sources import KDD_SQL, OUT

# --- alarm over hourly error counts ---------------------------------------------------
ALARM_SQL = sql_fin("""
WITH per AS (
  SELECT date_trunc('hour', ts) AS period_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_end,
         sum(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS metric
  FROM events GROUP BY ALL),
b AS (SELECT *, CASE WHEN metric > 5 THEN 1 ELSE 0 END AS breaching,
             CAST(floor(epoch(period_start) / 3600) AS BIGINT) AS period_index FROM per),
isl AS (SELECT *, period_index - row_number() OVER (PARTITION BY breaching ORDER BY period_index)
                  AS island FROM b),
r AS (SELECT *, CASE WHEN breaching = 1 THEN count(*) OVER (
                 PARTITION BY breaching, island ORDER BY period_index
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END AS run_length
      FROM isl)
SELECT period_start, period_end, metric, breaching, period_index, run_length,
       CASE WHEN run_length >= 2 THEN 1 ELSE 0 END AS alarm
FROM r""", ["metric"], ["breaching", "period_index", "run_length", "alarm"])

def ERR():
    return F.when(F.col("event_type") == "error", F.lit(1.0)).otherwise(F.lit(0.0))


@register("windowed_alarm", ALARM_SQL)
def q_windowed_alarm(spark, sf):
    e = events(spark, sf)
    return fin(AL.windowed_alarm(e, "ts", ERR(), "1 hour", 3600, "sum", 5.0, ">", 2))


def _stage_chunks(df, ts, n_chunks):
    """Split ``df`` into ``n_chunks`` consecutive time ranges (boundaries from
    one aggregate): [(lo, hi), ...] in microseconds."""
    r = df.agg(F.min(F.unix_micros(F.col(ts).cast("timestamp"))).alias("lo"),
               F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("hi")).first()
    lo, hi = r["lo"], r["hi"] + 1
    step = (hi - lo + n_chunks - 1) // n_chunks
    return [(lo + i * step, min(hi, lo + (i + 1) * step)) for i in range(n_chunks)]


def _chunk(df, ts, lo, hi):
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.filter((t >= F.lit(lo)) & (t < F.lit(hi)))


def _heartbeat(e):
    """An event three hours after the last one: it closes every period before."""
    last = e.agg(F.max("ts").alias("ts"))
    beat = {"ts": F.col("ts") + F.expr("INTERVAL 3 HOURS"), "event_type": F.lit("heartbeat")}
    return last.select(*[beat.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in e.schema.fields])


@register("alarm_stream", ALARM_SQL)
def q_alarm_stream(spark, sf):
    e = events(spark, sf)
    src, sink, ck = (scratch_path(spark, f"alarm_{x}") for x in ("src", "sink", "ckpt"))
    # files arrive in time order; each arrival is processed by an availableNow run, two heartbeats come last
    parts = [_chunk(e, "ts", lo, hi) for lo, hi in _stage_chunks(e, "ts", 4)] + [_heartbeat(e)] * 2
    for i, part in enumerate(parts):
        part.write.mode("overwrite").parquet(f"{src}/part={i}")
        stream = SS.file_stream(spark, f"{src}/part=*", e.schema, "parquet")
        SA.start_alarm_stream(stream, "ts", sink, ck, ERR(), "1 hour", 3600, 5.0, ">", 2, "1 hour").awaitTermination()
    return fin(SA.read_alarms(spark, sink))


# --- stateless stream scoring ----------------------------------------------------------
_SCORE_COLS = ["conn_id", "probability", "prediction", "prediction_label", "confidence",
               "threat_level"]


def _stream_scored(spark, sf, transform):
    c = connections(spark, sf)
    src = scratch_path(spark, "score_src")
    c.repartition(6).write.mode("overwrite").parquet(src)
    sink = scratch_path(spark, "score_sink")
    SS.score_stream(spark, src, c.schema, transform, sink, scratch_path(spark, "score_ckpt"),
                    max_files_per_trigger=2)
    return spark.read.parquet(sink)


def _score(df):
    return AL.apply_bands(risk_probability(df)).select(*_SCORE_COLS)


@register("score_stream", sql_fin(with_cte(SCORED_CTE, f"SELECT {', '.join(_SCORE_COLS)} FROM scored"),
                                  ["probability"], ["conn_id", "prediction"]))
def q_score_stream(spark, sf):
    return fin(_stream_scored(spark, sf, _score))


def _alerts(df):
    s = AL.apply_bands(risk_probability(df))
    return AL.alerts(s, key="conn_id", ts="ts", model_version="rules-v1")


@register("alert_stream", sql_fin(with_cte(SCORED_CTE, ALERT_SQL), ["probability"], ["conn_id"]))
def q_alert_stream(spark, sf):
    return fin(_stream_scored(spark, sf, _alerts))


# --- keyed-state rolling features -------------------------------------------------------
@register("rolling_stream", _roll_sql(["value_rolling_mean", "value_rolling_std", "value_zscore"]))
def q_rolling_stream(spark, sf):
    e = events(spark, sf)
    w = WI.rolling_window_size(e.count())
    src = scratch_path(spark, "roll_src")
    sink = scratch_path(spark, "roll_sink")
    ck = scratch_path(spark, "roll_ckpt")
    for i, (lo, hi) in enumerate(_stage_chunks(e, "ts", 3)):
        _chunk(e, "ts", lo, hi).write.mode("overwrite").parquet(f"{src}/part={i}")
        stream = SS.file_stream(spark, f"{src}/part=*", e.schema, "parquet")
        with SR.rocksdb_state(spark):
            SR.rolling_stream(stream, "user_id", "ts", "event_id", "value", w).writeStream.format("parquet").option(
                "path", sink).option("checkpointLocation", ck).outputMode("append").trigger(
                availableNow=True).start().awaitTermination()
    return fin(spark.read.parquet(sink).select("event_id", "value_rolling_mean",
                                               "value_rolling_std", "value_zscore"))


# --- file stream source ---------------------------------------------------------------------
@register("stream_source", KDD_SQL)
def q_stream_source(spark, sf):
    k = kdd_layout(connections(spark, sf))
    src = scratch_path(spark, "kdd_stream_src")
    k.repartition(4).write.mode("overwrite").csv(src)
    sink = scratch_path(spark, "kdd_stream_sink")
    from ..sources.files import _finish
    stream = SS.file_stream(spark, src, kdd_schema(), "csv", max_files_per_trigger=1)
    q = SS.start(stream, sink, scratch_path(spark, "kdd_stream_ckpt"), _finish)
    q.awaitTermination()
    return fin(spark.read.parquet(sink).select(*OUT))


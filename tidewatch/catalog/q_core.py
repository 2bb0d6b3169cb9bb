"""Connections adapter, projections, bands, alerts, prediction statistics."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions.expressions import (derive_label, rule_label, rule_score, safe_divide)
from ..operators import alerts as A
from ..operators import features as FE
from ..plans.scoring import rule_scored
from ..sources.tables import connections, events
from .base import CONN_CTE, SCORED_CTE, fin, register, sql_fin, with_cte

CONN_COLS = ["conn_id", "ts", "duration", "protocol_type", "service", "flag", "src_bytes",
             "dst_bytes", "count", "srv_count", "serror_rate", "rerror_rate",
             "same_srv_rate", "diff_srv_rate", "attack_type", "is_attack"]
CONN_DOUBLES = ["duration", "src_bytes", "dst_bytes", "serror_rate", "rerror_rate",
                "same_srv_rate", "diff_srv_rate"]
CONN_INTS = ["conn_id", "count", "srv_count", "is_attack"]


@register("connections", sql_fin(with_cte(CONN_CTE, "SELECT * FROM connections"),
                                 CONN_DOUBLES, CONN_INTS))
def q_connections(spark, sf):
    return fin(connections(spark, sf))


# --- derive_label: NULL attack type counts as attack --------------------------
@register("derive_label", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id, t AS attack_type,
       CASE WHEN t IS NOT DISTINCT FROM 'normal' THEN 0 ELSE 1 END AS is_attack
FROM (SELECT conn_id, CASE WHEN "count" IS NULL THEN NULL ELSE attack_type END AS t
      FROM connections) x"""), ints=["conn_id", "is_attack"]))
def q_derive_label(spark, sf):
    c = connections(spark, sf)
    t = F.when(F.col("count").isNull(), F.lit(None).cast("string")).otherwise(F.col("attack_type"))
    df = c.select("conn_id", t.alias("attack_type"))
    return fin(df.withColumn("is_attack", derive_label("attack_type")))


# --- network features ---------------------------------------------------------
NET_SQL = """
SELECT conn_id,
  src_bytes / (dst_bytes + 1) AS bytes_ratio,
  (src_bytes + dst_bytes) / (duration + 1) AS bytes_per_second,
  CAST(srv_count AS DOUBLE) / ("count" + 1) AS srv_connection_ratio,
  serror_rate + rerror_rate AS total_error_rate,
  abs(serror_rate - rerror_rate) AS error_rate_diff,
  1.0 - same_srv_rate AS srv_diversity,
  diff_srv_rate * (1.0 - same_srv_rate) AS srv_anomaly,
  CASE WHEN duration > -1 THEN ln(1 + duration) END AS duration_log,
  coalesce(CAST(duration < 1 AS INTEGER), 0) AS is_short_connection,
  coalesce(CAST(duration > 100 AS INTEGER), 0) AS is_long_connection
FROM connections"""
NET_DOUBLES = ["bytes_ratio", "bytes_per_second", "srv_connection_ratio", "total_error_rate",
               "error_rate_diff", "srv_diversity", "srv_anomaly", "duration_log"]


@register("network_features", sql_fin(with_cte(CONN_CTE, NET_SQL), NET_DOUBLES,
                                      ["conn_id", "is_short_connection", "is_long_connection"]))
def q_network_features(spark, sf):
    c = connections(spark, sf)
    feats = FE.network_feature_columns(c.columns)
    return fin(c.select("conn_id", *[e.alias(k) for k, e in feats.items()]))


@register("bytes_ratio", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id, src_bytes / (dst_bytes + 1) AS bytes_ratio,
       (src_bytes + dst_bytes) / (duration + 1) AS bytes_per_second
FROM connections"""), ["bytes_ratio", "bytes_per_second"], ["conn_id"]))
def q_bytes_ratio(spark, sf):
    c = connections(spark, sf)
    return fin(c.select("conn_id",
                        safe_divide("src_bytes", F.col("dst_bytes") + 1).alias("bytes_ratio"),
                        safe_divide(F.col("src_bytes") + F.col("dst_bytes"),
                                    F.col("duration") + 1).alias("bytes_per_second")))


@register("safe_divide", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id,
       coalesce(CASE WHEN "count" - srv_count = 0 THEN NULL
                     ELSE CAST(duration AS DOUBLE) / ("count" - srv_count) END, 0.0) AS q
FROM connections"""), ["q"], ["conn_id"]))
def q_safe_divide(spark, sf):
    c = connections(spark, sf)
    return fin(c.select("conn_id", safe_divide("duration", F.col("count") - F.col("srv_count"),
                                               default=0.0).alias("q")))


# --- interactions: the first pairs present, at most 10 columns ----------------
@register("interactions", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id,
  same_srv_rate * diff_srv_rate AS same_srv_rate_x_diff_srv_rate,
  same_srv_rate / (diff_srv_rate + 1e-8) AS same_srv_rate_div_diff_srv_rate,
  CAST("count" AS DOUBLE) * srv_count AS count_x_srv_count,
  "count" / (srv_count + 1e-8) AS count_div_srv_count,
  src_bytes * dst_bytes AS src_bytes_x_dst_bytes,
  src_bytes / (dst_bytes + 1e-8) AS src_bytes_div_dst_bytes
FROM connections"""), ["same_srv_rate_x_diff_srv_rate", "same_srv_rate_div_diff_srv_rate",
                       "count_x_srv_count", "count_div_srv_count", "src_bytes_x_dst_bytes",
                       "src_bytes_div_dst_bytes"], ["conn_id"]))
def q_interactions(spark, sf):
    c = connections(spark, sf)
    feats = FE.interaction_columns(c.columns, max_interactions=10)
    return fin(c.select("conn_id", *[e.alias(k) for k, e in feats.items()]))


# --- rule-based detector -----------------------------------------------------
@register("rule_score", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id, score, CASE WHEN score > 0.4 THEN 1 ELSE 0 END AS rule_label
FROM (SELECT conn_id,
        0.0::DOUBLE + CASE WHEN serror_rate > 0.5 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
            + CASE WHEN rerror_rate > 0.3 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
            + CASE WHEN duration > 100 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END AS score
      FROM connections) s"""), ["score"], ["conn_id", "rule_label"]))
def q_rule_score(spark, sf):
    c = connections(spark, sf)
    s = rule_score(c.columns)
    return fin(c.select("conn_id", s.alias("score"), rule_label(s).alias("rule_label")))


# --- bands ---------------------------------------------------------------------
SCORED_OUT = """
SELECT conn_id, probability, prediction, prediction_label, confidence, threat_level,
  CASE threat_level WHEN 'Critical' THEN 'Immediate isolation and investigation required'
    WHEN 'High' THEN 'Priority investigation and monitoring'
    WHEN 'Medium' THEN 'Enhanced monitoring and logging'
    WHEN 'Low' THEN 'Standard monitoring' WHEN 'Minimal' THEN 'Continue normal operations'
    ELSE 'Unknown threat level' END AS recommended_action
FROM scored"""


@register("threat_level", sql_fin(with_cte(SCORED_CTE, SCORED_OUT), ["probability"],
                                  ["conn_id", "prediction"]))
def q_threat_level(spark, sf):
    from ..functions.expressions import recommended_action
    s = rule_scored(spark, sf)
    return fin(s.select("conn_id", "probability", "prediction", "prediction_label",
                        "confidence", "threat_level",
                        recommended_action("threat_level").alias("recommended_action")))


@register("confidence_band", sql_fin(with_cte(SCORED_CTE, """
SELECT confidence, count(*) AS n, min(probability) AS p_min, max(probability) AS p_max
FROM scored GROUP BY confidence"""), ["p_min", "p_max"], ["n"]))
def q_confidence_band(spark, sf):
    s = rule_scored(spark, sf)
    return fin(s.groupBy("confidence").agg(F.count(F.lit(1)).alias("n"),
                                           F.min("probability").alias("p_min"),
                                           F.max("probability").alias("p_max")))


@register("recommended_action", sql_fin(with_cte(SCORED_CTE, """
SELECT lvl AS threat_level,
  CASE lvl WHEN 'Critical' THEN 'Immediate isolation and investigation required'
    WHEN 'High' THEN 'Priority investigation and monitoring'
    WHEN 'Medium' THEN 'Enhanced monitoring and logging'
    WHEN 'Low' THEN 'Standard monitoring' WHEN 'Minimal' THEN 'Continue normal operations'
    ELSE 'Unknown threat level' END AS recommended_action, count(*) AS n
FROM (SELECT CASE WHEN is_attack = 1 AND probability < 0.3 THEN 'Unrated'
                  ELSE threat_level END AS lvl FROM scored) x
GROUP BY lvl"""), ints=["n"]))
def q_recommended_action(spark, sf):
    from ..functions.expressions import recommended_action
    s = rule_scored(spark, sf)
    lvl = F.when((F.col("is_attack") == 1) & (F.col("probability") < 0.3), "Unrated") \
        .otherwise(F.col("threat_level"))
    x = s.select(lvl.alias("threat_level"))
    return fin(x.groupBy("threat_level").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("recommended_action", recommended_action("threat_level")))


@register("prediction_label", sql_fin(with_cte(SCORED_CTE, """
SELECT prediction_label, count(*) AS n FROM scored GROUP BY prediction_label"""),
    ints=["n"]))
def q_prediction_label(spark, sf):
    s = rule_scored(spark, sf)
    return fin(s.groupBy("prediction_label").agg(F.count(F.lit(1)).alias("n")))


@register("valid_predictions", sql_fin(with_cte(SCORED_CTE, """
SELECT conn_id, probability FROM scored WHERE "count" IS NOT NULL"""),
    ["probability"], ["conn_id"]))
def q_valid_predictions(spark, sf):
    # rows without packets get no prediction (an error record), then are dropped
    s = rule_scored(spark, sf).withColumn(
        "prediction", F.when(F.col("count").isNotNull(), F.col("prediction")))
    return fin(A.valid_predictions(s).select("conn_id", "probability"))


# --- prediction statistics ---------------------------------------------------
PSTATS_SQL = """
SELECT count(*) AS total_predictions,
  count(pred2) AS valid_predictions,
  coalesce(sum(pred2), 0) AS attack_predictions,
  count(*) FILTER (WHERE pred2 = 0) AS normal_predictions,
  CAST(sum(pred2) AS DOUBLE) * 100.0 / count(pred2) AS attack_rate,
  avg(pv) AS probability_mean,
  quantile_cont(pv, 0.5) AS probability_median,
  stddev_pop(pv) AS probability_std,
  min(pv) AS probability_min, max(pv) AS probability_max,
  count(*) FILTER (WHERE pv IS NOT NULL AND confidence = 'High') AS confidence_high,
  count(*) FILTER (WHERE pv IS NOT NULL AND confidence = 'Medium') AS confidence_medium,
  count(*) FILTER (WHERE pv IS NOT NULL AND confidence = 'Low') AS confidence_low,
  count(*) FILTER (WHERE pv IS NOT NULL AND threat_level = 'Critical') AS threat_critical,
  count(*) FILTER (WHERE pv IS NOT NULL AND threat_level = 'High') AS threat_high,
  count(*) FILTER (WHERE pv IS NOT NULL AND threat_level = 'Medium') AS threat_medium,
  count(*) FILTER (WHERE pv IS NOT NULL AND threat_level = 'Low') AS threat_low,
  count(*) FILTER (WHERE pv IS NOT NULL AND threat_level = 'Minimal') AS threat_minimal
FROM (SELECT *, CASE WHEN "count" IS NOT NULL THEN prediction END AS pred2,
             CASE WHEN "count" IS NOT NULL THEN probability END AS pv FROM scored) s0
"""
PSTATS_INTS = ["total_predictions", "valid_predictions", "attack_predictions",
               "normal_predictions", "confidence_high", "confidence_medium", "confidence_low",
               "threat_critical", "threat_high", "threat_medium", "threat_low",
               "threat_minimal"]
PSTATS_DOUBLES = ["attack_rate", "probability_mean", "probability_median", "probability_std",
                  "probability_min", "probability_max"]


@register("prediction_stats", sql_fin(with_cte(SCORED_CTE, PSTATS_SQL), PSTATS_DOUBLES,
                                      PSTATS_INTS))
def q_prediction_stats(spark, sf):
    # several passes (median sketch + counts): materialize the scored input once
    s = rule_scored(spark, sf, materialize=True).withColumn(
        "prediction", F.when(F.col("count").isNotNull(), F.col("prediction")))
    return fin(A.prediction_stats(s))


# --- alerts ------------------------------------------------------------------
ALERT_SQL = """
SELECT 'THREAT_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || CAST(conn_id AS VARCHAR) AS alert_id,
  conn_id, threat_level AS severity, probability, confidence, ts AS "timestamp",
  'High-risk threat detected with ' || CAST(CAST(floor(t / 10) AS BIGINT) AS VARCHAR) || '.'
    || CAST(CAST(t % 10 AS BIGINT) AS VARCHAR) || '% probability' AS description,
  CASE threat_level WHEN 'Critical' THEN 'Immediate isolation and investigation required'
    WHEN 'High' THEN 'Priority investigation and monitoring'
    WHEN 'Medium' THEN 'Enhanced monitoring and logging'
    WHEN 'Low' THEN 'Standard monitoring' WHEN 'Minimal' THEN 'Continue normal operations'
    ELSE 'Unknown threat level' END AS recommended_action,
  'rules-v1' AS model_version
FROM (SELECT *, CASE WHEN x - floor(x) > 0.5 THEN floor(x) + 1
                     WHEN x - floor(x) < 0.5 THEN floor(x)
                     ELSE floor(x) + (floor(x) % 2) END AS t
      FROM (SELECT *, probability * 1000.0 AS x FROM scored) a) b
WHERE probability IS NOT NULL AND probability >= 0.7"""


@register("alerts", sql_fin(with_cte(SCORED_CTE, ALERT_SQL), ["probability"], ["conn_id"]))
def q_alerts(spark, sf):
    s = rule_scored(spark, sf)
    return fin(A.alerts(s, key="conn_id", ts="ts", model_version="rules-v1"))


@register("alert_filter", sql_fin(with_cte(SCORED_CTE, """
SELECT threat_level, count(*) AS n FROM scored
WHERE probability IS NOT NULL AND probability >= 0.7 GROUP BY threat_level"""), ints=["n"]))
def q_alert_filter(spark, sf):
    s = rule_scored(spark, sf)
    return fin(A.alert_filter(s).groupBy("threat_level").agg(F.count(F.lit(1)).alias("n")))


# --- drop targets / flatten nested -------------------------------------------
@register("drop_targets", sql_fin(with_cte(CONN_CTE, """
SELECT * EXCLUDE (attack_type, is_attack) FROM connections"""),
    [c for c in CONN_DOUBLES], ["conn_id", "count", "srv_count"]))
def q_drop_targets(spark, sf):
    return fin(FE.drop_targets(connections(spark, sf)))


@register("flatten_struct", sql_fin("""
SELECT event_id, user_id AS entity_id, event_type AS entity_kind,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k
FROM events""", ints=["event_id", "entity_id", "props_k"]))
def q_flatten_struct(spark, sf):
    e = events(spark, sf)
    props_t = T.StructType([T.StructField("k", T.LongType())])
    nested = e.select("event_id", F.struct(F.col("user_id").alias("id"),
                                           F.col("event_type").alias("kind")).alias("entity"),
                      F.from_json("props", props_t).alias("props"))
    return fin(FE.flatten_struct(nested))


# --- the individual derived columns of the network block ------------------------
def _net_query(name, cols, sql_exprs, frame=None):
    dbl = [c for c in cols if c not in ("is_short_connection", "is_long_connection")]
    ints = ["conn_id"] + [c for c in cols if c not in dbl]
    sql = sql_fin(with_cte(CONN_CTE, f"SELECT conn_id, {sql_exprs} FROM connections"), dbl, ints)

    @register(name, sql)
    def q(spark, sf):
        c = connections(spark, sf)
        if frame is not None:
            c = frame(c)
        feats = FE.network_feature_columns(c.columns)
        return fin(c.select("conn_id", *[feats[k].alias(k) for k in cols]))
    return q


_net_query("srv_connection_ratio", ["srv_connection_ratio"],
           'CAST(srv_count AS DOUBLE) / ("count" + 1) AS srv_connection_ratio')
_net_query("total_error_rate", ["total_error_rate", "error_rate_diff"],
           "serror_rate + rerror_rate AS total_error_rate, "
           "abs(serror_rate - rerror_rate) AS error_rate_diff")
_net_query("srv_diversity", ["srv_diversity", "srv_anomaly"],
           "1.0 - same_srv_rate AS srv_diversity, "
           "diff_srv_rate * (1.0 - same_srv_rate) AS srv_anomaly")
_net_query("duration_log", ["duration_log", "is_short_connection", "is_long_connection"],
           "CASE WHEN duration > -1 THEN ln(1 + duration) END AS duration_log, "
           "coalesce(CAST(duration < 1 AS INTEGER), 0) AS is_short_connection, "
           "coalesce(CAST(duration > 100 AS INTEGER), 0) AS is_long_connection")
# host counts of the connection record, taken here from the per-order counts
_net_query("host_connection_density", ["host_connection_density"],
           'CAST(srv_count AS DOUBLE) / ("count" + 1) AS host_connection_density',
           frame=lambda c: c.withColumn("dst_host_count", F.col("count"))
           .withColumn("dst_host_srv_count", F.col("srv_count")))


# --- attack families ------------------------------------------------------------------
def _family_sql():
    from ..functions.expressions import ATTACK_FAMILIES, FAMILIES
    pairs = dict(ATTACK_FAMILIES)
    pairs.update({f: f for f in FAMILIES})
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return with_cte(CONN_CTE, f"""
SELECT family, count(*) AS n FROM (
  SELECT CASE WHEN attack_type IS NULL THEN NULL
              ELSE coalesce(CASE lower(trim(attack_type)) {whens} END, 'unknown') END AS family
  FROM connections) f
GROUP BY family""")


@register("attack_family", sql_fin(_family_sql(), ints=["n"]))
def q_attack_family(spark, sf):
    from ..functions.expressions import attack_family
    c = connections(spark, sf)
    return fin(c.groupBy(attack_family("attack_type").alias("family"))
               .agg(F.count(F.lit(1)).alias("n")))

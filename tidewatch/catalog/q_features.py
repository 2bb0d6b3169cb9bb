"""Imputation, fences, encoders, scaling, percentile flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encoders as EN
from ..operators import features as FE
from ..operators import impute as IM
from ..operators import outliers as OU
from ..operators import scaling as SC
from ..session import cut_lineage
from ..sources.tables import connections, events, load
from .base import CONN_CTE, fin, register, sql_fin, with_cte

NUM = ["duration", "src_bytes", "dst_bytes", "count", "srv_count", "serror_rate",
       "rerror_rate", "same_srv_rate", "diff_srv_rate"]


def _q(c):
    return f'"{c}"'


# --- median imputation (fitted on the whole table, applied to it) ---------------
_MED = ", ".join(f"quantile_cont({_q(c)}, 0.5) AS {_q(c)}" for c in NUM)
_FILL = ", ".join(f"coalesce(CAST(x.{_q(c)} AS DOUBLE), m.{_q(c)}) AS {_q(c)}" for c in NUM)


@register("impute_median", sql_fin(with_cte(CONN_CTE, f""",
med AS (SELECT {_MED} FROM connections)
SELECT x.conn_id, {_FILL} FROM connections x CROSS JOIN med m"""), NUM, ["conn_id"]))
def q_impute_median(spark, sf):
    c = connections(spark, sf, materialize=True)
    state = IM.fit_median(c, NUM)
    return fin(IM.transform(c, state).select("conn_id", *NUM))


# --- mode imputation (nulls injected where an order has no lines) --------------
_STR = ["protocol_type", "service", "flag"]
_STR_NULLED = ", ".join(
    f"CASE WHEN \"count\" IS NULL THEN NULL ELSE {c} END AS {c}" for c in _STR)
_MODES = "\n".join(
    f", m_{c} AS (SELECT {c} AS v FROM (SELECT {c}, count(*) AS n FROM sn "
    f"WHERE {c} IS NOT NULL GROUP BY {c}) t ORDER BY n DESC, v LIMIT 1)" for c in _STR)


@register("impute_mode", with_cte(CONN_CTE, f""",
sn AS (SELECT conn_id, {_STR_NULLED} FROM connections)
{_MODES}
SELECT CAST(conn_id AS BIGINT) AS conn_id,
       {", ".join(f"coalesce(sn.{c}, (SELECT v FROM m_{c})) AS {c}" for c in _STR)}
FROM sn"""))
def q_impute_mode(spark, sf):
    c = connections(spark, sf, materialize=True)
    sn = c.select("conn_id", *[F.when(F.col("count").isNull(), F.lit(None).cast("string"))
                               .otherwise(F.col(x)).alias(x) for x in _STR])
    state = IM.fit_mode(sn, _STR)
    return fin(IM.transform(sn, state))


# --- IQR fence, joint (one aggregate) on the skewed events.value ---------------
@register("fence_iqr", sql_fin("""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events)
SELECT event_id, value FROM events, q
WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)""",
    ["value"], ["event_id"]))
def q_fence_iqr(spark, sf):
    e = events(spark, sf, normalize_nan=False)   # bounds push into the scan
    state = OU.fit_iqr(e, ["value"], mode="joint")
    return fin(OU.apply(e, state).select("event_id", "value"))


# --- IQR fence, sequential over three columns (chained) -------------------------
_SEQ = ["duration", "src_bytes", "dst_bytes"]


def _seq_sql():
    parts, prev = [], "connections"
    for i, c in enumerate(_SEQ):
        parts.append(f", b{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, "
                     f"quantile_cont({c}, 0.75) AS q3 FROM {prev})")
        parts.append(f", s{i} AS (SELECT {prev}.* FROM {prev}, b{i} WHERE {c} >= q1 - 1.5 * (q3 - q1)"
                     f" AND {c} <= q3 + 1.5 * (q3 - q1))")
        prev = f"s{i}"
    return with_cte(CONN_CTE, "\n".join(parts) + f"\nSELECT conn_id, {', '.join(_SEQ)} FROM {prev}")


@register("fence_iqr_sequential", sql_fin(_seq_sql(), _SEQ, ["conn_id"]))
def q_fence_iqr_sequential(spark, sf):
    c = connections(spark, sf, materialize=True)
    state = OU.fit_iqr(c, _SEQ, mode="sequential")
    return fin(OU.apply(c, state).select("conn_id", *_SEQ))


@register("fence_zscore", sql_fin("""
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, value FROM events, s WHERE abs((value - m) / sd) < 3.0""",
    ["value"], ["event_id"]))
def q_fence_zscore(spark, sf):
    e = events(spark, sf, normalize_nan=False)   # bounds push into the scan
    state = OU.fit_zscore(e, ["value"], threshold=3.0)
    return fin(OU.apply(e, state).select("event_id", "value"))


# fitted on the first half of the month, applied as a flag to every event
@register("outlier_flag", sql_fin("""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
SELECT event_id, CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)
                      THEN 0 ELSE 1 END AS is_outlier
FROM events, q""", ints=["event_id", "is_outlier"]))
def q_outlier_flag(spark, sf):
    e = events(spark, sf)
    train = e.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    state = OU.fit_iqr(train, ["value"], mode="joint")
    return fin(OU.flag(e, state).select("event_id", "is_outlier"))


# --- one-hot (long form for checking: conn_id, feature, value) ------------------
_CAT = ["protocol_type", "service", "flag"]
_CATS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS category, dense_rank() OVER (ORDER BY {c}) AS r "
    f"FROM (SELECT DISTINCT {c} FROM connections WHERE {c} IS NOT NULL) d{i}"
    for i, c in enumerate(_CAT))
_VALS_SQL = " UNION ALL ".join(f"SELECT conn_id, '{c}' AS col, {c} AS v FROM connections"
                               for c in _CAT)


@register("encode_onehot", sql_fin(with_cte(CONN_CTE, f""",
cats AS ({_CATS_SQL}),
vals AS ({_VALS_SQL})
SELECT vals.conn_id, cats.col || '_' || cats.category AS feature,
       CASE WHEN vals.v IS NOT DISTINCT FROM cats.category THEN 1 ELSE 0 END AS value
FROM vals JOIN cats ON vals.col = cats.col AND cats.r > 1"""), ints=["conn_id", "value"]))
def q_encode_onehot(spark, sf):
    c = connections(spark, sf, materialize=True).select("conn_id", *_CAT)
    state = EN.fit_dictionary(c, _CAT)
    enc = EN.onehot_transform(c, state)
    feats = [x for x in enc.columns if x != "conn_id"]
    long = enc.unpivot("conn_id", feats, "feature", "value")
    return fin(long)


# --- one sparse vector a row, over every (part, supplier) endpoint there is -------------
@register("encode_onehot_sparse", sql_fin("""WITH
lines AS (SELECT l_orderkey, l_linenumber, l_partkey || '/' || l_suppkey AS endpoint, l_returnflag FROM lineitem),
ends AS (SELECT endpoint, row_number() OVER (ORDER BY endpoint) - 2 AS place
         FROM (SELECT DISTINCT endpoint FROM lines WHERE endpoint IS NOT NULL) e),
flags AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 2 AS place
          FROM (SELECT DISTINCT l_returnflag FROM lines WHERE l_returnflag IS NOT NULL) f),
sizes AS (SELECT (SELECT count(*) - 1 FROM ends) AS n_ends, (SELECT count(*) - 1 FROM flags) AS n_flags)
SELECT l_orderkey, l_linenumber, n_ends + n_flags AS size,
       concat_ws(',', CASE WHEN e.place >= 0 THEN e.place END,
                 CASE WHEN f.place >= 0 THEN f.place + n_ends END) AS indices
FROM lines LEFT JOIN ends e USING (endpoint) LEFT JOIN flags f USING (l_returnflag), sizes""",
    ints=["l_orderkey", "l_linenumber", "size"]))
def q_encode_onehot_sparse(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.concat_ws(
        "/", "l_partkey", "l_suppkey").alias("endpoint"))
    state = cut_lineage(EN.fit_dictionary(lines, ["endpoint", "l_returnflag"]), "dictionary")
    v = EN.onehot_vectors(lines, state)
    return fin(v.select("l_orderkey", "l_linenumber", F.col("onehot.size").alias("size"),
                        F.array_join(F.col("onehot.indices").cast("array<string>"), ",").alias("indices")))


# --- label encoding fitted on old connections, applied to all -----------------------
_FIT_WHERE = "ts < TIMESTAMP '1996-01-01 00:00:00'"
_LBL_CATS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS category, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} FROM connections WHERE {_FIT_WHERE} AND {c} IS NOT NULL) d{i}"
    for i, c in enumerate(_CAT))
_LBL_SEL = ", ".join(
    f"coalesce((SELECT code FROM cats WHERE col = '{c}' AND category = x.{c}), -1) AS {c}"
    for c in _CAT)


@register("encode_label", sql_fin(with_cte(CONN_CTE, f""",
cats AS ({_LBL_CATS})
SELECT conn_id, {_LBL_SEL} FROM connections x"""), ints=["conn_id"] + _CAT))
def q_encode_label(spark, sf):
    c = connections(spark, sf, materialize=True).select("conn_id", "ts", *_CAT)
    fit_on = c.filter(F.col("ts") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
    state = EN.fit_dictionary(fit_on, _CAT)
    return fin(EN.label_transform(c, state).drop("ts"))


# --- standard scaling (population std, zero variance -> 1) --------------------------
_SC_STATS = ", ".join(f"avg(CAST({_q(c)} AS DOUBLE)) AS m_{i}, stddev_pop(CAST({_q(c)} AS DOUBLE)) AS s_{i}"
                      for i, c in enumerate(NUM))
_SC_SEL = ", ".join(f"(CAST(x.{_q(c)} AS DOUBLE) - m_{i}) / CASE WHEN s_{i} IS NULL OR s_{i} = 0 "
                    f"THEN 1.0 ELSE s_{i} END AS {_q(c)}" for i, c in enumerate(NUM))


@register("scale_standard", sql_fin(with_cte(CONN_CTE, f""",
st AS (SELECT {_SC_STATS} FROM connections)
SELECT x.conn_id, {_SC_SEL} FROM connections x CROSS JOIN st"""), NUM, ["conn_id"]))
def q_scale_standard(spark, sf):
    c = connections(spark, sf, materialize=True)
    state = SC.fit(c, NUM)
    return fin(SC.transform(c, state).select("conn_id", *NUM))


# --- percentile flags on the first five numeric columns -----------------------------
_PF = NUM[:5]
_PF_Q = ", ".join(f"quantile_cont({_q(c)}, {p / 100}) AS {c}_p{p}"
                  for c in _PF for p in FE.PERCENTILES)
_PF_SEL = ", ".join(f"coalesce(CAST(x.{_q(c)} > q.{c}_p{p} AS INTEGER), 0) AS {c}_above_p{p}"
                    for c in _PF for p in FE.PERCENTILES)


@register("percentile_flags", sql_fin(with_cte(CONN_CTE, f""",
q AS (SELECT {_PF_Q} FROM connections)
SELECT x.conn_id, {_PF_SEL} FROM connections x CROSS JOIN q"""),
    ints=["conn_id"] + [f"{c}_above_p{p}" for c in _PF for p in FE.PERCENTILES]))
def q_percentile_flags(spark, sf):
    c = connections(spark, sf, materialize=True)
    state = FE.fit_percentile_flags(c, exclude=("conn_id", "is_attack"))
    return fin(FE.apply_percentile_flags(c, state).select(
        "conn_id", *[f"{x}_above_p{p}" for x in _PF for p in FE.PERCENTILES]))


# --- switchable outlier step ---------------------------------------------------------
@register("outlier_switch", sql_fin("SELECT event_id, value FROM events", ["value"], ["event_id"]))
def q_outlier_switch(spark, sf):
    e = events(spark, sf)
    return fin(OU.remove_outliers(e, "iqr", ["value"], enabled=False).select("event_id", "value"))


_ZSEQ = ["duration", "dst_bytes"]


def _zseq_sql():
    parts, prev = [], "connections"
    for i, c in enumerate(_ZSEQ):
        parts.append(f", z{i} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS sd FROM {prev})")
        parts.append(f", t{i} AS (SELECT {prev}.* FROM {prev}, z{i} WHERE abs(({c} - m) / sd) < 3.0)")
        prev = f"t{i}"
    return with_cte(CONN_CTE, "\n".join(parts) + f"\nSELECT conn_id, {', '.join(_ZSEQ)} FROM {prev}")


@register("fence_zscore_sequential", sql_fin(_zseq_sql(), _ZSEQ, ["conn_id"]))
def q_fence_zscore_sequential(spark, sf):
    c = connections(spark, sf, materialize=True)
    return fin(OU.remove_outliers(c, "zscore", _ZSEQ, mode="sequential", threshold=3.0)
               .select("conn_id", *_ZSEQ))

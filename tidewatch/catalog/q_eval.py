"""Rolling windows, splits / folds and evaluation operators with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import sampling as SA
from ..operators import windows as WI
from ..plans.scoring import eval_frame, rule_scored
from ..session import cut_lineage, scratch_path, scratch_scope
from ..sources import sinks as SK
from ..sources.tables import connections, events
from .base import CONN_CTE, ORACLE, SCORED_CTE, fin, register, sql_fin, with_cte


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


# --- rolling features -----------------------------------------------------------------
def _events_rolling(spark, sf, partition=True):
    e = events(spark, sf)
    w = WI.rolling_window_size(e.count())
    return WI.rolling(e, ["value"], w, ["ts", "event_id"],
                      partition_by=["user_id"] if partition else None, bucket_rows=2000)


_ROLL = """
SELECT event_id, value, m AS value_rolling_mean, s AS value_rolling_std,
       (value - m) / (s + 1e-8) AS value_zscore
FROM (SELECT event_id, value,
        avg(value) OVER w AS m, stddev_samp(value) OVER w AS s
      FROM events
      WINDOW w AS ({part} ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)) r"""


def _roll_sql(cols, partition=True):
    inner = _ROLL.format(part="PARTITION BY user_id" if partition else "")
    return sql_fin(f"SELECT event_id, {', '.join(cols)} FROM ({inner}) x", cols, ["event_id"])


@register("rolling_mean", _roll_sql(["value_rolling_mean"]))
def q_rolling_mean(spark, sf):
    return fin(_events_rolling(spark, sf).select("event_id", "value_rolling_mean"))


@register("rolling_std", _roll_sql(["value_rolling_std"]))
def q_rolling_std(spark, sf):
    return fin(_events_rolling(spark, sf).select("event_id", "value_rolling_std"))


@register("rolling_zscore", _roll_sql(["value_zscore"]))
def q_rolling_zscore(spark, sf):
    return fin(_events_rolling(spark, sf).select("event_id", "value_zscore"))


@register("rolling_global", _roll_sql(["value_rolling_mean", "value_rolling_std", "value_zscore"],
                                      partition=False))
def q_rolling_global(spark, sf):
    return fin(_events_rolling(spark, sf, partition=False).select(
        "event_id", "value_rolling_mean", "value_rolling_std", "value_zscore"))


_CONN_ROLL = ["src_bytes", "dst_bytes", "duration"]


@register("rolling_connections", sql_fin(with_cte(CONN_CTE, """
SELECT conn_id, """ + ", ".join(
    f"avg({c}) OVER w AS {c}_rolling_mean, stddev_samp({c}) OVER w AS {c}_rolling_std, "
    f"({c} - avg({c}) OVER w) / (stddev_samp({c}) OVER w + 1e-8) AS {c}_zscore" for c in _CONN_ROLL)
    + """
FROM connections WINDOW w AS (ORDER BY ts, conn_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""),
    [f"{c}_{s}" for c in _CONN_ROLL for s in ("rolling_mean", "rolling_std", "zscore")],
    ["conn_id"]))
def q_rolling_connections(spark, sf):
    c = connections(spark, sf)
    w = WI.rolling_window_size(c.count())
    r = WI.rolling(c, _CONN_ROLL, w, ["ts", "conn_id"], bucket_rows=2000)
    return fin(r.select("conn_id", *[f"{x}_{s}" for x in _CONN_ROLL
                                     for s in ("rolling_mean", "rolling_std", "zscore")]))


# --- split and folds ---------------------------------------------------------------------
_RANKED = """,
rk AS (SELECT conn_id, is_attack,
         row_number() OVER (PARTITION BY is_attack
                            ORDER BY md5(CAST(conn_id AS VARCHAR) || ':42'), conn_id) AS r,
         count(*) OVER (PARTITION BY is_attack) AS n
       FROM connections)"""


@register("split_stratified", sql_fin(with_cte(CONN_CTE, _RANKED + """
SELECT conn_id, is_attack, CASE WHEN r <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split
FROM rk"""), ints=["conn_id", "is_attack"]))
def q_split_stratified(spark, sf):
    c = cut_lineage(connections(spark, sf).select("conn_id", "is_attack"))      # read more than once
    return fin(SA.split_stratified(c, "is_attack", "conn_id", 0.8, 42))


@register("fold_stratified", sql_fin(with_cte(CONN_CTE, _RANKED + """
SELECT conn_id, is_attack, (r - 1) % 5 AS fold FROM rk"""), ints=["conn_id", "is_attack", "fold"]))
def q_fold_stratified(spark, sf):
    c = cut_lineage(connections(spark, sf).select("conn_id", "is_attack"))      # read more than once
    return fin(SA.fold_stratified(c, "is_attack", "conn_id", 5, 42))


@register("concat_parts", sql_fin(with_cte(CONN_CTE, _RANKED + """
SELECT CASE WHEN r <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split,
       is_attack, count(*) AS n
FROM rk GROUP BY ALL"""), ints=["is_attack", "n"]))
def q_concat_parts(spark, sf):
    c = cut_lineage(connections(spark, sf).select("conn_id", "is_attack"))      # read more than once
    s = SA.split_stratified(c, "is_attack", "conn_id", 0.8, 42)
    both = SA.concat_parts(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"))
    return fin(both.groupBy("split", "is_attack").agg(F.count(F.lit(1)).alias("n")))


# --- evaluation ----------------------------------------------------------------------------
def _ev(spark, sf, materialize=False):
    # multi-pass reports (counts + score table + curve sums) materialize the input once
    return eval_frame(rule_scored(spark, sf, materialize=materialize))


_CNT = """,
cnt AS (SELECT count(*) FILTER (WHERE is_attack = 0 AND prediction = 0) AS tn,
               count(*) FILTER (WHERE is_attack = 0 AND prediction = 1) AS fp,
               count(*) FILTER (WHERE is_attack = 1 AND prediction = 0) AS fn,
               count(*) FILTER (WHERE is_attack = 1 AND prediction = 1) AS tp,
               count(*) AS n FROM scored),
cls AS (
  SELECT '0' AS class, CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS pr,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS rc,
         tn + fp AS support, n FROM cnt
  UNION ALL
  SELECT '1', CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, tp + fn, n FROM cnt),
cls2 AS (SELECT class, pr AS precision, rc AS recall,
                CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1_score,
                support, n FROM cls)"""

_ST = """,
st AS (SELECT probability AS p, count(*) FILTER (WHERE is_attack = 1) AS pos,
              count(*) FILTER (WHERE is_attack <> 1) AS neg
       FROM scored WHERE probability IS NOT NULL GROUP BY probability),
cum AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp,
               sum(neg) OVER (ORDER BY p DESC) AS fp,
               sum(neg) OVER (ORDER BY p ASC) AS neg_le FROM st),
tot AS (SELECT sum(pos) AS "P", sum(neg) AS "N" FROM st),
auc AS (SELECT sum(pos * (neg_le - neg * 0.5)) / (CAST((SELECT "P" FROM tot) AS DOUBLE)
               * (SELECT "N" FROM tot)) AS auc FROM cum),
ap AS (SELECT sum(CAST(pos * tp AS DOUBLE) / (tp + fp)) / sum(pos) AS average_precision FROM cum)"""


@register("confusion_matrix", sql_fin(with_cte(SCORED_CTE, _CNT + """
SELECT 0 AS y_true, 0 AS y_pred, tn AS n FROM cnt UNION ALL SELECT 0, 1, fp FROM cnt
UNION ALL SELECT 1, 0, fn FROM cnt UNION ALL SELECT 1, 1, tp FROM cnt"""),
    ints=["y_true", "y_pred", "n"]))
def q_confusion_matrix(spark, sf):
    return fin(EV.confusion_matrix(_ev(spark, sf)))


@register("class_report", sql_fin(with_cte(SCORED_CTE, _CNT + """
SELECT class, precision, recall, f1_score, support FROM cls2
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM cls2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support)
FROM cls2"""), ["precision", "recall", "f1_score"], ["support"]))
def q_class_report(spark, sf):
    return fin(EV.class_report(_ev(spark, sf)))


@register("basic_metrics", sql_fin(with_cte(SCORED_CTE, _CNT + _ST + """
SELECT CAST((SELECT tp + tn FROM cnt) AS DOUBLE) / (SELECT n FROM cnt) AS accuracy,
       (SELECT sum(precision * support) / max(n) FROM cls2) AS precision,
       (SELECT sum(recall * support) / max(n) FROM cls2) AS recall,
       (SELECT sum(f1_score * support) / max(n) FROM cls2) AS f1_score,
       (SELECT auc FROM auc) AS auc,
       (SELECT average_precision FROM ap) AS average_precision"""),
    ["accuracy", "precision", "recall", "f1_score", "auc", "average_precision"]))
def q_basic_metrics(spark, sf):
    return fin(EV.basic_metrics(_ev(spark, sf, materialize=True)))


@register("roc_curve", sql_fin(with_cte(SCORED_CTE, _ST + """
SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT p, CAST(fp AS DOUBLE) / (SELECT "N" FROM tot), CAST(tp AS DOUBLE) / (SELECT "P" FROM tot)
FROM cum"""), ["threshold", "fpr", "tpr"]))
def q_roc_curve(spark, sf):
    return fin(EV.roc_curve(_ev(spark, sf, materialize=True)))


@register("auc_roc", sql_fin(with_cte(SCORED_CTE, _ST + "\nSELECT auc FROM auc"), ["auc"]))
def q_auc_roc(spark, sf):
    return fin(EV.auc_roc(_ev(spark, sf)))


@register("pr_curve", sql_fin(with_cte(SCORED_CTE, _ST + """
SELECT p AS threshold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END
         AS precision,
       CAST(tp AS DOUBLE) / (SELECT "P" FROM tot) AS recall
FROM cum
UNION ALL SELECT NULL, 1.0, 0.0"""), ["threshold", "precision", "recall"]))
def q_pr_curve(spark, sf):
    return fin(EV.pr_curve(_ev(spark, sf, materialize=True)))


@register("average_precision", sql_fin(with_cte(SCORED_CTE, _ST + """
SELECT average_precision FROM ap"""), ["average_precision"]))
def q_average_precision(spark, sf):
    return fin(EV.average_precision(_ev(spark, sf)))


_THR = " UNION ALL ".join(f"SELECT {_dbl(t)} AS t" for t in EV.SWEEP_THRESHOLDS)


@register("threshold_sweep", sql_fin(with_cte(SCORED_CTE, f""",
th AS ({_THR}),
c AS (SELECT t, count(*) FILTER (WHERE probability >= t AND is_attack = 1) AS tp,
             count(*) FILTER (WHERE probability >= t AND is_attack <> 1) AS fp,
             count(*) FILTER (WHERE probability < t AND is_attack = 1) AS fn,
             count(*) FILTER (WHERE probability < t AND is_attack <> 1) AS tn,
             count(*) AS n
      FROM th, scored WHERE probability IS NOT NULL GROUP BY t),
m AS (SELECT t AS threshold, CAST(tp + tn AS DOUBLE) / n AS accuracy,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall
      FROM c),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                     ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM m)
SELECT *, CASE WHEN row_number() OVER (ORDER BY f1_score DESC, threshold ASC) = 1 THEN 1 ELSE 0 END
          AS is_best
FROM f"""), ["threshold", "accuracy", "precision", "recall", "f1_score"], ["is_best"]))
def q_threshold_sweep(spark, sf):
    return fin(EV.threshold_sweep(_ev(spark, sf)))


def _bins_case(edges):
    parts = [f"WHEN probability < {_dbl(edges[0])} THEN NULL"]
    for i in range(len(edges) - 1):
        parts.append(f"WHEN probability < {_dbl(edges[i + 1])} THEN {i}")
    return "CASE " + " ".join(parts) + " ELSE NULL END"


_LABELS = " ".join(f"WHEN {i} THEN '{EV.BIN_EDGES[i]:.1f}-{EV.BIN_EDGES[i + 1]:.1f}'"
                   for i in range(len(EV.BIN_EDGES) - 1))


@register("confidence_bins", sql_fin(with_cte(SCORED_CTE, f""",
b AS (SELECT *, {_bins_case(EV.BIN_EDGES)} AS bin FROM scored WHERE probability IS NOT NULL),
g AS (SELECT bin, count(*) AS "count", avg(probability) AS avg_confidence,
             avg(CAST(is_attack AS DOUBLE)) AS accuracy FROM b WHERE bin IS NOT NULL GROUP BY bin)
SELECT bin, CASE bin {_LABELS} END AS bin_range, "count", avg_confidence, accuracy,
       abs(avg_confidence - accuracy) AS calibration_error FROM g"""),
    ["avg_confidence", "accuracy", "calibration_error"], ["bin", "count"]))
def q_confidence_bins(spark, sf):
    return fin(EV.confidence_bins(_ev(spark, sf)))


_CAL_BIN = " + ".join(f"CAST(probability > {_dbl(e)} AS INTEGER)"
                      for e in EV.CALIBRATION_EDGES[1:-1])
_CAL = f""",
cb AS (SELECT ({_CAL_BIN}) AS bin, probability, is_attack FROM scored WHERE probability IS NOT NULL),
cal AS (SELECT bin, count(*) AS "count", avg(CAST(is_attack AS DOUBLE)) AS prob_true,
               avg(probability) AS prob_pred FROM cb GROUP BY bin)"""


@register("calibration", sql_fin(with_cte(SCORED_CTE, _CAL + "\nSELECT * FROM cal"),
                                 ["prob_true", "prob_pred"], ["bin", "count"]))
def q_calibration(spark, sf):
    return fin(EV.calibration(_ev(spark, sf)))


@register("calibration_error", sql_fin(with_cte(SCORED_CTE, _CAL + """
SELECT avg(abs(prob_pred - prob_true)) AS calibration_error,
       sum(abs(prob_pred - prob_true) * "count") / sum("count") AS weighted_calibration_error,
       count(*) AS bins FROM cal"""), ["calibration_error", "weighted_calibration_error"], ["bins"]))
def q_calibration_error(spark, sf):
    return fin(EV.calibration_error(_ev(spark, sf)))


# --- the whole report ------------------------------------------------------------------------
_REPORT_VALUES = {
    "basic_metrics": ["accuracy", "precision", "recall", "f1_score", "auc", "average_precision"],
    "class_report": ["precision", "recall", "f1_score", "support"], "confusion_matrix": ["n"],
    "roc_curve": ["fpr", "tpr"], "pr_curve": ["precision", "recall"],
    "threshold_sweep": ["accuracy", "precision", "recall", "f1_score", "is_best"],
    "confidence_bins": ["count", "avg_confidence", "accuracy", "calibration_error"],
    "calibration": ["count", "prob_true", "prob_pred"],
    "calibration_error": ["calibration_error", "weighted_calibration_error", "bins"]}


def _report_sql() -> str:
    """The twins of the parts, one row a value."""
    parts = ",\n".join(f"part_{p} AS ({ORACLE[p]})" for p in _REPORT_VALUES)
    rows = []
    for p, values in _REPORT_VALUES.items():
        keys = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in EV.REPORT_KEYS.get(p, [])) or "CAST(NULL AS VARCHAR)"
        at = "threshold" if p in EV.REPORT_AT else "CAST(NULL AS DOUBLE)"
        rows += [f"SELECT '{p}' AS section, {keys} AS key, {at} AS threshold, '{v}' AS metric, "
                 f'CAST("{v}" AS DOUBLE) AS value FROM part_{p}' for v in values]
    return f"WITH {parts}\n" + "\nUNION ALL ".join(rows)


@register("evaluate_all", _report_sql())
def q_evaluate_all(spark, sf):
    return fin(EV.report_long(EV.evaluate_all(_ev(spark, sf))))


@register("sink_report_evaluation", _report_sql())
def q_sink_report_evaluation(spark, sf):
    # the report as JSON lines, read back
    path = scratch_path(spark, "report")
    with scratch_scope(spark):
        SK.write_report(EV.report_long(EV.evaluate_all(_ev(spark, sf))), path)
    return fin(SK.read_table(spark, path, "json", EV.REPORT_DDL))

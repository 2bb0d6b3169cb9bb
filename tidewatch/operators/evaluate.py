"""Evaluation of (y, pred, p) tables.

Counting metrics come from one aggregate. Curve metrics first collapse the
table to one row per distinct score (map-side combined), then take running
sums over the scores with the range-partitioned prefix sums of
operators/windows — never a single-partition window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .windows import prefix_sums


# The sweep thresholds and bin edges of the evaluation report,
# exactly as numpy.arange(0.1, 1.0, 0.05), numpy.arange(0, 1.1, 0.1) and
# numpy.linspace(0, 1, 11) produce them. They are not round numbers, and a
# score exactly on an edge must land where it lands there.
SWEEP_THRESHOLDS = [
    0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006,
    0.30000000000000004, 0.3500000000000001, 0.40000000000000013, 0.45000000000000007,
    0.5000000000000001, 0.5500000000000002, 0.6000000000000002, 0.6500000000000001,
    0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002,
    0.9000000000000002, 0.9500000000000003,
]
BIN_EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001,
             0.7000000000000001, 0.8, 0.9, 1.0]
CALIBRATION_EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001,
                     0.7000000000000001, 0.8, 0.9, 1.0]


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 where b == 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """One row: tn, fp, fn, tp, n."""
    Y, P = F.col(y), F.col(pred)
    return df.agg(F.count_if((Y == 0) & (P == 0)).alias("tn"),
                  F.count_if((Y == 0) & (P == 1)).alias("fp"),
                  F.count_if((Y == 1) & (P == 0)).alias("fn"),
                  F.count_if((Y == 1) & (P == 1)).alias("tp"),
                  F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Complete 2x2 grid (zero-filled): y_true, y_pred, n."""
    c = counts(df, y, pred)
    cells = F.array(*[F.struct(F.lit(a).alias("y_true"), F.lit(b).alias("y_pred"),
                               F.col(k).alias("n"))
                      for a, b, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.explode(cells).alias("c")).select("c.*")


def _class_structs():
    """Per class precision / recall / f1 / support from the counts row."""
    rows = []
    for cls, tp, fp, fn in ((0, "tn", "fn", "fp"), (1, "tp", "fp", "fn")):
        prec = _div0(F.col(tp), F.col(tp) + F.col(fp))
        rec = _div0(F.col(tp), F.col(tp) + F.col(fn))
        f1 = _div0(2 * prec * rec, prec + rec)
        rows.append((str(cls), prec, rec, f1, F.col(tp) + F.col(fn)))
    return rows


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Rows for class 0, 1, 'macro avg', 'weighted avg' — all from one counts
    row (one pass over the data)."""
    (c0, p0, r0, f0, s0), (c1, p1, r1, f1, s1) = _class_structs()
    n = (s0 + s1).cast("double")
    w = lambda a, b: _div0(a * s0 + b * s1, n)
    rows = [(c0, p0, r0, f0, s0), (c1, p1, r1, f1, s1),
            ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
            ("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), s0 + s1)]
    items = F.array(*[F.struct(F.lit(k).alias("class"), a.alias("precision"), b.alias("recall"),
                               c.alias("f1_score"), d.cast("long").alias("support"))
                      for k, a, b, c, d in rows])
    return counts(df, y, pred).select(F.explode(items).alias("r")).select("r.*")


def score_table(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score: p, pos, neg."""
    return df.filter(F.col(p).isNotNull()).groupBy(F.col(p).alias("p")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


def _cumulative_desc(st: DataFrame) -> DataFrame:
    """tp / fp at each threshold p (scores >= p)."""
    return prefix_sums(st, [F.col("p").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})


def _totals(st: DataFrame) -> tuple[int, int]:
    """(P, N): one tiny aggregate row, used as literals."""
    r = st.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"),
               F.coalesce(F.sum("neg"), F.lit(0)).alias("N")).first()
    return int(r["P"]), int(r["N"])


def roc_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """threshold, fpr, tpr for every distinct score (descending) plus the
    starting point (inf, 0, 0). All points are kept."""
    st = score_table(df, y, p)
    P, N = _totals(st)
    cum = _cumulative_desc(st)
    pts = cum.select(F.col("p").alias("threshold"), _div0(F.col("fp"), F.lit(N)).alias("fpr"),
                     _div0(F.col("tp"), F.lit(P)).alias("tpr"))
    start = pts.limit(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def auc_value(df: DataFrame, y: str = "y", p: str = "p") -> float | None:
    return auc_roc(df, y, p).first()["auc"]


def _areas(cum: DataFrame) -> list:
    """auc and average precision from ONE aggregate over the descending
    cumulative table. With fp = negatives scoring >= p, the negatives scoring
    <= p are N - fp + neg, so sum pos * (neg_le - neg / 2) = sum pos * (neg / 2
    - fp) + P * N; both numerators are sums of (half-)integers, exact."""
    a = F.sum(F.col("pos") * (F.col("neg") * 0.5 - F.col("fp")))
    P, N = F.sum("pos"), F.sum("neg")
    auc = F.try_divide(a + P.cast("double") * N, P.cast("double") * N)
    ap = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / P
    return [auc.alias("auc"), ap.alias("average_precision")]


def auc_roc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Exact area (ties count one half): sum pos * (neg below + neg / 2) / (P N)."""
    cum = _cumulative_desc(score_table(df, y, p))
    return cum.agg(*_areas(cum)).select("auc")


def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """threshold, precision, recall per distinct score plus the final (1, 0)."""
    st = score_table(df, y, p)
    P, _ = _totals(st)
    cum = _cumulative_desc(st)
    recall = F.lit(1.0) if P == 0 else F.col("tp") / F.lit(float(P))
    pts = cum.select(F.col("p").alias("threshold"),
                     _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     recall.alias("recall"))
    end = pts.limit(1).select(F.lit(None).cast("double").alias("threshold"),
                              F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Step-wise sum of (recall increase) * precision over descending scores."""
    cum = _cumulative_desc(score_table(df, y, p))
    return cum.agg(*_areas(cum)).select("average_precision")


def basic_metrics(df: DataFrame, y: str = "y", pred: str = "pred", p: str = "p") -> DataFrame:
    """accuracy, support-weighted precision / recall / f1, auc, average precision.
    Counting metrics in one aggregate; both curve areas from one running-sum
    table and one aggregate."""
    areas = _cumulative_desc(score_table(df, y, p))
    r = areas.agg(*_areas(areas)).first()
    auc, ap = r["auc"], r["average_precision"]
    c = counts(df, y, pred)
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp       # rows with a label and a prediction, as in class_report
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    f0, f1 = _div0(2 * p0 * r0, p0 + r0), _div0(2 * p1 * r1, p1 + r1)
    s0, s1 = (tn + fp).cast("double"), (tp + fn).cast("double")
    wavg = lambda a, b: _div0(a * s0 + b * s1, n)
    return c.select(_div0(tp + tn, n).alias("accuracy"), wavg(p0, p1).alias("precision"),
                    wavg(r0, r1).alias("recall"), wavg(f0, f1).alias("f1_score"),
                    F.lit(auc).cast("double").alias("auc"),
                    F.lit(ap).cast("double").alias("average_precision"))


def threshold_sweep(df: DataFrame, y: str = "y", p: str = "p",
                    thresholds=SWEEP_THRESHOLDS) -> DataFrame:
    """Metrics at each threshold (pred = p >= t). The data is first collapsed
    to one row per distinct score (a two-aggregate group-by), then one
    aggregate over that score table sums positives / negatives at or above
    every threshold; ``is_best`` marks the max F1 (lowest threshold wins)."""
    st = score_table(df, y, p)
    aggs = [F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")]
    for i, t in enumerate(thresholds):
        hit = F.col("p") >= F.lit(t)
        aggs += [F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias(f"tp{i}"),
                 F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias(f"fp{i}")]
    row = st.agg(*aggs).select(
        "*", (F.col("n_pos") + F.col("n_neg")).alias("n"),
        *[(F.col("n_pos") - F.col(f"tp{i}")).alias(f"fn{i}") for i in range(len(thresholds))],
        *[(F.col("n_neg") - F.col(f"fp{i}")).alias(f"tn{i}") for i in range(len(thresholds))])
    items = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                               F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"),
                               F.col(f"tn{i}").alias("tn"))
                      for i, t in enumerate(thresholds)])
    long = row.select(F.explode(items).alias("s"), "n").select("s.*", "n")
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    out = long.select("threshold", _div0(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
                      prec.alias("precision"), rec.alias("recall"))
    out = out.withColumn("f1_score", _div0(2 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall")))
    w = Window.orderBy(F.col("f1_score").desc(), F.col("threshold").asc())  # 18 rows
    return out.withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))


def _bin_index(p: Column, edges: list[float], right_closed: bool) -> Column:
    """Bin number from literal edges. Left-closed [a, b): values outside
    [edges[0], edges[-1]) get NULL. Right-closed (searchsorted on the inner
    edges): number of inner edges strictly below p."""
    if right_closed:
        idx = F.lit(0)
        for e in edges[1:-1]:
            idx = idx + (p > F.lit(e)).cast("int")
        return idx
    e = F.when(p < F.lit(edges[0]), F.lit(None).cast("int"))
    for i in range(len(edges) - 1):
        e = e.when(p < F.lit(edges[i + 1]), F.lit(i))
    return e.otherwise(F.lit(None).cast("int"))


def confidence_bins(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Ten bins [a, b) on the reference edges; p = 1.0 falls in none; empty
    bins are omitted."""
    labels = F.create_map(*[x for i in range(len(BIN_EDGES) - 1) for x in (
        F.lit(i), F.lit(f"{BIN_EDGES[i]:.1f}-{BIN_EDGES[i + 1]:.1f}"))])
    b = df.filter(F.col(p).isNotNull()).withColumn("bin", _bin_index(F.col(p), BIN_EDGES, False))
    g = b.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"), F.avg(p).alias("avg_confidence"),
        F.avg(F.col(y).cast("double")).alias("accuracy"))
    return g.select("bin", F.try_element_at(labels, F.col("bin")).alias("bin_range"), "count",
                    "avg_confidence", "accuracy",
                    F.abs(F.col("avg_confidence") - F.col("accuracy")).alias("calibration_error"))


def calibration(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Uniform bins, right-closed (first bin includes 0): count, prob_true,
    prob_pred per non-empty bin."""
    edges = CALIBRATION_EDGES if n_bins == 10 else [i / n_bins for i in range(n_bins + 1)]
    b = df.filter(F.col(p).isNotNull()).withColumn("bin", _bin_index(F.col(p), edges, True))
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("count"),
                                F.avg(F.col(y).cast("double")).alias("prob_true"),
                                F.avg(p).alias("prob_pred"))


def calibration_error(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Unweighted mean |prob_pred - prob_true| over non-empty bins (the
    reference's figure) and the count-weighted ECE."""
    c = calibration(df, y, p)
    gap = F.abs(F.col("prob_pred") - F.col("prob_true"))
    return c.agg(F.avg(gap).alias("calibration_error"),
                 (F.sum(gap * F.col("count")) / F.sum("count")).alias("weighted_calibration_error"),
                 F.count(F.lit(1)).alias("bins"))


REPORT_DDL = "section string, key string, threshold double, metric string, value double"
# What names a row of a part beside its threshold; all else is a value.
REPORT_KEYS = {"class_report": ["class"], "confusion_matrix": ["y_true", "y_pred"],
               "confidence_bins": ["bin", "bin_range"], "calibration": ["bin"]}
REPORT_AT = ("roc_curve", "pr_curve", "threshold_sweep")


def evaluate_all(df: DataFrame, y: str = "y", pred: str = "pred", p: str = "p") -> dict:
    """Every report part, each a DataFrame, from one saved (y, pred, p) table (a
    scope around removes it; the parts read it when they run)."""
    base = cut_lineage(df.select(F.col(y).alias("y"), F.col(pred).alias("pred"), F.col(p).alias("p")), "evaluated")
    return {
        "basic_metrics": basic_metrics(base),
        "class_report": class_report(base),
        "confusion_matrix": confusion_matrix(base),
        "roc_curve": roc_curve(base),
        "pr_curve": pr_curve(base),
        "threshold_sweep": threshold_sweep(base),
        "confidence_bins": confidence_bins(base),
        "calibration": calibration(base),
        "calibration_error": calibration_error(base),
    }


def report_long(parts: dict) -> DataFrame:
    """Flatten report parts into (section, key, threshold, metric, value) rows: the
    key names a class, cell or bin, the threshold (a number) a point of a curve or
    sweep; both are null in parts of one row."""
    out = None
    for name, d in parts.items():
        keys = REPORT_KEYS.get(name, [])
        at = ["threshold"] if name in REPORT_AT else []
        vals = [c for c in d.columns if c not in keys + at]
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]) \
            if keys else F.lit(None).cast("string")
        threshold = F.col("threshold") if at else F.lit(None).cast("double")
        cols = d.select(key.alias("key"), threshold.alias("threshold"),
                        *[F.col(v).cast("double").alias(v) for v in vals])
        long = cols.unpivot(["key", "threshold"], vals, "metric", "value").withColumn("section", F.lit(name))
        long = long.select("section", "key", "threshold", "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out

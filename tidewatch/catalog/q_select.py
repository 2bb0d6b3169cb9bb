"""Feature scoring and selection with SQL twins."""

from __future__ import annotations

from ..operators import selection as SE
from ..sources.tables import connections
from .base import CONN_CTE, fin, register, sql_fin, with_cte

FEATS = ["duration", "src_bytes", "dst_bytes", "count", "srv_count", "serror_rate", "rerror_rate",
         "same_srv_rate", "diff_srv_rate"]


def q(c):
    return f'"{c}"'


_PER = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, is_attack AS y, count({q(c)}) AS n, avg(CAST({q(c)} AS DOUBLE)) AS m, "
    f"var_pop(CAST({q(c)} AS DOUBLE)) AS v FROM connections WHERE is_attack IS NOT NULL "
    f"GROUP BY is_attack" for c in FEATS)

ANOVA_SQL = f""",
per AS (SELECT * FROM ({_PER}) u WHERE n > 0),
g AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS gm FROM per GROUP BY feature),
f AS (SELECT g.feature,
             CASE WHEN g.k > 1 AND sum(per.n * per.v) <> 0 THEN
               (sum(per.n * (per.m - g.gm) * (per.m - g.gm)) / (g.k - 1))
               / (sum(per.n * per.v) / (g.n - g.k)) END AS score
      FROM per JOIN g ON per.feature = g.feature GROUP BY g.feature, g.k, g.n)"""


def _ranked(k):
    key = "round(score * 1e6)"
    return (f"SELECT feature, score, row_number() OVER (ORDER BY {key} DESC NULLS LAST, feature) "
            f"AS rank, CASE WHEN row_number() OVER (ORDER BY {key} DESC NULLS LAST, feature) <= {k} "
            f"THEN 1 ELSE 0 END AS selected FROM f")


@register("select_kbest_anova", sql_fin(with_cte(CONN_CTE, ANOVA_SQL + "\n" + _ranked(5)),
                                        ["score"], ["rank", "selected"]))
def q_select_kbest_anova(spark, sf):
    c = connections(spark, sf)
    return fin(SE.rank_scores(SE.anova_f(c, FEATS, "is_attack"), 5))


@register("feature_scores", sql_fin(with_cte(CONN_CTE, ANOVA_SQL + """
SELECT feature, score FROM f ORDER BY round(score * 1e6) DESC NULLS LAST, feature LIMIT 20"""), ["score"]))
def q_feature_scores(spark, sf):
    c = connections(spark, sf)
    return fin(SE.feature_scores(SE.anova_f(c, FEATS, "is_attack"), 20))


_EDGES = ", ".join(f"quantile_cont({q(c)}, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS e_{c}"
                   for c in FEATS)


def _mi_sql():
    parts = []
    for c in FEATS:
        # bins = number of distinct decile edges strictly below x
        b = (f"coalesce(CAST((SELECT count(*) FROM (SELECT DISTINCT unnest(e_{c}) AS e) z "
             f"WHERE z.e < x.{q(c)}) AS DOUBLE) + CASE WHEN x.{q(c)} IS NULL THEN NULL ELSE 0 END, "
             f"'nan'::DOUBLE)")
        parts.append(f"SELECT '{c}' AS feature, {b} AS xb, is_attack AS y FROM connections x, edges "
                     f"WHERE is_attack IS NOT NULL")
    return f""",
edges AS (SELECT {_EDGES} FROM connections),
lb AS ({' UNION ALL '.join(parts)}),
c AS (SELECT feature, xb, y, count(*) AS nxy FROM lb GROUP BY ALL),
nx AS (SELECT feature, xb, sum(nxy) AS nx FROM c GROUP BY ALL),
ny AS (SELECT feature, y, sum(nxy) AS ny FROM c GROUP BY ALL),
nn AS (SELECT feature, sum(nxy) AS n FROM c GROUP BY ALL),
f AS (SELECT c.feature,
             sum((CAST(nxy AS DOUBLE) / n) * ln((CAST(nxy AS DOUBLE) * n) / (CAST(nx AS DOUBLE) * ny)))
             AS score
      FROM c JOIN nx USING (feature, xb) JOIN ny USING (feature, y) JOIN nn USING (feature)
      GROUP BY c.feature)"""


@register("select_kbest_mi", sql_fin(with_cte(CONN_CTE, _mi_sql() + "\n" + _ranked(5)),
                                     ["score"], ["rank", "selected"]))
def q_select_kbest_mi(spark, sf):
    c = connections(spark, sf, materialize=True)
    return fin(SE.rank_scores(SE.mutual_info(c, FEATS, "is_attack"), 5))


# --- drift (PSI) and correlation ---------------------------------------------------------
from ..operators import drift as DR  # noqa: E402

_PSI_COLS = ["duration", "src_bytes", "dst_bytes", "serror_rate", "same_srv_rate"]
_CUT = "1998-01-01 00:00:00"


def _psi_sql():
    edges = ", ".join(f"list_distinct(quantile_cont({q(c)}, [{', '.join(str(i / 10) for i in range(1, 10))}])) AS e_{c}"
                      for c in _PSI_COLS)
    parts = []
    for c in _PSI_COLS:
        b = (f"(SELECT count(*) FROM (SELECT unnest(e_{c}) AS e) z WHERE z.e < x.{q(c)})")
        for side, cond in (("ref", f"ts < TIMESTAMP '{_CUT}'"), ("cur", f"ts >= TIMESTAMP '{_CUT}'")):
            parts.append(f"SELECT '{c}' AS col, '{side}' AS side, {b} AS bucket FROM connections x, edges "
                         f"WHERE {cond} AND x.{q(c)} IS NOT NULL")
    return f""",
edges AS (SELECT {edges} FROM connections WHERE ts < TIMESTAMP '{_CUT}'),
lb AS ({' UNION ALL '.join(parts)}),
c AS (SELECT col, bucket, count(*) FILTER (WHERE side = 'ref') AS n_ref,
             count(*) FILTER (WHERE side = 'cur') AS n_cur FROM lb GROUP BY ALL),
t AS (SELECT col, sum(n_ref) AS t_ref, sum(n_cur) AS t_cur FROM c GROUP BY col),
p AS (SELECT c.col, greatest(CAST(n_ref AS DOUBLE) / t_ref, 1e-4) AS pe,
             greatest(CAST(n_cur AS DOUBLE) / t_cur, 1e-4) AS pa FROM c JOIN t USING (col)),
s AS (SELECT col AS "column", sum((pa - pe) * ln(pa / pe)) AS psi FROM p GROUP BY col)
SELECT "column", psi, CASE WHEN psi > 0.25 THEN 'drift' WHEN psi > 0.1 THEN 'warning'
                          ELSE 'metric' END AS severity FROM s"""


@register("drift_psi", sql_fin(with_cte(CONN_CTE, _psi_sql()), ["psi"]))
def q_drift_psi(spark, sf):
    from pyspark.sql import functions as F
    c = connections(spark, sf, materialize=True)
    cut = F.lit(_CUT).cast("timestamp_ntz")
    return fin(DR.psi(c.filter(F.col("ts") < cut), c.filter(F.col("ts") >= cut), _PSI_COLS))


_CORR_COLS = ["duration", "src_bytes", "dst_bytes", "count", "srv_count", "serror_rate",
              "rerror_rate", "same_srv_rate"]


def _corr_sql():
    comp = " AND ".join(f"{q(c)} IS NOT NULL" for c in _CORR_COLS)
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, CAST(1.0 AS DOUBLE) AS corr" if a == b else
             f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({q(a)} AS DOUBLE), CAST({q(b)} AS DOUBLE))"
             f" AS corr FROM cc" for a in _CORR_COLS for b in _CORR_COLS]
    return f""",
cc AS (SELECT * FROM connections WHERE {comp})
{' UNION ALL '.join(parts)}"""


@register("correlation", sql_fin(with_cte(CONN_CTE, _corr_sql()), ["corr"]))
def q_correlation(spark, sf):
    return fin(DR.correlation(connections(spark, sf), _CORR_COLS))

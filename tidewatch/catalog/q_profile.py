"""Profiling and validation checks (long-form check tables) with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import rule_label, rule_score
from ..operators import profile as P
from ..operators.sampling import concat_parts
from ..sources.tables import connections
from .base import CONN_CTE, fin, register, with_cte

ALL = ["conn_id", "ts", "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
       "count", "srv_count", "serror_rate", "rerror_rate", "same_srv_rate", "diff_srv_rate",
       "attack_type", "is_attack"]
NUMERIC = ["conn_id", "duration", "src_bytes", "dst_bytes", "count", "srv_count", "serror_rate",
           "rerror_rate", "same_srv_rate", "diff_srv_rate", "is_attack"]
DOUBLES = ["duration", "src_bytes", "dst_bytes", "serror_rate", "rerror_rate", "same_srv_rate",
           "diff_srv_rate"]
STRINGS = ["protocol_type", "service", "flag", "attack_type"]
TYPES = {"conn_id": "bigint", "ts": "timestamp_ntz", "count": "int", "srv_count": "int",
         "is_attack": "int", **{c: "double" for c in DOUBLES}, **{c: "string" for c in STRINGS}}


def q(c):
    return f'"{c}"'


def m(check, column, metric, value, severity="'metric'", text="NULL", src="src"):
    return (f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{metric}' AS metric, "
            f"CAST({value} AS DOUBLE) AS value, CAST({text} AS VARCHAR) AS text, "
            f"{severity} AS severity FROM {src}")


def sev(cond, level):
    return f"CASE WHEN {cond} THEN '{level}' ELSE 'metric' END"


def lit_row(check, column, metric, value, text, severity):
    v = "NULL" if value is None else str(float(value))
    t = "NULL" if text is None else f"'{text}'"
    return (f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{metric}' AS metric, "
            f"CAST({v} AS DOUBLE) AS value, CAST({t} AS VARCHAR) AS text, '{severity}' AS severity")


def r6(x):
    from .base import r6 as _r6
    return _r6(x)


def wrap(union_sql):
    return (f"SELECT \"check\", \"column\", metric, {r6('value')} AS value, text, severity "
            f"FROM ({union_sql}) AS u")


def union(parts):
    return "\nUNION ALL ".join(parts)


def src_cte(body_sql):
    return with_cte(CONN_CTE, ",\nsrc AS (SELECT * FROM connections)\n" + body_sql)


# --- SQL builders mirroring the operators --------------------------------------------

def null_sql(cols, check="null_profile"):
    parts = []
    for c in cols:
        nc = f"(count(*) - count({q(c)}))"
        pct = f"(round(CAST({nc} AS DOUBLE) * 100.0 / count(*) * 100.0) / 100.0)"
        parts.append(m(check, c, "null_count", nc))
        parts.append(m(check, c, "null_pct", pct,
                       f"CASE WHEN {pct} > 90 THEN 'error' WHEN {pct} > 50 THEN 'warning' ELSE 'metric' END"))
    tot = " + ".join(f"(count(*) - count({q(c)}))" for c in cols)
    aff = " + ".join(f"CAST((count(*) - count({q(c)})) > 0 AS INTEGER)" for c in cols)
    mx = "greatest(" + ", ".join(
        f"round(CAST(count(*) - count({q(c)}) AS DOUBLE) * 100.0 / count(*) * 100.0) / 100.0"
        for c in cols) + ")"
    parts += [m(check, "*", "total_missing", tot), m(check, "*", "columns_with_missing", aff),
              m(check, "*", "max_missing_percentage", mx)]
    return parts


def empty_sql(cols, check="empty_columns"):
    return [m(check, c, "non_null_count", f"count({q(c)})",
              sev(f"count({q(c)}) = 0 AND count(*) > 0", "error")) for c in cols]


def constant_sql(cols, check="constant_columns"):
    out = []
    for c in cols:
        cond = f"(count({q(c)}) > 0 AND min({q(c)}) = max({q(c)}))"
        out.append(m(check, c, "is_constant", f"CAST({cond} AS INTEGER)", sev(cond, "warning")))
    return out


def infinite_sql(cols, check="infinite_values"):
    return [m(check, c, "infinite_count", f"count(*) FILTER (WHERE abs({q(c)}) = 'inf'::DOUBLE)",
              sev(f"count(*) FILTER (WHERE abs({q(c)}) = 'inf'::DOUBLE) > 0", "error"))
            for c in cols]


def schema_sql(cols, types, expected):
    parts = [m("schema", "*", "num_rows", "count(*)", sev("count(*) = 0", "error")),
             lit_row("schema", "*", "num_columns", len(cols), None, "metric")]
    counts = {}
    for c in cols:
        counts[types[c]] = counts.get(types[c], 0) + 1
    for t, k in sorted(counts.items()):
        parts.append(lit_row("schema", "*", "dtype_count", k, t, "metric"))
    for c in sorted(set(expected) - set(cols)):
        parts.append(lit_row("schema", c, "missing_column", 1, None, "error"))
    for c in sorted(set(cols) - set(expected)):
        parts.append(lit_row("schema", c, "extra_column", 1, None, "warning"))
    parts += empty_sql(cols, "schema") + constant_sql([c for c in cols if c in NUMERIC], "schema")
    return parts


def distribution_sql(cols, check="distribution"):
    out = []
    for c in cols:
        x = f"CAST({q(c)} AS DOUBLE)"
        has = f"count({x}) > 0"
        out += [
            m(check, c, "mean", f"avg({x})"),
            m(check, c, "std", f"stddev_samp({x})"),
            m(check, c, "skewness", f"skewness({x})", sev(f"{has} AND abs(skewness({x})) > 3", "warning")),
            m(check, c, "kurtosis", f"kurtosis({x})", sev(f"{has} AND abs(kurtosis({x})) > 10", "warning")),
            m(check, c, "min", f"min({x})",
              sev(f"{has} AND min({x}) < 0", "error") if c in P.NON_NEGATIVE else "'metric'"),
            m(check, c, "max", f"max({x})"),
            m(check, c, "q25", f"quantile_cont({x}, 0.25)"),
            m(check, c, "q50", f"quantile_cont({x}, 0.5)"),
            m(check, c, "q75", f"quantile_cont({x}, 0.75)"),
        ]
    return out


def categorical_sql(cols, check="categorical"):
    longc = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({q(c)} AS VARCHAR) AS v FROM src WHERE {q(c)} IS NOT NULL"
        for c in cols)
    counts = f"(SELECT col, v, count(*) AS n FROM ({longc}) l GROUP BY col, v)"
    per = (f"(SELECT col, count(*) AS uc, sum(n) AS nn, count(*) FILTER (WHERE n = 1) AS rare "
           f"FROM {counts} c GROUP BY col)")
    mode = (f"(SELECT col, v, n FROM (SELECT col, v, n, row_number() OVER (PARTITION BY col "
            f"ORDER BY n DESC, v) AS r FROM {counts} c) z WHERE r = 1)")
    top = (f"(SELECT col, v, n FROM (SELECT col, v, n, row_number() OVER (PARTITION BY col "
           f"ORDER BY n DESC, v) AS r FROM {counts} c) z WHERE r <= 10)")
    return [
        f"SELECT '{check}' AS \"check\", col AS \"column\", 'unique_count' AS metric, "
        f"CAST(uc AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text, "
        f"CASE WHEN uc > nn * 0.8 THEN 'warning' ELSE 'metric' END AS severity FROM {per} p1",
        f"SELECT '{check}', col, 'most_frequent', CAST(n AS DOUBLE), v, 'metric' FROM {mode} p2",
        f"SELECT '{check}', col, 'rare_categories', CAST(rare AS DOUBLE), CAST(NULL AS VARCHAR), "
        f"CASE WHEN rare > uc * 0.5 THEN 'warning' ELSE 'metric' END FROM {per} p3",
        f"SELECT '{check}', col, 'top_value', CAST(n AS DOUBLE), v, 'metric' FROM {top} p4",
    ]


def target_sql(t="is_attack"):
    cnt = f"(SELECT {q(t)} AS v, count(*) AS k FROM src GROUP BY {q(t)})"
    uniq = "count(*) FILTER (WHERE v IS NOT NULL)"
    miss = "coalesce(sum(k) FILTER (WHERE v IS NULL), 0)"
    kmin = "min(k) FILTER (WHERE v IS NOT NULL)"
    kmax = "max(k) FILTER (WHERE v IS NOT NULL)"
    tot = "sum(k) FILTER (WHERE v IS NOT NULL)"
    minority = f"CASE WHEN {uniq} = 2 THEN CAST({kmin} AS DOUBLE) / {tot} END"
    return [
        m("target", t, "unique_values", uniq, sev(f"{uniq} <> 2", "warning"), src=cnt + " c1"),
        m("target", t, "missing_values", miss, sev(f"{miss} > 0", "error"), src=cnt + " c2"),
        m("target", t, "minority_class_ratio", minority, sev(f"{minority} < 0.1", "warning"),
          f"CASE WHEN {minority} < 0.05 THEN 'severe' WHEN {minority} < 0.1 THEN 'imbalanced' END", src=cnt + " c3"),
        m("target", t, "imbalance_ratio", f"CASE WHEN {uniq} = 2 THEN CAST({kmax} AS DOUBLE) / {kmin} END",
          src=cnt + " c4"),
        f"SELECT 'target', '{t}', 'value_count', CAST(k AS DOUBLE), CAST(v AS VARCHAR), 'metric' "
        f"FROM {cnt} c5 WHERE v IS NOT NULL",
    ]


def domain_sql(cols):
    parts = [lit_row("domain", f, "missing_feature", 1, None, "warning")
             for f in P.EXPECTED_FEATURES if f not in cols]
    for c in cols:
        if "rate" in c.lower():
            bad = f"(min({q(c)}) < 0 OR max({q(c)}) > 1)"
            parts += [m("domain", c, "rate_min", f"min({q(c)})", sev(bad, "error")),
                      m("domain", c, "rate_max", f"max({q(c)})", sev(bad, "error"))]
    parts.append(m("domain", "service", "distinct_services", "count(DISTINCT service)",
                   sev("count(DISTINCT service) > 100", "warning")))
    z = "count(*) FILTER (WHERE duration = 0 AND (src_bytes > 0 OR dst_bytes > 0))"
    parts.append(m("domain", "*", "zero_duration_with_bytes", z, sev(f"{z} > 0", "warning")))
    i = ("count(*) FILTER (WHERE (is_attack = 1 AND attack_type IS NOT DISTINCT FROM 'normal') OR "
         "(is_attack = 0 AND attack_type IS DISTINCT FROM 'normal'))")
    parts.append(m("domain", "*", "inconsistent_labels", i, sev(f"{i} > 0", "error")))
    bad = "(protocol_type NOT IN ('tcp', 'udp', 'icmp') OR protocol_type IS NULL)"
    parts.append(
        f"SELECT 'domain', 'protocol_type', CASE WHEN {bad} THEN 'unexpected_protocol' "
        f"ELSE 'protocol_count' END, CAST(count(*) AS DOUBLE), protocol_type, "
        f"CASE WHEN {bad} THEN 'warning' ELSE 'metric' END FROM src GROUP BY protocol_type")
    return parts


EXPECTED = [c for c in ALL if c not in ("ts", "conn_id")] + ["land", "hot"]


# --- registered queries --------------------------------------------------------------

@register("null_profile", wrap(src_cte(union(null_sql(ALL)))))
def q_null_profile(spark, sf):
    return fin(P.null_profile(connections(spark, sf)))


_DUP_COLS = ["protocol_type", "service", "flag", "count", "srv_count", "serror_rate", "rerror_rate"]


def _dup_sql(cols, src="connections"):
    groups = f"(SELECT {', '.join(q(c) for c in cols)}, count(*) AS k FROM {src} GROUP BY ALL) g"
    severity = sev("coalesce(sum(k - 1), 0) > coalesce(sum(k), 0) * 0.1", "warning")
    return wrap(with_cte(CONN_CTE, union([
        m("duplicate_rows", "*", "duplicate_count", "coalesce(sum(k - 1), 0)", severity, src=groups),
        m("duplicate_rows", "*", "duplicate_pct", "coalesce(sum(k - 1), 0) * 100.0 / sum(k)", severity, src=groups)])))


@register("duplicate_rows", _dup_sql(ALL))
def q_duplicate_rows(spark, sf):
    return fin(P.duplicate_rows(connections(spark, sf, materialize=True)))


@register("duplicate_rows_key_columns", _dup_sql(_DUP_COLS))
def q_duplicate_rows_key_columns(spark, sf):
    return fin(P.duplicate_rows(connections(spark, sf, materialize=True).select(*_DUP_COLS)))


# all columns, with the attacks loaded a second time
@register("duplicate_rows_reloaded", _dup_sql(
    ALL, "(SELECT * FROM connections UNION ALL SELECT * FROM connections WHERE is_attack = 1) x"))
def q_duplicate_rows_reloaded(spark, sf):
    c = connections(spark, sf, materialize=True)
    return fin(P.duplicate_rows(concat_parts(c, c.filter(F.col("is_attack") == 1))))


@register("infinite_columns", wrap(src_cte(union(infinite_sql(DOUBLES)))))
def q_infinite_columns(spark, sf):
    return fin(P.infinite_columns(connections(spark, sf)))


@register("empty_columns", wrap(src_cte(union(empty_sql(ALL)))))
def q_empty_columns(spark, sf):
    return fin(P.empty_columns(connections(spark, sf)))


@register("constant_columns", wrap(src_cte(union(constant_sql(NUMERIC)))))
def q_constant_columns(spark, sf):
    return fin(P.constant_columns(connections(spark, sf)))


@register("schema_check", wrap(src_cte(union(schema_sql(ALL, TYPES, EXPECTED)))))
def q_schema_check(spark, sf):
    return fin(P.schema_check(connections(spark, sf, materialize=True), EXPECTED))


@register("target_check", wrap(src_cte(union(target_sql()))))
def q_target_check(spark, sf):
    return fin(P.target_check(connections(spark, sf, materialize=True), "is_attack"))


_DIST = [c for c in NUMERIC if c != "is_attack"]


@register("distribution_profile", wrap(src_cte(union(distribution_sql(_DIST)))))
def q_distribution_profile(spark, sf):
    return fin(P.distribution_profile(connections(spark, sf, materialize=True)))


@register("categorical_profile", wrap(src_cte(union(categorical_sql(STRINGS)))))
def q_categorical_profile(spark, sf):
    return fin(P.categorical_profile(connections(spark, sf, materialize=True)))


@register("domain_check", wrap(src_cte(union(domain_sql(ALL)))))
def q_domain_check(spark, sf):
    return fin(P.domain_check(connections(spark, sf, materialize=True)))


@register("value_counts", with_cte(CONN_CTE, """
SELECT attack_type AS value, count(*) AS n FROM connections GROUP BY attack_type
ORDER BY n DESC, value LIMIT 10"""))
def q_value_counts(spark, sf):
    return fin(P.value_counts(connections(spark, sf), "attack_type", top=10))


@register("zero_duration_with_bytes", with_cte(CONN_CTE, """
SELECT CAST(conn_id AS BIGINT) AS conn_id FROM connections
WHERE duration - 1 = 0 AND (src_bytes > 0 OR dst_bytes > 0)"""))
def q_zero_duration(spark, sf):
    # connections always carry >= 1 unit, so shift by one to exercise the filter
    c = connections(spark, sf).withColumn("duration", F.col("duration") - 1)
    return fin(c.filter(P.zero_duration_with_bytes_condition()).select("conn_id"))


@register("inconsistent_labels", with_cte(CONN_CTE, """
SELECT CAST(conn_id AS BIGINT) AS conn_id, attack_type FROM (
  SELECT conn_id, attack_type,
         CASE WHEN (0.0::DOUBLE + CASE WHEN serror_rate > 0.5 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
                  + CASE WHEN rerror_rate > 0.3 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
                  + CASE WHEN duration > 100 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END) > 0.4
              THEN 1 ELSE 0 END AS is_attack
  FROM connections) x
WHERE (is_attack = 1 AND attack_type IS NOT DISTINCT FROM 'normal')
   OR (is_attack = 0 AND attack_type IS DISTINCT FROM 'normal')"""))
def q_inconsistent_labels(spark, sf):
    # a rule detector's label set against the recorded attack type
    c = connections(spark, sf)
    c = c.withColumn("is_attack", rule_label(rule_score(c.columns)))
    return fin(c.filter(P.inconsistent_labels_condition()).select("conn_id", "attack_type"))


_IN_FEATS = [c for c in NUMERIC if c != "is_attack"]


def _input_sql():
    parts = [lit_row("input", "*", "num_features", len(_IN_FEATS), None, "metric"),
             m("input", "*", "num_samples", "count(*)", sev("count(*) = 0", "error"))]
    for c in _IN_FEATS:
        k = f"(count(*) - count({q(c)}))"
        parts.append(m("input", c, "null_count", k, sev(f"{k} > 0", "error")))
    parts += infinite_sql([c for c in _IN_FEATS if c in DOUBLES], "input")
    parts.append(m("input", "is_attack", "unique_values", "count(DISTINCT is_attack)"))
    parts.append("SELECT 'input', 'is_attack', 'value_count', CAST(count(*) AS DOUBLE), CAST(is_attack AS VARCHAR), "
                 "'metric' FROM src WHERE is_attack IS NOT NULL GROUP BY is_attack")
    return parts


@register("input_check", wrap(src_cte(union(_input_sql()))))
def q_input_check(spark, sf):
    c = connections(spark, sf, materialize=True).select(*NUMERIC)
    return fin(P.input_check(c, "is_attack"))


_REQ = ["duration", "src_bytes", "protocol_type", "num_failed_logins"]


def _quick_sql():
    parts = [lit_row("quick", c, "missing_column", 1, None, "error")
             for c in sorted(set(_REQ) - set(ALL))]
    parts.append(lit_row("quick", "*", "string_columns", len(STRINGS), None, "metric"))
    parts.append(m("quick", "*", "num_rows", "count(*)", sev("count(*) = 0", "error")))
    for c in ALL:
        pct = f"CAST(count(*) - count({q(c)}) AS DOUBLE) * 100.0 / count(*)"
        parts.append(m("quick", c, "missing_pct", pct, sev(f"{pct} > 50", "error")))
    return parts


@register("quick_check", wrap(src_cte(union(_quick_sql()))))
def q_quick_check(spark, sf):
    return fin(P.quick_check(connections(spark, sf, materialize=True), _REQ))


def _summary_sql():
    parts = [m("summary", "*", "num_rows", "count(*)"),
             lit_row("summary", "*", "num_columns", len(ALL), None, "metric")]
    for c in ALL:
        kind = "numeric" if c in NUMERIC else "categorical" if c in STRINGS else "other"
        parts.append(lit_row("summary", c, "dtype", None, TYPES[c], "metric"))
        parts.append(lit_row("summary", c, "kind", None, kind, "metric"))
        k = f"(count(*) - count({q(c)}))"
        parts += [m("summary", c, "missing", k),
                  m("summary", c, "missing_pct", f"CAST({k} AS DOUBLE) * 100.0 / count(*)")]
    for t in ("is_attack", "attack_type"):
        parts.append(f"SELECT 'summary', '{t}', 'distribution', CAST(count(*) AS DOUBLE), "
                     f"CAST({t} AS VARCHAR), 'metric' FROM src GROUP BY {t}")
    return parts


@register("summary", wrap(src_cte(union(_summary_sql()))))
def q_summary(spark, sf):
    return fin(P.summary(connections(spark, sf, materialize=True)))


def _validate_sql():
    parts = schema_sql(ALL, TYPES, EXPECTED)
    parts += null_sql(ALL, "quality") + infinite_sql(DOUBLES, "quality")
    parts += distribution_sql(_DIST)
    parts += [p for p in domain_sql(ALL)]
    dsrc = f"(SELECT {', '.join(q(c) for c in ALL)}, count(*) AS k FROM src GROUP BY ALL) g"
    parts += [m("quality", "*", "duplicate_count", "coalesce(sum(k - 1), 0)",
                sev("coalesce(sum(k - 1), 0) > coalesce(sum(k), 0) * 0.1", "warning"), src=dsrc),
              m("quality", "*", "duplicate_pct", "coalesce(sum(k - 1), 0) * 100.0 / sum(k)",
                sev("coalesce(sum(k - 1), 0) > coalesce(sum(k), 0) * 0.1", "warning"), src=dsrc)]
    parts += target_sql() + categorical_sql(STRINGS)
    return parts


@register("validate_all", wrap(src_cte(union(_validate_sql()))))
def q_validate_all(spark, sf):
    return fin(P.validate_all(connections(spark, sf, materialize=True), EXPECTED))


@register("validate_summary", f"""
SELECT count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings,
       CAST(count(*) FILTER (WHERE severity = 'error') = 0 AS INTEGER) AS is_valid
FROM ({wrap(src_cte(union(_validate_sql())))}) v""")
def q_validate_summary(spark, sf):
    return fin(P.overall(P.validate_all(connections(spark, sf, materialize=True), EXPECTED)))

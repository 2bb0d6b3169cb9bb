"""Scans and sinks: the connection table is written by Spark in each format to
a fresh folder under the shared checkpoint directory and read back through
the scan under test; the SQL twin states the expected table directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import derive_label
from ..operators import profile as P
from ..plans.scoring import rule_scored
from ..schemas import KDD_COLUMNS, KDD_NAMES, nsl_schema
from ..session import cut_lineage, scratch_path
from ..sources import files as FI
from ..sources import sinks as SK
from ..sources.tables import connections, kdd_layout
from .base import CONN_CTE, SCORED_CTE, fin, register, sql_fin, with_cte
from .q_profile import ALL, empty_sql, src_cte, union, wrap

_SQL_TYPES = {"DoubleType()": "DOUBLE", "StringType()": "VARCHAR", "LongType()": "BIGINT",
              "IntegerType()": "INTEGER"}
_HAVE = {
    "src_bytes": "CAST(floor(src_bytes) AS BIGINT)",
    "dst_bytes": "CAST(floor(dst_bytes) AS BIGINT)",
}
_PASS = {"duration", "protocol_type", "service", "flag", "count", "srv_count", "serror_rate",
         "rerror_rate", "same_srv_rate", "diff_srv_rate", "attack_type"}


def _kdd_select():
    parts = []
    for name, t in KDD_COLUMNS:
        st = _SQL_TYPES[repr(t)]
        if name in _HAVE:
            e = _HAVE[name]
        elif name in _PASS:
            e = f'"{name}"'
        else:
            e = "0"
        parts.append(f'CAST({e} AS {st}) AS "{name}"')
    return ", ".join(parts)


KDD_CTE = CONN_CTE + f""",
kdd AS (SELECT {_kdd_select()} FROM connections),
kddl AS (SELECT *, CASE WHEN attack_type IS NOT DISTINCT FROM 'normal' THEN 0 ELSE 1 END
                   AS is_attack FROM kdd)"""
_DBL = [n for n, t in KDD_COLUMNS if repr(t) == "DoubleType()"]
_INT = [n for n, t in KDD_COLUMNS if repr(t) in ("LongType()", "IntegerType()")] + ["is_attack"]
KDD_SQL = sql_fin(with_cte(KDD_CTE, "SELECT * FROM kddl"), _DBL, _INT)
OUT = KDD_NAMES + ["is_attack"]


def _kdd(spark, sf):
    return kdd_layout(connections(spark, sf))


@register("scan_kdd", KDD_SQL)
def q_scan_kdd(spark, sf):
    path = scratch_path(spark, "kdd")
    _kdd(spark, sf).write.mode("overwrite").option("header", False).csv(path)
    return fin(FI.scan_kdd(spark, path).select(*OUT))


@register("scan_kdd_header", KDD_SQL)
def q_scan_kdd_header(spark, sf):
    # the bundled-sample shape: header line and a trailing is_attack column
    path = scratch_path(spark, "kdd_header")
    k = _kdd(spark, sf)
    k.withColumn("is_attack", derive_label("attack_type")).write.mode("overwrite") \
        .option("header", True).csv(path)
    return fin(FI.scan_kdd(spark, path).select(*OUT))


@register("scan_nsl", sql_fin(with_cte(
    KDD_CTE, "SELECT *, CASE WHEN flag = 'BUILDING' THEN 'test' ELSE 'train' END AS part FROM kddl"), _DBL, _INT))
def q_scan_nsl(spark, sf):
    # a pair of files: train without, test with a header line
    paths = [scratch_path(spark, f"nsl_{part}") for part in ("train", "test")]
    k = _kdd(spark, sf).withColumn("difficulty_level", F.col("count"))
    k = k.select(*[f.name for f in nsl_schema().fields])
    test = F.coalesce(F.col("flag") == "BUILDING", F.lit(False))
    k.filter(~test).write.mode("overwrite").csv(paths[0])
    k.filter(test).write.mode("overwrite").option("header", True).csv(paths[1])
    both = FI.scan_nsl(spark, *paths)
    train, test = (df.select(*OUT, F.lit(part).alias("part")) for df, part in zip(both, ("train", "test")))
    return fin(train.unionByName(test))


@register("scan_auto", KDD_SQL)
def q_scan_auto(spark, sf):
    # 'nsl' in the path routes to the 43-column reader before 'kdd' matches
    path = scratch_path(spark, "nsl_kdd_train")
    k = _kdd(spark, sf).withColumn("difficulty_level", F.col("count"))
    k.write.mode("overwrite").csv(path)
    return fin(FI.scan_auto(spark, path).select(*OUT))


@register("scan_csv", KDD_SQL)
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    SK.write_table(_kdd(spark, sf), path, "csv")
    from ..schemas import kdd_schema
    df = FI.scan_csv(spark, path, schema=kdd_schema(), header=True)
    return fin(df.withColumn("is_attack", derive_label("attack_type")).select(*OUT))


@register("scan_json_record", KDD_SQL)
def q_scan_json_record(spark, sf):
    path = scratch_path(spark, "json")
    SK.write_table(_kdd(spark, sf), path, "json")
    return fin(FI.scan_json_records(spark, path).select(*OUT))


# Bad lines: connections of one packet lose the end of their line, those of two
# packets have a text where a number belongs.
@register("scan_chunked", with_cte(KDD_CTE + """,
flagged AS (SELECT is_attack, coalesce("count" = 1, FALSE) AS cut, coalesce("count" = 2, FALSE) AS wrong FROM kddl)""", """
SELECT layout, CASE WHEN wrong OR (cut AND layout = 'plain') THEN 'rejected' ELSE 'good' END AS outcome,
       count(*) AS n, count(*) FILTER (WHERE is_attack = 1) AS attacks
FROM flagged, (SELECT 'plain' AS layout UNION ALL SELECT 'header') l GROUP BY ALL"""))
def q_scan_chunked(spark, sf):
    k = cut_lineage(_kdd(spark, sf), "records")
    plain, headed = scratch_path(spark, "chunked"), scratch_path(spark, "chunked_header")
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in KDD_NAMES]
    wrong = F.coalesce(F.col("count") == 2, F.lit(False))
    texts = [F.when(wrong, "n/a").otherwise(t) if c == "src_bytes" else t for c, t in zip(KDD_NAMES, texts)]
    line = F.concat_ws(",", *texts)
    cut = F.concat_ws(",", *texts[:30], texts[-1])
    k.select(F.when(F.col("count") == 1, cut).otherwise(line).alias("value")).write.mode("overwrite").text(plain)
    # with a header line the columns may stand in any order
    named = dict(zip(KDD_NAMES, texts))
    k.select(*[named[c].alias(c) for c in reversed(KDD_NAMES)]).write.mode("overwrite").option(
        "header", True).option("emptyValue", "").csv(headed)
    out = None
    for layout, path in (("plain", plain), ("header", headed)):
        good, bad = FI.scan_chunked(spark, path)
        rows = good.select("is_attack", F.lit("good").alias("outcome")).unionByName(
            bad.where("raw IS NOT NULL AND error IS NOT NULL").select(
                F.when(F.col("raw").rlike("(^normal,)|(,normal$)"), 0).otherwise(1).alias("is_attack"),
                F.lit("rejected").alias("outcome")))
        rows = rows.groupBy("outcome").agg(F.count("*").alias("n"), F.count_if(F.col("is_attack") == 1).alias(
            "attacks")).withColumn("layout", F.lit(layout))
        out = rows if out is None else out.unionByName(rows)
    return fin(out.select("layout", "outcome", "n", "attacks"))


_SCORED_OUT = ["conn_id", "probability", "prediction", "prediction_label", "confidence",
               "threat_level"]
_SCORED_SQL = sql_fin(with_cte(SCORED_CTE, f"SELECT {', '.join(_SCORED_OUT)} FROM scored"),
                      ["probability"], ["conn_id", "prediction"])


def _roundtrip(spark, sf, fmt):
    s = rule_scored(spark, sf).select(*_SCORED_OUT)
    path = scratch_path(spark, f"sink_{fmt}")
    SK.write_table(s, path, fmt)
    back = SK.read_table(spark, path, fmt, schema=s.schema if fmt != "parquet" else None)
    return fin(back.select(*_SCORED_OUT))


@register("sink_csv", _SCORED_SQL)
def q_sink_csv(spark, sf):
    return _roundtrip(spark, sf, "csv")


@register("sink_json", _SCORED_SQL)
def q_sink_json(spark, sf):
    return _roundtrip(spark, sf, "json")


@register("sink_parquet", _SCORED_SQL)
def q_sink_parquet(spark, sf):
    return _roundtrip(spark, sf, "parquet")


@register("sink_processed", KDD_SQL)
def q_sink_processed(spark, sf):
    base = scratch_path(spark, "processed")
    k = _kdd(spark, sf).withColumn("is_attack", derive_label("attack_type"))
    path = SK.save_processed(k, base, "connections", "parquet")
    return fin(spark.read.parquet(path).select(*OUT))


@register("sink_report", wrap(src_cte(union(empty_sql(ALL)))))
def q_sink_report(spark, sf):
    path = scratch_path(spark, "report")
    SK.write_report(P.empty_columns(connections(spark, sf)), path)
    return fin(spark.read.schema(P.CHECK_DDL).json(path))


@register("sink_capture", with_cte(SCORED_CTE, """
SELECT CAST(ts AS DATE) AS capture_date, count(*) AS n, count(*) FILTER (WHERE prediction = 1)
       AS attacks FROM scored GROUP BY ALL"""))
def q_sink_capture(spark, sf):
    path = scratch_path(spark, "capture")
    SK.capture(rule_scored(spark, sf), path, ts="ts", by_month=True)
    back = spark.read.parquet(path)
    return fin(back.groupBy("capture_date").agg(F.count(F.lit(1)).alias("n"),
                                               F.count_if(F.col("prediction") == 1).alias("attacks")))


"""Readers for the driver tables and the ``connections`` adapter.

``connections`` turns the order/line star schema into connection records: one
order is one connection, its lines are the packets. Money is summed as decimal
so that every engine gets the same total regardless of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import nan_to_null


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_stats(lineitem: DataFrame) -> DataFrame:
    """Per-order packet statistics: one shuffle on l_orderkey.

    The distinct-supplier count is a two-level aggregate; the first level
    groups (order, supplier) so one hot order is split across suppliers and
    map-side combining shrinks it before the exchange.
    """
    li = lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice",
                         "l_returnflag", "l_linestatus")
    per_supp = li.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("price"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
        F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_f"),
    )
    agg = per_supp.groupBy("l_orderkey").agg(
        F.sum("qty").alias("duration"),
        F.sum("price").cast("double").alias("src_bytes"),
        F.sum("n").alias("n"),
        F.count("l_suppkey").alias("srv_count"),
        F.sum("n_r").alias("n_r"),
        F.sum("n_a").alias("n_a"),
        F.sum("n_f").alias("n_f"),
    )
    n = F.col("n").cast("double")
    return agg.select(
        "l_orderkey", "duration", "src_bytes",
        F.col("n").cast("int").alias("count"),
        F.col("srv_count").cast("int").alias("srv_count"),
        (F.col("n_r").cast("double") / n).alias("serror_rate"),
        (F.col("n_a").cast("double") / n).alias("rerror_rate"),
        (F.col("n_f").cast("double") / n).alias("same_srv_rate"),
        (F.lit(1.0) - F.col("n_f").cast("double") / n).alias("diff_srv_rate"),
    )


def attack_type_from_rates(serror="serror_rate", rerror="rerror_rate"):
    s = F.coalesce(F.col(serror), F.lit(0.0))
    r = F.coalesce(F.col(rerror), F.lit(0.0))
    return F.when(s >= 0.75, "dos").when(r >= 0.75, "probe").otherwise("normal")


def connections(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Connection records. ``materialize=True`` writes the derived table once
    (reliable checkpoint in the shared folder) for callers that make several
    passes over it, instead of re-aggregating lineitem on every pass."""
    out = _connections(spark, sf_dir)
    if materialize:
        from ..session import cut_lineage
        out = cut_lineage(out)
    return out


def _connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    lines = line_stats(load(spark, sf_dir, "lineitem"))
    df = (orders
          .join(customer, orders.o_custkey == customer.c_custkey, "left")
          .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    proto = (F.when(F.col("o_orderstatus") == "F", "tcp")
             .when(F.col("o_orderstatus") == "O", "udp")
             .when(F.col("o_orderstatus") == "P", "icmp"))
    out = df.select(
        F.col("o_orderkey").alias("conn_id"),
        F.col("o_orderdate").alias("ts"),
        "duration",
        proto.alias("protocol_type"),
        F.col("o_orderpriority").alias("service"),
        F.col("c_mktsegment").alias("flag"),
        "src_bytes",
        F.col("o_totalprice").alias("dst_bytes"),
        "count", "srv_count", "serror_rate", "rerror_rate", "same_srv_rate",
        "diff_srv_rate",
    )
    at = attack_type_from_rates()
    return nan_to_null(out.withColumn("attack_type", at)
                       .withColumn("is_attack", (at != F.lit("normal")).cast("int")))


def events(spark: SparkSession, sf_dir: str, normalize_nan: bool = True) -> DataFrame:
    """The event table. ``normalize_nan=False`` keeps raw scan columns so that
    literal filters (fitted fence bounds) reach the parquet reader; NaN fails
    such bound filters exactly as NULL does."""
    raw = load(spark, sf_dir, "events")
    return nan_to_null(raw) if normalize_nan else raw


def risk_probability(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for a model's P(attack), used wherever a scored
    table is needed without a fitted model (bands, alerts, evaluation):
    0.8 * max(serror, rerror) + 0.2 * diff_srv_rate, rounded to 4 places."""
    s = F.coalesce(F.col("serror_rate"), F.lit(0.0))
    r = F.coalesce(F.col("rerror_rate"), F.lit(0.0))
    d = F.coalesce(F.col("diff_srv_rate"), F.lit(0.0))
    raw = F.lit(0.8) * F.greatest(s, r) + F.lit(0.2) * d
    p = F.round(raw * F.lit(1e4), 0) / F.lit(1e4)
    return df.withColumn("probability", p)


# Columns of the KDD layout that the order/line adapter does not produce are
# filled with zero; byte counts are whole numbers in that layout.
def kdd_layout(conn: DataFrame) -> DataFrame:
    from ..schemas import KDD_COLUMNS
    have = {
        "duration": F.col("duration"),
        "protocol_type": F.col("protocol_type"),
        "service": F.col("service"),
        "flag": F.col("flag"),
        "src_bytes": F.floor(F.col("src_bytes")).cast("bigint"),
        "dst_bytes": F.floor(F.col("dst_bytes")).cast("bigint"),
        "count": F.col("count"),
        "srv_count": F.col("srv_count"),
        "serror_rate": F.col("serror_rate"),
        "rerror_rate": F.col("rerror_rate"),
        "same_srv_rate": F.col("same_srv_rate"),
        "diff_srv_rate": F.col("diff_srv_rate"),
        "attack_type": F.col("attack_type"),
    }
    cols = []
    for name, t in KDD_COLUMNS:
        e = have.get(name, F.lit(0))
        cols.append(e.cast(t).alias(name))
    return conn.select(*cols)

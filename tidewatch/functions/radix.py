"""Exact order statistics by radix selection on order-preserving 64-bit keys.

To find the row of rank r, keys are counted by their first 16 bits; the bucket
that holds the rank is counted by the next 16, and so on: at most four scans, and
fewer where a bucket turns out to hold one value. Every count is combined in
each task first, so a scan sends at most 65,536 rows a task and wanted prefix
however many rows there are, and an equal value that most rows share is one
bucket row a task.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

BITS = 16               # of the key that a scan counts by


def with_double_key(df: DataFrame, x: str, k: str = "k") -> DataFrame:
    """Adds ``k``, a bigint in the order of the doubles in ``x``: the IEEE bits of
    |x|, negated below zero (so both zeros are 0); NULL for NULL and NaN. Plain
    arithmetic in whole-stage code, a step a column so that no step is computed
    twice: scaling by powers of two is exact, and where the logarithm was rounded
    over a power the exponent is put right."""
    a, e, m = F.col("__a"), F.col("__e"), F.col("__m")
    over, under = m >= 2, (m < 1) & (e > -1022)
    df = df.withColumn("__a", F.abs(F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double"))))
    df = df.withColumn("__e", F.floor(F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.log2(a)))).cast("int"))
    df = df.withColumn("__m", a / F.pow(F.lit(2.0), e))
    df = df.withColumn("__e", F.when(over, e + 1).when(under, e - 1).otherwise(e)).withColumn(
        "__m", F.when(over, m / 2).when(under, m * 2).otherwise(m))
    scale = F.lit(float(1 << 52))
    df = df.withColumn("__a", F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(2047 << 52))
                       .when(m < 1, (m * scale).cast("long"))
                       .otherwise((e + 1023).cast("long") * F.lit(1 << 52) + ((m - 1) * scale).cast("long")))
    return df.withColumn(k, F.when(F.col(x) < 0, -a).otherwise(a)).drop("__a", "__e", "__m")


def key_double(k: int) -> float:
    """The double of a key of ``with_double_key``."""
    v = struct.unpack("<d", struct.pack("<q", abs(k)))[0]
    return -v if k < 0 else v


def select_ranks(keys: DataFrame, ranks: list[Column], local: bool = True) -> DataFrame:
    """``keys(g, k)``, g a group and k a bigint, neither NULL -> (g, i, n, below, k):
    for each group of n keys and each i, the key at 0-based rank ``ranks[i]`` (an
    expression over the column n) and how many keys are smaller than it. Ranks
    outside 0 to n - 1 give no row.

    ``keys`` is read once a scan: pass a saved table. ``local``: the targets, a row
    a group and rank, pass through the driver between scans (groups are columns);
    else they are saved and joined as tables of any size.
    """
    schema = "g string, i int, rank bigint, n bigint, below bigint, prefix bigint, lo bigint, hi bigint"
    keys = keys.select(F.col("g").cast("string").alias("g"), "k")
    spark = keys.sparkSession

    def settled(df):
        """Targets whose bucket holds one value, and the others (None: there are none)."""
        if local:
            rows = df.collect()
            part = [[r for r in rows if (r["lo"] == r["hi"]) is one] for one in (True, False)]
            return spark.createDataFrame(part[0], schema), spark.createDataFrame(part[1], schema) if part[1] else None
        df = cut_lineage(df, "ranks")
        rest = df.where("lo < hi")
        return df.where("lo = hi"), None if rest.isEmpty() else rest

    done, wanted, shift = None, None, 64
    while shift > 0:
        shift -= BITS
        bucket = F.shiftright("k", shift)
        if wanted is None:
            counts = keys.groupBy("g", bucket.alias("b"))
        else:
            few = wanted.select("g", "prefix").distinct()
            few = F.broadcast(few) if local else few
            counts = (keys.withColumn("prefix", F.shiftright("k", shift + BITS)).join(few, ["g", "prefix"])
                      .groupBy("g", "prefix", bucket.alias("b")))
        counts = counts.agg(F.count("*").alias("m"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        # at most 2^BITS rows in a window
        part = ["g"] if wanted is None else ["g", "prefix"]
        before = Window.partitionBy(*part).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("sum", F.coalesce(F.sum("m").over(before), F.lit(0)))
        if wanted is None:
            counts = counts.withColumn("n", F.sum("m").over(Window.partitionBy("g")))
            items = F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("rank")) for i, r in enumerate(ranks)])
            hit = counts.withColumn("below", F.col("sum")).withColumn("t", F.explode(F.filter(
                items, lambda t: (t["rank"] >= F.col("sum")) & (t["rank"] < F.col("sum") + F.col("m")))))
            hit = hit.select("g", "t.i", "t.rank", "n", "below", F.col("b").alias("prefix"), "lo", "hi")
        else:
            t = wanted.select("g", "prefix", "i", "rank", "n", F.col("below").alias("base"))
            hit = (counts.join(F.broadcast(t) if local else t, ["g", "prefix"])
                   .withColumn("below", F.col("base") + F.col("sum"))
                   .where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("m")))
                   .select("g", "i", "rank", "n", "below", F.col("b").alias("prefix"), "lo", "hi"))
        ended, wanted = settled(hit)
        done = ended if done is None else done.unionByName(ended)
        if wanted is None:
            break
    return done.select("g", "i", "n", "below", F.col("lo").alias("k"))

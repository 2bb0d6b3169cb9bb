"""Deterministic stratified split and folds.

Rows are ranked inside their label by ``md5(key:seed)`` (ties by key); the
first ``floor(frac * n_label + 0.5)`` of each label are train. The result is the
same on every run and in plain SQL; ``randomSplit``/``sampleBy`` are neither exact
in size nor stable under recomputation. No row is sorted for a split: the hash at
the boundary rank is found by radix selection (functions/radix.py) and rows are
compared with it where they are. Folds need every rank: rows meet the others of
their (label, hash prefix) only, and counts of the prefixes give the offsets. Both
read their input two or three times: pass a saved table, not a costly plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.radix import select_ranks
from ..session import cut_lineage, scratch_scope
from .windows import join_small

FOLD_ROWS = 10_000      # rows of a (label, hash prefix) at the mean


def shuffle_key(key: str, seed: int) -> Column:
    """The hash that orders rows; rows without a key come last."""
    return F.coalesce(F.md5(F.concat(F.col(f"`{key}`").cast("string"), F.lit(f":{seed}"))), F.lit("~"))


def _hash_bits(h: Column) -> Column:
    """The first 64 bits of a hex hash as a bigint of the same order."""
    bits = F.conv(F.substring(h, 1, 16), 16, -10).cast("bigint")
    return F.when(h == "~", F.lit((1 << 63) - 1)).otherwise(bits.bitwiseXOR(F.lit(-(1 << 63))))


def _boundaries(df: DataFrame, label: str, key: str, seed: int, ranks: list[Column]) -> DataFrame:
    """(label, n, h0, key0, h1, key1, ...): hash and key of the row at each rank in
    its label; NULL where a rank is outside it. ``ranks`` are over a label's count n."""
    rows = cut_lineage(df.select(F.col(f"`{label}`").alias("y"), F.col(f"`{key}`").alias("x"))
                       .withColumn("h", shuffle_key("x", seed)).select("y", "x", _hash_bits(F.col("h")).alias("k")), "hashes")
    named = rows.withColumn("g", F.coalesce(F.concat(F.lit("="), F.col("y").cast("string")), F.lit("null")))
    found = cut_lineage(select_ranks(named, [*ranks, F.lit(0)], local=False), "found")
    # rows that share the 64 bits of a boundary: one, but for repeated keys, which are counted as one here
    near = join_small(named.select("g", "y", "x", "k"), found.select("g", "k").distinct(), ["g", "k"])
    near = near.groupBy("g", "y", "x", "k").agg(F.count("*").alias("m")).withColumn("h", shuffle_key("x", seed))
    w = Window.partitionBy("g", "k").orderBy("h", "x")
    near = near.withColumn("upto", F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.coalesce(*[F.when(F.col("i") == i, r.cast("long")) for i, r in enumerate([*ranks, F.lit(0)])])
    hit = found.withColumn("place", rank - F.col("below")).join(near, ["g", "k"]).where(
        "place >= upto - m AND place < upto")
    one = hit.groupBy("g", "y").agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("i") == i, F.struct("h", "x"))).alias(f"b{i}") for i in range(len(ranks))])
    return one.select(F.col("y").alias(label), *[F.col(f"b{i}").alias(f"__b{i}") for i in range(len(ranks))])


def split_stratified(df: DataFrame, label: str = "is_attack", key: str = "conn_id",
                     train_frac: float = 0.8, seed: int = 42,
                     validation_frac: float = 0.0) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' (and 'validation' when
    ``validation_frac`` > 0: the last floor(n_train * frac + 0.5) of each
    label's train ranks — a second stratified split without a second ranking).

    ``key`` names a row: rows that share one stay on one side, that of the first
    of them. Rows without a key count as one key, the last. A NULL label is a
    label."""
    n_train = F.floor(F.col("n") * F.lit(float(train_frac)) + F.lit(0.5))
    n_val = F.floor(n_train * F.lit(float(validation_frac)) + F.lit(0.5))
    ranks = [n_train - 1] + ([n_train - n_val - 1] if validation_frac > 0 else [])
    spark = df.sparkSession
    with scratch_scope(spark) as scope:
        bounds = scope.save(_boundaries(df, label, key, seed, ranks), "boundaries")
    own = F.struct(F.col("__h").alias("h"), F.col(f"`{key}`").alias("x"))
    r = join_small(df.withColumn("__h", shuffle_key(key, seed)), bounds, [label], "left")
    upto = lambda b: F.col(b).isNotNull() & (own <= F.col(b))
    split = F.when(~upto("__b0"), "test")
    if validation_frac > 0:
        split = split.when(~upto("__b1"), "validation")
    return r.withColumn("split", split.otherwise("train")).drop("__h", *[f"__b{i}" for i in range(len(ranks))])


def fold_stratified(df: DataFrame, label: str = "is_attack", key: str = "conn_id",
                    k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Adds ``fold`` in 0..k-1, round-robin over each label's shuffled order. One
    shuffle of the rows, by (label, hash prefix)."""
    keyed = df.withColumn("__h", shuffle_key(key, seed))
    n = df.count()
    bits = max(0, min(40, math.ceil(math.log2(max(1, n / FOLD_ROWS)))))
    prefix = F.shiftrightunsigned(_hash_bits(F.col("__h")).bitwiseXOR(F.lit(-(1 << 63))), 64 - bits) if bits else F.lit(0)
    keyed = keyed.withColumn("__p", prefix.cast("long"))
    counts = keyed.groupBy(label, "__p").agg(F.count("*").alias("__m"))
    # two levels, so that no window holds more than 2^20 prefixes
    counts = cut_lineage(counts.withColumn("__q", F.shiftright("__p", (bits + 1) // 2)), "counts")
    before = lambda *by: Window.partitionBy(label, *by[:-1]).orderBy(by[-1]).rowsBetween(
        Window.unboundedPreceding, -1)
    tops = counts.groupBy(label, "__q").agg(F.sum("__m").alias("__m")).select(
        label, "__q", F.coalesce(F.sum("__m").over(before("__q")), F.lit(0)).alias("__top"))
    offs = join_small(counts, cut_lineage(tops, "tops"), [label, "__q"]).select(
        label, "__p", (F.col("__top") + F.coalesce(F.sum("__m").over(before("__q", "__p")), F.lit(0))).alias("__off"))
    r = join_small(keyed, cut_lineage(offs, "offsets"), [label, "__p"])
    w = Window.partitionBy(label, "__p").orderBy("__h", key)
    return r.withColumn(name, ((F.col("__off") + F.row_number().over(w) - 1) % k).cast("int")).drop(
        "__h", "__p", "__off")


def concat_parts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out

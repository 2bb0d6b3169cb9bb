"""Sharding by a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import RID, cut_lineage, with_row_id

SHARDS = 8
SEED = 20240
ROUNDS = 6
ROWS_PER_PARTITION = 2_000_000


def _mix(x, key):
    """32-bit round function on uint64 arrays that hold 32-bit values."""
    import numpy as np
    low = np.uint64(0xFFFFFFFF)
    x = (x ^ np.uint64(key)) & low
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x45D9F3B)) & low
    return x ^ (x >> np.uint64(16))


def permute(numbers, n: int, seed: int = SEED, rounds: int = ROUNDS):
    """Places of row ``numbers`` (0 to n - 1) in the seeded permutation of n rows:
    a balanced Feistel network over the next even power of two; values that
    fall at n or beyond walk on along their cycle until they fall below it."""
    import numpy as np
    half = max(1, -(-max(1, (max(n, 2) - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(rounds):
            left, right = right, left ^ (_mix(right, (seed * 0x9E3779B1 + r * 0x85EBCA77) & 0xFFFFFFFF) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def locate(number: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of one global row number, without any table."""
    p = int(permute([number], n, seed)[0])
    return p % shards, p // shards


def global_numbers(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Add ``number``: the rank of each row by ``order`` (row number last, so
    equal rows differ), and return the count of rows. Range partitions in
    proportion to the rows, saved once; a row's rank is its place in its
    partition plus the rows of the partitions before, a table of a row a
    partition."""
    n = df.count()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-n // ROWS_PER_PARTITION))
    keys = [*order, RID]
    ranged = cut_lineage(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("__tw_place", F.monotonically_increasing_id()), "ranged")
    part, place = F.shiftright("__tw_place", 33), F.col("__tw_place").bitwiseAND((1 << 33) - 1)
    ranged = ranged.withColumn("__tw_part", part).withColumn("__tw_place", place)
    sizes = ranged.groupBy("__tw_part").agg(F.count("*").alias("__tw_n"))
    rows = sorted((r["__tw_part"], r["__tw_n"]) for r in sizes.collect())     # a row a partition
    at, offsets = 0, []
    for p, c in rows:
        offsets.append((p, at))
        at += c
    spark = df.sparkSession
    table = spark.createDataFrame(offsets or [(0, 0)], "__tw_part bigint, __tw_before bigint")
    out = ranged.join(F.broadcast(table), "__tw_part").withColumn(
        "number", F.col("__tw_before") + F.col("__tw_place"))
    return out.drop("__tw_part", "__tw_place", "__tw_before"), n


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, size, text_crc32, number, shard, slot.

    Rows are numbered by (doc_id, text_crc32, size); the permuted number p gives
    shard p mod shards and slot p div shards, so counts differ by one at most
    and slots have no gap. Only these narrow columns are shuffled. A null text
    has no bytes; null doc_ids sort first; rows equal in all three change
    places freely, which changes no result. No rows give no rows.
    """
    from pyspark.sql.functions import pandas_udf

    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = with_row_id(docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")))
    numbered, n = global_numbers(narrow, ["doc_id", "text_crc32", "size"])

    @pandas_udf("bigint")
    def place(x):
        import pandas as pd
        return pd.Series(permute(x.to_numpy(), n, seed))

    return (numbered.withColumn("p", place("number"))
            .select("doc_id", "size", "text_crc32", "number",
                    (F.col("p") % shards).cast("int").alias("shard"),
                    F.expr(f"p div {shards}").alias("slot")))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    return shard(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "number")

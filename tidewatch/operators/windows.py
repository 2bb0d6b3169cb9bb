"""Order-dependent operators without single-partition windows.

``global_row_number`` / ``prefix_sums`` are two-level scans: the input is saved
once unless it merely projects or filters a saved table (range boundaries come from
sampling, which reads it again), range-partitioned
on the order columns into partitions of a size taken from its row count, sorted
inside them, tagged with ``monotonically_increasing_id`` (partition in the high
bits, place in the low bits) and written, so recomputation cannot move rows between
partitions. Totals of the partitions, one row each, are summed up in order and
joined back; nothing of them passes through the driver or the plan.

``rolling``: row-count frames over an order, optionally per entity. Rows are
numbered per entity, cut into buckets of ``bucket_rows`` rows, and the last
``w-1`` rows of each bucket are copied into the next one as a halo, so a group
(entity, bucket) holds every frame whole. No group ever has more than
``bucket_rows + w - 1`` rows, even for an entity that owns a third of the table.
A group is one Arrow table whose frames are summed up together, ``w`` array steps
a column, where a window function would walk each row's frame by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage, reads_saved

LOW_BITS = 33
LOW_MASK = (1 << LOW_BITS) - 1


PARTITION_ROWS = 1_000_000


def ranged(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted, id-tagged and saved copy of ``df``; adds
    ``__pid`` and ``__pos``."""
    if not reads_saved(df):
        df = cut_lineage(df, "unordered")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n = partitions or max(least, -(-df.count() // PARTITION_ROWS))
    r = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("__id", F.monotonically_increasing_id()))
    # ids are fixed once written: partition id and position are data from here on
    r = cut_lineage(r, "ranged")
    return (r.withColumn("__pid", F.shiftright(F.col("__id"), LOW_BITS).cast("int"))
            .withColumn("__pos", F.col("__id").bitwiseAND(F.lit(LOW_MASK))))


def _with_offsets(r: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """``r`` with, for each total, its sum over all partitions before the row's
    own. The joined table has a row a range partition."""
    per = r.groupBy("__pid").agg(*[t.alias(k) for k, t in totals.items()])
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("__pid", *[F.coalesce(F.sum(k).over(w), F.lit(0)).alias(k) for k in totals])
    return r.join(F.broadcast(offs), "__pid")


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number in the total order ``order`` (must be unique)."""
    r = _with_offsets(ranged(df, order, partitions), {"__before": F.count(F.lit(1))})
    return r.withColumn(name, F.col("__before") + F.col("__pos") + 1).drop("__id", "__pid", "__pos", "__before")


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column],
                partitions: int | None = None) -> DataFrame:
    """Inclusive running sums in the total order ``order``: adds one column per
    ``sums`` entry. Local running sums are a window per range partition (each
    partition is one bounded slice); partition totals become offsets."""
    base = df.withColumns({f"__v_{k}": v for k, v in sums.items()})
    r = _with_offsets(ranged(base, order, partitions), {f"__o_{k}": F.sum(f"__v_{k}") for k in sums})
    w = Window.partitionBy("__pid").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    out = r.withColumns({k: F.col(f"__o_{k}") + F.sum(f"__v_{k}").over(w) for k in sums})
    return out.drop("__id", "__pid", "__pos", *[f"__{x}_{k}" for k in sums for x in "vo"])


def rank_within_groups(df: DataFrame, groups: list[str], order: list[Column],
                       name: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based row number inside each group (total order inside the group),
    without one task per group: global number, minus the group's first."""
    rn = global_row_number(df, [F.col(g) for g in groups] + order, "__grn", partitions)
    first = rn.groupBy(*groups).agg(F.min("__grn").alias("__first"))
    return (join_small(rn, cut_lineage(first, "firsts"), groups)
            .withColumn(name, F.col("__grn") - F.col("__first") + 1)
            .drop("__grn", "__first"))


BROADCAST_BYTES = 48 << 20


def table_bytes(df: DataFrame) -> int:
    """Rows, at 16 bytes a column, and the bytes of all strings, counted."""
    text = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields
            if f.dataType.typeName() in ("string", "binary", "varchar", "char")]
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(text, F.lit(0)).cast("long")).alias("b")).first()
    return r["n"] * 16 * len(df.columns) + (r["b"] or 0)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a per-group table: broadcast it when its counted bytes are under
    ``limit`` (hot groups then cost nothing), else a shuffle join that AQE's skew
    handling splits. NULL keys match each other: a NULL group keeps its rows."""
    keys = {c: f"__key{i}" for i, c in enumerate(on)}
    side = small.withColumnsRenamed(keys)
    if table_bytes(small) <= limit:
        side = F.broadcast(side)
    same = [big[f"`{c}`"].eqNullSafe(side[k]) for c, k in keys.items()]
    joined = big.join(side, on=same, how=how)
    return joined if how == "left_semi" else joined.drop(*keys.values())


def rolling_window_size(n_rows: int, cap: int = 100, divisor: int = 10) -> int:
    """min(cap, n // divisor), and at least 1 (the reference fails below 10 rows)."""
    return max(1, min(cap, n_rows // divisor))


def rolling(df: DataFrame, columns: list[str], w: int, order: list[str],
            partition_by: list[str] | None = None, bucket_rows: int = 4096,
            strategy: str = "halo", eps: float = 1e-8) -> DataFrame:
    """For each column c: c_rolling_mean, c_rolling_std (sample; NULL on a
    one-row frame), c_zscore = (c - mean) / (std + eps). With ``'halo'`` the rows
    pass through Arrow: columns must be of types that it carries.

    ``strategy='window'`` is the plain keyed window (fine when no entity is
    hot); ``'halo'`` (default) bounds every task as described above.
    """
    keys = list(partition_by or [])
    if strategy == "window":
        win = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(w - 1), 0)
        return _rolling_cols(df, columns, win, eps)
    if bucket_rows < w - 1:
        bucket_rows = w - 1
    ordered = [F.col(c) for c in order]
    if keys:
        numbered = rank_within_groups(df, keys, ordered, "__rn")
    else:
        numbered = global_row_number(df, ordered, "__rn")
    copies = F.array(F.lit(0))
    if w > 1:       # the last rows of a bucket go into the next one, too
        copies = F.when((F.col("__rn") - 1) % bucket_rows >= bucket_rows - (w - 1),
                        F.array(F.lit(0), F.lit(1))).otherwise(copies)
    xs = {f"__x{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(columns)}
    dealt = numbered.select("*", F.explode(copies).alias("__halo")).withColumns({
        "__bucket": F.floor((F.col("__rn") - 1) / bucket_rows).cast("long") + F.col("__halo"), **xs})
    stats = [f"{c}_rolling_{s}" for c in columns for s in ("mean", "std")]
    out = T.StructType([f for f in df.schema.fields if f.name not in stats]
                       + [T.StructField(s, T.DoubleType()) for s in stats])
    kept = [f.name for f in out.fields[:-len(stats)]]

    def rolled(rows: pa.Table) -> pa.Table:
        return _rolled_bucket(rows, kept, stats, w)

    return _zscores(dealt.groupBy(*[F.col(f"`{k}`") for k in keys], "__bucket").applyInArrow(rolled, out), columns, eps)


def frame_stats(x: np.ndarray, valid: np.ndarray, w: int, place: np.ndarray | None = None):
    """(rows counted, mean, sum of squared deviations) of the last ``w`` rows at each
    row, by the steps of Spark's ``avg`` and ``stddev_samp`` over that frame, in
    their order: the same doubles. Step d takes the row d places back, for all rows.
    ``place``: of each row in its entity, from 0, where rows of several lie end to end."""
    n, total, mean, m2 = (np.zeros(len(x)) for _ in range(4))
    whole = place is None and bool(valid.all())
    with np.errstate(all="ignore"):
        for d in range(min(w, len(x)) - 1, -1, -1):
            v, ok = x[:len(x) - d], valid[:len(x) - d]
            if place is not None:
                ok = ok & (place[d:] >= d)
            n[d:] += ok
            if whole:
                total[d:] += v
                delta = v - mean[d:]
                step = delta / n[d:]
            else:
                total[d:] += np.where(ok, v, 0.0)
                delta = np.where(ok, v - mean[d:], 0.0)
                step = delta / np.maximum(n[d:], 1.0)
            mean[d:] += step
            m2[d:] += delta * (delta - step)
        return n, total / n, m2


def _rolled_bucket(rows: pa.Table, kept: list[str], stats: list[str], w: int) -> pa.Table:
    rows = rows.take(np.argsort(rows["__rn"].to_numpy(), kind="stable"))
    own = rows["__halo"].to_numpy() == 0
    out = [rows[c].filter(pa.array(own)) for c in kept]
    for i in range(len(stats) // 2):
        col = rows[f"__x{i}"].combine_chunks()
        n, mean, m2 = frame_stats(col.fill_null(0.0).to_numpy(zero_copy_only=False),
                                  col.is_valid().to_numpy(zero_copy_only=False), w)
        with np.errstate(all="ignore"):
            std = np.sqrt(m2 / (n - 1))
        out += [pa.array(mean[own], mask=n[own] == 0), pa.array(std[own], mask=n[own] < 2)]
    return pa.table(out, names=kept + stats)


def _rolling_cols(df: DataFrame, columns, win, eps) -> DataFrame:
    exprs = {}
    for c in columns:
        x = F.col(c).cast("double")
        mean = F.avg(x).over(win)
        std = F.stddev_samp(x).over(win)
        exprs[f"{c}_rolling_mean"] = mean
        exprs[f"{c}_rolling_std"] = std
    return _zscores(df.withColumns(exprs), columns, eps)


def _zscores(df: DataFrame, columns, eps) -> DataFrame:
    return df.withColumns({
        f"{c}_zscore": (F.col(c).cast("double") - F.col(f"{c}_rolling_mean"))
        / (F.col(f"{c}_rolling_std") + F.lit(eps)) for c in columns})

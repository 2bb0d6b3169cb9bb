"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, scratch_path, scratch_scope  # noqa: F401  (re-used by the operators)

# Internal row number. Operators pick the columns they need before they add it,
# so a caller's column of any ordinary name cannot clash with it.
RID = "__tw_rid"

# A side is broadcast only when its counted rows stay below this many bytes;
# above it the same join runs as a shuffle join.
BROADCAST_BYTES = 48 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_row_id(df: DataFrame) -> DataFrame:
    """Add a row number that a second scan of the same files repeats (partition
    and place in it). Frames that are not file scans: cut their lineage first."""
    return df.withColumn(RID, F.monotonically_increasing_id())


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is under ``limit``;
    else as it is, for a shuffle join. ``df`` must be cheap to count (a saved
    table)."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def mix64(x):
    """SplitMix64 finaliser over a numpy uint64 array (wraps silently)."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(n: int, seed: int):
    """n odd uint32 multipliers and n uint32 masks from a seed."""
    import numpy as np
    base = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(seed))
    v = (base >> np.uint64(32)).astype(np.uint32)
    return v[:n] | np.uint32(1), v[n:]


def segment_minhash(h, starts, mult, mask):
    """MinHash of hash segments: ``h`` uint32 hashes, segment i from starts[i]
    to starts[i + 1] (each not empty). Returns a (segments, k) uint32 array.
    Worked in slices that stay in cache."""
    import numpy as np
    n, k = len(starts), len(mult)
    out = np.empty((n, k), np.uint32)
    ends = np.append(starts[1:], len(h))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + 65536, "right")))
        part, at = h[starts[i]:ends[j - 1]], starts[i:j] - starts[i]
        buf = np.empty_like(part)
        for c in range(k):
            np.multiply(np.bitwise_xor(part, mask[c], out=buf), mult[c], out=buf)
            out[i:j, c] = np.minimum.reduceat(buf, at)
        i = j
    return out


SLICE = 512             # rows of texts that a task has as Python objects


def slices(batches, rows: int = SLICE):
    """The rows of Arrow batches, so many at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def give_back():
    """Return the memory that this process has freed to the system."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc has it
    if trim:
        trim(0)


def lean(run):
    """``run`` (Arrow batches -> Arrow batches), after which the Python worker,
    which outlives its task, keeps nothing that the task has freed."""
    def task(batches):
        yield from run(batches)
        give_back()
    return task


PAIRS = 4096            # sets or pairs of sets in one sort: 12 bits of number, 52 of hash


def spread(starts, counts):
    """Places of the elements of segments, end to end."""
    import numpy as np
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def distinct_sets(h, counts):
    """Segments of 64-bit hashes -> (52-bit hashes, counts): each once in a segment."""
    import numpy as np
    flat, n, at = [], [], 0
    for lo in range(0, len(counts), PAIRS):
        some = counts[lo:lo + PAIRS]
        key = np.sort(np.repeat(np.arange(len(some), dtype=np.uint64) << np.uint64(52), some)
                      | (h[at:at + some.sum()] >> np.uint64(12)))
        at += some.sum()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        key = key[new]
        flat.append(key & np.uint64((1 << 52) - 1))
        n.append(np.bincount((key >> np.uint64(52)).astype(np.int64), minlength=len(some)))
    return np.concatenate(flat), np.concatenate(n)


def similar(sets, counts, a, b, percent, most=2_000_000):
    """Pairs (a[i], b[i]) of ``distinct_sets`` -> 100 * intersection - percent *
    union; far below 0 for pairs that the set sizes rule out. Pairs are worked in sorts of ``most`` hashes or one pair."""
    import numpy as np
    starts = np.cumsum(counts) - counts
    n, m = counts[a], counts[b]
    out = np.full(len(a), -1 << 40, np.int64)
    fit = np.flatnonzero(100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    total = np.cumsum(n[fit] + m[fit])
    lo = 0
    while lo < len(fit):
        before = total[lo - 1] if lo else 0
        hi = min(lo + PAIRS, max(lo + 1, int(np.searchsorted(total, before + most, "right"))))
        some = fit[lo:hi]
        number = np.arange(len(some), dtype=np.uint64) << np.uint64(52)
        key = np.sort(np.concatenate([
            np.repeat(number, n[some]) | sets[spread(starts[a[some]], n[some])],
            np.repeat(number, m[some]) | sets[spread(starts[b[some]], m[some])]]))
        both = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(52)).astype(np.int64), minlength=len(some))
        out[some] = 100 * both - percent * (n[some] + m[some] - both)
        lo = hi
    return out


def band_keys(sig, rows: int):
    """(n, k) signature -> (n, k / rows) int64 bucket keys; the band number is
    part of the key."""
    import numpy as np
    n, k = sig.shape
    out = np.empty((n, k // rows), np.int64)
    with np.errstate(over="ignore"):
        for b in range(k // rows):
            acc = np.full(n, np.uint64(b + 1) * np.uint64(0x9E3779B97F4A7C15), np.uint64)
            for c in range(b * rows, (b + 1) * rows):
                acc = mix64(acc ^ sig[:, c].astype(np.uint64))
            out[:, b] = acc.view(np.int64)
    return out


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered; emptied when it grows large."""

    LIMIT = 200_000

    def __missing__(self, word):
        import xxhash
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

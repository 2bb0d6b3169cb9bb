"""MinHash near-duplicate documents with odd sketches.

Documents with the same shingle set are one class. Class signatures are banded
into buckets; every bucket is a star around its smallest class, so a bucket
costs a row a member however large it is. Pairs whose odd sketches rule out the
threshold go; the rest are confirmed on full shingle sets. Buckets that still
hold two components after that get new pivots, and in the end are compared in
blocks, where sketches screen and full sets decide.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F, types as T

from .common import (RID, WordHashes, band_keys, cut_lineage, lean, mix64, odd_multipliers,
                     scratch_scope, segment_minhash, sized, slices, with_row_id)
from .components import settle, spanning_links

SHINGLE = 5
THRESHOLD = 75          # percent
BANDS, ROWS = 24, 4     # recall of a pair at the threshold: 1 - (1 - 0.75^4)^24 = 0.9999
SKETCH_BITS = 512
# A pair goes if its sketch estimate is so far under the threshold; 0.25 is over
# five standard deviations of the estimate at the threshold.
MARGIN = 0.25
BLOCK = 256             # members in a block of the second round

# A-Z go to a-z.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()      # at \x20 and \x09-\x0D


def shingle_hashes(words, cache, size=SHINGLE):
    """Distinct 64-bit hashes of the word shingles of one text, sorted."""
    import numpy as np
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    acc = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        acc = mix64(acc + h[k:len(h) - n + 1 + k])
    return np.unique(acc)


def odd_sketches(sig, bits=SKETCH_BITS):
    """(n, k) MinHash samples -> (n, bits / 64) uint64 parity bitmaps: sample
    (i, value) flips the bit it hashes to."""
    import numpy as np
    n, k = sig.shape
    place = mix64(sig.astype(np.uint64) + (np.arange(k, dtype=np.uint64) << np.uint64(32))) % np.uint64(bits)
    out = np.zeros((n, bits // 64), np.uint64)
    row = np.arange(n)
    for i in range(k):
        out[row, (place[:, i] >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (place[:, i] & np.uint64(63))
    return out


def most_differing_bits(k, threshold, margin=MARGIN, bits=SKETCH_BITS) -> int:
    """XOR population count at which the estimated similarity
    1 + bits / (4 k) ln(1 - 2 count / bits) falls to threshold - margin."""
    least = threshold / 100 - margin
    return int(bits / 2 * (1 - math.exp(-4 * k * (1 - least) / bits)))


def _profile(batches, bands, rows, bits, size):
    """Arrow rows (rid, doc_id, text) -> set size, set digest, bucket keys, sketch."""
    import numpy as np
    import pyarrow as pa
    import xxhash
    mult, mask = odd_multipliers(bands * rows, 7)
    cache = WordHashes()
    for some in slices(batches):
        part = [shingle_hashes(words_of(t or b""), cache, size)
                for t in some.column("text").cast(pa.binary()).to_pylist()]
        n = np.array([len(p) for p in part], np.int64)
        full = np.flatnonzero(n)
        keys, sketch = [None] * len(part), [None] * len(part)
        if len(full):
            flat = np.concatenate([part[i] for i in full])
            starts = np.concatenate(([0], np.cumsum(n[full])[:-1]))
            sig = segment_minhash((flat >> np.uint64(32)).astype(np.uint32), starts, mult, mask)
            kk, ss = band_keys(sig, rows), odd_sketches(sig, bits)
            for j, i in enumerate(full):
                keys[i], sketch[i] = kk[j], ss[j].tobytes()
        digest = [xxhash.xxh128_intdigest(p.tobytes()) if len(p) else None for p in part]
        high = [None if d is None else (d >> 64) - (1 << 63) for d in digest]
        low = [None if d is None else (d & ((1 << 64) - 1)) - (1 << 63) for d in digest]
        yield pa.RecordBatch.from_arrays(
            [some.column(RID), some.column("doc_id"), pa.array(n),
             pa.array(high, pa.int64()), pa.array(low, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
            [RID, "doc_id", "n", "d1", "d2", "keys", "sketch"])


def profiles(docs: DataFrame, bands=BANDS, rows=ROWS, bits=SKETCH_BITS, size=SHINGLE) -> DataFrame:
    base = with_row_id(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return base.select(RID, "doc_id", "text").mapInArrow(
        lean(lambda it: _profile(it, bands, rows, bits, size)),
        f"{RID} bigint, doc_id {id_type}, n bigint, d1 bigint, d2 bigint, keys array<bigint>, sketch binary")


def _near_sketches(batches, most):
    """Pairs with both sketches -> those that may reach the threshold."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        if not batch.num_rows:
            continue
        a = np.frombuffer(b"".join(batch.column("s1").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
        b = np.frombuffer(b"".join(batch.column("s2").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
        ok = np.bitwise_count(a ^ b).sum(axis=1) <= most
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def _confirm(batches, percent, size):
    """Pairs with both texts -> whether their full shingle sets reach the
    threshold. Sets are of words, not of hashes."""
    import pyarrow as pa
    last, last_set = None, None

    def shingles(text):
        w = words_of(text or b"")
        n = min(size, len(w))
        return set(zip(*(w[k:len(w) - n + 1 + k] for k in range(n)))) if n else set()

    for batch in slices(batches):
        ok = []
        for x, y in zip(batch.column("t1").cast(pa.binary()).to_pylist(),
                        batch.column("t2").cast(pa.binary()).to_pylist()):
            if y != last:
                last, last_set = y, shingles(y)
            one = shingles(x)
            both = len(one & last_set)
            ok.append(100 * both >= percent * (len(one) + len(last_set) - both) and both > 0)
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def confirmed_links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, most: int,
                    size: int) -> DataFrame:
    """Candidate class pairs (a, b) -> the linked ones. Sizes and sketches rule
    pairs out first; texts are then fetched only for classes still in a pair."""
    side = lambda c, s, n: classes.select(F.col("cid").alias(c), F.col("sketch").alias(s), F.col("n").alias(n))
    near = (pairs.join(side("a", "s1", "n1"), "a").join(side("b", "s2", "n2"), "b")
            .where(f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)")
            .select("a", "b", "s1", "s2").mapInArrow(lean(lambda it: _near_sketches(it, most)), "a bigint, b bigint"))
    near = cut_lineage(near, "near")
    wanted = cut_lineage(near.select(F.explode(F.array("a", "b")).alias(RID)).distinct(), "wanted")
    base = with_row_id(docs.select(F.col("text").cast("string").alias("text")))
    texts = cut_lineage(base.join(sized(wanted, 16), RID, "left_semi"), "texts")
    t1 = texts.select(F.col(RID).alias("a"), F.col("text").alias("t1"))
    t2 = texts.select(F.col(RID).alias("b"), F.col("text").alias("t2"))
    return cut_lineage(near.join(t1, "a").join(t2, "b").select("a", "b", "t1", "t2")
                       .mapInArrow(lean(lambda it: _confirm(it, percent, size)), "a bigint, b bigint"), "links")


def _block_links(frame, percent, most):
    """Links of one task of the last round, on full sets of 64-bit shingle hashes."""
    import numpy as np
    import pandas as pd
    if not len(frame):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sets = frame["hashes"].to_list()
    n = np.array([len(x) for x in sets])
    sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(len(frame), -1)

    def near(a, b):
        ok = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        return ok & (np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1) <= most)

    def same(a, b):
        both = np.array([len(np.intersect1d(sets[r], sets[q], assume_unique=True)) for r, q in zip(a, b)])
        return 100 * both >= percent * (n[a] + n[b] - both)

    return pd.DataFrame(spanning_links(frame, same, near), columns=["a", "b"], dtype="int64")


def _hash_rows(batches, size):
    import numpy as np
    import pyarrow as pa
    cache = WordHashes()
    for batch in slices(batches):
        got = [shingle_hashes(words_of(t or b""), cache, size).view(np.int64)
               for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(RID), pa.array(got, pa.list_(pa.int64()))],
                                         ["node", "hashes"])


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    bits: int = SKETCH_BITS, size: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> row number, doc_id, n_shingles,
    component_id (smallest doc_id of the component), kept.

    Texts that share a set are one class from the start (also copies and
    repeated rows), so groups of copies are never expanded. A null text or one
    without words is alone and kept. In a component, the smallest doc_id is
    kept; rows that repeat it: the first of them. Null doc_ids are larger than
    all others. Read more than once: pass a frame read from files.
    """
    prof = cut_lineage(profiles(docs, bands, rows, bits, size), "profiles")
    full = prof.where("n > 0")
    classes = cut_lineage(
        full.groupBy("d1", "d2").agg(F.min(RID).alias("cid"), F.min("n").alias("n"),
                                     F.count("*").alias("members")), "classes")
    reps = cut_lineage(full.join(sized_semi(classes), F.col(RID) == F.col("cid"), "left_semi")
                       .select(F.col(RID).alias("cid"), "n", "keys", "sketch"), "reps")
    entries = reps.select(F.explode("keys").alias("key"), "cid")
    stars = cut_lineage(entries.groupBy("key").agg(
        F.min("cid").alias("lo"), F.max("cid").alias("hi"), F.count("*").alias("m")).where("m > 1"), "stars")
    wide = stars.where("m > 2")
    inside = cut_lineage(entries.join(sized(wide.select("key", "lo"), 32), "key"), "inside")
    pairs = stars.where("m = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(
        inside.where("cid <> lo").select(F.col("cid").alias("a"), F.col("lo").alias("b")))
    pairs = cut_lineage(pairs.distinct(), "pairs")
    most = most_differing_bits(bands * rows, percent, MARGIN, bits)
    links = confirmed_links(pairs, reps, docs, percent, most, size)

    def finish(rows):
        wanted = cut_lineage(rows.select(F.col("node").alias(RID)).distinct(), "wanted")
        base = with_row_id(docs.select(F.col("text").cast("string").alias("text")))
        hashes = (base.join(sized(wanted, 16), RID, "left_semi").select(RID, "text")
                  .mapInArrow(lean(lambda it: _hash_rows(it, size)), "node bigint, hashes array<bigint>"))
        own = cut_lineage(reps.select(F.col("cid").alias("node"), "keys", "sketch").join(hashes, "node"), "own")
        return (rows.join(own, "node").groupBy("task")
                .applyInPandas(lambda f: _block_links(f, percent, most), "a bigint, b bigint"))

    comp = settle(inside.select("key", F.col("cid").alias("node")), pairs, links,
                  lambda p: confirmed_links(p, reps, docs, percent, most, size), finish, block)
    # back to documents: class -> component -> smallest doc_id
    of_class = classes.join(comp.withColumnRenamed("node", "cid"), "cid", "left").select(
        "d1", "d2", F.coalesce("component", "cid").alias("component"))
    rows_ = cut_lineage(full.select(RID, "doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"])
                        .select(RID, "doc_id", "n", "component"), "rows")
    first = rows_.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(RID))).alias("f"))
    some = rows_.join(first, "component").select(
        RID, "doc_id", F.col("n").alias("n_shingles"), F.col("f.doc_id").alias("component_id"),
        (F.col(RID) == F.col(f"f.{RID}")).alias("kept"))
    alone = prof.where("n = 0").select(
        RID, "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(True).alias("kept"))
    return some.unionByName(alone)


def sized_semi(classes: DataFrame) -> DataFrame:
    return sized(classes.select("cid"), 16)


def near_rows(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id",
        F.expr("doc_id <=> component_id").alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the same columns and one document of each component."""
    with scratch_scope(docs.sparkSession) as scope:
        gone = scope.save(near_duplicates(docs, **options).where("NOT kept").select(RID), "gone")
    return with_row_id(docs).join(sized(gone, 16), RID, "left_anti").drop(RID)

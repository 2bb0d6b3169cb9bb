"""Benchmark decontamination: a broadcast set of hashed test windows, scanned
over the word windows of every training text and verified word by word."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F, types as T

from .common import RID, cut_lineage, lean, mix64, slices, with_row_id

WINDOW = 10
# Benchmark text is broadcast in blocks of at most so many bytes; more blocks
# mean more scans of the documents, never a larger broadcast.
BLOCK_BYTES = 32 << 20

# A-Z go to a-z; bytes that part words become spaces.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else
               b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text (every byte of a character past ASCII is one of a word)."""
    return text.translate(_TABLE).split()


class Windows:
    """The windows of one block of items: word numbers, and for each window
    length the sorted hashes, the windows behind each and the items of each."""

    def __init__(self, items, size=WINDOW):
        import numpy as np
        self.ids: dict[bytes, int] = {}
        by_len: dict[int, dict[tuple, set]] = {}
        for item_id, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text)]
            n = min(size, len(w))
            for at in range(len(w) - n + 1 if n else 0):
                by_len.setdefault(n, {}).setdefault(tuple(w[at:at + n]), set()).add(item_id)
        self.by_len = {}
        for n, windows in by_len.items():
            keys = list(windows)
            h = roll(np.array(keys, np.uint64), n, rows=True)
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[(h >> np.uint64(44)).astype(np.int64)] = True
            self.by_len[n] = (h[order], bits, [keys[i] for i in order], [windows[keys[i]] for i in order])

    def occurrences(self, numbers):
        """(position, length, item ids) of each window that occurs in an array
        of word numbers (0: a word in no item)."""
        import numpy as np
        for n, (hashes, bits, keys, items) in self.by_len.items():
            if len(numbers) < n:
                continue
            h = roll(numbers, n)
            for at in np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)]):
                lo = int(np.searchsorted(hashes, h[at]))
                while lo < len(hashes) and hashes[lo] == h[at]:
                    if tuple(numbers[at:at + n].tolist()) == keys[lo]:   # verified
                        yield int(at), n, items[lo]
                        break
                    lo += 1


def roll(numbers, n, rows=False):
    """64-bit hash of every n consecutive word numbers (or of every row)."""
    import numpy as np
    count = len(numbers) if rows else len(numbers) - n + 1
    h = np.zeros(count, np.uint64)
    for k in range(n):
        part = numbers[:, k] if rows else numbers[k:k + count]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += part
    return mix64(h)


def _scan(batches, block, carry):
    """Arrow rows (rid, text) -> (rid, n_words, hits, items) of one block."""
    import numpy as np
    import pyarrow as pa
    windows = Windows(block.value)
    get = windows.ids.get
    from itertools import repeat
    schema = pa.schema([(RID, pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))),
                        ("items", pa.list_(pa.string()))])
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        n_words, hits, items = [], [], []
        for text in texts:
            w = words_of(text or b"")
            numbers = np.fromiter(map(get, w, repeat(0)), np.uint64, len(w))
            found, who = [], set()
            for at, n, ids in windows.occurrences(numbers):
                found.append((at, at + n))
                who |= ids
            merged = []
            for a, b in sorted(found):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            n_words.append(len(w))
            hits.append(merged)
            items.append(sorted(str(x) for x in who if x is not None))
        out = [batch.column(RID), pa.array(n_words, pa.int64()),
               pa.array(hits, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))]
        if carry:
            out.insert(1, batch.column("doc_id"))
        yield pa.RecordBatch.from_arrays(
            out, [RID, *(["doc_id"] if carry else []), "n_words", "hits", "items"])


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark as lists of (item_id, text bytes), each list bounded in
    bytes; read from the cluster partition by partition."""
    rows = benchmark.select(F.col("item_id"), F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    block, size = [], 0
    for r in rows.where("text IS NOT NULL").toLocalIterator():
        text = bytes(r["text"])
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], text))
        size += len(text) + 64
    yield block


def scan_hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` -> doc_id, n_words,
    hits (merged word ranges, end exclusive), items (sorted ids of the items
    with an occurring window).

    A benchmark of one block is one pass. A larger one is one pass a block; the
    passes' rows are merged by row number. Null texts have no words; an item
    with null id marks its words as hit but is in no list; repeated rows and
    items count as they stand; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    base = with_row_id(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"{RID} bigint, doc_id {id_type}, n_words bigint, hits array<array<bigint>>, items array<string>")
    passes = []
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        passes.append(base.select(RID, "doc_id", "text").mapInArrow(
            lean(lambda it, b=shared: _scan(it, b, True)), schema))
        if len(passes) > 1:
            passes[-1] = cut_lineage(passes[-1].where("size(hits) > 0"), "hits")
    if len(passes) == 1:
        return passes[0].drop(RID)
    more = passes[1]
    for p in passes[2:]:
        more = more.unionByName(p)
    more = more.groupBy(RID).agg(F.flatten(F.collect_list("hits")).alias("hits2"),
                                 F.flatten(F.collect_list("items")).alias("items2"))
    both = passes[0].join(more, RID, "left")
    hits = F.expr("""aggregate(array_sort(concat(hits, coalesce(hits2, array()))),
        cast(array() AS array<array<bigint>>),
        (a, x) -> if(size(a) > 0 AND x[0] <= element_at(a, -1)[1],
            concat(slice(a, 1, size(a) - 1),
                   array(array(element_at(a, -1)[0], greatest(x[1], element_at(a, -1)[1])))),
            concat(a, array(x))))""")
    return both.select("doc_id", "n_words", hits.alias("hits"), F.array_sort(F.array_distinct(
        F.concat("items", F.coalesce("items2", F.array().cast("array<string>"))))).alias("items"))


def contamination_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts and digests of ``scan_hits``."""
    got = scan_hits(docs, benchmark)
    n_hit = F.expr("aggregate(hits, 0L, (a, x) -> a + x[1] - x[0])")
    return got.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def _filtered(batches, block, mode):
    """Batches of all columns with contaminated rows gone, or with the hit words
    cut out of ``text``."""
    import re

    import numpy as np
    import pyarrow as pa
    from itertools import repeat
    windows = Windows(block.value)
    get = windows.ids.get
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for batch in slices(batches):
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).cast(pa.binary()).to_pylist()
        keep, new = [], []
        for text in texts:
            w = words_of(text or b"")
            found = list(windows.occurrences(np.fromiter(map(get, w, repeat(0)), np.uint64, len(w))))
            keep.append(not found)
            if found and mode == "spans":
                places = [m.span() for m in word.finditer(text.translate(_TABLE))]
                gone = bytearray(len(text))
                for p, n, _ in found:
                    a, b = places[p][0], places[p + n - 1][1]
                    gone[a:b] = b"\1" * (b - a)
                text = bytes(c for c, g in zip(text, gone) if not g)
            new.append(text)
        if mode == "documents":
            yield batch.filter(pa.array(keep, pa.bool_()))
        else:
            cols = list(batch.columns)
            cols[at] = pa.array(new, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the same columns and without contaminated documents (mode
    "documents"), or with every hit span cut out of their text ("spans"). No
    shuffle: one pass over the rows for each block of the benchmark."""
    if mode not in ("documents", "spans"):
        raise ValueError(mode)
    out = docs
    for block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        out = out.mapInArrow(lean(lambda it, b=shared: _filtered(it, b, mode)), T.StructType(docs.schema.fields))
    return out

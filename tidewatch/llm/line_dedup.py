"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard
verification and union-find; one line of each component stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import (BROADCAST_BYTES, RID, band_keys, cut_lineage, distinct_sets, lean, mix64, odd_multipliers,
                     scratch_scope, similar, sized, spread, with_row_id)
from .components import settle, spanning_links

SHINGLE = 8             # characters
THRESHOLD = 80          # percent
BANDS, ROWS = 8, 3      # recall of a pair at the threshold: 1 - (1 - 0.8^3)^8 = 0.997


BLOCK = 128             # lines in a block of the second round
SCREEN = 64             # MinHash samples that screen the pairs of that round
MARGIN = 25             # percent under the threshold: five standard deviations
SEEN = 500_000          # hashes a task remembers to sign a line once
CHUNK = 1 << 18         # bytes of text hashed at once
PARTS = 4096            # of the bucket keys, for the filter of keys that one line has
PACKED = 400_000        # rows that a task packs by part at once
HELD = 2_000_000        # rows of a part that the filter holds, 32 MB; a larger part passes whole


def _signatures(batches, bands, rows, size):
    """Arrow rows (h, line) -> (part, rows): (key, h), a row a bucket of each line
    that the task has not signed before, packed by part of the keys."""
    import numpy as np
    import pyarrow as pa
    mult, mask = odd_multipliers(bands * rows, 11)
    seen: set[int] = set()
    held, n = [], 0
    for batch in batches:
        places = dict(zip(batch.column("h").to_pylist(), range(batch.num_rows)))
        some = batch.take(pa.array([i for h, i in places.items() if h not in seen], pa.int64()))
        if len(seen) >= SEEN:
            seen.clear()
        seen.update(places)
        keys = sign(some.column("line"), mult, mask, rows, size)
        held.append(np.stack([keys.ravel(), np.repeat(some.column("h").to_numpy(), bands)], 1))
        n += len(held[-1])
        if n >= PACKED:
            yield _packed(held)
            held, n = [], 0
    if n:
        yield _packed(held)


def _packed(held):
    import numpy as np
    import pyarrow as pa
    pairs = np.concatenate(held)
    part = (pairs[:, 0] & (PARTS - 1)).astype(np.uint16)
    parts, count = np.unique(part, return_counts=True)
    ends = np.append(0, np.cumsum(count) * 16).astype(np.int32)
    data = pairs[np.argsort(part, kind="stable")].tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()),
         pa.BinaryArray.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(data)])],
        ["part", "rows"])


def _shared(batches):
    """Arrow rows (part, rows), by part -> rows (key, h) without those whose key one
    line alone has. A part of more than HELD rows passes whole."""
    import numpy as np
    import pyarrow as pa

    def unpacked(held):
        return np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[:, c].copy()) for c in (0, 1)], ["key", "h"])

    def filtered(held):
        rows = unpacked(held)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
        rows = rows[new]
        same = np.append(rows[1:, 0] == rows[:-1, 0], False)
        same[1:] |= same[:-1].copy()
        return out(rows[same])

    held, n, now, whole = [], 0, None, False
    for batch in batches:
        for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist()):
            if part != now:
                if held:
                    yield out(unpacked(held)) if whole else filtered(held)
                held, n, now, whole = [], 0, part, False
            held.append(rows)
            n += len(rows) // 16
            if n > HELD:
                yield out(unpacked(held))
                held, n, whole = [], 0, True
    if held:
        yield out(unpacked(held)) if whole else filtered(held)


def sign(lines, mult, mask, rows, size):
    """Bucket keys of Arrow strings, none empty."""
    return band_keys(minhashes(lines, mult, mask, size), rows)


def minhashes(lines, mult, mask, size):
    """MinHash signatures of Arrow strings, none empty."""
    import numpy as np
    out, lo = np.empty((len(mult), len(lines)), np.uint32), 0
    for h, first, count, n in rolling_hashes(lines, size):
        h >>= np.uint64(32)
        h = h.astype(np.uint32)
        # shingles of a line, and those over its end, whose minimum is not taken
        at, buf = np.stack([first, first + count], 1).ravel(), np.empty_like(h)
        for k in range(len(mult)):
            np.multiply(np.bitwise_xor(h, mask[k], out=buf), mult[k], out=buf)
            out[k, lo:lo + len(n)] = np.minimum.reduceat(buf, at)[::2]
        lo += len(n)
    return out.T


def shingle_hashes(lines, size):
    """64-bit hashes of the shingles of Arrow strings, none empty, end to end, and
    the count of each line."""
    import numpy as np
    flat, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for h, first, count, n in rolling_hashes(lines, size):
        inside = np.ones(len(h), bool)
        inside[spread(first + count, n - count)] = inside[-1] = False
        flat.append(h[inside])
        counts.append(count)
    return np.concatenate(flat), np.concatenate(counts)


def rolling_hashes(lines, size):
    """Chunks of Arrow strings, none empty, as (hashes, first, count, n): 64-bit
    hashes of the shingles from each code point on and of one place more, and where
    each line begins, its count of shingles and its length. Shingles that run over a
    line's end are hashed too; a line shorter than a shingle is one shingle."""
    import numpy as np
    import xxhash
    for raw, ends in chunks(lines):
        n = np.diff(ends, prepend=0)
        cp = raw
        if raw.max() > 127:
            cp = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            n = np.diff(np.cumsum((raw & 0xC0) != 0x80)[ends - 1], prepend=0)
        part = np.zeros(len(cp) + size, np.uint64)
        part[:len(cp)] = cp
        if size & (size - 1):
            acc = np.zeros(len(cp) + 1, np.uint64)
            for k in range(size):
                acc *= np.uint64(0x9E3779B97F4A7C15)
                acc += part[k:k + len(acc)]
        else:       # the same sum, by doubling
            acc, power, k = part, 0x9E3779B97F4A7C15, 1
            while k < size:
                part = acc[:-k] * np.uint64(power)
                part += acc[k:]
                acc, power, k = part, power * power % (1 << 64), 2 * k
        count = np.maximum(n - size + 1, 1)
        first = np.cumsum(n) - n
        for i in np.flatnonzero(n < size):
            acc[first[i]] = np.uint64(xxhash.xxh64_intdigest(raw[ends[i - 1] if i else 0:ends[i]].tobytes()))
        yield mix64(acc), first, count, n


def chunks(lines):
    """Arrow strings -> (UTF-8 bytes, ends of the lines in them) of some CHUNK bytes,
    at least a line."""
    import numpy as np
    import pyarrow as pa
    lines = lines.cast(pa.large_string())
    if not len(lines):
        return
    _, offsets, data = lines.buffers()
    at = np.frombuffer(offsets, np.int64)[lines.offset:lines.offset + len(lines) + 1]
    raw, lo = np.frombuffer(data, np.uint8), 0
    while lo < len(lines):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK, "right")) - 1)
        yield raw[at[lo]:at[hi]], at[lo + 1:hi + 1] - at[lo]
        lo = hi


class LineSets:
    """Shingle sets of lines, compared in pairs by 52-bit hashes; pairs so close
    to the threshold that a collision could decide are compared as strings."""

    def __init__(self, lines, size):
        import pyarrow as pa
        self.lines, self.size = lines if isinstance(lines, pa.Array) else pa.array(lines, pa.large_string()), size
        self.sets, self.counts = distinct_sets(*shingle_hashes(self.lines, size))

    def shingles(self, r):
        t = self.lines[int(r)].as_py()
        return {t[i:i + self.size] for i in range(max(1, len(t) - self.size + 1))}

    def same(self, a, b, percent):
        import numpy as np
        over = similar(self.sets, self.counts, a, b, percent)
        ok = over >= 0
        for k in np.flatnonzero(np.abs(over) <= 2 * (100 + percent)):
            one, other = self.shingles(a[k]), self.shingles(b[k])
            both = len(one & other)
            ok[k] = 100 * both >= percent * (len(one) + len(other) - both)
        return ok


def _confirm(batches, percent, size):
    """Pairs (a, b, t1, t2) of lines -> those that reach the threshold."""
    import pyarrow as pa
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            some = batch.slice(lo, 2048)
            both = pa.chunked_array([some.column("t1"), some.column("t2")]).combine_chunks()
            yield some.select(["a", "b"]).filter(pa.array(
                _same(both, _numbers(some, "a", "b"), percent, size), pa.bool_()))


def _numbers(table, *names):
    import numpy as np
    return np.concatenate([table.column(c).to_numpy() for c in names])


def _same(lines, nodes, percent, size):
    """Pairs of the first and the second half of ``lines`` (by hash ``nodes``) ->
    mask of those that reach the threshold; each line is hashed once."""
    import numpy as np
    import pyarrow as pa
    _, at, place = np.unique(nodes, return_index=True, return_inverse=True)
    a, b = place.reshape(2, -1)
    return LineSets(lines.take(pa.array(at)), size).same(a, b, percent)


def _block_links(table, percent, bands, rows, size):
    """Links of one task of the last round, on full shingle sets of the pairs that
    the screen leaves."""
    import numpy as np
    import pyarrow as pa
    frame = table.drop_columns(["line"]).to_pandas()
    _, at, place = np.unique(frame["node"].to_numpy(), return_index=True, return_inverse=True)
    lines = table.column("line").combine_chunks().take(pa.array(at))
    mult, mask = (np.concatenate(x) for x in zip(odd_multipliers(SCREEN, 13), odd_multipliers(bands * rows, 11)))
    sig = minhashes(lines, mult, mask, size)
    keys, sig = band_keys(sig[:, SCREEN:], rows), np.ascontiguousarray(sig[:, :SCREEN])

    def same(a, b):
        both = np.concatenate([place[a], place[b]])
        return _same(lines.take(pa.array(both)), both, percent, size)

    links = spanning_links(
        frame.assign(keys=[*keys[place]]), same,
        lambda a, b: 100 * (sig[place[a]] == sig[place[b]]).sum(axis=1) >= (percent - MARGIN) * SCREEN)
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def lines_of(docs: DataFrame) -> DataFrame:
    """Row number, doc_id, line_no and line (lower case, trimmed) of each line
    with anything but spaces, with its 64-bit hash h."""
    base = with_row_id(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    return (base.select(RID, "doc_id", F.posexplode(F.split(F.lower("text"), "\n", -1)).alias("line_no", "line"))
            .withColumn("line", F.trim("line")).where("line <> ''")
            .withColumn("h", F.xxhash64("line")))


def duplicate_lines(docs: DataFrame, percent: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    size: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per line that is not blank: row
    number, doc_id, line_no, h, component (of lines by hash), kept.

    Lines are compared in lower case and without spaces at their ends. Equal
    lines are one node; nodes are linked where the Jaccard similarity of their
    character shingles reaches ``percent``, and of each component the line that
    comes first by doc_id, row and place stays. Blank lines and null texts take
    no part. Equal lines are told by a 64-bit hash. Buckets are stars around
    their smallest node: a hot one costs a row a distinct line. Buckets that
    then still hold two components get other pivots, and in the end are compared
    in blocks. ``docs`` is read several times: pass a frame that is read from files.
    """
    with scratch_scope(docs.sparkSession) as scope:
        return _marked(docs, percent, bands, rows, size, scope)


def _marked(docs, percent, bands, band_rows, size, scope):
    # the input is read again where texts are needed: only numbers are saved of its lines
    lines = lines_of(docs)
    saved = scope.save(lines.select(RID, "doc_id", "line_no", "h"), "lines")
    # most keys are of one line: those go before the window, whose shuffle what follows groups by too
    bucket = Window.partitionBy("key")
    members = (lines.select("h", "line").mapInArrow(lean(lambda it: _signatures(it, bands, band_rows, size)),
                                                    "part int, rows binary")
               .repartition("part").sortWithinPartitions("part").mapInArrow(lean(_shared), "key bigint, h bigint")
               .withColumn("lo", F.min("h").over(bucket)).withColumn("hi", F.max("h").over(bucket)).where("lo < hi")
               .select("key", "h", "lo").distinct().withColumn("m", F.count("*").over(bucket)))
    members = cut_lineage(members, "members")
    inside = members.where("m > 2")
    pairs = cut_lineage(members.where("h <> lo").select(F.col("h").alias("a"), F.col("lo").alias("b")).distinct(), "pairs")
    wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "wanted")
    texts = cut_lineage(lines.select("h", "line").join(sized(wanted, 16), "h", "left_semi")
                        .groupBy("h").agg(F.first("line").alias("line")), "texts")

    def texts_of(nodes):
        return texts.join(sized(cut_lineage(nodes.distinct(), "some"), 16), "h", "left_semi")

    def confirm(some, texts=None):
        if texts is None:
            texts = texts_of(some.select(F.explode(F.array("a", "b")).alias("h")))
        t1, t2 = (texts.select(F.col("h").alias(c), F.col("line").alias(t)) for c, t in (("a", "t1"), ("b", "t2")))
        return cut_lineage(some.join(t1, "a").join(t2, "b").select("a", "b", "t1", "t2")
                           .mapInArrow(lean(lambda it: _confirm(it, percent, size)), "a bigint, b bigint"), "links")

    def finish(rows):
        # every member of a bucket is in a pair with its first pivot: its text is there
        own = texts_of(rows.select(F.col("node").alias("h"))).withColumnRenamed("h", "node")
        return (rows.join(own, "node").groupBy("task")
                .applyInArrow(lambda t: _block_links(t, percent, bands, band_rows, size), "a bigint, b bigint"))

    comp = settle(inside.select("key", F.col("h").alias("node")), pairs, confirm(pairs, texts), confirm, finish, BLOCK)
    comp = scope.save(comp.withColumnRenamed("node", "h"), "components")
    marked = saved.select(RID, "doc_id", "line_no", "h").join(sized(comp, 24), "h", "left").select(
        RID, "doc_id", "line_no", "h", F.coalesce("component", "h").alias("component"))
    # lines that are alone stay without a join, and a hot component's rows can be split
    first = scope.save(marked.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(RID), F.col("line_no"))).alias("f"),
        F.count("*").alias("n")).where("n > 1").select(
            "component", F.col(f"f.{RID}").alias("__tw_row"), F.col("f.line_no").alias("__tw_line")), "first")
    return marked.join(sized(first, 48), "component", "left").select(
        RID, "doc_id", "line_no", "h", "component",
        (F.col("__tw_row").isNull() | ((F.col(RID) == F.col("__tw_row"))
                                       & (F.col("line_no") == F.col("__tw_line")))).alias("kept"))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank, with its component and whether it stays."""
    return duplicate_lines(docs).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), "component", "kept")


def drop_duplicate_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the same columns, without the lines that repeat an earlier
    one (their line breaks go with them). A document that loses all of its lines
    that are not blank goes; one that had none stays as it is. A column
    ``n_chars`` is kept as it was read."""
    with scratch_scope(docs.sparkSession) as scope:
        gone = scope.save(duplicate_lines(docs, **options).groupBy(RID).agg(
            F.collect_list(F.when(~F.col("kept"), F.col("line_no"))).alias("__tw_gone"),
            F.count("*").alias("__tw_n")).where("size(__tw_gone) > 0"), "gone")
    names = docs.columns
    # where the table of dropped line numbers is small, the texts need no shuffle
    n = gone.agg(F.coalesce(F.sum(F.size("__tw_gone") * 4 + 48), F.lit(0))).first()[0]
    gone = F.broadcast(gone) if n <= BROADCAST_BYTES else gone
    d = with_row_id(docs).join(gone, RID, "left").where(
        "__tw_gone IS NULL OR size(__tw_gone) < __tw_n")
    text = F.when(F.col("__tw_gone").isNull(), F.col("text")).otherwise(F.expr(
        "array_join(filter(split(text, '\\n', -1), (x, i) -> NOT array_contains(__tw_gone, i)), '\\n')"))
    return d.withColumn("text", text).select(*names)

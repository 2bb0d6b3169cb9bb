"""Best-fit packing of tokenised documents into fixed-length sequences by a
grouping genetic algorithm, run as islands over blocks of pieces."""

from __future__ import annotations

import random
import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame, functions as F, types as T

from .common import RID, cut_lineage, lean, slices, with_row_id

CAPACITY = 2048        # ids in a sequence
BLOCK_ITEMS = 4096     # mean pieces in a block, the unit of one genetic search
ISLANDS = 3
EPOCHS = 2             # migrations are between epochs
GENERATIONS = 6
POPULATION = 6
ELITES = 2             # solutions that leave an island for the next one
EOS = 0
CACHED_WORDS = 300_000  # of words and of runs of letters, in a Python worker


# --------------------------------------------------------------- tokenising

class WordIds:
    """Token ids of texts, word by word, with the ids of words remembered.

    White space always parts words in this vocabulary, and so does the step from
    a letter or digit to the ASCII marks that end a word; ASCII letters count in
    lower case. Texts are cut there as one byte buffer and each different word
    is looked up once. New words of letters go straight to the tokenizer's
    merges, many in one text, whose ids are parted at the tokens that end a
    word; any other new word goes through the whole tokenizer.
    """

    # Bytes of white space, of ASCII marks, of ASCII letters and digits.
    SPACE, MARK, PLAIN, OTHER = 0, 1, 2, 3
    LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

    def __init__(self, path):
        import numpy as np
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True      # their strings in a text are ordinary text
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.kind = np.array([
            self.SPACE if b in b" \t\n\r\x0b\x0c" else self.OTHER if b >= 0x80 or b < 0x20 or b == 0x7F
            else self.PLAIN if chr(b).isalnum() else self.MARK for b in range(256)], np.uint8)
        self.words: dict[bytes, bytes] = {}

    def cut(self, texts: list[bytes]):
        """(words as an Arrow array, words of each text) in order."""
        import numpy as np
        import pyarrow as pa
        flat = b" ".join([*texts, b""])
        if b"\xcc" not in flat and b"\xcd" not in flat:     # no combining mark for an ASCII letter
            flat = flat.translate(self.LOWER)
        buf = np.frombuffer(flat, np.uint8)
        kind = self.kind[buf]
        full = kind != self.SPACE
        start = full.copy()
        start[1:] &= ~full[:-1]
        mark = kind == self.MARK
        first, last = mark.copy(), mark.copy()
        first[1:] &= ~mark[:-1]
        last[:-1] &= ~mark[1:]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        first, last = first[first > 1], last[first > 1]
        before = buf[first - 1]
        letter = (kind[first - 1] == self.PLAIN) | (                # or a letter of Latin-1
            (before >= 0x80) & (buf[first - 2] == 0xC3) & (before != 0x97) & (before != 0xB7))
        start[first[letter & ~full[np.minimum(last + 1, len(buf) - 1)]]] = True
        at = np.flatnonzero(start[full])
        body = buf[full]
        words = pa.Array.from_buffers(pa.binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(body)).astype(np.int32)), pa.py_buffer(body)])
        ends = np.cumsum([len(t) + 1 for t in texts])
        return words, np.diff(np.searchsorted(np.flatnonzero(start), ends), prepend=0)

    def of(self, texts: list[bytes]):
        """Ids of the texts, end to end as one uint32 array, and the count of each."""
        import numpy as np
        words, count = self.cut(texts)
        coded = words.dictionary_encode()
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        unique = coded.dictionary.to_pylist()
        got = list(map(self.words.get, unique))
        self.learn([w for w, g in zip(unique, got) if g is None])
        got = [self.words[w] if g is None else g for w, g in zip(unique, got)]
        ids = np.frombuffer(b"".join(got), "<u4")
        size = np.array([len(g) for g in got], np.int64) // 4
        place = np.cumsum(size) - size
        which = coded.indices.to_numpy()
        n = size[which]
        ends = np.cumsum(n)
        out = ids[np.repeat(place[which] - (ends - n), n) + np.arange(n.sum())]
        by_text = np.append(0, ends)[np.cumsum(count)]
        return out, np.diff(by_text, prepend=0)

    def learn(self, words):
        import numpy as np
        keys, runs, alone = [], [], []
        for w in words:
            t = w.decode()
            low = t if t.islower() else t.lower()
            if low.isalpha() and (t.isascii() or (len(low) == len(t) and "\u03c3" not in low and "\u03c2" not in low
                                                  and unicodedata.is_normalized("NFC", low)
                                                  and unicodedata.is_normalized("NFC", t))):
                keys.append(w)
                runs.append(low)
            else:
                alone.append(w)
        parts = [slice(at, at + 100) for at in range(0, len(runs), 100)]
        done = self.merges.encode_batch_fast([" ".join(runs[p]) for p in parts], add_special_tokens=False)
        for p, enc in zip(parts, done):
            ids = np.array(enc.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(keys[p]):           # not one run of tokens a word
                alone += keys[p]
                continue
            flat, lo = ids.tobytes(), 0
            for w, hi in zip(keys[p], (4 * ends).tolist()):
                self.words[w] = flat[lo:hi]
                lo = hi
        for w, enc in zip(alone, self.tok.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False)):
            self.words[w] = np.array(enc.ids, "<u4").tobytes()


_WORD_IDS: dict[str, WordIds] = {}      # by tokenizer file; a worker's tasks share the tokenizers


def _slices(texts, most=2 << 20):
    """Runs of texts of ``most`` bytes in all, or of one longer text."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= most):
            size += len(texts[to])
            to += 1
        yield at, to
        at = to


def _pieces_of(batches, tokenizer_path, capacity, eos, with_ids):
    """Arrow batches (rid, doc_id, text) -> piece rows."""
    import os
    import zlib

    import numpy as np
    import pyarrow as pa
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if tokenizer_path not in _WORD_IDS:
        _WORD_IDS[tokenizer_path] = WordIds(tokenizer_path)
    ids_of = _WORD_IDS[tokenizer_path].of
    _WORD_IDS[tokenizer_path].words.clear()       # a worker outlives the stage: its memory is others'
    for batch in slices(batches, 2048):
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        for lo, hi in _slices(texts):
            flat, count = ids_of(texts[lo:hi])
            ends = np.cumsum(count)
            for i, (a, b) in enumerate(zip((ends - count).tolist(), ends.tolist()), lo):
                own = np.append(flat[a:b], np.uint32(eos))
                for k, at in enumerate(range(0, len(own), capacity)):
                    part = own[at:at + capacity]
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
        take = pa.array(rows, pa.int64())
        cols = [batch.column(RID).take(take), batch.column("doc_id").take(take),
                pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = [RID, "doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            cols.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(cols, names)
    _WORD_IDS[tokenizer_path].words.clear()


def tokenize(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
             eos: int = EOS, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per piece: doc_id, piece, start,
    length, ids_crc32 and, if asked for, ids. A null text is empty and gives one
    piece that holds the end id alone; only documents over ``capacity`` ids are
    cut. Repeated rows each give their own pieces; other columns are ignored."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    base = with_row_id(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    fields = [T.StructField(RID, T.LongType()),
              T.StructField("doc_id", docs.schema["doc_id"].dataType),
              T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return base.select(RID, "doc_id", "text").mapInArrow(
        lean(lambda it: _pieces_of(it, tokenizer_path, capacity, eos, with_ids)), T.StructType(fields))


# ------------------------------------------------------- the genetic search

class _Rooms:
    """Open bins by free room: the smallest room that fits in a few steps."""

    def __init__(self, capacity):
        self.at = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, room, b):
        self.at[room].append(b)
        self.mask |= 1 << room

    def take(self, size):
        """The bin with the least room of at least ``size``: (bin, room) or None."""
        m = self.mask >> size
        if not m:
            return None
        room = size + (m & -m).bit_length() - 1
        b = self.at[room].pop()
        if not self.at[room]:
            self.mask ^= 1 << room
        return b, room


def best_fit(bins, items, sizes, capacity):
    """Put ``items``, largest first, into ``bins`` (lists of items) by best fit."""
    rooms = _Rooms(capacity)
    for b, members in enumerate(bins):
        rooms.add(capacity - sum(sizes[i] for i in members), b)
    for i in sorted(items, key=lambda i: -sizes[i]):
        got = rooms.take(sizes[i])
        if got is None:
            bins.append([i])
            rooms.add(capacity - sizes[i], len(bins) - 1)
        else:
            bins[got[0]].append(i)
            rooms.add(got[1] - sizes[i], got[0])
    return bins


def replace(bins, items, sizes, capacity):
    """Swap one or two members of a bin for a larger item of ``items`` that still
    fits, so that bins fill up and smaller items are left; returns those left."""
    left = sorted(items, key=lambda i: sizes[i])
    have = [sizes[i] for i in left]
    for members in bins:
        if not left:
            break
        room = capacity - sum(sizes[i] for i in members)
        if not room:
            continue
        outs = [(i,) for i in members]
        if len(members) <= 8:
            outs += [(a, b) for k, a in enumerate(members) for b in members[k + 1:]]
        gain, swap = 0, None
        for out in outs:
            gone = sum(sizes[o] for o in out)
            at = bisect_right(have, gone + room) - 1      # the largest that fits
            if at >= 0 and have[at] - gone > gain:
                gain, swap = have[at] - gone, (at, out)
                if gain == room:
                    break
        if swap:
            at, out = swap
            members[:] = [i for i in members if i not in out] + [left.pop(at)]
            have.pop(at)
            for o in out:
                to = bisect_right(have, sizes[o])
                have.insert(to, sizes[o])
                left.insert(to, o)
    return left


def fitness(bins, sizes, capacity):
    """Fewer bins first, then unevenly filled ones (mean squared fill)."""
    return (-len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins))


def crossover(one, other, sizes, capacity, rng):
    """Inject a share of the well-filled bins of ``other`` whole into ``one``;
    bins of ``one`` that hold an injected item go, and what they held besides
    replaces smaller items where it can and is best-fitted again."""
    filled = sorted(other, key=lambda b: -sum(sizes[i] for i in b))
    some = filled[:max(1, len(filled) // 2)]
    injected = rng.sample(some, max(1, len(some) // 2))
    taken = {i for b in injected for i in b}
    child, displaced = [list(b) for b in injected], []
    for b in one:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    return best_fit(child, replace(child, displaced, sizes, capacity), sizes, capacity)


def mutate(bins, sizes, capacity, rng):
    """Empty the least-filled bin and a few others and best-fit their items."""
    order = sorted(range(len(bins)), key=lambda b: sum(sizes[i] for i in bins[b]))
    gone = {order[0], *rng.sample(range(len(bins)), min(len(bins), 1 + len(bins) // 50))}
    rest = [list(b) for k, b in enumerate(bins) if k not in gone]
    loose = [i for k in gone for i in bins[k]]
    return best_fit(rest, replace(rest, loose, sizes, capacity), sizes, capacity)


def evolve(sizes, capacity, seed, arrived=(), generations=GENERATIONS, population=POPULATION):
    """One epoch on one island: solutions (lists of bins), best first. Stops as
    soon as the count of bins meets the bound ceil(sum / capacity)."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    pool = [p for p in arrived] or [best_fit([], range(len(sizes)), sizes, capacity)]
    rank = lambda p: fitness(p, sizes, capacity)
    pool.sort(key=rank, reverse=True)
    if len(pool[0]) <= least:
        return pool
    while len(pool) < population:
        pool.append(mutate(pool[0], sizes, capacity, rng))
    for _ in range(generations):
        pool.sort(key=rank, reverse=True)
        if len(pool[0]) <= least:
            break
        children = []
        for _ in range(population // 2):
            one, other = rng.sample(pool, 2)
            child = crossover(one, other, sizes, capacity, rng)
            children.append(mutate(child, sizes, capacity, rng) if rng.random() < 0.5 else child)
        pool = sorted(pool + children, key=rank, reverse=True)[:population]
    return sorted(pool, key=rank, reverse=True)


_POP = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("island", T.IntegerType()),
    T.StructField("n_bins", T.LongType()), T.StructField("fill", T.DoubleType()),
    T.StructField("elites", T.ArrayType(T.ArrayType(T.IntegerType())))])


def _evolve_rows(batches, capacity, epoch, generations):
    """A row is one island of one block; a solution is the bin of each item."""
    import pyarrow as pa
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            sizes, arrived, seen = r["sizes"], [], set()
            for code in r["elites"] or []:
                if tuple(code) in seen:
                    continue
                seen.add(tuple(code))
                bins = [[] for _ in range(max(code) + 1)]
                for i, b in enumerate(code):
                    bins[b].append(i)
                arrived.append(bins)
            seed = (r["block"] * 1_000_003 + r["island"]) * 101 + epoch
            best = evolve(sizes, capacity, seed, arrived, generations)[:ELITES]
            codes = []
            for bins in best:
                code = [0] * len(sizes)
                for b, members in enumerate(bins):
                    for i in members:
                        code[i] = b
                codes.append(code)
            n, fill = fitness(best[0], sizes, capacity)
            out.append({"block": r["block"], "island": r["island"], "n_bins": -n, "fill": fill,
                        "elites": codes})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("block", pa.int64()), ("island", pa.int32()), ("n_bins", pa.int64()),
            ("fill", pa.float64()), ("elites", pa.list_(pa.list_(pa.int32())))]))


def _pack_blocks(items: DataFrame, n_blocks: int, capacity: int, layer: int, islands: int,
                 epochs: int, generations: int) -> DataFrame:
    """Deal ``items`` into blocks by hash, search each block on its islands, and
    return the items with block, bin, offset and ``tail`` (in the emptiest bin)."""
    payload = [c for c in items.columns]
    blocks = cut_lineage(
        items.withColumn("block", F.expr(
            f"pmod(xxhash64({RID}, piece, {layer}), {n_blocks})"))
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("length")).alias("neg"), *[F.col(c) for c in [RID, "piece"]],
            *[F.col(c) for c in payload if c not in (RID, "piece")]))).alias("items")), "blocks")
    sizes = blocks.select("block", F.expr("transform(items, x -> cast(x.length as int))").alias("sizes"))
    state = (sizes.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
             .withColumn("elites", F.lit(None).cast("array<array<int>>")))
    for epoch in range(epochs):
        ran = state.select("block", "island", "sizes", "elites").mapInArrow(
            lean(lambda it, e=epoch: _evolve_rows(it, capacity, e, generations)), _POP)
        ran = cut_lineage(ran, "islands")
        # ring migration: an island gets its own elites and its neighbour's
        moved = (ran.select("block", F.explode(F.array(
                    "island", ((F.col("island") + 1) % islands).cast("int"))).alias("island"), "elites")
                 .groupBy("block", "island")
                 .agg(F.flatten(F.collect_list("elites")).alias("elites")))
        state = sizes.join(moved, "block")
    best = ran.groupBy("block").agg(F.min_by(
        F.element_at("elites", 1),
        F.struct("n_bins", (-F.col("fill")).alias("neg"), "island")).alias("code"))
    flat = (blocks.join(best, "block")
            .select("block", F.explode(F.arrays_zip("items", F.col("code").alias("code"))).alias("x"))
            .select("block", F.col("x.code").alias("bin"),
                    *[F.col(f"x.items.{c}").alias(c) for c in payload]))
    from pyspark.sql import Window
    by_bin = Window.partitionBy("block", "bin").orderBy(F.desc("length"), RID, "piece")
    placed = (flat.withColumn("offset", F.coalesce(
                F.sum("length").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("fill", F.sum("length").over(Window.partitionBy("block", "bin"))))
    worst = placed.groupBy("block").agg(F.min(F.struct("fill", "bin")).alias("w")).select(
        F.col("block"), F.col("w.bin").alias("worst"))
    return placed.join(worst, "block").withColumn("tail", F.col("bin") == F.col("worst"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS,
         islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """Pieces (as from ``tokenize``) -> the same rows with ``sequence_id`` and
    ``offset``, packed into as few sequences as the search finds.

    Full pieces are sequences of their own. The others are dealt by a hash of
    the row number into blocks of ``block_items`` pieces at the mean, so no
    document, source or length can fill a block; each block is one bin-packing
    problem for the islands. The emptiest sequence of every block is opened
    again and its pieces are packed in the next layer, until one block is left.
    Ties in length go by row number. No pieces give no rows.
    """
    pieces = cut_lineage(pieces, "pieces")
    full = (pieces.where(F.col("length") >= capacity)
            .withColumn("sequence_id", -F.monotonically_increasing_id() - 1)
            .withColumn("offset", F.lit(0).cast("long")))
    names = pieces.columns
    done, left, layer = [full], pieces.where(F.col("length") < capacity), 0
    while True:
        n = left.count()
        if n == 0:
            break
        n_blocks = max(1, -(-n // block_items))
        placed = cut_lineage(_pack_blocks(left, n_blocks, capacity, layer, islands, epochs,
                                          generations), "placed")
        keep = placed if n_blocks == 1 else placed.where(~F.col("tail"))
        done.append(keep.select(*names, F.expr(
            f"({layer}L << 56) + (block << 16) + bin").alias("sequence_id"),
            F.col("offset").cast("long").alias("offset")))
        if n_blocks == 1:
            break
        left, layer = placed.where("tail").select(*names), layer + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces that carry ``ids`` -> (sequence_id, ids, doc_ids, offsets),
    one row per sequence (at most its capacity of ids, so a group is bounded)."""
    got = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(
        F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return got.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                      F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """documents -> packed pieces: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    return pack(tokenize(docs), **options).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Periodic runs of words, found as maximal pairs in a bottom-up LCP-interval tree.

Two equal stretches of a text, d words apart, that neither the word before nor
the word after them prolongs are a maximal pair. With ``l`` common words the
pair spans a stretch of ``l + d`` words with period d that no neighbouring word
extends: if ``l >= (k - 1) d`` it is a run of exponent k or more as it stands.
The pairs come from the intervals of the suffix order, deepest first: where
parts of an interval are joined, the smaller one's places look up the larger
one's within ``l / (k - 1)`` words, and only partners after another word count.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, functions as F

from .common import give_back, slices

EXPONENT = 4            # a run has so many periods at least
LENGTH = 6              # and so many words
AT_ONCE = 4 << 20       # bytes of texts worked together

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Ids(dict):
    """word -> number, in order of first use."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def numbered(texts):
    """Lists of words -> (one int64 array, first place of each list). Words are
    numbered anew in each list and every list ends with a number of its own, so
    equal stretches are always of one list and inside it."""
    import numpy as np
    parts, starts, base, at = [], [], 0, 0
    for words in texts:
        ids = Ids()
        part = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        parts += [part + base, np.array([base + len(ids)])]
        starts.append(at)
        base, at = base + len(ids) + 1, at + len(words) + 1
    return np.concatenate(parts), np.array(starts)


def _pair_ranks(a, b):
    import numpy as np
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].ravel()


def _shift(a, k):
    import numpy as np
    return np.concatenate([a[k:], np.zeros(min(k, len(a)), a.dtype)])


def _repeated(x, size):
    """Mask of the places whose ``size`` words a 64-bit hash finds twice."""
    import numpy as np
    h = np.zeros(len(x), np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + _shift(x, k).astype(np.uint64) + np.uint64(1)
    h ^= h >> np.uint64(29)
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    return np.isin(h, twice) if len(twice) else np.zeros(len(x), bool)


def suffix_order(x, size):
    """(places, common): the suffixes of ``x`` that share ``size`` words with
    another, in suffix order, and how many words each has in common with the one
    before (0 where a new group of equal ``size`` words begins). Ranks are
    refined by doubling; only groups that are still together are sorted again."""
    import numpy as np
    rank, length = x, 1
    while 2 * length <= size:
        rank, length = _pair_ranks(rank, _shift(rank, length)), 2 * length
    while length < size:
        rank, length = _pair_ranks(rank, _shift(x, length)), length + 1
    order = np.argsort(rank, kind="stable")
    first = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
    count = np.diff(np.append(first, len(x)))
    ranks = np.empty(len(x), np.int32)
    ranks[order] = np.repeat(first, count)
    live = order[np.repeat(count > 1, count)]
    places, levels = live, [(length, ranks.copy())]
    while len(live):
        # a stretch that occurs twice ends before its list does: live + length is a place
        now, nxt = ranks[live], ranks[live + length]
        by = np.lexsort((nxt, now))
        live, now, nxt = live[by], now[by], nxt[by]
        old = np.append(True, now[1:] != now[:-1])
        new = old | np.append(True, nxt[1:] != nxt[:-1])
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(live)))
        offset = np.arange(len(live)) - np.flatnonzero(old)[np.cumsum(old) - 1]
        ranks[live] = now + np.repeat(offset[begin], count)
        length *= 2
        levels.append((length, ranks.copy()))
        live = live[np.repeat(count > 1, count)]
    places = places[np.argsort(ranks[places])]
    i, j = places[:-1].copy(), places[1:].copy()
    common = np.zeros(len(places), np.int64)
    for length, r in reversed(levels):
        step = length * (r[i] == r[j])
        common[1:] += step
        i += step
        j += step
    more = common[1:] >= size
    for _ in range(size - 1):
        more &= x[i] == x[j]
        common[1:] += more
        i += more
        j += more
    return places, common


def _near_groups(places, common, ratio):
    """Mask of the groups (from one 0 of ``common`` to the next) in which two
    places are near enough for their deepest common stretch."""
    import numpy as np
    group = np.cumsum(common == 0) - 1
    by = np.lexsort((places, group))
    gap = np.append(np.iinfo(np.int64).max, np.diff(places[by]))
    start = np.flatnonzero(common == 0)
    gap[start] = np.iinfo(np.int64).max
    near = np.minimum.reduceat(gap, start) * ratio <= np.maximum.reduceat(common, start)
    return near[group]


def maximal_pairs(places, common, before, ratio):
    """(start, distance, common words) of the maximal pairs with
    ``common >= ratio * distance``, from one group of ``suffix_order``.

    ``before[p]`` is the word before place p: an interval's places fall into
    classes by it, and only places of different classes pair. Occurrences of a
    stretch within a third of its length lie one period apart, so of those near
    a place all but the first are in one class: it is met whole or passed over
    whole, without a step for each of its places."""
    out, stack = [], []

    def join(one, two, depth):
        small, large = (one, two) if len(one) <= len(two) else (two, one)
        reach = depth // ratio
        for p in small:
            own, at = before[p], bisect_left(large, p)
            for k in range(at, len(large)):
                q = large[k]
                if q - p > reach or before[q] == own:
                    break
                out.append((p, q - p, depth))
            low = bisect_left(large, p - reach, 0, at)
            if low < at and before[large[low]] != own:
                out.append((large[low], p - large[low], depth))
        if len(small) < 32:
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        return large

    part = None
    for p, depth in zip([*places, None], [*common, 0]):
        if part is not None:
            while stack and stack[-1][0] > depth:
                level, others = stack.pop()
                part = join(others, part, level)
            if stack and stack[-1][0] == depth:
                stack[-1][1] = join(stack[-1][1], part, depth)
            elif depth:
                stack.append([depth, part])
        part = [p]
    return out


def runs_of(texts, exponent: int = EXPONENT, length: int = LENGTH):
    """Lists of words -> for each list its runs (start, length, period), by start,
    then period: stretches with smallest period ``period``, of ``length`` words
    and ``exponent`` periods at least, that no neighbouring word extends."""
    import numpy as np
    texts = list(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    ratio = exponent - 1
    # common words of a run's pair: length less period, and ratio periods
    size = min(max(length - d, ratio * d) for d in range(1, length + 1))
    if not any(len(t) > size for t in texts):
        return found
    x, starts = numbered(texts)
    ends = np.append(starts[1:], len(x))
    mask = np.logical_or.reduceat(_repeated(x, size), starts)
    if not mask.any():
        return found
    kept = np.flatnonzero(mask)         # lists that hold some stretch twice
    x = np.concatenate([x[starts[k]:ends[k]] for k in kept])
    starts = np.append(0, np.cumsum(ends[kept] - starts[kept]))[:-1]
    x = np.unique(x, return_inverse=True)[1].ravel()
    places, common = suffix_order(x, size)
    if not len(places):
        return found
    near = _near_groups(places, common, ratio)
    places, common = places[near], common[near]
    before = np.append(-1, x[:-1]).tolist()
    cut = np.append(np.flatnonzero(common == 0), len(places))
    places, common = places.tolist(), common.tolist()
    best: dict[tuple[int, int], int] = {}
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        for p, d, depth in maximal_pairs(places[lo:hi], common[lo:hi], before, ratio):
            if depth + d >= length:
                # pairs at a multiple of the period span the same stretch
                span = (p, p + d + depth)
                best[span] = min(d, best.get(span, d))
    for (p, end), d in best.items():
        k = int(np.searchsorted(starts, p, "right")) - 1
        found[kept[k]].append((p - int(starts[k]), end - p, d))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words, runs):
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = bytes(length - period)
    return [w for w, k in zip(words, keep) if k]


def _batches(batches, exponent, length, prepare):
    import pyarrow as pa
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(ids, texts):
        words = [(t or b"").split() for t in texts]
        if prepare:
            words = [prepare(w, i) for w, i in zip(words, ids.to_pylist())]
        found = runs_of(words, exponent, length)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(w) for w in words], pa.int64()),
             pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], kind),
             pa.array([b" ".join(collapsed(w, r)) for w, r in zip(words, found)], pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    for batch in slices(batches):
        ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary()).to_pylist()
        lo, n = 0, 0
        for hi, t in enumerate(texts, 1):
            n += len(t or b"")
            if n >= AT_ONCE or hi == len(texts):
                yield work(ids.slice(lo, hi - lo), texts[lo:hi])
                lo, n = hi, 0
    give_back()


def find_runs(docs: DataFrame, exponent: int = EXPONENT, length: int = LENGTH, prepare=None) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, n_words, ``runs`` (of at least
    ``exponent`` periods, 3 or more, and ``length`` words: start, length and
    period in words, by start, then period) and ``collapsed``: the words joined by
    one space, without those that some run holds after its first period.

    Words are parted by spaces and the control characters 9 to 13. ``prepare(words,
    doc_id)`` may change a document's words (as bytes) first. A null or empty text
    has no words, no runs and an empty ``collapsed``; every row is worked by itself,
    so repeated rows and a null doc_id change nothing; an empty table gives an
    empty table. Other columns are dropped, whatever their names. Nothing is
    shuffled; a task holds a slice of texts, or one text with some forty bytes a
    word and four more for each doubling of its longest repeated stretch.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda it: _batches(it, exponent, length, prepare),
        f"doc_id {id_type}, n_words bigint, runs {RUNS}, collapsed string")


def planted(words, doc_id):
    """The words of the query's contract: where crc32(doc_id) is divisible by ten,
    those from a place on repeat with a period; both depend on the checksum only.
    A null doc_id has no checksum and its words stay."""
    import zlib
    n = len(words)
    if not n or doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + (part * ((n - a) // p + 1))[:n - a]


def run_rows(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, its longest run (ties: smallest
    start, then period; nulls without a run), and digests of all runs and of the
    collapsed text."""
    r = find_runs(docs, prepare=planted)
    top = F.expr("array_min(transform(runs, x -> struct(-x.length AS l, x.start AS s, x.period AS p)))")
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    return (r.select("doc_id", "runs", "collapsed", top.alias("top"))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    F.col("top.s").alias("start"), (-F.col("top.l")).alias("length"), F.col("top.p").alias("period"),
                    F.expr("(-top.l * 1000) div top.p").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))

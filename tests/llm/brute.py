"""Plain-Python versions of what the operators must return, and small tables
with the awkward rows: nulls, empty texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, line string"


def docs_frame(spark, texts, langs=None, ids=None):
    rows = [(i if ids is None else ids[i], t, (langs or {}).get(i, "en"), "s", 0, "x", "y")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def saved(spark, df, tmp_path, name="t"):
    """Operators that read their input more than once want a table of files."""
    path = f"{tmp_path}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)).encode()).hexdigest()


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def secrets(text):
    text = text or ""
    out = [(m.start(), 1, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 2, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 3, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return out


def added_spans(text, model):
    """All spans of a text: the fixed patterns' and the model's, in order."""
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
    base = sorted((s, k, e) for s, k, e, _ in secrets(text))
    out, covered = list(base), bytearray(len(text))
    for s, _, e in base:
        covered[s:e] = b"\x01" * (e - s)
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        run = m.group()
        if not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
            continue
        if covered[m.start():m.end()].count(1):
            continue
        at = [symbols.find(c) + 1 for c in run]
        score = sum(model["table"][a * (len(symbols) + 1) + b] for a, b in zip([0] + at, at)) / len(run)
        if score > model["threshold"]:
            out.append((m.start(), 4, m.end()))
    return [(s, k, e, text[s:e]) for s, k, e in sorted(out)]


def luhn(d):
    t = 0
    for i, c in enumerate(map(int, reversed(d))):
        t += c if i % 2 == 0 else (2 * c - 9 if 2 * c > 9 else 2 * c)
    return t % 10 == 0


def personal(text):
    text = text or ""
    out = [(m.start(), 1, m.end(), "email") for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 2, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 3, m.end(), "card"))
    out += [(m.start(), 4, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def contamination(texts, items, n=10):
    """n_words, n_hit, ids of the items, per text."""
    windows = defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[a:a + k])].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for t in texts:
        w = WORD.findall(lower(t))
        hit, who = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                ids = windows.get(tuple(w[a:a + k]))
                if ids:
                    hit.update(range(a, a + k))
                    who |= ids
        out.append((len(w), len(hit), sorted(str(x) for x in who)))
    return out


def shingle_set(t, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if not w:
        return frozenset()
    k = min(n, len(w))
    return frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1))


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def near(ids, texts, percent=75):
    """doc_id -> (set size, smallest id of the component); every pair compared."""
    sets = [shingle_set(t) for t in texts]
    u, inverted = Union(ids), defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in inverted[x]:
                shared[j] += 1
            inverted[x].append(i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                u.join(ids[i], ids[j])
    return {d: (len(s), u.find(d)) for d, s in zip(ids, sets)}


def line_components(lines, percent=80, n=8):
    """distinct lines -> component number; every pair compared."""
    lines = sorted(set(lines))
    sets = [{t[a:a + n] for a in range(max(1, len(t) - n + 1))} for t in lines]
    u, inverted = Union(range(len(lines))), defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in inverted[x]:
                shared[j] += 1
            inverted[x].append(i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                u.join(i, j)
    return {t: u.find(i) for i, t in enumerate(lines)}


def topk(rows, k=10, every=100, scale=1024):
    """rows: (vec_id, vector or None). Sorted (query_id, rank, vec_id, score)."""
    clean = []
    for i, (v, x) in enumerate(rows):
        if v is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        clean.append((i, v, [math.floor(scale * float(c)) for c in x]))
    out = []
    for i, v, x in clean:
        if v % every:
            continue
        got = sorted((-sum(a * b for a, b in zip(x, y)), w, j) for j, w, y in clean if j != i and len(y) == len(x))
        out += [(v, r, w, -s) for r, (s, w, _) in enumerate(got[:k], 1)]
    return sorted(out)


def crc(b):
    return zlib.crc32(b)

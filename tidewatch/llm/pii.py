"""Personal data: four fixed patterns, and bootstrapped contextual extraction:
the entities they find seed lexical patterns, a pattern-instance graph is scored
in rounds, and confident patterns name identifiers that no pattern knew."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import RID, cut_lineage, with_row_id

KINDS = ["email", "ip", "card", "phone"]        # base kinds, in listed order
FOUND = "ctx_"                                  # prefix of the kinds of added spans
MIN_DIGITS = 6          # of a token inside a run of digit groups that is also looked up alone
MAX_DIGITS = 19         # of one identifier: a longer run of groups holds several
MIN_SEEDS = 5           # different seed instances behind a pattern
MIN_PATTERN = 0.8       # confidence of a pattern that may discover
MIN_INSTANCE = 0.9      # confidence of an instance that is reported
PRIOR = 1.0             # instances that count against a pattern from the start

# The base patterns. Digit runs are taken whole, which finds what
# the plain patterns find and keeps long runs linear.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_GROUP = re.compile(r"\+?[0-9][0-9()./-]*")            # a token of a run of digit groups
_WORD = re.compile(r"[^\W_]")
_GAP = re.compile(r"[()\x20-]{1,3}")                   # and what parts it from the next
_EDGE = ".,;:!?()[]{}<>\"'#$%&*|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind from 1, end) of the base entities, by start and kind."""
    out = []
    if "@" in text:
        last = 0
        for m in _AT.finditer(text):
            s = m.start()
            while s > last and text[s - 1] in _LOCAL:
                s -= 1
            if s < m.start():
                out.append((s, 1, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 2, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 3, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((m.start(), 4, m.end()))
    return sorted(out)


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: the one and two words before, the one and
    two words after, and the words on both sides, in lower case and without
    marks; what is only marks is no word."""
    left = [w.strip(_EDGE).lower() for w in text[max(0, start - 80):start].split() if _WORD.search(w)][-2:]
    right = [w.strip(_EDGE).lower() for w in text[end:end + 40].split() if _WORD.search(w)][:2]
    out = []
    if left:
        out.append(f"L {left[-1]}")
        if len(left) > 1:
            out.append(f"LL {left[0]} {left[1]}")
        if right:
            out.append(f"LR {left[-1]} {right[0]}")
    if right:
        out.append(f"R {right[0]}")
        if len(right) > 1:
            out.append(f"RR {right[0]} {right[1]}")
    return out


def candidates(text: str, base) -> list[tuple[int, int, bool]]:
    """(start, end, with its contexts) of what may be an unknown identifier:
    tokens with a digit or an at sign that touch no base span. Neighbours of
    digit groups parted by blanks, brackets or hyphens are one candidate; a token
    of it with MIN_DIGITS digits is looked up too, but its contexts count only
    if the run is longer than any identifier."""
    tokens, k = [], 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if a == b:
            continue
        while k < len(base) and base[k][2] <= a:
            k += 1
        if not any(s < b and a < e for s, _, e in base[max(0, k - 4):k + 8]):
            tokens.append((a, b))
    out, i = [], 0
    while i < len(tokens):
        j, (a, b) = i + 1, tokens[i]
        if _GROUP.fullmatch(text, a, b):
            while (j < len(tokens) and _GAP.fullmatch(text, b, tokens[j][0])
                   and _GROUP.fullmatch(text, *tokens[j])):
                b = tokens[j][1]
                j += 1
            if a and text[a - 1] == "(" and ")" in text[a:b]:
                a -= 1
        out.append((a, b, True))
        if j > i + 1:
            digits = [sum("0" <= c <= "9" for c in text[x:y]) for x, y in tokens[i:j]]
            out += [(x, y, sum(digits) > MAX_DIGITS) for (x, y), n in zip(tokens[i:j], digits) if n >= MIN_DIGITS]
        i = j
    return out


_ROWS = ("base array<struct<s:int,k:int,e:int>>, "
         "seen array<struct<s:int,e:int,k:int,inst:string,pats:array<string>>>")


def _extract(batches):
    """Arrow rows (rid, doc_id, text) -> base spans and all instances with
    their patterns (k 0: an unknown token)."""
    import pyarrow as pa
    span = pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())])
    inst = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32()), ("inst", pa.string()),
                      ("pats", pa.list_(pa.string()))])
    for batch in batches:
        base_col, seen_col = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            seen = [(s, e, k, True) for s, k, e in base]
            seen += [(s, e, 0, own) for s, e, own in candidates(text, base)]
            base_col.append([{"s": s, "k": k, "e": e} for s, k, e in base])
            seen_col.append([{"s": s, "e": e, "k": k, "inst": text[s:e].lower(), "pats": p}
                             for s, e, k, own in seen if (p := contexts(text, s, e) if own else []) or not k])
        yield pa.RecordBatch.from_arrays(
            [batch.column(RID), batch.column("doc_id"), pa.array(base_col, pa.list_(span)),
             pa.array(seen_col, pa.list_(inst))], [RID, "doc_id", "base", "seen"])


def score_graph(edges: DataFrame, min_seeds: int = MIN_SEEDS,
                min_pattern: float = MIN_PATTERN, min_instance: float = MIN_INSTANCE) -> DataFrame:
    """Distinct ``edges(pattern, inst, k)`` (k 0: unknown instance) -> the
    discovered (inst, k, conf).

    A round scores each pattern for each kind: the confidence of its instances
    of that kind over all its instances plus PRIOR; patterns need ``min_seeds``
    instances of the kind. An unknown instance gets 1 - prod(1 - confidence)
    over its confident patterns and, from MIN_INSTANCE up, counts as an instance
    of its best kind, which it keeps, in the next round; found instances only
    add to scores, so rounds go on until none is new. Sums are pre-aggregated by
    task, so a pattern as common as a stop word costs a row a task.
    """
    edges = cut_lineage(edges, "edges")
    known = edges.where("k > 0").select("pattern", "inst", "k", F.lit(1.0).alias("conf"))
    unknown = edges.where("k = 0").select("pattern", "inst")
    total = cut_lineage(edges.groupBy("pattern").agg(F.count("*").alias("n")), "totals")
    found, before = None, 0
    while True:
        support = known if found is None else known.unionByName(
            unknown.join(found, "inst").select("pattern", "inst", "k", "conf"))
        good = (support.groupBy("pattern", "k").agg(F.sum("conf").alias("c"), F.count("*").alias("m"))
                .where(F.col("m") >= min_seeds).join(total, "pattern")
                .select("pattern", "k", (F.col("c") / (F.col("n") + PRIOR)).alias("p"))
                .where(F.col("p") >= min_pattern))
        good = cut_lineage(good, "patterns")
        scored = (unknown.join(good, "pattern").groupBy("inst", "k")
                  .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))))).alias("conf"))
                  .where(F.col("conf") >= min_instance))
        kept = F.lit(False)
        if found is not None:
            scored = scored.join(found.select("inst", F.col("k").alias("was")), "inst", "left")
            kept = F.col("k").eqNullSafe(F.col("was"))
        scored = (scored.groupBy("inst").agg(F.max(F.struct(
                      kept.alias("kept"), "conf", (-F.col("k")).alias("neg"))).alias("b"))
                  .select("inst", (-F.col("b.neg")).alias("k"), F.col("b.conf").alias("conf")))
        found = cut_lineage(scored, "instances")
        now = found.count()
        if now <= before:
            break
        before = now
    return found


def find_personal_data(docs: DataFrame, **options) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, base (structs of start, kind, end)
    and spans (the same with the discovered ones; kind 10 + k is discovered).

    Whole texts are read, once. Null and empty texts have no spans; repeated
    rows repeat their result; other columns are ignored. The pattern graph holds
    only tokens and runs with digits or at signs and their contexts.
    """
    base = with_row_id(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = cut_lineage(base.select(RID, "doc_id", "text").mapInArrow(
        _extract, f"{RID} bigint, doc_id {id_type}, {_ROWS}"), "extracted")
    seen = rows.select(RID, F.explode("seen").alias("x"))
    edges = (seen.select(F.explode("x.pats").alias("pattern"), F.col("x.inst").alias("inst"), F.col("x.k").alias("k"))
             .groupBy("pattern", "inst").agg(F.max("k").alias("k")))
    found = score_graph(edges, **options)
    # a token that lies in a found run of digit groups is part of that run
    longer = F.max("e").over(Window.partitionBy(RID).orderBy("s", F.desc("e")).rowsBetween(
        Window.unboundedPreceding, -1))
    added = (seen.where("x.k = 0").select(RID, "x.s", "x.e", "x.inst").join(found.select("inst", "k"), "inst")
             .withColumn("longer", longer).where("longer IS NULL OR e > longer")
             .groupBy(RID).agg(F.collect_list(F.struct(
                 "s", (F.col("k") + 10).cast("int").alias("k"), "e")).alias("added")))
    return rows.join(added, RID, "left").select(
        "doc_id", "base", F.expr("array_sort(concat(base, coalesce(added, cast(array() as "
                                 "array<struct<s:int,k:int,e:int>>))))").alias("spans"))


def _joined(col: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"concat_ws(',', transform({col}, x -> concat(if(x.k > 10, '{FOUND}', ''), "
                  f"element_at(array({names}), if(x.k > 10, x.k - 10, x.k)), ':', x.s, ':', x.e)))")


def personal_rows(docs: DataFrame) -> DataFrame:
    found = find_personal_data(docs)
    n = lambda k: F.expr(f"cast(size(filter(base, x -> x.k = {k})) AS bigint)")
    return found.select(
        "doc_id", n(1).alias("n_email"), n(2).alias("n_ip"), n(3).alias("n_card"), n(4).alias("n_phone"),
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))

"""Secret scan with DataFrame functions only: three fixed patterns, and two
character Markov models (random strings, ordinary identifiers) whose
log-likelihood ratio finds more."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage

# The base patterns; group 2 of the first is the secret's value.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"       # 20 or more characters, greedy: as AKIA[A-Z0-9]+ cut by length
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]
MIN_ASSIGN = 6

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
MIN_CANDIDATE = 20
_RUN = "A-Za-z0-9+/_=-"
# A whole run of token characters; those without a digit or a letter are dropped after.
CANDIDATE = rf"(?<![{_RUN}])[{_RUN}]{{{MIN_CANDIDATE},}}"
# Ordinary identifiers: words of letters and marks, at most with a short number at the end.
WORD = r"(?<![A-Za-z0-9+/_=.-])[A-Za-z_]{4,}[0-9]{0,4}(?![A-Za-z0-9+/_=-])"
MIN_WORD = 6

SMOOTHING = 0.5
QUANTILE = 0.999       # share of the held-out identifiers that stay at or under the threshold

_SPAN = "struct<s:int,k:int,e:int,v:string>"
_SPANS = f"array<{_SPAN}>"
BLOCK = 256            # elements whose results are collected together in one text


def _walk(items: str, item_type: str, state: str, state_type: str, step: str, out: str, out_type: str) -> str:
    """SQL of a walk over array ``items`` from the left: ``state`` before the
    first element, ``step`` the state after element x from state a, ``out`` what
    x gives in state a (null: nothing). The states before blocks of BLOCK elements
    come first and each block collects its own results, so the time is near
    linear in the number of elements."""
    return f"""
      flatten(transform(
        aggregate(
          transform(array({items}), z -> transform(sequence(0, greatest(size(z) - 1, 0) div {BLOCK}),
                                                   i -> slice(z, i * {BLOCK} + 1, {BLOCK})))[0],
          struct({state} AS a, cast(array() AS array<struct<a:{state_type},part:array<{item_type}>>>) AS done),
          (o, part) -> struct(aggregate(part, o.a, (a, x) -> {step}) AS a,
                              concat(o.done, array(struct(o.a AS a, part AS part))) AS done),
          o -> o.done),
        o -> aggregate(o.part, struct(o.a AS a, cast(array() AS array<{out_type}>) AS got),
          (w, x) -> transform(array(w.a), a -> struct({step} AS a,
            concat(w.got, filter(array({out}), y -> y IS NOT NULL)) AS got))[0],
          w -> w.got)))"""


def _hits(text: str, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches in column ``text`` as (start, kind, end,
    text), in code points: the gaps between the matches give the places."""
    p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(_walk(
        f"""zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1),
                     (v, gap) -> struct(v, length(gap) AS g, coalesce(length(v), 0) AS n))""",
        "struct<v:string,g:int,n:int>", "0", "int", "a + x.g + x.n",
        f"if(x.v IS NULL, NULL, struct(a + x.g AS s, {kind} AS k, a + x.g + x.n AS e, x.v AS v))", _SPAN))


def _apart(runs: str, base: str) -> Column:
    """The spans of ``runs`` that touch none of ``base`` (both sorted): walked
    together, with the furthest end and the number of base spans so far."""
    kept = _walk(f"array_sort(concat({base}, {runs}))", _SPAN, "struct(0 AS reach, 0 AS c)", "struct<reach:int,c:int>",
                 "if(x.k < 4, struct(greatest(a.reach, x.e) AS reach, a.c + 1 AS c), a)",
                 "if(x.k = 4 AND a.reach <= x.s, struct(x AS r, a.c AS c), NULL)", f"struct<r:{_SPAN},c:int>")
    return F.expr(f"transform(filter({kept}, y -> coalesce(get({base}, y.c).s >= y.r.e, true)), y -> y.r)")


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the spans of the three fixed patterns, each kind in order."""
    value = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    none = F.expr(f"cast(array() AS {_SPANS})")
    t = F.col(text)
    assign = F.when(t.rlike("(?i)passw|secret|token|api_?key"), _hits(text, ASSIGN, 1)).otherwise(none)
    access = F.when(t.contains("AKIA"), _hits(text, ACCESS, 2)).otherwise(none)
    hexes = F.when(t.rlike("[0-9a-f]{24}"), _hits(text, HEX, 3)).otherwise(none)
    df = df.withColumn("__tw_a", assign).withColumn("__tw_b", access).withColumn("__tw_c", hexes)
    keep = F.expr(f"filter(__tw_a, x -> length(regexp_extract(x.v, '{value}', 2)) >= {MIN_ASSIGN})")
    return df.withColumn(out, F.concat(keep, "__tw_b", "__tw_c")).drop("__tw_a", "__tw_b", "__tw_c")


def _score(value: str, table: str) -> str:
    """SQL of the mean log-likelihood ratio a character of string ``value``."""
    n = len(SYMBOLS) + 1
    return f"""(aggregate(split({value}, ''), struct(0D AS sum, 0 AS prev),
      (a, c) -> struct(a.sum + get({table}, a.prev * {n} + instr('{SYMBOLS}', c)) AS sum,
                       instr('{SYMBOLS}', c) AS prev),
      a -> a.sum) / length({value}))"""


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(label, value, held) of all documents: random strings are the values that
    the fixed patterns find, ordinary identifiers the words of the rest of the
    texts with at most a short number at their end, which a secret that no pattern
    labels hardly ever is. The words of one half of the texts (by a hash) are held
    out of the models."""
    d = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = F.pmod(F.xxhash64("text"), F.lit(2)) == 1
    d = base_spans(d, "text", "base")
    value = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    rand = d.select(F.lit("random").alias("label"), F.lit(False).alias("held"), F.explode(F.expr(
        f"transform(base, x -> if(x.k = 1, regexp_extract(x.v, '{value}', 2), x.v))")).alias("value"))
    rest = d.select(F.regexp_replace("text", f"{HEX}|{ACCESS}", " ").alias("text"), held.alias("held"))
    words = rest.select(F.lit("word").alias("label"), "held", F.explode(F.expr(
        f"regexp_extract_all(text, '{WORD}', 0)")).alias("value")).where(F.length("value") >= MIN_WORD)
    return rand.unionByName(words)


def fit_models(samples: DataFrame, smoothing: float = SMOOTHING) -> dict:
    """Two first-order character models from (label, value, held) rows: a table of
    log-likelihood ratios by (previous, next) symbol, and the threshold on the
    mean ratio: the QUANTILE of the identifiers that are held out of the models,
    0 at least. Every string counts as often as it occurs; the different strings are
    saved with their counts. Only symbol-pair counts, bounded by the alphabet,
    come to the driver. Without strings of a kind its model is the smoothing's:
    all symbols alike, which is what random strings look like.
    """
    n = len(SYMBOLS) + 1
    strings = cut_lineage(samples.groupBy("label", "value", "held").agg(F.count("*").alias("n")), "strings")
    pairs = strings.where("NOT held").withColumn(
        "at", F.expr(f"transform(split(value, ''), c -> instr('{SYMBOLS}', c))")).select(
        "label", "n", F.explode(F.expr(
            f"transform(at, (c, i) -> if(i = 0, 0, get(at, i - 1)) * {n} + c)")).alias("pair"))
    counts = {(r["label"], r["pair"]): r["n"] for r in
              pairs.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()}
    logp = {}
    for lab in ("random", "word"):
        for a in range(n):
            row = [counts.get((lab, a * n + b), 0) + smoothing for b in range(n)]
            total = sum(row)
            logp.update({(lab, a * n + b): math.log(x / total) for b, x in enumerate(row)})
    table = [round(logp["random", p] - logp["word", p], 4) for p in range(n * n)]
    lit = _table_literal(table)
    # scores to 4 places: few enough different ones for an exact quantile
    scores = cut_lineage(strings.where("held AND label = 'word'").select(
        "n", F.round(F.expr(_score("value", lit)), 4).alias("t")).groupBy("t").agg(F.sum("n").alias("n")), "scores")
    at = scores.agg(F.expr(f"percentile(t, {QUANTILE}, n)").alias("t")).first()["t"]
    cut = None if at is None else scores.where(F.col("t") >= at - 1e-9).agg(F.min("t").alias("t")).first()["t"]
    return {"table": table, "threshold": max(0.0, cut or 0.0)}


def _table_literal(table) -> str:
    return "cast(split('" + ",".join(f"{x:g}" for x in table) + "', ',') AS array<double>)"


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, spans (array of start, kind, end,
    value; code points, end exclusive) in order of start and kind.

    Added spans are whole runs of MIN_CANDIDATE or more token characters that hold
    a digit and a letter, touch no base span and whose mean log-likelihood ratio
    exceeds the model's threshold. A null or empty text has no spans; repeated
    rows repeat their result; other columns are ignored.
    """
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = base_spans(d, "text", "base").withColumn("base", F.array_sort("base"))
    none = F.expr(f"cast(array() AS {_SPANS})")
    d = d.withColumn("runs", F.when(F.col("text").rlike(CANDIDATE), _hits("text", CANDIDATE, 4)).otherwise(none))
    d = d.withColumn("runs", F.expr("filter(runs, r -> r.v RLIKE '[0-9]' AND r.v RLIKE '[A-Za-z]')"))
    d = d.withColumn("runs", F.when(F.expr("size(base) = 0 OR size(runs) = 0"), F.col("runs")).otherwise(
        _apart("runs", "base")))
    score = _score("r.v", _table_literal(model["table"]))
    d = d.withColumn("more", F.expr(f"filter(runs, r -> {score} > {model['threshold']}D)"))
    return d.select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def _joined(col: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"concat_ws(',', transform({col}, x -> "
                  f"concat(element_at(array({names}), x.k), ':', x.s, ':', x.e)))")


def secret_rows(docs: DataFrame) -> DataFrame:
    """Fit on the labelled strings of all ``docs``, scan all of it and give the
    counts and digests."""
    found = scan(docs, fit_models(labelled_samples(docs)))
    n = lambda k: F.expr(f"cast(size(filter(base, x -> x.k = {k})) AS bigint)")
    return found.select(
        "doc_id", n(1).alias("n_assign"), n(2).alias("n_access"), n(3).alias("n_hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        F.expr("cast(size(spans) - size(base) AS bigint)").alias("n_markov"))

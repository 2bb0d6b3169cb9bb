"""Language identification: averaged hashed subword embeddings under a linear
softmax, trained by stochastic gradient descent in numpy, with a calibrated
score and rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import RID, lean, mix64, slices, with_row_id

BUCKETS = 1 << 14
GRAMS = (1, 2, 3)       # characters in a subword; a word is closed by a blank on both sides
DIM = 16
UNKNOWN = "und"
# Bounds of the labelled sample: documents of each language, and languages.
TRAIN_PER_LANG = 600
MAX_LANGS = 200
EPOCHS = 8
BATCH = 32
RATE = 2.0
REJECT_SHARE = 0.0005   # share of the validation texts that the rejection may cost
REJECT_BELOW = 0.5      # and never a score of this or more
# A text is strange to its language beyond this many times what the strangest
# validation text is, LEAST_STRANGE standard deviations at least.
STRANGE_MARGIN = 1.5
LEAST_STRANGE = 4.0
OVERSAMPLE = 1.5        # of the hashes that are looked at for the sample


class _Letters:
    """Code points -> lower-case letters, everything else 0."""

    table = None

    @classmethod
    def get(cls):
        import numpy as np
        if cls.table is None:
            t = np.zeros(0x110000, np.uint32)
            for i in range(0x110000):
                c = chr(i)
                if c.isalpha():
                    low = c.lower()
                    t[i] = ord(low) if len(low) == 1 else i
            cls.table = t
        return cls.table


def subword_buckets(texts, buckets=BUCKETS, grams=GRAMS):
    """Hash buckets of the character n-grams of every whole text, and where each
    text's begin. Runs of other characters than letters count as one blank, and
    n-grams with a blank inside are left out. A text without letters has none."""
    import numpy as np
    table = _Letters.get()
    n = np.array([len(t) + 1 for t in texts], np.int64)
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = table[raw]
    owner = np.repeat(np.arange(len(texts)), n)
    blank = cp == 0
    # a blank stays only after a letter; the text starts as after a blank
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    cp, owner, blank = cp[keep].astype(np.uint64), owner[keep], blank[keep]
    got, own = [], []
    for g in grams:
        # g letters, or g - 1 letters with the blank before or after
        if len(cp) < g:
            continue
        acc = np.full(len(cp) - g + 1, np.uint64(g), np.uint64)
        for k in range(g):
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + cp[k:k + len(acc)]
        ok = owner[:len(acc)] == owner[g - 1:g - 1 + len(acc)]
        for k in range(1 if g > 1 else 0, g - 1 if g > 1 else g):
            ok &= ~blank[k:k + len(acc)]
        if g > 1:
            ok &= ~(blank[:len(acc)] & blank[g - 1:g - 1 + len(acc)])
        got.append((mix64(acc[ok]) % np.uint64(buckets)).astype(np.int32))
        own.append(owner[:len(acc)][ok])
    counts = np.zeros(len(texts), np.int64)
    if not got:
        return np.empty(0, np.int32), counts, np.empty(0, np.int64)
    all_got, all_own = np.concatenate(got), np.concatenate(own)
    return all_got, np.bincount(all_own, minlength=len(texts)), all_own


def averages(values, found, texts):
    """Mean of the rows of ``values`` (buckets, m) over the subwords that
    ``subword_buckets`` found of so many texts."""
    import numpy as np
    b, n, own = found
    out = np.stack([np.bincount(own, weights=values[b, j], minlength=texts)
                    for j in range(values.shape[1])], axis=1)
    return out / np.maximum(n, 1)[:, None]


def _slices(texts, most=400_000):
    """Runs of texts of so many characters at most; a longer text is alone."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= most):
            size += len(texts[to])
            to += 1
        yield at, to
        at = to


def _count_rows(batches, buckets):
    """Arrow rows (lang, text) -> (lang, bucket indices, counts)."""
    import numpy as np
    import pyarrow as pa
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        idx, cnt, keep = [], [], []
        for i, t in enumerate(texts):
            b, _, _ = subword_buckets([t], buckets)
            if len(b):
                u, c = np.unique(b, return_counts=True)
                idx.append(u.astype(np.int32))
                cnt.append(c.astype(np.int32))
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(pa.array(keep, pa.int64())), pa.array(idx, pa.list_(pa.int32())),
             pa.array(cnt, pa.list_(pa.int32()))], ["lang", "idx", "cnt"])


def labelled_sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG, max_langs: int = MAX_LANGS) -> DataFrame:
    """(lang, text) of at most ``per_lang`` different texts of each language, those
    with the smallest hashes; the ``max_langs`` most frequent labels. ``docs`` has
    the rows that may be learned from, as (lang, text). Copies of a text count
    once: a common text takes one place, and a task sends it once.
    """
    ok = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    # each language's count of different texts tells which hashes can be among the smallest
    counts = (ok.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h", 0.05).alias("m"))
              .orderBy(F.desc("n"), "lang").limit(max_langs))
    share = counts.select("lang", F.expr(f"least(1D, {OVERSAMPLE * per_lang}D / m)").alias("share"))
    below = F.col("share") * float(1 << 63) * 2 - float(1 << 63)
    some = (ok.join(F.broadcast(share), "lang").where((F.col("share") >= 1) | (F.col("h") < below))
            .groupBy("lang", "h").agg(F.min("text").alias("text")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return some.withColumn("r", rank).where(F.col("r") <= per_lang).select("lang", "text")


def fit(sample: DataFrame, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, seed: int = 3):
    """Train on a bounded (lang, text) sample: subword counts are made on the
    cluster, the descent runs in numpy. Returns None if nothing is labelled.

    A fifth of the sample is held out to fit the temperature of the softmax and
    two rejection thresholds: the score under which REJECT_SHARE of the held-out
    texts fall, REJECT_BELOW at most, and how strange a text may be to the
    language it is given (``strangeness``). A softmax alone is sure of foreign text
    too: one of its languages must have it.
    """
    import numpy as np
    rows = sample.select("lang", "text").mapInArrow(
        lean(lambda it: _count_rows(it, buckets)), "lang string, idx array<int>, cnt array<int>").toPandas()
    if not len(rows):
        return None
    rows = rows.iloc[np.lexsort(([hash_of(i, c) for i, c in zip(rows["idx"], rows["cnt"])], rows["lang"]))]
    langs = sorted(set(rows["lang"]))
    y = np.array([langs.index(v) for v in rows["lang"]])
    feats = [(np.asarray(i), np.asarray(c, np.float32) / np.sum(c)) for i, c in zip(rows["idx"], rows["cnt"])]
    size = np.array([int(np.sum(c)) for c in rows["cnt"]])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = order[:len(order) // 5]
    train = order[len(order) // 5:]
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((dim, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    weight = 1 / np.maximum(np.bincount(y, minlength=len(langs)), 1)
    weight = (weight / weight[y].mean()).astype(np.float32)
    steps, done = epochs * -(-len(train) // BATCH), 0
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            rate = RATE * (1 - done / steps)
            done += 1
            some = train[at:at + BATCH]
            x = np.stack([feats[i][1] @ emb[feats[i][0]] for i in some])
            g = _softmax(x @ out + bias)
            g[np.arange(len(some)), y[some]] -= 1
            g *= weight[y[some]][:, None] / len(some)
            back = g @ out.T
            out -= rate * x.T @ g
            bias -= rate * g.sum(axis=0)
            for i, b in zip(some, back):
                # an average spreads its gradient thin; the table's rate makes up for it
                emb[feats[i][0]] -= (50 * rate) * feats[i][1][:, None] * b[None, :]
    logits = emb @ out
    model = {"langs": langs, "table": logits.astype(np.float32), "bias": bias, "temperature": 1.0, "reject": 0.0,
             **_usage([feats[i] for i in train], y[train], len(langs), buckets), "strange": float("inf")}
    if len(held):
        z = np.stack([feats[i][1] @ logits[feats[i][0]] for i in held]) + bias
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean()
        model["temperature"] = float(min((0.25 * 1.15 ** i for i in range(30)), key=loss))
        best = _softmax(z / model["temperature"]).max(axis=1)
        model["reject"] = float(min(REJECT_BELOW, np.quantile(best, REJECT_SHARE)))
        mean = np.array([feats[i][1] @ model["usage"][feats[i][0], y[i]] for i in held])
        strange = strangeness(mean, size[held], y[held], model)
        model["strange"] = float(max(LEAST_STRANGE, STRANGE_MARGIN * strange.max()))
    return model


def _usage(feats, y, langs: int, buckets: int) -> dict:
    """How each language uses the subwords, from training texts of equal weight:
    the log share of every bucket (smoothed), its mean over the texts of the
    language, and its deviation between texts and between single subwords."""
    import numpy as np
    share = np.zeros((buckets, langs))
    for (i, f), k in zip(feats, y):
        share[i, k] += f
    share /= np.maximum(share.sum(axis=0), 1e-9)
    usage = np.log(0.99 * share + 0.01 / buckets)
    mean = (share * usage).sum(axis=0)
    within = np.sqrt((share * (usage - mean) ** 2).sum(axis=0)) + 1e-9
    between = np.zeros(langs)
    for k in range(langs):
        got = [f @ usage[i, k] for (i, f), v in zip(feats, y) if v == k and len(i) >= 100]
        between[k] = np.std(got) if len(got) > 1 else 0.0
    return {"usage": usage.astype(np.float32), "usual": mean, "within": within, "between": between}


def strangeness(mean, n, lang, model):
    """How far below its language's the mean log share of a text's n subwords is,
    in standard deviations (of texts, and of the mean of so few subwords)."""
    import numpy as np
    sd = model["between"][lang] + model["within"][lang] / np.sqrt(np.maximum(n, 1))
    return (model["usual"][lang] - mean) / sd


def hash_of(idx, cnt) -> int:
    import zlib

    import numpy as np
    return zlib.crc32(np.asarray(idx, np.int32).tobytes() + np.asarray(cnt, np.int32).tobytes())


def _softmax(z):
    import numpy as np
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict_texts(texts, model):
    """(labels, scores, rejected) of a list of texts; None is a null text.
    Without a model, only texts without a letter are rejected."""
    import numpy as np
    label, score, rejected = [], [], []
    texts = [t or "" for t in texts]
    if model is None:
        letters = [any(map(str.isalpha, t)) for t in texts]
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [not x for x in letters]
    for lo, hi in _slices(texts):
        found = b, n, own = subword_buckets(texts[lo:hi], len(model["table"]))
        p = _softmax((averages(model["table"], found, hi - lo) + model["bias"]) / model["temperature"])
        best = p.argmax(axis=1)
        mean = np.bincount(own, weights=model["usage"][b, best[own]], minlength=hi - lo) / np.maximum(n, 1)
        strange = strangeness(mean, n, best, model) > model["strange"]
        for i in range(hi - lo):
            label.append(model["langs"][best[i]] if n[i] else UNKNOWN)
            score.append(float(p[i, best[i]]) if n[i] else 0.0)
            rejected.append(bool(not n[i] or score[-1] < model["reject"] or strange[i]))
    return label, score, rejected


def identify(docs: DataFrame, model) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, lang_pred, score, rejected.

    The whole text is read. Null texts and texts without a letter are ``und``
    with score 0 and rejected. Without a model (nothing was labelled) all is
    ``und``, and only those are rejected. Repeated rows repeat their result;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for batch in slices(batches):
            lang, score, rejected = predict_texts(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model) -> DataFrame:
    """``docs`` with the same columns, without the rows that are rejected: no
    letter, a calibrated score under the model's threshold, or a text too strange
    to the language it is given. One pass, no shuffle. Null texts go; repeated rows
    stay or go alike; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for batch in slices(batches):
            _, _, rejected = predict_texts(batch.column("text").to_pylist(), shared.value)
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(lean(run), T.StructType(docs.schema.fields))


def held_out():
    """crc32(doc_id as text) mod 3 = 1 (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def language_rows(docs: DataFrame) -> DataFrame:
    """Fit on a bounded sample of the documents that are not held out, predict all."""
    got = identify(docs, fit(labelled_sample(learnable(docs))))
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")

"""Spelling variants through permuterm rotations.

A word ends in a terminator and every rotation of it is listed. The rotation
that begins right after a letter ends in that letter: without it, two words that
differ in that letter alone have the same rotation, and a word that lacks the
letter has it as a whole rotation. So after sorting, replacements, insertions
and deletions are the rows of one prefix, and a scan of each group gives every
member its neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import cut_lineage, sized

LETTERS = "A-Za-zÀ-ÿ"
END = "$"               # no letter, so the place of a word's end is part of a rotation
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
EDITED = 199            # one in so many (document, word) pairs loses a letter in the query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, word): every maximal run of at least ``least_length`` letters of
    whole texts, A to Z in lower case. Null texts have none."""
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    return (docs.select(F.col("doc_id"), F.explode(runs).alias("word"))
            .select("doc_id", F.translate("word", UPPER, LOWER).alias("word")))


def planted(words: DataFrame, one_in: int = EDITED) -> DataFrame:
    """The occurrences of the query's contract: where the checksum of doc_id and
    word is divisible by ``one_in``, the word loses the letter that it names. A
    null doc_id has no checksum and its words stay."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    return (words.withColumn("h", h).withColumn("at", F.expr("cast(h % length(word) AS int)"))
            .select("doc_id", F.when(F.col("h") % one_in == 0, F.expr(
                "concat(substring(word, 1, at), substring(word, at + 2))")).otherwise(F.col("word")).alias("word")))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words of ``least_length`` letters that occur
    ``least_count`` times. Counted in each task first, so a frequent word costs
    a row a task."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def rotations(vocab: DataFrame) -> DataFrame:
    """(prefix, word, n, edited, first). ``edited``: the rotation after a letter,
    without that letter; ``first`` is false where the letter before is the same
    (dropping either gives the same word, which counts once). Else: a whole
    rotation, which stands for words with a letter more."""
    marked = vocab.where("word <> ''").withColumn("size", F.length("word"))
    edited = marked.withColumn("k", F.explode(F.expr("sequence(1, size)"))).select(
        F.expr(f"concat(substring(word, k + 1), '{END}', substring(word, 1, k - 1))").alias("prefix"),
        "word", "n", F.lit(True).alias("edited"),
        F.expr("k = 1 OR substring(word, k, 1) <> substring(word, k - 1, 1)").alias("first"))
    whole = marked.withColumn("k", F.explode(F.expr("sequence(0, size)"))).select(
        F.expr(f"concat(substring(word, k + 1), '{END}', substring(word, 1, k))").alias("prefix"),
        "word", "n", F.lit(False).alias("edited"), F.lit(False).alias("first"))
    return edited.unionByName(whole)


def near_words(vocab: DataFrame) -> DataFrame:
    """``vocab(word, n)``, words distinct -> (word, n, n_near, best, best_n): how
    many words differ by exactly one inserted, deleted or replaced code point, and
    the most frequent of them (ties: the smallest; null without one).

    Rotations are dealt by prefix and sorted in each partition. A prefix has at
    most one whole rotation and one edited one for each letter of the alphabet,
    so a group is small whatever the data; no pairs are formed: each member gets
    its group's count and best member other than itself. Null and empty
    words take no part, and words hold no ``$``; an empty table gives an empty one.
    """
    rows = rotations(vocab).withColumn("self", F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")))
    by = Window.partitionBy("prefix", "edited").orderBy("self")
    group = Window.partitionBy("prefix")
    # the windows over whole groups come first: their exchange serves the ordered ones too
    rows = (rows.withColumn("whole", F.max(F.when(~F.col("edited"), F.col("self"))).over(group))
            .withColumn("lead", F.min(F.when(F.col("edited"), F.col("self"))).over(group))
            .withColumn("n_edited", F.sum(F.col("edited").cast("long")).over(group))
            .withColumn("n_first", F.sum(F.col("first").cast("long")).over(group))
            .withColumn("top", F.first("self").over(by)).withColumn("next", F.lead("self").over(by))
            .withColumn("other", F.when(F.col("self") == F.col("top"), F.col("next")).otherwise(F.col("top"))))
    shorter = F.col("first") & F.col("whole").isNotNull()
    rows = rows.select(
        "word", "n",
        F.when(F.col("edited"), F.col("n_edited") - 1 + shorter.cast("long")).otherwise(F.col("n_first")).alias("c"),
        F.when(F.col("edited"), F.least("other", F.when(shorter, F.col("whole"))))
        .otherwise(F.col("lead")).alias("b"))
    return rows.groupBy("word", "n").agg(F.sum("c").alias("n_near"), F.min("b").alias("b")).select(
        "word", "n", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def variant_groups(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``near_words`` with ``form`` (the best near word, if it is ``ratio`` times as
    frequent; else null), form_n and ``root``, the last of the forms from a word on
    (itself without one).

    A form is ``ratio`` times as frequent as its word, so chains are at most
    log(largest n) long and pointers that jump over each other end in its
    logarithm of rounds; each round is a saved table.
    """
    fits = F.col("best_n") >= ratio * F.col("n")
    words = cut_lineage(near_words(vocab).select(
        "word", "n", "n_near", F.when(fits, F.col("best")).alias("form"),
        F.when(fits, F.col("best_n")).alias("form_n")), "words")
    most = words.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    longest = math.log((most["most"] or 1) / (most["least"] or 1), ratio) if most["most"] else 0
    links = cut_lineage(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    reach = 1
    while reach < longest and not links.isEmpty():
        # a link reaches as many forms as it has joined
        end = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = cut_lineage(links.join(sized(end, 64), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "links")
        reach *= 2
    return words.join(sized(links, 64), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_rows(docs: DataFrame) -> DataFrame:
    """One row per word of the contract's vocabulary: form, root, n, n_near, form_n."""
    return variant_groups(cut_lineage(vocabulary(planted(occurrences(docs))), "vocabulary"))

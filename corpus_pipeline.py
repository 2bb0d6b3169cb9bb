"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage
before kept; ``run`` writes each result as a parquet table in the shared folder
and reads it again as the next one's documents.
"""

from __future__ import annotations

from tidewatch.llm import decontaminate, language, line_dedup, near_dedup, packing
from tidewatch.llm.common import cut_lineage, read_table


def language_id(spark, docs, sf_dir):
    """Fit on a bounded sample of the labelled documents; what it rejects goes."""
    model = language.fit(language.labelled_sample(language.learnable(docs)))
    return language.keep_identified(docs, model)


def dedup_lines(spark, docs, sf_dir):
    """Lines that nearly repeat an earlier line go; so do documents left empty by it."""
    return line_dedup.drop_duplicate_lines(docs)


def dedup_documents(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark text go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), "documents")


def pack_sequences(spark, docs, sf_dir):
    """What is left, packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# No stage is plain SQL (trained model, MinHash, tokenizer): tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the training-data operators, each over the whole
of its table. The top-k search has a SQL twin; the others' results have digests
(SHA-256 over spans or ids, CRC-32, tokenizer ids, trained models) that DuckDB
cannot make or are too slow there, and are tested against brute force."""

from __future__ import annotations

from .common import read_table
from .decontaminate import contamination_rows
from .language import language_rows
from .line_dedup import line_rows
from .near_dedup import near_rows
from .packing import pack_documents
from .periodic import run_rows
from .pii import personal_rows
from .secret_scan import secret_rows
from .sharding import shard_rows
from .spelling import spelling_rows
from .topk import top_k
from .url_filter import url_rows
from .warc import archive_rows

QUERIES = {
    "op1_best_fit_packing": lambda spark, d: pack_documents(read_table(spark, d, "documents")),
    "op2_secret_scan": lambda spark, d: secret_rows(read_table(spark, d, "documents")),
    "op3_decontamination": lambda spark, d: contamination_rows(
        read_table(spark, d, "documents"), read_table(spark, d, "benchmark")),
    "op4_sharding": lambda spark, d: shard_rows(read_table(spark, d, "documents")),
    "op5_line_dedup": lambda spark, d: line_rows(read_table(spark, d, "documents")),
    "op6_near_dedup": lambda spark, d: near_rows(read_table(spark, d, "documents")),
    "op7_topk_search": lambda spark, d: top_k(read_table(spark, d, "embeddings")),
    "op8_personal_data": lambda spark, d: personal_rows(read_table(spark, d, "documents")),
    "op9_web_archive": lambda spark, d: archive_rows(read_table(spark, d, "pages")),
    "op10_language_id": lambda spark, d: language_rows(read_table(spark, d, "documents")),
    "op11_periodic_runs": lambda spark, d: run_rows(read_table(spark, d, "documents")),
    "op12_url_filter": lambda spark, d: url_rows(read_table(spark, d, "pages")),
    "op13_spelling_variants": lambda spark, d: spelling_rows(read_table(spark, d, "documents")),
}
ORACLE: dict[str, str] = {
    # scores are sums of whole numbers far under 2^53, so doubles hold them
    "op7_topk_search": """
WITH numbered AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
vectors AS (
  SELECT r, vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM numbered
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scores AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.r AS cr, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON len(q.v) = len(c.v) AND q.r <> c.r
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, cr) AS rank
  FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""}

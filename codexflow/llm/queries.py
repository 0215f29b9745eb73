"""The registered queries of this subpackage and their DuckDB twins.

Each query runs its operator, with production parameters, over a whole table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.functions.partitions import spread
from codexflow.llm import exact_dedup, fm_decontam, ppm_language, quality_ranking, sentencepiece_bpe, shared, shingle_join, suffix_tree_lm, token_counts, token_planes, toxicity_ordinal


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name == "documents" else rows


def op1_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_ordinal.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared.shared_dir(spark)}/planes"
    token_planes.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2)
    return token_planes.read_documents(spark, path)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify_with_training(_table(spark, sf_dir, "documents"))


def op5_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score_texts(_table(spark, sf_dir, "documents"))


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each call begins with an empty cache of its own, so that no count comes from an earlier run."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranking.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9_SQL = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""


OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, doc_id, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
shared AS (SELECT a.r AS ra, b.r AS rb, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM shared JOIN sizes x ON x.r = ra JOIN sizes y ON y.r = rb
          WHERE 100 * common >= 80 * (x.n + y.n - common) AND x.doc_id <> y.doc_id),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (r) LEFT JOIN least ON least.a = d.doc_id
"""

_W = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_W} AS w FROM documents),
b AS (SELECT item_id, {_W} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT DISTINCT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity_ordinal": op1_toxicity_ordinal,
        "op2_token_planes": op2_token_planes,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_ppm_language": op4_ppm_language,
        "op5_suffix_tree_lm": op5_suffix_tree_lm,
        "op6_shingle_join": op6_shingle_join,
        "op7_token_counts": op7_token_counts,
        "op8_fm_decontam": op8_fm_decontam,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_quality_ranking": op10_quality_ranking,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_shingle_join": OP6_SQL, "op8_fm_decontam": OP8_SQL, "op9_exact_dedup": OP9_SQL}

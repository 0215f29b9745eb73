"""Roll-ups over documents, jobs, outcomes and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.functions.text import is_sparse


def audit_summary(pages: DataFrame, min_chars: int = 40) -> DataFrame:
    """One row over pages (document_id, page, text): documents and pages, and the fractions with sparse pages; null where there is nothing."""
    by_doc = pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(is_sparse(F.col("text"), min_chars)).alias("low"), F.sum(F.octet_length("text")).alias("bytes"))
    return by_doc.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("pages").alias("pages"), F.count_if(F.col("low") > 0).alias("documents_with_candidates"), F.sum("low").alias("candidate_pages"),
        F.round(F.try_divide(F.count_if(F.col("low") > 0), F.count(F.lit(1))), 6).alias("document_fraction"), F.round(F.try_divide(F.sum("low"), F.sum("pages")), 6).alias("page_fraction"), F.round(F.avg("bytes"), 4).alias("mean_bytes"),
    )


def status_rollup(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("profile", "status").agg(F.count(F.lit(1)).alias("jobs"))


def versions(documents: DataFrame) -> DataFrame:
    """Documents with more than one profile."""
    return documents.groupBy("document_id").agg(F.count_distinct("profile").alias("profiles")).where("profiles > 1")


def label_counts(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("label").agg(F.count(F.lit(1)).alias("blocks"))


def manifest_metrics(chunks: DataFrame) -> DataFrame:
    """``document_id, chunks, text_bytes, first_page, last_page`` of chunk rows."""
    return chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.octet_length("text")).alias("text_bytes"), F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"))


def union_records(**kinds: DataFrame) -> DataFrame:
    """Rows of several kinds in one frame, with their kind in ``type``; absent columns are null."""
    out = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("type", F.lit(kind))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out

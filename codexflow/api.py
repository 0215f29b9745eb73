"""The command surface as functions: audit, run, export, dedup, index, search, link, status and upload plans.

A corpus is a folder of Parquet tables: ``documents`` (document_id, profile, status, page_count, low_text_pages, title,
license, language, source_url, normalized_text_sha256, simhash), ``chunks``, ``removed`` and ``sources`` (path, fingerprint,
document_id). Inputs are page texts (path, document_id, page, text), which is where PDF decoding, OCR and layout models end.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.functions import signatures as S
from codexflow.operators import audits, bindings, near_duplicates, retrieval, segmentation
from codexflow.sources import readers, writers

REVISION = 1
TABLES = {
    "documents": "document_id string, profile string, status string, page_count long, low_text_pages array<int>, title string, license string, language string, source_url string, text string, normalized_text_sha256 string, simhash long, quality_tier string",
    "chunks": segmentation.CHUNK,
    "removed": segmentation.REMOVED,
    "sources": "path string, fingerprint string, document_id string",
}


@dataclass(frozen=True)
class Config:
    """What a run depends on; the profile is a digest of it, so that a change of settings gives a new version."""

    min_chars: int = 40
    chunk_chars: int = 6000
    overlap: int = 200
    chunk_tokens: int = 1000
    tokenizer: str | None = None
    profile_tag: str = "default"
    ocr_deferred: bool = True

    @property
    def profile(self) -> str:
        text = json.dumps({"revision": REVISION, **asdict(self)}, sort_keys=True, ensure_ascii=False)
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    @property
    def limits(self) -> segmentation.Limits:
        return segmentation.Limits(self.chunk_chars, self.overlap, self.chunk_tokens)


def _read(spark: SparkSession, corpus: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{corpus}/{name}")


def _begin(spark: SparkSession, corpus: str) -> None:
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{corpus}/{name}")


def audit(pages: DataFrame, min_chars: int = 40) -> DataFrame:
    """Fractions of documents and pages with sparse text."""
    if min_chars <= 0:
        raise ValueError("min_chars must be positive")
    return audits.audit_summary(pages, min_chars)


def run(pages: DataFrame, corpus: str, config: Config = Config(), metadata: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Adds the documents of pages (path, fingerprint, document_id, page, text) that the corpus lacks; returns outcomes.

    ``metadata``: document_id, title, license, language, source_url. Sources known by path and fingerprint are skipped, and a
    document of the same id and profile is not written again. ``limit`` bounds the documents that are added.
    """
    spark = pages.sparkSession
    _begin(spark, corpus)
    known = _read(spark, corpus, "sources")
    sources = pages.select("path", "fingerprint", "document_id").distinct()
    new = bindings.uncached(sources, known)
    done = _read(spark, corpus, "documents").where(F.col("profile") == config.profile).select("document_id")
    todo = new.select("document_id").distinct().join(done, "document_id", "left_anti")
    if limit is not None:
        todo = todo.orderBy("document_id").limit(limit)
    todo = todo.persist()  # one row for each new document, read by every table below
    one_path = new.join(todo, "document_id", "left_semi").groupBy("document_id").agg(F.min("path").alias("path"))
    work = pages.join(one_path, ["document_id", "path"], "left_semi").select("document_id", "page", "text")
    status = segmentation.statuses(work, config.min_chars, config.ocr_deferred)
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    texts = work.groupBy("document_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))
    names = ("title", "license", "language", "source_url")
    meta = metadata.select("document_id", *names) if metadata is not None else spark.createDataFrame([], "document_id string, title string, license string, language string, source_url string")
    documents = status.join(texts, "document_id").join(meta, "document_id", "left").select(
        "document_id", F.lit(config.profile).alias("profile"), "status", "page_count", F.col("low_text_pages").cast("array<int>").alias("low_text_pages"), "title", F.coalesce("license", F.lit("unknown")).alias("license"),
        F.coalesce("language", F.lit("und")).alias("language"), "source_url", "text", S.normalized_sha256(F.col("text")).alias("normalized_text_sha256"), S.simhash_blake2b(F.col("text")).alias("simhash"),
        F.lit("fast_text_unreviewed").alias("quality_tier"),
    )
    flagged = F.when(F.array_contains("low_text_pages", F.col("page_start")), F.array_union("quality_flags", F.array(F.lit("low_text_page")))).otherwise(F.col("quality_flags"))
    chunks = segmentation.chunks(work, config.profile, config.limits).join(status.select("document_id", "low_text_pages"), "document_id").withColumn("quality_flags", F.array_sort(flagged))
    chunks.select(*[f.name for f in _read(spark, corpus, "chunks").schema]).write.mode("append").parquet(f"{corpus}/chunks")
    segmentation.removed_lines(work).write.mode("append").parquet(f"{corpus}/removed")
    outcomes = new.join(todo.withColumn("outcome", F.lit("added")), "document_id", "left").withColumn("outcome", F.coalesce("outcome", F.lit("known" if limit is None else "waiting")))
    outcomes = spark.createDataFrame(outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("files")).collect(), "outcome string, files long")
    documents.write.mode("append").parquet(f"{corpus}/documents")  # last: a run that breaks off before is taken up again
    written = _read(spark, corpus, "documents").where(F.col("profile") == config.profile).select("document_id")
    new.join(written, "document_id", "left_semi").select("path", "fingerprint", "document_id").write.mode("append").parquet(f"{corpus}/sources")
    todo.unpersist()
    return outcomes


def _chunks(spark: SparkSession, corpus: str) -> DataFrame:
    """Each chunk once, as a run that broke off may have appended some before."""
    return _read(spark, corpus, "chunks").dropDuplicates(["chunk_id"])


def status(spark: SparkSession, corpus: str) -> DataFrame:
    return audits.status_rollup(_read(spark, corpus, "documents"))


def export(spark: SparkSession, corpus: str, destination: str, kind: str = "documents", format: str = "parquet", licenses: list[str] = (), profile: str | None = None, role: str | None = None, shard_rows: int = writers.SHARD_ROWS) -> dict:
    """Writes ready documents, or their chunks, of the given licences to a new place."""
    if kind not in ("documents", "chunks"):
        raise ValueError("documents or chunks can be exported")
    documents = _read(spark, corpus, "documents")
    if profile is None:
        retrieval.guard_versions(documents.where("status = 'ready'"))
    if kind == "documents" and role is not None:
        texts = segmentation.role_texts(_chunks(spark, corpus)).where(F.col("content_role") == role)
        documents = documents.drop("text").join(texts, "document_id")
    rows = writers.export_rows(documents, _chunks(spark, corpus) if kind == "chunks" else None, list(licenses), profile, role)
    return writers.export_corpus(rows, destination, format, shard_rows)


def dedup(spark: SparkSession, corpus: str, profile: str | None = None, max_pairs: int = 100_000) -> DataFrame:
    """Candidates for review among ready documents; nothing is deleted."""
    documents = _read(spark, corpus, "documents").where("status = 'ready'")
    documents = documents.where(F.col("profile") == profile) if profile else retrieval.guard_versions(documents)
    rows = documents.select(F.col("document_id").alias("doc_id"), "simhash", F.col("normalized_text_sha256").alias("digest"))
    return near_duplicates.candidate_report(rows, rows, max_pairs)


def index(spark: SparkSession, corpus: str, destination: str, include_needs_review: bool = False, profile: str | None = None) -> DataFrame:
    """Writes the indexable chunks with their citations, postings and lengths as a new snapshot, and returns the receipt.

    A chunk id with different texts is an error.
    """
    wanted = ["ready", *(["needs_ocr", "needs_review"] if include_needs_review else [])]
    documents = _read(spark, corpus, "documents").where(F.col("status").isin(*wanted))
    documents = documents.where(F.col("profile") == profile) if profile else retrieval.guard_versions(documents)
    sources = _read(spark, corpus, "sources")
    cited = bindings.first_path(documents.select("document_id", "profile", "title", "license", "language", "source_url", "status", "quality_tier"), sources)
    rows = _chunks(spark, corpus).join(cited, ["document_id", "profile"]).withColumnRenamed("text", "body")
    good = retrieval.indexable(F.col("page_start"), F.col("quality_flags"), F.col("body"))
    texts = _read(spark, corpus, "chunks").groupBy("chunk_id").agg(F.min(F.sha2("text", 256)).alias("low"), F.max(F.sha2("text", 256)).alias("high"))
    if twice := texts.where("low <> high").first():
        raise ValueError(f"chunk {twice.chunk_id} has different texts")
    retrieval.write_index(rows.where(good), destination)
    return retrieval.index_receipt(rows)


def search(spark: SparkSession, index: str, query: str, limit: int = 5, license: str | None = None, role: str | None = None) -> DataFrame:
    stored = spark.read.parquet(f"{index}/postings"), spark.read.parquet(f"{index}/lengths")
    return retrieval.search(spark.read.parquet(f"{index}/chunks"), query, limit, license, role, stored=stored)


def link(spark: SparkSession, manifest: str, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bindings of a manifest to an inventory (relative, size), and the summary of matches and errors."""
    rows = readers.manifest(readers.numbered_lines(spark, manifest))
    good = rows.where("error IS NULL")
    matches = bindings.bind_downloads(good, inventory).drop("file_no").unionByName(bindings.bind_paths(good, inventory))
    broken = rows.where("error IS NOT NULL").select("line", F.lit(None).cast("string").alias("relative"), F.lit(None).cast("long").alias("size"), "error")
    linked = bindings.bindings(matches).join(bindings.binding_metadata(good), "line", "left")
    return linked, bindings.link_summary(matches.unionByName(broken), inventory)

"""Writers: licence-filtered corpus exports, catalogues and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns of an export.
EXPORT = (
    "record_id string, document_id string, profile string, title string, license string, language string, source_url string, content_role string, anchor string, text string, metadata string, "
    "page_start int, page_end int, token_count int, section_path array<string>"
)
SHARD_ROWS, SHARD_BYTES = 1000, 32 << 20


def licensed(licence: Column, wanted: list[str]) -> Column:
    """Exact membership; a missing licence is unknown, and an empty list filters nothing."""
    return F.coalesce(licence, F.lit("unknown")).isin(*wanted) if wanted else F.lit(True)


def export_rows(documents: DataFrame, chunks: DataFrame | None = None, licenses: list[str] = (), profile: str | None = None, role: str | None = None) -> DataFrame:
    """Rows of ready documents (document_id, profile, status, license, language, title, source_url, text), or of their chunks.

    Filters on status, profile and licence come before any text is joined.
    """
    ready = documents.where("status = 'ready'").where(licensed(F.col("license"), list(licenses)))
    if profile is not None:
        ready = ready.where(F.col("profile") == profile)
    licence = F.coalesce("license", F.lit("unknown")).alias("license")
    if chunks is None:
        rows = ready if role is None else ready.where(F.col("content_role") == role) if "content_role" in ready.columns else ready
        return rows.select(F.concat_ws(":", "document_id", "profile").alias("record_id"), "document_id", "profile", "title", licence, "language", "source_url", "text")
    rows = chunks if role is None else chunks.where(F.col("content_role") == role)
    joined = rows.join(ready.select("document_id", "profile", "title", licence, "language", "source_url"), ["document_id", "profile"])
    return joined.select(F.col("chunk_id").alias("record_id"), "document_id", "profile", "title", "license", "language", "source_url", "content_role", "anchor", "text", "page_start", "page_end", "token_count", "section_path")


def shards(rows: DataFrame, key_cols: list[str], text_col: str = "text", most_rows: int = SHARD_ROWS, most_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows with ``part`` and ``shard``: within each hash part, a new shard begins with every ``most_bytes`` of text or ``most_rows`` rows.

    Parts keep the running sums apart, so no task sees the whole table.
    """
    part = F.pmod(F.xxhash64(*key_cols), F.lit(max(1, rows.rdd.getNumPartitions())))
    inside = Window.partitionBy("part").orderBy(*key_cols)
    size, count = F.sum(F.octet_length(text_col)).over(inside) - F.octet_length(text_col), F.row_number().over(inside) - 1
    return rows.withColumn("part", part).withColumn("shard", F.greatest(F.floor(size / most_bytes), F.floor(count / most_rows)))


def export_corpus(rows: DataFrame, destination: str, format: str = "parquet", shard_rows: int = SHARD_ROWS) -> dict:
    """Writes rows to a new place, at most ``shard_rows`` to a file, and returns a receipt. An existing place is an error."""
    if format not in ("parquet", "jsonl"):
        raise ValueError("the format is parquet or jsonl")
    if shard_rows <= 0:
        raise ValueError("a shard holds one row at least")
    writer = rows.write.mode("errorifexists").option("maxRecordsPerFile", shard_rows)
    if format == "parquet":
        writer.option("compression", "zstd").parquet(destination)
    else:
        writer.option("compression", "gzip").json(destination)
    spark = rows.sparkSession
    back = spark.read.parquet(destination) if format == "parquet" else spark.read.schema(rows.schema).json(destination)
    return {"destination": destination, "format": format, "rows": back.count(), "shard_rows": shard_rows}


def write_catalogue(flat: DataFrame, records: DataFrame, people: DataFrame, destination: str) -> None:
    """CSV of texts, JSON lines of nested records, and Parquet of both tables."""
    flat.write.mode("errorifexists").option("header", True).csv(f"{destination}/csv")
    records.write.mode("errorifexists").json(f"{destination}/jsonl")
    flat.write.mode("errorifexists").parquet(f"{destination}/theses")
    people.write.mode("errorifexists").parquet(f"{destination}/people")


def report(title: str, rows: DataFrame, order: list[str], most: int = 1000) -> str:
    """A small Markdown table of at most ``most`` rows in order."""
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    for r in rows.orderBy(*order).limit(most).collect():
        lines.append("| " + " | ".join("" if v is None else str(v) for v in r) + " |")
    return "\n".join(lines) + "\n"


def review(blocks: DataFrame, start: int, end: int) -> DataFrame:
    """``label, blocks`` of layout blocks (label, pages) on pages from ``start`` to ``end``; a block outside the range is an error."""
    if start < 1 or end < start:
        raise ValueError("the range is empty")
    outside = blocks.where(F.exists("pages", lambda p: (p < start) | (p > end))).limit(1).count()
    if outside:
        raise ValueError("a block lies outside the reviewed pages")
    return blocks.groupBy("label").agg(F.count(F.lit(1)).alias("blocks"))

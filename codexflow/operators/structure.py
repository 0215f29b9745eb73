"""Layout and structure: page texts from blocks, page ranges of coordinates, and metadata that only structure knows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACEHOLDER = "Document"


def page_texts(blocks: DataFrame, page_count: DataFrame | None = None) -> DataFrame:
    """``document_id, page, text`` put together from layout blocks (document_id, item, text, pages) in order of ``item``.

    A block on several pages counts for each. With ``page_count`` (document_id, page_count) pages without blocks are there, empty.
    """
    rows = blocks.select("document_id", "item", "text", F.explode(F.array_distinct("pages")).alias("page"))
    ordered = F.array_sort(F.collect_list(F.struct("item", "text")))
    found = rows.groupBy("document_id", "page").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))
    if page_count is None:
        return found
    every = page_count.select("document_id", F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page"))
    return every.join(found, ["document_id", "page"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def page_range(rows: DataFrame, coords_col: str = "coords") -> DataFrame:
    """Rows with the first and last page of their coordinates (array of structs with ``page``); null without any."""
    pages = F.transform(coords_col, lambda c: c["page"])
    return rows.withColumns({"page_start": F.array_min(pages), "page_end": F.array_max(pages)})


def anchored(rows: DataFrame) -> DataFrame:
    """Rows (document_id, page_start) with their anchor; null where there is no page."""
    anchor = F.concat(F.lit("sha256:"), F.col("document_id").cast("string"), F.lit("#page="), F.col("page_start").cast("string"))
    return rows.withColumn("anchor", F.when(F.col("page_start") > 0, anchor))


def with_structure(documents: DataFrame, structure: DataFrame) -> DataFrame:
    """Documents (document_id, title, authors) that take title and authors from structure (same columns) where they have none.

    ``heading`` is the title a rendered document begins with.
    """
    other = structure.select("document_id", F.col("title").alias("__title"), F.col("authors").alias("__authors"))
    rows = documents.join(other, "document_id", "left")
    title = F.coalesce(F.nullif("title", F.lit("")), F.nullif("__title", F.lit("")))
    authors = F.when(F.coalesce(F.size("authors"), F.lit(0)) > 0, F.col("authors")).otherwise(F.coalesce("__authors", F.array().cast("array<string>")))
    return rows.withColumns({"title": title, "authors": authors, "heading": F.coalesce(title, F.lit(PLACEHOLDER))}).drop("__title", "__authors")

"""Size census, sample allocation, stratified byte-share estimates and page inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIB = 1024 * 1024
# Upper bounds of the size bins in MiB.
BOUNDS = [1, 5, 20, 100, 500, 1024]
LAST_BIN = f">={BOUNDS[-1]} MiB"


def labels(bounds: list[int] = BOUNDS, unit: str = "MiB") -> list[str]:
    return [*(f"<{b} {unit}" for b in bounds), f">={bounds[-1]} {unit}"]


def bin_label(size: Column, bounds: list[int] = BOUNDS, scale: int = MIB, unit: str = "MiB") -> Column:
    """The half-open bin of a size; ``bounds`` are in units of ``scale``."""
    out = F.when(size < bounds[0] * scale, F.lit(f"<{bounds[0]} {unit}"))
    for b in bounds[1:]:
        out = out.when(size < b * scale, F.lit(f"<{b} {unit}"))
    return out.otherwise(F.lit(f">={bounds[-1]} {unit}"))


def histogram(files: DataFrame, size_col: str, bounds: list[int] = BOUNDS, scale: int = MIB, unit: str = "MiB") -> DataFrame:
    """``bin, files, bytes`` for every bin, empty ones too."""
    spark = files.sparkSession
    counted = files.groupBy(bin_label(F.col(size_col), bounds, scale, unit).alias("bin")).agg(F.count(F.lit(1)).alias("files"), F.sum(size_col).alias("bytes"))
    bins = spark.createDataFrame([(x,) for x in labels(bounds, unit)], "bin string")
    return bins.join(counted, "bin", "left").select("bin", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def allocate(bins: DataFrame, budget: int, floor: int = 5) -> DataFrame:
    """``bin, files, bytes, quota``: the budget by bytes, at least ``floor`` and at most the bin's files. Quotas may exceed the budget."""
    live = bins.where("files > 0")
    total = F.greatest(F.sum("bytes").over(Window.partitionBy()), F.lit(1))  # a row for each bin
    share = F.bround(F.lit(float(budget)) * F.col("bytes") / total, 0)
    return live.select("bin", "files", "bytes", F.least(F.col("files"), F.greatest(F.lit(floor), share)).cast("long").alias("quota"))


def duplicate_summary(files: DataFrame, digest_col: str, size_col: str) -> DataFrame:
    """``groups, extra_copies, extra_bytes, hashed`` of equal digests; nulls for the first three if nothing is hashed."""
    groups = files.where(F.col(digest_col).isNotNull()).groupBy(digest_col).agg(F.count(F.lit(1)).alias("n"), F.min(size_col).alias("size"))
    return groups.agg(
        F.when(F.count(F.lit(1)) > 0, F.count_if(F.col("n") > 1)).alias("groups"),
        F.when(F.count(F.lit(1)) > 0, F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0))).alias("extra_copies"),
        F.when(F.count(F.lit(1)) > 0, F.coalesce(F.sum(F.when(F.col("n") > 1, (F.col("n") - 1) * F.col("size"))), F.lit(0))).alias("extra_bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("hashed"),
    )


def stratified_estimates(sample: DataFrame, population: DataFrame) -> DataFrame:
    """``category, estimated_bytes, estimated_share, ci95_bytes, ci95_share`` from sampled rows (bin, category, bytes) and bins (bin, files, bytes).

    Within a bin the category's share of sampled bytes carries over to the bin's bytes; the variance has the finite-population
    correction, so a bin that was sampled whole adds none.
    """
    by_bin = sample.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("sampled")).where("sampled > 0")
    by_both = sample.groupBy("bin", "category").agg(F.sum("bytes").alias("own"))
    pop = population.select("bin", F.col("files").alias("bin_files"), F.col("bytes").alias("bin_bytes"))
    total = F.lit(population.agg(F.sum("bytes")).first()[0] or 1)
    rows = by_both.join(by_bin, "bin").join(pop, "bin", "left").withColumn("p", F.col("own") / F.col("sampled"))
    part = F.coalesce(F.col("bin_bytes"), F.lit(0)).cast("double")
    fpc = F.when(F.col("bin_files") > 0, F.greatest(F.lit(0.0), 1 - F.col("n") / F.col("bin_files"))).otherwise(F.lit(1.0))
    variance = part * part * F.col("p") * (1 - F.col("p")) / F.greatest(F.col("n") - 1, F.lit(1)) * fpc
    out = rows.groupBy("category").agg(F.sum(part * F.col("p")).alias("estimate"), (1.96 * F.sqrt(F.sum(variance))).alias("half"))
    return out.select(
        "category", F.bround("estimate", 0).cast("long").alias("estimated_bytes"), F.bround(F.col("estimate") / total, 4).alias("estimated_share"),
        F.bround("half", 0).cast("long").alias("ci95_bytes"), F.bround(F.col("half") / total, 4).alias("ci95_share"),
    )


def strata(sample: DataFrame, population: DataFrame, floor: int = 5) -> DataFrame:
    """``bin, files, bytes, sampled, censused, insufficient`` for each bin with files."""
    drawn = sample.groupBy("bin").agg(F.count(F.lit(1)).alias("sampled"))
    rows = population.where("files > 0").join(drawn, "bin", "left").withColumn("sampled", F.coalesce("sampled", F.lit(0)))
    return rows.select("bin", "files", "bytes", "sampled", (F.col("sampled") == F.col("files")).alias("censused"), ((F.col("sampled") < floor) & (F.col("sampled") < F.col("files"))).alias("insufficient"))


def stratified_sample(files: DataFrame, quotas: DataFrame, key_col: str, bin_col: str = "bin", seed: int = 42) -> DataFrame:
    """In each bin the quota's number of rows that come first by a digest of key and seed: the same draw on every run.

    Rows beyond a threshold of the digest, set to hold the quota several times over, go before the ranking, so no window
    ever holds a whole bin.
    """
    digest = F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{seed}")))
    want = quotas.select(bin_col, "quota", "files")
    scaled = F.col("quota") * 4 + 64
    part = F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = files.withColumn("digest", digest).join(F.broadcast(want), bin_col).where(part * F.col("files") <= scaled)
    rank = F.row_number().over(Window.partitionBy(bin_col).orderBy("digest", key_col))
    return rows.withColumn("rank", rank).where("rank <= quota").drop("rank", "digest", "quota", "files")


def uniform_sample(rows: DataFrame, key_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by a digest of key and seed."""
    return rows.orderBy(F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{seed}"))), key_col).limit(n)


def page_count_plan(count: Column, most: int = 3, cap: int = 16) -> Column:
    """How many of a document's pages to look at."""
    return F.greatest(F.lit(1), F.least(F.lit(cap), count, F.greatest(F.lit(most), F.ceil(F.sqrt(count) / 2)))).cast("int")


def page_indices(count: Column, planned: Column) -> Column:
    """Evenly spaced page numbers from 0, halves rounded to even."""
    spaced = F.transform(F.sequence(F.lit(0), planned - 1), lambda i: F.bround(i * (count - 1) / F.greatest(F.lit(1), planned - 1), 0).cast("int"))
    return F.array_sort(F.array_distinct(spaced))


def extra_indices(count: Column, indices: Column) -> Column:
    """Up to four pages more where all planned ones are sparse: each planned page moved by half the spacing."""
    step = F.greatest(F.lit(1), F.floor(count / (2 * F.size(indices))))
    moved = F.transform(indices, lambda i: F.least(count - 1, F.greatest(F.lit(0), i + step)).cast("int"))
    found = F.slice(F.array_sort(F.array_except(F.array_distinct(moved), indices)), 1, 4)
    return F.when(count > F.size(indices), found).otherwise(F.array().cast("array<int>"))


def inspection_category(pages: int | Column, low: Column, images: Column, forms: Column) -> Column:
    """Of a document by how many of its looked-at pages are sparse, and whether any has an image or a form."""
    all_low = F.when(images, F.lit("low_text_image_candidate")).when(forms, F.lit("low_text_form_candidate")).otherwise(F.lit("low_text_unknown"))
    return F.when(low == pages, all_low).when(low > 0, F.lit("mixed_text_candidate")).otherwise(F.lit("text_present"))


def effective_dpi(pixels: Column, a: Column, b: Column, unit: Column) -> Column:
    """Dots per inch of an image painted into the unit square by a matrix with (a, b) along this axis; null if it has no extent."""
    extent = F.hypot(a, b) * unit
    return F.when(extent != 0, F.bround(72 * pixels / extent, 1))


def inspect(pages: DataFrame, min_chars: int = 40) -> DataFrame:
    """``document_id, pages_examined, low_pages, category`` from examined pages (document_id, alnum_chars, images, forms)."""
    rows = pages.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages_examined"), F.count_if(F.col("alnum_chars") < min_chars).alias("low_pages"), F.bool_or(F.col("images") > 0).alias("images"), F.bool_or(F.col("forms") > 0).alias("forms")
    )
    return rows.select("document_id", "pages_examined", "low_pages", inspection_category(F.col("pages_examined"), F.col("low_pages"), F.col("images"), F.col("forms")).alias("category"))

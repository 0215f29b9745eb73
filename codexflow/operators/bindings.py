"""Manifest rows to local files: candidate keys, safety checks, metadata, and the state tables around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexflow.functions.rights import licence_from_evidence


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: how appended tables stand for upserts."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__n", rank).where("__n = 1").drop("__n")


def keep_newest(generations: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest of generations (generation, created_at)."""
    return generations.orderBy(F.desc("created_at"), F.desc("generation")).limit(n)


def unsafe_path(path: Column) -> Column:
    """Absolute paths and paths with a parent step."""
    return path.rlike(r"^/|^[A-Za-z]:|(^|/)\.\.(/|$)")


def uncached(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Files (path, fingerprint) that no source row has: what an incremental run has to read."""
    return files.join(sources.select("path", "fingerprint"), ["path", "fingerprint"], "left_anti")


def to_upload(manifests: DataFrame, receipts: DataFrame, remote: str) -> DataFrame:
    """Ready manifests (document_id, profile, status, manifest_sha) without a receipt of the same content at ``remote``."""
    done = receipts.where(F.col("remote") == remote).select("document_id", "profile", "manifest_sha")
    return manifests.where("status = 'ready'").join(done, ["document_id", "profile", "manifest_sha"], "left_anti")


def download_candidates(manifest: DataFrame) -> DataFrame:
    """``line, relative, expected, file_no`` of downloaded files of manifest rows (line, uuid, downloaded_files).

    A file may lie at uuid/name or, if its recorded folder is the uuid, at uuid/recorded name.
    """
    rows = manifest.where(F.col("downloaded_files").isNotNull() & (F.coalesce("uuid", F.lit("")) != "")).select("line", "uuid", F.posexplode("downloaded_files").alias("file_no", "f"))
    rows = rows.where("f.download_status = 'downloaded'")
    recorded = F.coalesce(F.col("f.path"), F.lit(""))
    parent, base = F.element_at(F.split(recorded, "/"), -2), F.element_at(F.split(recorded, "/"), -1)
    given = F.concat("uuid", F.lit("/"), F.coalesce(F.col("f.name"), F.lit("")))
    other = F.when(F.size(F.split(recorded, "/")) >= 2, F.when(parent == F.col("uuid"), F.concat("uuid", F.lit("/"), base)))
    keys = F.array_distinct(F.array_compact(F.array(given, other)))
    return rows.select("line", "file_no", F.explode(keys).alias("relative"), F.col("f.sizeBytes").cast("long").alias("expected"))


def bind_downloads(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """``line, file_no, relative, size, error`` of each downloaded file that the inventory (relative, size) has.

    Two present files for one entry, a missing expected size and a size that differs are errors; ``relative`` is the first
    file in order.
    """
    found = download_candidates(manifest).join(inventory.select("relative", "size"), "relative")
    one = found.groupBy("line", "file_no", "expected").agg(F.count(F.lit(1)).alias("n"), F.min_by("size", "relative").alias("size"), F.min("relative").alias("relative"))
    error = (
        F.when(F.col("n") > 1, F.lit("ambiguous file names")).when(unsafe_path(F.col("relative")), F.lit("path leaves the root")).when(F.col("expected").isNull(), F.lit("missing size"))
        .when(F.col("expected") != F.col("size"), F.lit("size mismatch"))
    )
    return one.select("line", "file_no", "relative", "size", error.alias("error"))


def bind_paths(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """``line, relative, size, error`` of manifest rows (line, pdf_path, size_bytes) that name a path.

    Unsafe paths are errors whether or not the file exists; a path that the inventory lacks gives no row.
    """
    rows = manifest.where(F.coalesce("pdf_path", F.lit("")) != "").select("line", F.col("pdf_path").alias("relative"), F.col("size_bytes").cast("long").alias("expected"))
    joined = rows.join(inventory.select("relative", "size"), "relative", "left").where(F.col("size").isNotNull() | unsafe_path(F.col("relative")))
    error = F.when(unsafe_path(F.col("relative")), F.lit("path leaves the root")).when(F.col("expected") != F.col("size"), F.lit("size mismatch"))
    return joined.select("line", "relative", "size", error.alias("error"))


def binding_metadata(manifest: DataFrame) -> DataFrame:
    """``line`` and the metadata a manifest row gives its files: source, title, year, language and licence by their fallbacks.

    Needs columns line, source_url, uri, landing_url, title, year, submitted, language, license, licence_class, rights and
    rights_uri; absent ones are taken as null.
    """
    have = set(manifest.columns)

    def first(*names: str) -> Column:
        return F.coalesce(*(F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in have), F.lit(None).cast("string"))

    texts = [F.coalesce(F.col(n), F.array().cast("array<string>")) for n in ("rights", "rights_uri") if n in have]
    evidence = licence_from_evidence(F.array_join(F.concat(*texts), " ")) if texts else F.lit("unknown")
    return manifest.select(
        "line", first("source_url", "uri", "landing_url").alias("source_url"), first("repository", "repo").alias("repository"), first("uuid", "oai_identifier").alias("source_identifier"),
        first("title").alias("title"), first("doi").alias("doi"), F.nullif(F.substring(first("year", "submitted"), 1, 4), F.lit("")).alias("year"),
        F.coalesce(first("language"), F.lit("und")).alias("language"), F.coalesce(first("license", "licence_class"), evidence).alias("license"),
    )


def bindings(matches: DataFrame) -> DataFrame:
    """Error-free matches (line, relative), the last manifest line of a path winning."""
    return latest(matches.where("error IS NULL"), ["relative"], [F.desc("line")])


def link_summary(matches: DataFrame, inventory: DataFrame) -> DataFrame:
    """``matched, unmatched, errors`` over an inventory."""
    rows = matches.select("relative", "error", F.lit(0).alias("files")).unionByName(inventory.select(F.lit(None).cast("string").alias("relative"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("files")))
    matched = F.count_distinct(F.when(F.col("error").isNull(), F.col("relative")))
    return rows.agg(matched.alias("matched"), (F.coalesce(F.sum("files"), F.lit(0)) - matched).alias("unmatched"), F.count("error").alias("errors"))


def bound(sources: DataFrame, links: DataFrame) -> DataFrame:
    """Sources (path, fingerprint) with their binding; ``error`` says why one has none that still holds."""
    rows = sources.join(links.select("path", F.col("fingerprint").alias("__bound"), *[c for c in links.columns if c not in ("path", "fingerprint")]), "path", "left")
    return rows.withColumn("error", F.when(F.col("__bound").isNull(), F.lit("no binding")).when(F.col("__bound") != F.col("fingerprint"), F.lit("file changed since it was bound"))).drop("__bound")


def first_path(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """Jobs with the first of their document's source paths in order."""
    return jobs.join(sources.groupBy("document_id").agg(F.min("path").alias("original_path")), "document_id", "left")


def valid_bundles(manifests: DataFrame, files: DataFrame, required: list[str]) -> DataFrame:
    """Manifests (document_id, profile, files map name to digest) whose required files are listed and whose listed files (document_id, profile, name, sha256) all match."""
    listed = manifests.select("document_id", "profile", F.explode("files").alias("name", "want"))
    wrong = listed.join(files, ["document_id", "profile", "name"], "left").where("NOT (sha256 <=> want) OR name LIKE '%/%'").select("document_id", "profile").distinct()
    complete = manifests.where(F.size(F.array_except(F.array(*map(F.lit, required)), F.map_keys("files"))) == 0)
    return complete.join(wrong, ["document_id", "profile"], "left_anti")

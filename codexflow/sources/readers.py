"""Readers: file inventories, page texts, sidecars, manifests, registries and harvested XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a sidecar and the older names that stand in for them, with what an absent one counts as.
SIDECAR = {
    "source_url": (["source_url", "landing_url"], None),
    "repository": (["repository", "repo"], None),
    "source_identifier": (["source_identifier", "oai_identifier"], None),
    "title": (["title"], None),
    "doi": (["doi"], None),
    "year": (["year"], None),
    "language": (["language"], "und"),
    "license": (["license", "licence_class"], "unknown"),
    "license_url": (["license_url"], None),
}
SIDECAR_LISTS = ["authors", "rights", "rights_uri"]
MANIFEST = (
    "uuid string, oai_identifier string, title string, doi string, year string, submitted string, language string, license string, licence_class string, repository string, repo string, "
    "source_url string, uri string, landing_url string, authors array<string>, rights string, rights_uri string, pdf_path string, size_bytes long, "
    "downloaded_files array<struct<name:string,path:string,download_status:string,sizeBytes:long,content_url:string>>, __bad string"
)


def fingerprint(length: Column, modified: Column) -> Column:
    """Size and modification time: Spark sees no change time, so this is weaker than a content hash."""
    return F.concat_ws(":", length.cast("string"), F.unix_micros(modified).cast("string"))


def inventory(spark: SparkSession, root: str, glob: str = "*.[pP][dD][fF]", hashed: bool = False, settled_before: str | None = None) -> DataFrame:
    """``path, size, modified, fingerprint`` (and ``sha256``) of files below ``root``; content is read only to hash it.

    Spark leaves out names that begin with a dot or an underscore, and empty files. ``settled_before``: files changed later
    stay out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if settled_before is not None:
        reader = reader.option("modifiedBefore", settled_before)
    files = reader.load(root)
    columns = ["path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), fingerprint(F.col("length"), F.col("modificationTime")).alias("fingerprint")]
    return files.select(*columns, *([F.sha2("content", 256).alias("sha256")] if hashed else []))


def relative_to(root: str, path: Column) -> Column:
    """A file's path below ``root``, without a scheme."""
    bare = root.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    return F.regexp_replace(F.regexp_replace(path, r"^[a-z]+:/*", "/"), f"^{bare}/", "")


def pages_of(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``document_id, page, text``: texts cut at form feeds, without a blank last part, NULs and carriage returns."""
    clean = F.replace(F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\0"), F.lit(""))
    parts = F.split(clean, "\f", -1)
    last_blank = (F.size(parts) > 1) & (F.trim(F.element_at(parts, -1)) == "")
    kept = F.when(last_blank, F.slice(parts, 1, F.greatest(F.lit(1), F.size(parts) - 1))).otherwise(parts)
    return documents.select(F.col(id_col).cast("string").alias("document_id"), F.posexplode(kept).alias("page", "text")).withColumn("page", F.col("page") + 1)


def sidecars(raw: DataFrame) -> DataFrame:
    """Metadata rows (path, json) on the sidecar's fields; a value that is no JSON object gives an error row."""
    fields = sorted({n for names, _ in SIDECAR.values() for n in names})
    ddl = ", ".join([*(f"{n} string" for n in fields), *(f"{n} array<string>" for n in SIDECAR_LISTS)])
    rows = raw.withColumn("r", F.from_json("json", ddl))
    out = []
    for name, (names, otherwise) in SIDECAR.items():
        out.append(F.coalesce(*(F.nullif(F.col(f"r.{n}"), F.lit("")) for n in names), F.lit(otherwise).cast("string")).alias(name))
    lists = [F.coalesce(f"r.{n}", F.array().cast("array<string>")).alias(n) for n in SIDECAR_LISTS]
    method = F.when(F.nullif("r.language", F.lit("")).isNotNull(), F.lit("source_metadata")).otherwise(F.lit("unknown"))
    return rows.select("path", *out, *lists, method.alias("language_method"), F.sha2("json", 256).alias("metadata_sha256"), F.when(~F.coalesce(F.trim("json").rlike(r"(?s)^\{.*\}$"), F.lit(False)), F.lit("not an object")).alias("error"))


def read_sidecars(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.metadata.json")
    return sidecars(files.select(F.regexp_replace(F.input_file_name(), r"\.metadata\.json$", "").alias("path"), F.col("value").alias("json")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value`` of one file's non-blank lines, numbered from 1.

    The file is read in one stretch, as line numbers need what stands before; a manifest is a driver-sized list of files.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "value"))
    return lines.where(F.trim("value") != "").select((F.col("at") + 1).alias("line"), "value")


def manifest(lines: DataFrame) -> DataFrame:
    """Manifest rows of numbered JSON lines; ``error`` marks those that are no objects. Texts and lists of texts are read alike."""
    rows = lines.withColumn("r", F.from_json("value", MANIFEST, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    bad = F.col("r.__bad").isNotNull() | F.col("r").isNull() | ~F.trim("value").startswith("{")
    names = [f.split(" ")[0] for f in MANIFEST.replace(", ", ",").split(",") if " " in f and ":" not in f.split(" ")[0]]
    plain = [n for n in names if n not in ("__bad", "rights", "rights_uri")]
    return rows.select("line", *(F.col(f"r.{n}") for n in plain), strings(F.col("r.rights")).alias("rights"), strings(F.col("r.rights_uri")).alias("rights_uri"), F.when(bad, F.lit("not a JSON object")).alias("error"))


def strings(value: Column) -> Column:
    """A JSON value read as text, as a list: null gives none, a list its members, anything else itself."""
    listed = F.from_json(value, "array<string>")
    return F.when(value.isNull(), F.array().cast("array<string>")).when(value.startswith("["), F.coalesce(listed, F.array(value))).otherwise(F.array(value))


def registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, name string, repo string, country string, software string, oai array<string>, rest array<string>, nobel int").option("multiLine", True).json(path)


def json_records(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines, plain or gzipped, without malformed ones."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def oai_records(pages: DataFrame) -> DataFrame:
    """Records of OAI ListRecords pages (repo, prefix, xml): header columns and the metadata's fields."""
    import pandas as pd

    from codexflow.operators import harvest as H

    ddl = f"repo string, prefix string, oai_identifier string, datestamp string, sets array<string>, deleted boolean, fields {H.FIELDS}, token string, error string"
    names = ["repo", "prefix", "oai_identifier", "datestamp", "sets", "deleted", "fields", "token", "error"]
    oai = "{http://www.openarchives.org/OAI/2.0/}"

    def rows_of(repo: str, prefix: str, xml: str):
        from xml.etree import ElementTree

        root = H.parse_xml(xml or "")
        if root is None:
            yield [repo, prefix, None, None, [], False, None, None, "unreadable XML"]
            return
        if (problem := root.find(f"{oai}error")) is not None:
            yield [repo, prefix, None, None, [], False, None, None, problem.get("code")]
            return
        token = (root.findtext(f".//{oai}resumptionToken") or "").strip() or None
        for record in root.iter(f"{oai}record"):
            header, metadata = record.find(f"{oai}header"), record.find(f"{oai}metadata")
            fields = H.fields_of(ElementTree.tostring(metadata, "unicode"), prefix) if metadata is not None else None
            yield [
                repo, prefix, (header.findtext(f"{oai}identifier") or "").strip(), (header.findtext(f"{oai}datestamp") or "").strip(),
                [(s.text or "").strip() for s in header.iterfind(f"{oai}setSpec")], header.get("status") == "deleted", fields, token, None,
            ]

    def run(batches):
        for batch in batches:
            yield pd.DataFrame([r for x in zip(batch["repo"], batch["prefix"], batch["xml"], strict=True) for r in rows_of(*x)], columns=names)

    return pages.select("repo", "prefix", "xml").mapInPandas(run, ddl)

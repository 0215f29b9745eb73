"""Incremental runs: watching a folder, and dropping records seen before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codexflow.operators.bindings import uncached
from codexflow.sources.readers import fingerprint


def watch(spark: SparkSession, root: str, ledger: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], settle: int = 60, interval: str | None = None, most_files: int = 100, glob: str = "*") -> StreamingQuery:
    """Processes new and changed files below ``root`` and appends (path, fingerprint, outcome) to ``ledger``.

    ``process`` gets files (path, size, fingerprint, content) and returns rows (path, outcome). Files changed within the
    last ``settle`` seconds wait for a later pass, as the stream offers a file but once: they go to the ledger as ``unsettled``
    and a later ``retry`` takes them up. A file whose fingerprint the ledger has is skipped. Without ``interval`` one pass runs.
    """
    schema = "path string, fingerprint string, outcome string"
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", most_files).load(root)

    def one(batch: DataFrame, _: int) -> None:
        files = batch.select("path", F.col("length").alias("size"), "modificationTime", fingerprint(F.col("length"), F.col("modificationTime")).alias("fingerprint"), "content")
        files = uncached(files, spark.read.schema(schema).parquet(ledger).where("outcome NOT IN ('error', 'unsettled')"))
        old = F.col("modificationTime") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(settle))
        done = process(files.where(old).drop("modificationTime")).select("path", "outcome")
        rows = files.where(old).select("path", "fingerprint").join(done, "path", "left").withColumn("outcome", F.coalesce("outcome", F.lit("error")))
        rows.unionByName(files.where(~old).select("path", "fingerprint", F.lit("unsettled").alias("outcome"))).write.mode("append").parquet(ledger)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def pass_summary(ledger: DataFrame) -> DataFrame:
    """``outcome, files`` of a ledger."""
    return ledger.groupBy("outcome").agg(F.count(F.lit(1)).alias("files"))


def new_records(stream: DataFrame, key: str = "oai_identifier") -> DataFrame:
    """A stream's records, each key once over all batches (kept in the state store)."""
    return stream.dropDuplicates([key])


def append_new(stream: DataFrame, sink: str, checkpoint: str, key: str = "oai_identifier") -> StreamingQuery:
    """Appends a stream's records that ``sink`` lacks; a batch that is run again appends nothing twice."""
    spark = stream.sparkSession
    schema = stream.schema
    spark.createDataFrame([], schema).write.mode("append").parquet(sink)

    def one(batch: DataFrame, _: int) -> None:
        have = spark.read.schema(schema).parquet(sink).select(key)
        batch.dropDuplicates([key]).join(have, key, "left_anti").select(*schema.names).write.mode("append").parquet(sink)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Exact deduplication by skew-safe combining.

Three stages, each of which compares full content: rows are combined within a task, the local winners are combined by
(digest, salt, content), and the winners of all salts by (digest, content). A text that a third of all rows share
reaches the first shuffle once per task and the second once per salt. Content travels zstd-compressed, which is
lossless and deterministic for one library version, so equal bytes mean equal texts and unequal bytes unequal ones.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexflow.llm import shared

FLUSH_BYTES = 16 << 20
LOCAL = "doc_id long, text_sha256 string, local long, content binary, rows long, top long"


def _combine_locally(batches):
    """A row for each document; the first row of each text within about FLUSH_BYTES also carries content and totals."""
    task, serial = TaskContext.get().partitionId() << 40, 0
    pack = zstandard.ZstdCompressor(level=1, write_checksum=False, write_content_size=True).compress
    ids, digests, local, held, first, size = [], [], [], {}, {}, 0

    def flushed():
        n = len(ids)
        content, rows, top = [None] * n, [None] * n, [None] * n
        for text, (at, count, best) in held.items():
            content[at], rows[at], top[at] = pack(text), count, best
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.string()), pa.array(local, pa.int64()), pa.array(content, pa.binary()), pa.array(rows, pa.int64()), pa.array(top, pa.int64())],
            names=["doc_id", "text_sha256", "local", "content", "rows", "top"],
        )

    for batch in shared.chunks(batches):
        texts = pc.cast(pc.ascii_lower(pc.fill_null(batch.column("text"), "")), pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            seen = held.get(text)
            if seen is None:
                first[len(ids)] = None
                held[text] = seen = [len(ids), 0, None]
                digests.append(hashlib.sha256(text).hexdigest())
                local.append(task + serial + len(ids))
                size += len(text)
            else:
                digests.append(digests[seen[0]])
                local.append(local[seen[0]])
            seen[1] += 1
            if doc_id is not None and (seen[2] is None or doc_id > seen[2]):
                seen[2] = doc_id
            ids.append(doc_id)
        if size >= FLUSH_BYTES or len(ids) >= 200_000:
            yield from shared.pieces(flushed(), 2000)
            serial += len(ids)
            ids, digests, local, held, first, size = [], [], [], {}, {}, 0
    if ids:
        yield from shared.pieces(flushed(), 2000)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """Groups documents whose texts are identical after lower-casing A-Z only; the largest id of a group stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for every input row, dropped ones too.

    Null texts count as empty and form one group with the empty texts. Repeated rows count towards ``group_size``; rows
    that share the winning id are all marked kept. A null id never wins over another id; in a group of null ids only,
    ``keep_id`` is null and all are kept. An empty table gives an empty result. Other columns of ``docs`` are not read.

    ``salts``: parts into which a group is cut before the global stage; by default the square root of the number of
    shuffle partitions, 8 at least: a text that all tasks hold meets a row for each task and salt first, then one for each salt.
    """
    spark = docs.sparkSession
    docs = shared.id_and_text(docs, id_col, text_col)
    if salts is None:
        salts = max(8, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = shared.stored(docs.mapInArrow(_combine_locally, LOCAL), f"{shared.shared_dir(spark)}/local", compression="uncompressed")
    winners = rows.where(F.col("content").isNotNull()).withColumn("salt", F.pmod(F.shiftright("local", 40), F.lit(salts)).cast("int"))

    # The local winners of a group within one salt number at most the tasks' chunks over ``salts``: their ids, not their
    # content, go along as an array, so that each content is shuffled once to its salt and once to its digest.
    salted = winners.groupBy("text_sha256", "salt", "content").agg(F.collect_list("local").alias("locals"), F.sum("rows").alias("rows"), F.max("top").alias("top"))
    globally = Window.partitionBy("text_sha256", "content")
    final = salted.select("locals", F.sum("rows").over(globally).alias("group_size"), F.max("top").over(globally).alias("keep_id"))
    groups = final.select(F.explode("locals").alias("local"), "group_size", "keep_id")
    return rows.select("doc_id", "text_sha256", "local").join(groups, "local").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that win a group of equal texts; rows that share an id are judged each by its text."""
    gone = exact_dedup(docs, id_col, text_col).where("NOT kept").select("doc_id", F.xxhash64("text_sha256"))
    digest = F.sha2(shared.ascii_lower(shared.text_of(text_col)).cast("binary"), 256)
    return shared.without(docs, [F.col(id_col).cast("long"), F.xxhash64(digest)], gone)

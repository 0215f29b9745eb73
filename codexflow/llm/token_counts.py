"""Token counts behind a digest cache.

Stored counts are keyed by the digest of the content and the digest of the tokenizer's version. Documents join to the
cache; only distinct texts that miss are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
from importlib.metadata import version

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared

CACHE = "content_sha256 binary, tokenizer_sha256 string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """SHA-256 over the vocabulary file and the version of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f"{library} {version(library)}\n".encode() + f.read()).hexdigest()


def counter(path: str):
    """A function from a list of texts to their numbers of tokens, without begin, end or added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        return lambda texts: [len(x) for x in encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


LOCAL = "doc_id long, n_bytes long, local long, content_sha256 binary"
TEXTS = "content_sha256 binary, content binary"


def _first_seen(batches):
    """Batches with their texts as bytes, the digest of each, and whether it is the first of its text in the task's stretch."""
    held: dict[bytes, int] = {}
    task, serial = TaskContext.get().partitionId() << 40, 0
    for batch in shared.chunks(batches):
        texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.binary()).to_pylist()
        digests, first = [hashlib.sha256(text).digest() for text in texts], []
        for digest in digests:
            first.append(digest not in held)
            if first[-1]:
                held[digest] = task + serial
                serial += 1
        yield batch, texts, digests, first, [held[digest] for digest in digests]
        if len(held) > 500_000:
            held.clear()


def _local_rows(batches):
    """A row for each document; the first row of each text within a task's stretch also carries its digest."""
    for batch, texts, digests, first, local in _first_seen(batches):
        digests = [digest if own else None for digest, own in zip(digests, first, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(local, pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "n_bytes", "local", "content_sha256"])


def _local_texts(batches):
    """Each text of a task's stretch once, compressed, with its digest."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for _, texts, digests, first, _ in _first_seen(batches):
        some = [k for k, own in enumerate(first) if own]
        yield pa.RecordBatch.from_arrays([pa.array([digests[k] for k in some], pa.binary()), pa.array([pack(texts[k]) for k in some], pa.binary())], names=["content_sha256", "content"])


def _encode(path: str, tokenizer: str):
    def run(batches):
        count, unpack = counter(path), zstandard.ZstdDecompressor().decompress
        for batch in shared.chunks(batches, "content", 1 << 20):
            texts = [unpack(x).decode() for x in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_sha256"), pa.array([tokenizer] * len(texts), pa.string()), pa.array(count(texts), pa.int64())], names=["content_sha256", "tokenizer_sha256", "n_tokens"]
            )

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; texts that the cache lacks are encoded once and appended.

    ``cache_path``: a Parquet table in a folder that all executors reach; it is made if absent, and a new one below the
    shared folder serves where none is given. Content is normalised only by taking null as empty, as any further change
    could alter the count. Two jobs may append the same digest at once: both store the same count, and readers take one.

    Empty and null texts have 0 bytes and the library's count for the empty text. Repeated rows and ids give a row each.
    Ids may be null. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    cache_path = cache_path or f"{shared.shared_dir(spark)}/counts"
    tokenizer = tokenizer_digest(tokenizer_path)
    docs = shared.id_and_text(docs, id_col, text_col)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)

    def cached() -> DataFrame:
        stored = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer_sha256") == tokenizer)
        return stored.groupBy("content_sha256").agg(F.max("n_tokens").alias("n_tokens"))

    # a text that a third of all rows share meets the digest join as one row for each task, and its own task's rows after that
    rows = shared.stored(docs.mapInArrow(_local_rows, LOCAL), f"{shared.shared_dir(spark)}/rows")
    texts = docs.mapInArrow(_local_texts, TEXTS)
    misses = texts.join(cached().select("content_sha256"), "content_sha256", "left_anti").dropDuplicates(["content_sha256"])
    misses.mapInArrow(_encode(tokenizer_path, tokenizer), CACHE).write.mode("append").parquet(cache_path)

    counts = rows.where(F.col("content_sha256").isNotNull()).select("local", "content_sha256").join(cached(), "content_sha256").select("local", "n_tokens")
    return rows.select("doc_id", "n_bytes", "local").join(counts, "local").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

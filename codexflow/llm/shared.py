"""What the operators of this subpackage share: the shared folder, text columns and byte-level tokenising."""

from __future__ import annotations

import ctypes
import hashlib
import math
import re
import sys
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MOST = 250_000  # numbers, hence 2 MB
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``.

    Where that setting is absent, a local session gets a temporary folder of its own; on a cluster, whose machines would not
    share one, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="codexflow-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/codexflow-{uuid.uuid4().hex}"


def stored(df: DataFrame, where: str, **options: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: this cuts the lineage and survives lost executors.

    The shuffle files of this one write go as soon as it is done, not when the driver happens to collect its garbage: no other
    execution reads them, and the table holds their rows. A later execution of ``df`` itself makes its own.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.select("*").write.options(**options).parquet(where)  # a frame of its own: the setting counts where a frame is made
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(where)


def removed(spark: SparkSession, *where: str) -> None:
    """Deletes tables that nothing reads any more from the shared folder."""
    for path in where:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def give_back(spark: SparkSession) -> None:
    """Has each executor collect its garbage and return unused heap to the system.

    Python workers share an executor's memory with its JVM, which keeps a heap that large shuffles have grown. One short task
    goes to each executor; one that is busy or missed only stays as it is.
    """
    executors = max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)
    collected = spark.range(0, executors, 1, executors).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")))
    collected.write.format("noop").mode("overwrite").save()


def small(table: DataFrame, columns: int = 1) -> DataFrame:
    """A stored table of numbers, to be broadcast if its count allows it (BROADCAST_MOST numbers in all), else as it is."""
    return F.broadcast(table) if table.count() * columns <= BROADCAST_MOST else table


def without(docs: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``keys`` are no row of ``gone`` (columns in the same order, nulls included).

    What goes is stored and counted: up to BROADCAST_MOST numbers are broadcast, so that no text is shuffled; more are joined by a
    shuffle. No column name of ``docs`` clashes with those of ``gone``, which are made up here.
    """
    taken = {c.lower() for c in docs.columns}
    names = [next(n for n in (f"gone{k}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken) for k in range(len(keys))]
    gone = stored(gone.toDF(*names).distinct(), f"{shared_dir(docs.sparkSession)}/gone")
    same = [key.eqNullSafe(gone[name]) for key, name in zip(keys, names, strict=True)]
    return docs.join(small(gone, len(names)), same, "left_anti")


def kept_rows(docs: DataFrame, text_col: str, judge: Callable[[], Callable[[pa.Array], np.ndarray]], limit: int = 1 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, that a judge of texts keeps: one map, without keys or joins.

    ``judge`` is called once in each task and returns a function from texts to flags.
    """
    bound_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        keeps = judge()
        for batch in chunks(batches, place, limit):
            yield batch.filter(pa.array(keeps(batch.column(place).cast(pa.string())), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def text_of(name: str = "text") -> Column:
    """A text column whose nulls count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of bytes in an Arrow batch: the JVM's pools keep what the largest batches took."""
    size, unit = re.fullmatch(r"(-?\d+)([kmg]?)b?", spark.conf.get(BATCH_CONF).lower()).groups()
    if not 0 < int(size) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] <= BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, under fixed names; columns with clashing names stay behind."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def crc_mod(id_column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null ids: null)."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % mod


def partitions_for(docs: DataFrame, text_col: str, bytes_each: int = 24 << 20) -> int:
    """How many partitions of about ``bytes_each`` bytes of text the whole table needs."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return max(1, math.ceil(total / bytes_each))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(batches, column: str | int = "text", limit: int = 4 << 20):
    """Joins small Arrow batches, and cuts large ones, to about ``limit`` bytes of ``column``; one longer text stays whole."""
    held, size = [], 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - base)
            at = to
            if at < n or size >= limit:
                yield _one(held)
                held, size = [], 0
    if held:
        yield _one(held)
    trim()


def let_go(broadcast) -> None:
    """At the end of a task: its Python worker lives on, and would keep the broadcast's value; the next task loads it again."""
    broadcast.__dict__.pop("_value", None)
    trim()


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def pieces(batch: pa.RecordBatch, rows: int = 50_000):
    """A large result in slices, so that the JVM never holds it as one buffer."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def trim() -> None:
    """Gives freed memory back to the system: Spark keeps Python workers for later tasks, and with them their peak."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins (with the end of the last). Nulls have no bytes."""
    texts = pc.fill_null(texts, "")
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of bytes for which ``inside`` (by byte) holds, never across texts."""
    is_in = np.zeros(len(data) + 2, bool)
    is_in[1:-1] = inside[data]
    begins_text = np.zeros(len(data) + 1, bool)
    begins_text[offsets] = True
    change = is_in[1:] != is_in[:-1]
    begins = np.flatnonzero(is_in[1:] & (change | begins_text))
    ends = np.flatnonzero(is_in[:-1] & (change | begins_text))
    return begins, ends


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BELOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)  # masks of the first k bytes


def word_digests(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each word, in two arrays, under keys drawn from ``seed``.

    Words of up to 16 bytes are their own bytes under a bijection for each length; longer ones, which are few, are hashed by
    keyed BLAKE2b. The two halves are as good as independent.
    """
    keys = np.frombuffer(hashlib.blake2b(b"words %d" % seed, digest_size=32).digest(), np.uint64)
    size = ends - begins
    held = np.concatenate([data, np.zeros(16, np.uint8)])
    eights = np.ndarray((len(held) - 7,), "<u8", held, strides=(1,))  # the eight bytes from each place on
    a = eights[begins] & _BELOW[np.minimum(size, 8)]
    b = eights[np.minimum(begins + 8, len(held) - 8)] & _BELOW[np.clip(size - 8, 0, 8)]
    length = size.astype(np.uint64)
    x = a ^ mixed(b + keys[0] + length * keys[2])
    y = b ^ mixed(x + keys[1] + length * keys[3])
    high, low = mixed(x), mixed(y + keys[2])
    for i in np.flatnonzero(size > 16).tolist():
        high[i], low[i] = np.frombuffer(hashlib.blake2b(data[begins[i] : ends[i]].tobytes(), digest_size=16, key=keys.tobytes()).digest(), np.uint64)
    return high, low


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return word_digests(data, begins, ends)[0]

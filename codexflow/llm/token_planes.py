"""Token ids as bit planes.

Documents are encoded in ascending id order and cut into containers that hold whole documents. A container cuts its ids
into blocks of a fixed size; each block is transposed into one plane for each bit (or byte) of its widest id, each plane
is compressed with zstandard, and a chunk index says where every plane of every block begins.

Container, all numbers little-endian:

    magic "CFTP", u8 version, u8 plane kind (1: bit, 8: byte), u16 planes, u32 ids in a block,
    u64 ids, u64 documents,
    i64 doc_id and u8 "id is null" and u64 ids of each document (three arrays, in order),
    u64 begin of each plane of each block, and of the end, counted from the end of this index,
    the planes.

Containers are the rows of a Parquet table (shard, container, number of ids, body): Spark's commit protocol then keeps a file
whole when an executor is lost. A shard is one task's share in ascending order. Where a container's ids begin follows from the
numbers alone, so that bodies are read once.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexflow.llm import shared

MAGIC, HEAD = b"CFTP", "<4sBBHIQQ"
HEAD_SIZE = struct.calcsize(HEAD)
BLOCK = 1 << 16
CONTAINER = 1 << 20
BATCH_TEXTS = 10
FEW = 1 << 20
LETTER, NUMBER, WHITE, OTHER = range(4)
GROUP = 1000  # shards that are summed up together
FILES = "shard int, container int, n long, body binary"


_class = np.full(0x110000, OTHER, np.uint8)  # of code points
_asked = np.zeros(0x1100, bool)  # pages of 256 code points


@functools.cache
def _runs() -> list:
    """For each class but OTHER, what finds its runs. Compiling a pattern takes longer than asking for a page."""
    from tokenizers import Regex, pre_tokenizers

    return [(kind, pre_tokenizers.Split(Regex(pattern), "removed", invert=True)) for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+"))]


def classes(points: np.ndarray) -> np.ndarray:
    """The class of each code point, as the library's own regular expressions see it; a page is asked for when it is met first."""
    met = np.zeros(len(_asked), bool)
    met[points >> 8] = True
    for page in np.flatnonzero(met & ~_asked).tolist():
        every = "".join(map(chr, range(page << 8, (page + 1) << 8)))
        for kind, runs in _runs():
            for _, (begin, end) in runs.pre_tokenize_str(every):
                _class[(page << 8) + begin : (page << 8) + end] = kind
        _asked[page] = True
    return _class[points]


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer cuts texts: places in their bytes, which lie end to end.

    Its pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    n, kind = len(points), classes(points)
    first = np.zeros(n + 3, bool)  # of a text
    first[np.searchsorted(place, offsets)] = True
    white, blank = kind == WHITE, points == 0x20
    cut = np.zeros(n + 3, bool)
    cut[1:n] = (kind[1:] != kind[:-1]) & ~(blank[:-1] & ~white[1:])  # a blank goes with what follows it
    cut[1 : n - 1] |= white[:-2] & white[1:-1] & ~white[2:] & ~first[1 : n - 1] & ~first[2:n]  # as does the last of several spaces
    # a contraction, which a match has to begin with
    mark = np.flatnonzero(points == 0x27)
    before = np.maximum(mark - 1, 0)
    mark = mark[first[mark] | (kind[before] == LETTER) | (kind[before] == NUMBER) | (white[before] & ~blank[before])]
    held = np.append(points, [0, 0])
    one, two = np.where(first[mark + 1], 0, held[mark + 1]), np.where(first[mark + 1] | first[mark + 2], 0, held[mark + 2])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    short = np.isin(one, [ord(c) for c in "stmd"])
    cut[mark[long | short] + 1] = False
    cut[mark[short] + 2] = cut[mark[long] + 3] = True
    return place[np.flatnonzero(cut[:n] & ~first[:n])]


@functools.lru_cache(maxsize=2)
def loaded(library: type, path: str, changed: int, cut: bool):
    """A tokenizer of the library, once in a process; ``cut``: as it is, else without cutting texts into words."""
    from tokenizers import pre_tokenizers

    tokenizer = library.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if not cut:
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


@functools.lru_cache(maxsize=2)
def vocabulary_of(path: str, changed: int) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Added tokens, and of each id its bytes and whether a word's border can be inside it; None unless merges are all that a byte-level vocabulary does.

    Inside an id, its own characters decide on a border, but for a white one at its end (the next character does) and for
    contractions: so ids are looked at with a letter behind them, and those with an apostrophe count as ids with a border.
    One that lacks the last byte of a character is looked at with each such byte; other parts of characters count as well,
    where another character begins inside. ASCII letters behind a letter or a blank are never looked at: they have no border.
    """
    from tokenizers import pre_tokenizers

    with open(path, encoding="utf-8") as f:
        form = json.load(f)
    cutter, model = form.get("pre_tokenizer") or {}, form["model"]
    vocabulary = model.get("vocab", {}) if model.get("type") == "BPE" else {}
    plain = (
        form.get("normalizer") is None and cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True) and set(pre_tokenizers.ByteLevel.alphabet()) <= set(vocabulary)
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    )
    if not plain:
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that are their own character; the others follow from 256 on
    byte_of = dict(zip([*shown, *range(256, 512)], [*shown, *(b for b in range(256) if b not in shown)], strict=False))
    endings = [b"", *(bytes([x]) for x in range(0x80, 0xC0))]
    size, loose, asked, rows = np.zeros(max(vocabulary.values()) + 1, np.int32), np.ones(max(vocabulary.values()) + 1, bool), [], []
    for token, k in vocabulary.items():
        size[k] = len(token)  # bytes, each of them a character
        spelled = token.translate(byte_of).encode("latin-1", "replace")
        if len(spelled) == 1 or spelled[1:].isalpha() and (spelled[0] == 0x20 or spelled[:1].isalpha()) or all(x & 0xC0 == 0x80 for x in spelled[1:]):
            loose[k] = False
        elif b"'" not in spelled:
            for ending in endings:
                try:
                    rows.append((spelled + ending).decode() + "a")
                except UnicodeDecodeError:
                    continue
                asked.append(k)
                if not ending:
                    break
    data, offsets = shared.flat(pa.array(rows, pa.string()))
    asked, cuts = np.array(asked, np.int64), borders(data, offsets)
    of = np.searchsorted(offsets, cuts, side="right") - 1
    loose[asked] = False
    loose[asked[of[cuts - offsets[of] < size[asked[of]]]]] = True
    return [x["content"] for x in form.get("added_tokens") or []], size, loose


def contracted(data: np.ndarray) -> np.ndarray:
    """Where contractions may end: places in the bytes of texts."""
    mark, held = np.flatnonzero(data == 0x27), np.append(data, np.zeros(2, np.uint8))
    one, two = held[mark + 1], held[mark + 2]
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    return np.concatenate([mark[np.isin(one, [ord(c) for c in "stmd"])] + 2, mark[long] + 3])


def encoder(path: str):
    """A function from an array of texts to all their ids end to end, and the number of ids of each.

    The tokenizers library encodes each whole text; equal texts of an array are encoded once. Where merges are all that a
    byte-level vocabulary does, the library merges a text without cutting it into words before. A merge across a word's
    border would leave an id across it, as ids only grow; without one, each word had the merges of its own, and the ids
    are those of the cut text. So where an id of a text may have a border inside, or a contraction ends inside one, the border
    of every word of that text is looked for, and a text with an id across one, or with an
    added token, is encoded by the tokenizer as it is; all further ones are once such texts are a third of a task's bytes and 1 MB.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    changed = os.stat(path).st_mtime_ns
    plain = vocabulary_of(path, changed)
    added, size, loose = plain or ([], None, None)

    def by(cut: bool, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where those of each begin (with the end of the last)."""
        ids, begins = array("I"), [0]
        for at in range(0, len(texts), BATCH_TEXTS):
            for x in loaded(Tokenizer, path, changed, cut).encode_batch_fast(texts[at : at + BATCH_TEXTS], add_special_tokens=False):
                ids.fromlist(x.ids)
                begins.append(len(ids))
        return np.frombuffer(ids, np.uint32), np.array(begins, np.int64)

    tried = crossed = 0  # bytes

    def whole(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        nonlocal tried, crossed
        every = texts.to_pylist()
        if not plain or 3 * crossed > max(tried, 3 * FEW):
            return by(True, every)
        again = np.array([any(x in text for x in added) for text in every], bool)
        some = texts.filter(pa.array(~again)) if again.any() else texts
        (ids, begins), (data, offsets) = by(False, [text for text, other in zip(every, again.tolist(), strict=True) if not other]), shared.flat(some)
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size[ids], out=ends[1:])
        if not np.array_equal(ends[begins], offsets):
            raise ValueError("ids of a text do not have its bytes")
        ended = np.zeros(len(data) + 1, bool)
        ended[ends] = True

        def texts_at(places: np.ndarray, among: np.ndarray = offsets) -> np.ndarray:
            return np.unique(np.searchsorted(among, places, side="right") - 1)

        turns = contracted(data)
        doubted = np.union1d(texts_at(ends[:-1][loose[ids]]), texts_at(turns[~ended[turns]] - 2))
        held, within = shared.flat(some.take(pa.array(doubted, pa.int64())))
        cuts = borders(held, within)
        shift = (offsets[doubted] - within[:-1])[np.searchsorted(within, cuts, side="right") - 1]
        across = texts_at(cuts[~ended[cuts + shift]] + shift[~ended[cuts + shift]])
        tried, crossed = tried + len(data), crossed + int(np.diff(offsets)[across].sum())
        own = np.flatnonzero(~again)
        again[own[across]] = True
        if not again.any():
            return ids, begins
        merged = dict(zip(own.tolist(), split(ids, begins), strict=True))
        rest = iter(split(*by(True, [text for text, other in zip(every, again.tolist(), strict=True) if other])))
        return joined([next(rest) if other else merged[k] for k, other in enumerate(again.tolist())])

    def split(ids: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
        return [ids[b:e] for b, e in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]

    def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.cumsum([0, *map(len, parts)])

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        coded = pc.fill_null(texts, "").dictionary_encode()
        ids, begins = whole(coded.dictionary)
        if len(coded.dictionary) < len(coded):
            parts = split(ids, begins)
            ids, begins = joined([parts[k] for k in coded.indices.to_pylist()])
        return ids, np.diff(begins)

    return encode


def turned(square: np.ndarray) -> np.ndarray:
    """Each u64 as a square of 8 x 8 bits, turned over: bit i of byte j becomes bit j of byte i."""
    for by, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        swap = (square ^ (square >> np.uint64(by))) & np.uint64(mask)
        square = square ^ swap ^ (swap << np.uint64(by))
    return square


def packed(doc_ids: list, sizes: list[int], ids: np.ndarray, kind: int = 1, block: int = BLOCK, level: int = 3) -> bytes:
    """One container. ``kind``: bits in a plane's element, 1 or 8."""
    pack = zstandard.ZstdCompressor(level=level).compress
    width = max(1, int(ids.max(initial=0)).bit_length())
    planes = width if kind == 1 else -(-width // 8)
    bodies = []
    for at in range(0, len(ids), block):
        part = ids[at : at + block].astype("<u4")
        if kind == 1:
            octets = (np.append(part, np.zeros(-len(part) % 8, "<u4")) if len(part) % 8 else part).view(np.uint8).reshape(-1, 4)
            for k in range(0, planes, 8):
                bits = turned(np.ascontiguousarray(octets[:, k // 8]).view("<u8")).view(np.uint8).reshape(-1, 8)
                bodies += [pack(x) for x in np.ascontiguousarray(bits.T[: planes - k])]  # copying plane by plane is ten times as slow
        else:
            bodies += [pack(x.tobytes()) for x in np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4)[:, :planes].T)]
    index = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype("<u8")
    head = struct.pack(HEAD, MAGIC, 1, kind, planes, block, len(ids), len(doc_ids))
    null = np.array([x is None for x in doc_ids], np.uint8)
    own = np.array([0 if x is None else x for x in doc_ids], "<i8")
    return b"".join([head, own.tobytes(), null.tobytes(), np.array(sizes, "<u8").tobytes(), index.tobytes(), *bodies])


class Container:
    """Reads a container; single blocks can be read by the chunk index alone."""

    def __init__(self, body: bytes):
        magic, version, self.kind, self.planes, self.block, self.n, docs = struct.unpack_from(HEAD, body)
        if magic != MAGIC or version != 1:
            raise ValueError("this is no container of token planes")
        at = HEAD_SIZE
        null = np.frombuffer(body, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [None if z else i for i, z in zip(np.frombuffer(body, "<i8", docs, at).tolist(), null.tolist(), strict=True)]
        self.sizes = np.frombuffer(body, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        self.blocks = -(-self.n // self.block)
        self.index = np.frombuffer(body, "<u8", self.blocks * self.planes + 1, at).astype(np.int64)
        self.body, self.base = body, at + 8 * len(self.index)

    def ids_of(self, k: int) -> np.ndarray:
        """The ids of block ``k``."""
        unpack, n = zstandard.ZstdDecompressor().decompress, min(self.block, self.n - k * self.block)
        raw = [np.frombuffer(unpack(self.body[self.base + self.index[j] : self.base + self.index[j + 1]]), np.uint8) for j in range(k * self.planes, (k + 1) * self.planes)]
        out = np.zeros((n, 4), np.uint8)
        if self.kind == 8:
            out[:, : self.planes] = np.stack(raw, 1)
        else:
            for k in range(0, self.planes, 8):
                bits = np.zeros((-(-n // 8), 8), np.uint8)
                bits[:, : self.planes - k] = np.stack(raw[k : k + 8], 1)
                out[:, k // 8] = turned(bits.reshape(-1).view("<u8")).view(np.uint8)[:n]
        return out.view("<u4").ravel()

    def ids(self) -> np.ndarray:
        return np.concatenate([self.ids_of(k) for k in range(self.blocks)]) if self.blocks else np.zeros(0, "<u4")


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", kind: int = 1) -> None:
    """Encodes every whole text, appends ``end_id`` to each and writes all ids in ascending id order as containers at ``path``.

    Null texts count as empty: they have the end id alone. Null ids come first; rows of equal ids are neighbours in no
    set order. An empty table gives a table without containers. Other columns of ``docs`` are not read.
    """

    def encode(batches):
        shard, serial, encode_texts = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        doc_ids, sizes, parts, held = [], [], [], 0

        def flushed():
            body = packed(doc_ids, sizes, np.concatenate(parts), kind)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([serial], pa.int32()), pa.array([held], pa.int64()), pa.array([body], pa.binary())], names=["shard", "container", "n", "body"])

        for batch in shared.chunks(batches):
            ids, counts = encode_texts(batch.column("text"))
            ends = np.cumsum(counts)
            parts.append(np.insert(ids, ends, end_id))
            doc_ids += batch.column("doc_id").to_pylist()
            sizes += (counts + 1).tolist()
            held += len(parts[-1])
            if held >= CONTAINER:
                yield flushed()
                serial += 1
                doc_ids, sizes, parts, held = [], [], [], 0
        if doc_ids:
            yield flushed()

    parts = shared.partitions_for(docs, text_col)
    docs = shared.id_and_text(docs, id_col, text_col)
    if parts > 1:
        # an id that a third of all rows share is cut by text, and equal rows by where they are read
        docs = docs.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.spark_partition_id())
    else:
        docs = docs.coalesce(1)
    ordered = docs.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(encode, FILES).write.option("compression", "uncompressed").parquet(path)


def read_documents(spark, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document, from the containers at ``path`` alone."""

    def decode(batches):
        for batch in batches:
            for shard, serial, n, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "container", "n", "body")), strict=True):
                box = Container(body)
                if box.n != n:
                    raise ValueError(f"container {serial} of shard {shard} holds {box.n} ids, not {n}")
                ids, ends = box.ids(), np.cumsum(box.sizes)
                begins = ends - box.sizes
                columns = [
                    pa.array(box.doc_ids, pa.int64()), pa.array([shard] * len(ends), pa.int32()), pa.array([serial] * len(ends), pa.int32()), pa.array(begins, pa.int64()), pa.array(box.sizes, pa.int64()),
                    pa.array([zlib.crc32(ids[b:e].tobytes()) for b, e in zip(begins, ends, strict=True)], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids[b:e] for b, e in zip(begins, ends, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "container", "begin", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    files = spark.read.schema(FILES).parquet(path)
    sizes = files.select("shard", "container", "n")
    # ids before a container: those of earlier groups of shards, one row for each group, of earlier shards of its group, and of its shard
    group = F.floor(F.col("shard") / GROUP).alias("group")
    shards = sizes.groupBy(group, "shard").agg(F.sum("n").alias("n"))
    groups = shards.groupBy("group").agg(F.sum("n").alias("n")).select("group", (F.sum("n").over(Window.orderBy("group")) - F.col("n")).alias("earlier"))
    inside = Window.partitionBy("group").orderBy("shard")
    shards = shards.withColumn("before", F.sum("n").over(inside) - F.col("n")).join(groups, "group").select("shard", (F.col("earlier") + F.col("before")).alias("before"))
    own = Window.partitionBy("shard").orderBy("container")
    bases = sizes.join(shards, "shard").select("shard", "container", (F.col("before") + F.sum("n").over(own) - F.col("n")).alias("base"))
    rows = files.mapInArrow(decode, "doc_id long, shard int, container int, begin long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return rows.join(bases, ["shard", "container"]).select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)

"""Language-model scoring with a probabilistic suffix tree, beside an additive unigram base.

The tree's symbols are the bytes of the text, lower-cased in A-Z, and one end symbol, so a text's probability covers its
words and what stands between them. Every training text is counted: each task sends the distinct (context of DEPTH
bytes, next symbol) grams it has met, and shorter contexts are sums of longer ones. A context is a candidate from
LEAST_CONTEXT occurrences on, and a next symbol is kept apart from LEAST_SYMBOL on, whatever the size of the corpus. A
candidate is retained if its next symbols diverge from its parent's by more than their cost in parameters, or if a
longer context is retained. Distributions are smoothed towards the parent's. A symbol is scored in the longest retained
suffix of what precedes it.

The tree grows with the corpus and is a table in buckets of the last HEAD + 1 bytes of the context; a bucket is learned
from its grams alone and the levels down to HEAD, which at most 257 * 256 ** HEAD keys can fill and which are broadcast.
Tasks send the distinct grams of a chunk of texts to their buckets, each once, and get the probabilities back for the
chunk. The base needs the corpus count of each token in each text, which comes back to the chunk in the same way; neither
counts nor texts are broadcast or gathered.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared
from codexflow.llm.ppm_language import Table

DEPTH = 5
END = 256
CHUNK = 14 << 20
PIECE = 1 << 18
LEAST_CONTEXT, LEAST_SYMBOL = 4, 2
HEAD = 2
BUCKETS, BUCKET_GRAMS = 64, 100_000  # at least so many buckets, and about so many training grams in each
SALT_CHUNKS = 64  # chunks that ask one copy of a bucket


def symbols_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each after DEPTH blanks and before its end; begins of the texts' stretches; which are scored."""
    data, offsets = shared.flat(texts)
    n = len(offsets) - 1
    bounds = offsets + (DEPTH + 1) * np.arange(n + 1)
    out = np.full(int(bounds[-1]), 0x20, np.int64)
    text = np.ones(len(out), bool)
    for k in range(DEPTH):
        text[bounds[:-1] + k] = False
    text[bounds[1:] - 1] = False
    out[text] = shared.LOWER[data]
    out[bounds[1:] - 1] = END
    text[bounds[1:] - 1] = True
    return out, bounds, text


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """At each place the DEPTH bytes before it and its symbol: context << 9 | symbol. The first DEPTH are not to be used."""
    key = symbols.copy()
    for k in range(1, DEPTH + 1):
        key[k:] |= (symbols[:-k] & 0xFF) << (9 + 8 * (k - 1))
    return key


def shortened(keys, depth: int):
    """The keys with contexts of ``depth`` bytes."""
    return keys & ((1 << (9 + 8 * depth)) - 1)


def bucket_of(context, buckets: int, shifted: Callable = np.right_shift):
    """The bucket of contexts of at least HEAD + 1 bytes, by all of their last HEAD + 1: the same over arrays and, with F.shiftright, columns."""
    return shifted((context * 2654435761) % (1 << 31), 7) % buckets


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _count_grams(batches):
    """The grams of a task's texts with their counts; what is held is sent on when it passes a few million."""
    keys, counts, held = [], [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, counts)], names=["key", "n"])

    for part in shared.chunks(batches, limit=1 << 20):
        symbols, _, scored = symbols_of(part.column("text"))
        some = np.sort(keys_of(symbols)[scored])
        del symbols, scored
        first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
        keys.append(some[first])
        counts.append(np.diff(np.append(first, len(some))))
        held += len(first)
        if held > 2_500_000:
            merged = _summed(keys, counts)
            keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
            if held > 2_000_000:
                yield from shared.pieces(batch())
                keys, counts, held = [], [], 0
    if keys:
        yield from shared.pieces(batch())


def level_of(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """What SuffixTree takes as a level, from grams of ``depth`` or more bytes."""
    keys, counts = _summed([shortened(keys, depth)], [counts])
    contexts, first = np.unique(keys >> 9, return_index=True)
    totals = np.add.reduceat(counts, first) if len(first) else counts
    distinct = np.diff(np.append(first, len(keys)))
    known = totals >= LEAST_CONTEXT
    kept = (counts >= LEAST_SYMBOL) & np.repeat(known, distinct)
    return contexts[known], totals[known], distinct[known], keys[kept], counts[kept]


def scores(texts: pa.Array, logs) -> np.ndarray:
    """log10 probability of each whole text, its end included, from ``logs`` of keys."""
    symbols, bounds, scored = symbols_of(texts)
    out = np.zeros(len(bounds) - 1)
    for low in range(0, len(symbols), PIECE):
        begin = max(0, low - DEPTH)
        key = keys_of(symbols[begin : low + PIECE])[low - begin :]
        here = np.flatnonzero(scored[low : low + PIECE])
        if len(here):
            document = np.searchsorted(bounds, here + low, side="right") - 1
            first = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]]))
            out[document[first]] += np.add.reduceat(logs(key[here]), first, dtype=np.float64)
    return out


class SuffixTree:
    """Retained contexts with smoothed next-symbol distributions, as tables of log10 probabilities for each depth."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]], positions: int, penalty: float = 0.1, marked: np.ndarray | None = None):
        """``levels``: for each depth the contexts, their totals and distinct symbols, then kept keys and counts (all sorted).

        ``marked``: contexts of the last level that longer ones retain.
        """
        charge = penalty * math.log(max(2, positions))
        value, back, passed, parents = [], [], [], []
        for depth, (contexts, totals, distinct, keys, counts) in enumerate(levels):
            of = np.searchsorted(contexts, keys >> 9)
            kept = np.bincount(of, counts, len(contexts))
            spare = distinct + (totals - kept)  # what goes to the parent: one for each distinct symbol, and what was not kept
            whole = np.maximum(kept + spare, 1e-9)
            if depth:
                above = self._probability(shortened(keys, depth - 1), depth - 1, levels, value, back)
                parents.append(np.searchsorted(levels[depth - 1][0], contexts & ((1 << (8 * (depth - 1))) - 1)))
            else:
                above = np.full(len(keys), 1 / 257)
                parents.append(np.zeros(len(contexts), np.int64))
            value.append((counts + spare[of] * above) / whole[of])
            back.append(spare / whole)
            with np.errstate(divide="ignore"):
                gain = np.bincount(of, counts * np.log(counts / totals[of] / above), len(contexts))
            passed.append((gain >= charge * np.maximum(1, distinct - 1)) | (depth == 0))
        if marked is not None and len(marked):
            passed[-1][np.searchsorted(levels[-1][0], marked)] = True
        for depth in range(len(levels) - 1, 0, -1):
            passed[depth - 1][parents[depth][passed[depth]]] = True
        self.marks = [np.unique(levels[depth][0][parents[depth + 1][passed[depth + 1]]]) for depth in range(len(levels) - 1)]
        self.rows, self.entries, self.contexts = [], [], []
        for depth, (contexts, _, _, keys, _) in enumerate(levels):
            keep = passed[depth][np.searchsorted(contexts, keys >> 9)]
            lower = np.log10(np.maximum(back[depth][passed[depth]], 1e-12))
            self.add(keys[keep], np.log10(value[depth][keep]).astype(np.float32), contexts[passed[depth]], lower.astype(np.float32))

    def add(self, keys: np.ndarray, logs: np.ndarray, contexts: np.ndarray, backs: np.ndarray) -> None:
        """One more level of retained contexts."""
        self.rows.append((keys, logs, contexts, backs))
        self.entries.append((Table(keys), logs))
        self.contexts.append((Table(contexts), backs))

    def with_levels(self, rows: list[tuple[np.ndarray, ...]]) -> SuffixTree:
        """A tree of these levels and deeper ones."""
        out = copy.copy(self)
        out.rows, out.entries, out.contexts = list(self.rows), list(self.entries), list(self.contexts)
        for row in rows:
            out.add(*row)
        return out

    @staticmethod
    def _probability(keys, depth, levels, value, back):
        """Of each key in the tree of all candidates down to ``depth``."""
        out, left, factor = np.zeros(len(keys)), np.arange(len(keys)), np.ones(len(keys))
        for d in range(depth, -1, -1):
            contexts, _, _, own, _ = levels[d]
            key = shortened(keys[left], d)
            at = np.minimum(np.searchsorted(own, key), max(0, len(own) - 1))
            hit = own[at] == key if len(own) else np.zeros(len(key), bool)
            out[left[hit]] = factor[left[hit]] * value[d][at[hit]]
            left, key = left[~hit], key[~hit]
            context = np.searchsorted(contexts, key >> 9)
            factor[left] *= back[d][context]
        out[left] = factor[left] / 257
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """log10 probability of each whole text, its end included."""
        return scores(texts, self.logs)

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each (context, symbol), in the longest retained suffix of the context."""
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        for depth in range(DEPTH, -1, -1):
            key = shortened(keys[left], depth)
            table, value = self.entries[depth]
            at = table.find(key)
            hit = at >= 0
            out[left[hit]] += value[at[hit]] if hit.any() else 0
            left, key = left[~hit], key[~hit]
            if not len(left):
                return out
            table, back = self.contexts[depth]
            at = table.find(key >> 9)
            known = at >= 0
            out[left[known]] += back[at[known]] if known.any() else 0
        out[left] -= math.log10(257)
        return out


TREE = "bucket int, depth int, keys binary, logs binary, contexts binary, backs binary"


def _grow(head_levels, positions: int):
    """For a bucket of grams its levels below HEAD, and as a level HEAD the contexts there that they retain."""

    def run(grams: pa.Table) -> pa.Table:
        key, n = grams.column("key").to_numpy(), grams.column("n").to_numpy()
        tree = SuffixTree([*head_levels.value, *(level_of(key, n, depth) for depth in range(HEAD + 1, DEPTH + 1))], positions)
        rows = [(HEAD, None, None, tree.marks[HEAD], None), *((depth, *tree.rows[depth]) for depth in range(HEAD + 1, DEPTH + 1))]
        columns = [pa.array([None if x is None else x.tobytes() for x in column], pa.binary()) for column in list(zip(*rows, strict=True))[1:]]
        bucket = pa.array([grams.column("bucket")[0].as_py()] * len(rows), pa.int32())
        return pa.Table.from_arrays([bucket, pa.array([r[0] for r in rows], pa.int32()), *columns], names=["bucket", "depth", "keys", "logs", "contexts", "backs"])

    return run


def learn(texts: DataFrame, where: str) -> tuple[SuffixTree | None, DataFrame, int]:
    """The tree of all of ``texts`` (column ``text``): its levels down to HEAD, the table of the others, and how many buckets that has.

    Counts and the table are kept at ``where``. Without texts there is no tree, and the table is empty.
    """
    spark = texts.sparkSession
    counted = texts.mapInArrow(_count_grams, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    grams = shared.stored(counted, f"{where}/grams", compression="zstd")
    positions, distinct = grams.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not positions:
        return None, spark.createDataFrame([], TREE), 1
    top = grams.select(F.col("key").bitwiseAND((1 << (9 + 8 * HEAD)) - 1).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = top.column("key").to_numpy(), top.column("n").to_numpy()
    levels = [level_of(key, n, depth) for depth in range(HEAD + 1)]
    buckets = max(BUCKETS, math.ceil(distinct / BUCKET_GRAMS))
    suffix = F.shiftright("key", 9).bitwiseAND((1 << (8 * (HEAD + 1))) - 1)
    dealt = grams.select(bucket_of(suffix, buckets, F.shiftright).cast("int").alias("bucket"), "key", "n")
    grown = dealt.groupBy("bucket").applyInArrow(_grow(spark.sparkContext.broadcast(levels), positions), TREE)
    table = shared.stored(grown, f"{where}/tree")
    shared.removed(spark, f"{where}/grams")
    marked = np.zeros(0, np.int64)
    for row in table.where(F.col("depth") == HEAD).select("contexts").toLocalIterator():
        marked = np.union1d(marked, np.frombuffer(row.contexts, np.int64))
    return SuffixTree(levels, positions, marked=marked), table.where(F.col("depth") > HEAD), buckets


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed planes of the bytes of their differences."""
    planes = np.diff(keys, prepend=0).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def _parts(texts: pa.Array) -> list[pa.Array]:
    return [part.column("text") for part in shared.chunks([pa.RecordBatch.from_arrays([texts], names=["text"])], limit=1 << 20)]


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def _grams(parts: list[pa.Array], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of texts, and the bucket of each."""
    each = []
    for part in parts:
        symbols, _, scored = symbols_of(part)
        each.append(_distinct(keys_of(symbols)[scored]))
    keys = _distinct(np.concatenate(each))
    return keys, bucket_of((keys >> 9) & ((1 << (8 * (HEAD + 1))) - 1), buckets)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens of texts; the number of each token among them; bounds of each text's tokens."""
    data, offsets = shared.flat(pc.ascii_lower(texts))
    begins, ends = shared.words(data, offsets, ~shared.SPACE)
    body = np.ascontiguousarray(data[~shared.SPACE[data]])  # words end to end
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)), pa.py_buffer(body)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), np.searchsorted(begins, offsets)


CHUNKS = "chunk long, code int, token string, n long, bucket int, grams binary, body binary"


def _chunked(buckets: int):
    """For each chunk of texts its distinct tokens with their training counts, its distinct grams by bucket, and one row with its texts."""

    def rows(size: int, /, **columns) -> pa.RecordBatch:
        types = {"chunk": pa.int64(), "code": pa.int32(), "token": pa.string(), "n": pa.int64(), "bucket": pa.int32(), "grams": pa.binary(), "body": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in types.items()], names=list(types))

    def run(batches):
        task, serial = TaskContext.get().partitionId() << 24, 0
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in shared.chunks(batches, limit=CHUNK):
            texts = pc.fill_null(batch.column("text"), "")
            dictionary, codes, bounds = _tokens(texts)
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            counts = np.bincount(codes[np.repeat(~held, np.diff(bounds))], minlength=len(dictionary))
            chunk, n = task + serial, len(dictionary)
            serial += 1
            yield from shared.pieces(rows(n, chunk=np.full(n, chunk), code=np.arange(n, dtype=np.int32), token=dictionary.cast(pa.string()), n=counts.astype(np.int64)))
            del dictionary, codes
            keys, bucket = _grams(_parts(texts), buckets)
            some = np.unique(bucket)
            yield rows(len(some), chunk=np.full(len(some), chunk), bucket=some.astype(np.int32), grams=[packed(keys[bucket == b]) for b in some])
            del keys, bucket
            ids = batch.column("doc_id")
            data, offsets = shared.flat(texts)
            raw = b"".join([
                np.array([len(ids)], np.int64).tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                held.tobytes(), offsets.astype(np.int64).tobytes(), data.tobytes(),
            ])
            yield rows(1, chunk=[chunk], n=[int((~held).sum())], body=[pack(raw)])

    return run


ANSWERS = "chunk long, bucket int, logs binary"


def _looked_up(head):
    """For a bucket of the tree and the grams that chunks ask of it: their log10 probabilities, in the order of the grams."""

    def run(levels: pa.Table, asked: pa.Table) -> pa.Table:
        tree = head.value
        if tree:
            deeper = {r["depth"]: (np.frombuffer(r["keys"], np.int64), np.frombuffer(r["logs"], np.float32), np.frombuffer(r["contexts"], np.int64), np.frombuffer(r["backs"], np.float32)) for r in levels.to_pylist()}
            none = (np.zeros(0, np.int64), np.zeros(0, np.float32)) * 2
            tree = tree.with_levels([deeper.get(depth, none) for depth in range(HEAD + 1, DEPTH + 1)])
        logs = []
        for grams in asked.column("grams"):
            keys = unpacked(grams.as_py())
            logs.append((tree.logs(keys) if tree else np.full(len(keys), -math.log10(257))).astype(np.float32).tobytes())
        return pa.Table.from_arrays([asked.column("chunk"), asked.column("bucket"), pa.array(logs, pa.binary())], names=["chunk", "bucket", "logs"])

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def _summed_up(end_count: int, buckets: int):
    """For a chunk, from its texts, its tokens' corpus counts and its grams' probabilities: a row for each text."""

    def run(answers: pa.Table, bodies: pa.Table) -> pa.Table:
        raw = zstandard.ZstdDecompressor().decompress(bodies.column("body")[0].as_py())
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        null, at = np.frombuffer(raw, bool, n, at), at + n
        ids, at = np.frombuffer(raw, np.int64, n, at), at + 8 * n
        held, at = np.frombuffer(raw, bool, n, at), at + n
        texts = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(raw[at : at + 8 * (n + 1)]), pa.py_buffer(raw[at + 8 * (n + 1) :])])
        del raw
        parts = _parts(texts)
        keys, bucket = _grams(parts, buckets)
        grams = answers.filter(pc.is_valid(answers.column("logs")))
        value = np.zeros(len(keys), np.float32)
        for b, logs in zip(grams.column("bucket").to_pylist(), grams.column("logs").to_pylist(), strict=True):
            value[bucket == b] = np.frombuffer(logs, np.float32)
        table = Table(keys)
        score = np.concatenate([scores(part, lambda k: value[table.find(k)]) for part in parts])
        del keys, bucket, grams, value, table
        _, codes, bounds = _tokens(texts)
        counts = answers.filter(pc.is_valid(answers.column("code")))
        c = np.zeros(counts.num_rows, np.int64)
        c[counts.column("code").to_numpy()] = counts.column("c").to_numpy()
        logs, known = np.log10(c + 0.1)[codes], (c > 0)[codes]
        total = np.concatenate([[0.0], np.cumsum(logs)])
        log_counts = total[bounds[1:]] - total[bounds[:-1]] + math.log10(end_count + 0.1)
        n_known = np.concatenate([[0], np.cumsum(known)])
        n_known = n_known[bounds[1:]] - n_known[bounds[:-1]] + (end_count > 0)
        return pa.Table.from_arrays(
            [pa.array(ids, mask=null), pa.array(held), pa.array(np.diff(bounds) + 1), pa.array(n_known.astype(np.int64)), pa.array(log_counts), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score"]
        )

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Rows whose crc32(doc_id) mod 10 is 0 are held out; all others are learned from, whole. Rows with a null id are not
    learned from and count as held out. Null texts count as empty: one token, the end. Repeated rows count, and are
    scored, each. Without any training row every next symbol is as likely as another, and the base has no counts. An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    where = shared.shared_dir(spark)
    rows = shared.id_and_text(docs, id_col, text_col).withColumn("held_out", F.coalesce(shared.crc_mod("doc_id", 10) == 0, F.lit(True)))
    head, tree, buckets = learn(rows.where(~F.col("held_out")).select("text"), where)
    chunks = shared.stored(rows.mapInArrow(_chunked(buckets), CHUNKS), f"{where}/chunks", compression="zstd")
    tokens = chunks.where(F.col("token").isNotNull())
    bodies = chunks.where(F.col("body").isNotNull())
    end_count = bodies.agg(F.sum("n")).first()[0] or 0
    # a token that all chunks hold is summed up within tasks first; the sums are joined back, and a hot token can be split there
    totals = shared.stored(tokens.groupBy("token").agg(F.sum("n").alias("c")), f"{where}/totals")
    n_words, distinct = totals.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n_train, distinct = (n_words or 0) + end_count, distinct + (end_count > 0)
    counts = tokens.select("chunk", "code", "token").join(totals, "token").select(F.col("chunk").alias("chunk"), "code", "c")
    salts = max(1, math.ceil(bodies.count() / SALT_CHUNKS))
    copies = tree.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = chunks.where(F.col("grams").isNotNull()).select("bucket", F.pmod(F.hash("chunk"), F.lit(salts)).alias("salt"), "chunk", "grams")
    logs = copies.groupBy("bucket", "salt").cogroup(asked.groupBy("bucket", "salt")).applyInArrow(_looked_up(spark.sparkContext.broadcast(head)), ANSWERS)
    answers = counts.unionByName(logs, allowMissingColumns=True)
    scored = answers.groupBy("chunk").cogroup(bodies.select("chunk", "body").groupBy("chunk")).applyInArrow(_summed_up(end_count, buckets), SCORED)
    base = F.col("log_counts") - F.col("n_tokens") * math.log10(n_train + 0.1 * (distinct + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), "score")

"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of order 0 to ORDER, with escape probabilities by method C (distinct symbols
over occurrences plus distinct symbols) and no exclusions; below order 0 all 256 bytes are alike. The statistics are
frozen after training, so a text's code length is a sum of constants: the length of every (context, symbol) of any
language, escapes included, is worked out once for all languages. Scoring looks each position's longest gram up in one
hash table and falls back, adding the context's escape cost, only where no language has the gram.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexflow.llm import shared

ORDER = 4
PIECE = 1 << 17
UNDETERMINED = "und"
RAW_BITS, LEAST_BYTES = 8.0, 64  # a code no shorter than the bytes themselves rejects a text of at least so many bytes


class Table:
    """An open-addressing hash table from distinct non-negative 64-bit keys to their places, for whole arrays of keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.place = np.full(1 << self.bits, -1, np.int32)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[at] < 0
            _, first = np.unique(at[free], return_index=True)
            winners = np.flatnonzero(free)[first]
            self.slots[at[winners]], self.place[at[winners]] = keys[left[winners]], left[winners]
            rest = np.ones(len(left), bool)
            rest[winners] = False
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is absent."""
        at = self._home(keys)
        held = self.slots[at]
        out = np.where(held == keys, self.place[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            held = self.slots[at]
            hit = held == keys[left]
            out[left[hit]] = self.place[at[hit]]
            going = ~hit & (held >= 0)
            left, at = left[going], at[going]
        return out


def padded(texts: pa.Array, pad: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, each after ``pad`` blanks; begins of the padded texts, with the end; which bytes are text."""
    data, offsets = shared.flat(texts)
    bounds = offsets + pad * np.arange(len(offsets))
    out = np.full(int(bounds[-1]), 0x20, np.uint8)
    real = np.ones(len(out), bool)
    for k in range(pad):
        real[bounds[:-1] + k] = False
    out[real] = shared.LOWER[data]
    return out, bounds, real


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """At each byte the key of the ``size`` bytes that end there; the first ``size - 1`` are short and not to be used."""
    key = data.astype(np.int64)
    for k in range(1, size):
        key[k:] |= data[:-k].astype(np.int64) << (8 * k)
    return key


def counted(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of ``order + 1`` bytes that end at the texts' bytes, ascending, and how often each occurs."""
    data, _, real = padded(texts, order)
    return np.unique(grams(data, order + 1)[real], return_counts=True)


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, times, len(distinct)).astype(np.int64)


class ContextTrees:
    """The trees of several languages, merged into one table of code lengths for each order."""

    def __init__(self, longest: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        """``longest``: for each language its grams of ``order + 1`` bytes and their counts. Shorter grams are sums of longer ones."""
        self.languages, self.order = sorted(longest), order
        count: list[dict] = [{x: summed(keys & ((1 << (8 * (d + 1))) - 1), times) for x, (keys, times) in longest.items()} for d in range(order + 1)]
        self.tables, self.cost, self.escape = [], [], []
        width = len(self.languages)
        for d in range(order + 1):
            keys = np.unique(np.concatenate([count[d][x][0] for x in self.languages]))
            cost = np.zeros((len(keys), width), np.float32)
            if d == 0:
                shorter, context_keys = np.full((len(keys), width), 8.0), np.zeros(1, np.int64)
                context = np.zeros(len(keys), np.int64)
            else:
                shorter = self.cost[d - 1][self.tables[d - 1].find(keys & ((1 << (8 * d)) - 1))]
                context_keys, context = np.unique(keys >> 8, return_inverse=True)
            escape = np.zeros((len(context_keys), width), np.float32)
            for j, language in enumerate(self.languages):
                own, times = count[d][language]
                at = np.searchsorted(keys, own)
                n = np.zeros(len(keys))
                n[at] = times
                total = np.bincount(context, n, len(context_keys))
                distinct = np.bincount(context, n > 0, len(context_keys))
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape[:, j] = np.where(total > 0, np.log2((total + distinct) / distinct), 0)
                    cost[:, j] = np.where(n > 0, np.log2((total + distinct)[context] / n), escape[context, j] + shorter[:, j])
            self.tables.append(Table(keys))
            self.cost.append(cost)
            self.escape.append((Table(context_keys), escape))

    @classmethod
    def of_texts(cls, samples: dict[str, list[str]], order: int = ORDER) -> ContextTrees:
        return cls({language: counted(pa.array(texts, pa.large_string()), order) for language, texts in samples.items()}, order)

    def packed(self) -> bytes:
        return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(self, protocol=5))

    @staticmethod
    def unpacked(data: bytes) -> ContextTrees:
        return pickle.loads(zstandard.ZstdDecompressor().decompress(data))

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each whole text (rows) under each language's tree (columns)."""
        data, bounds, real = padded(texts, self.order)
        out = np.zeros((len(bounds) - 1, len(self.languages)))
        for low in range(0, len(data), PIECE):
            begin = max(0, low - self.order)
            part = data[begin : low + PIECE]
            key = grams(part, self.order + 1)[low - begin :]
            here = np.flatnonzero(real[low : low + PIECE])
            bits = self._bits(key[here])
            document = np.searchsorted(bounds, here + low, side="right") - 1
            if len(here):
                first = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]]))
                out[document[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.float64)
        return out

    def _bits(self, keys: np.ndarray) -> np.ndarray:
        place = self.tables[self.order].find(keys)
        bits = self.cost[self.order][np.maximum(place, 0)]
        left = np.flatnonzero(place < 0)
        bits[left] = 0
        keys = keys[left]
        for d in range(self.order, -1, -1):
            if not len(left):
                return bits
            table, escape = self.escape[d]
            context = table.find(keys >> 8)
            bits[left] += np.where(context >= 0, 1, 0)[:, None] * escape[np.maximum(context, 0)]
            if d == 0:
                bits[left] += 8.0
                return bits
            keys = keys & ((1 << (8 * d)) - 1)
            place = self.tables[d - 1].find(keys)
            hit = place >= 0
            bits[left[hit]] += self.cost[d - 1][place[hit]]
            left, keys = left[~hit], keys[~hit]
        return bits


class Judged:
    """What the trees say of an array of texts."""

    def __init__(self, trees: ContextTrees | None, texts: pa.Array, scale: float):
        n = len(texts)
        self.size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if trees is None:
            self.language, self.score, self.bits = [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
            return
        lengths = trees.code_lengths(texts)
        at = lengths.argmin(1)
        self.bits = lengths[np.arange(n), at] / np.maximum(self.size, 1)
        worse = (lengths - lengths.min(1)[:, None]) * np.log(2) * np.minimum(1, scale / np.maximum(self.size, 1))[:, None]
        self.score = np.where(letters, 1 / np.exp(-worse).sum(1), 0)
        self.language = [trees.languages[k] if ok else UNDETERMINED for k, ok in zip(at.tolist(), letters.tolist(), strict=True)]


def identify(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text", scale: float = 64.0) -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte`` for every row: the language with the shortest code for the whole text.

    ``model``: packed ContextTrees, or None. ``score`` is the posterior of that language after ``scale`` bytes of such text (of
    the whole text if it is shorter). A null text, or one without a letter, is ``und`` with score 0; so is any text where no
    language was learned. Ties go to the first language in order. Repeated rows and null ids give a row each; an empty
    table gives an empty result.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        trees = shipped.value and ContextTrees.unpacked(shipped.value)
        for batch in shared.chunks(batches, limit=1 << 20):
            got = Judged(trees, batch.column("text"), scale)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got.language, pa.string()), pa.array(got.score, pa.float64()), pa.array(got.bits, pa.float64())], names=["doc_id", "lang_pred", "score", "bits_per_byte"])
        del trees
        shared.let_go(shipped)

    return shared.id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def identify_with_training(docs: DataFrame, lang_col: str = "lang", per_language: int = 1500) -> DataFrame:
    """Learns from ``docs`` and predicts for ``docs``: ``doc_id, held_out, lang_pred, score``.

    Rows whose crc32(doc_id) mod 4 is 2 are held out; rows with a null id are not learned from either and count as held
    out. The model is fitted on a bounded sample of the others: at most ``per_language`` whole texts of each language, of any
    length. Prediction covers every row and whole texts, and reads nothing but the text.
    """
    return identify(docs, learned(docs, lang_col, per_language)).select("doc_id", _held().alias("held_out"), "lang_pred", "score")


def _held():
    return F.coalesce(shared.crc_mod("doc_id", 4) == 2, F.lit(True))


def _fit(batches):
    """One row with the packed trees of texts with their languages; no row without texts."""
    grams_of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in shared.chunks(batches):
        language = batch.column("lang")
        for name in language.unique().to_pylist():
            keys, times = counted(batch.column("text").filter(pc.equal(language, name)))
            before = grams_of.get(name)
            grams_of[name] = (keys, times) if before is None else summed(np.concatenate([before[0], keys]), np.concatenate([before[1], times]))
    if grams_of:
        yield pa.RecordBatch.from_arrays([pa.array([ContextTrees(grams_of).packed()], pa.binary())], names=["model"])
    grams_of.clear()
    shared.trim()


def learned(docs: DataFrame, lang_col: str = "lang", per_language: int = 1500) -> bytes | None:
    """The packed model of a bounded sample of the rows that are not held out; None if no language can be learned.

    The sample are the first ``per_language`` texts of each language by a hash of id and text, so that a run that is repeated
    draws the same. One task counts them, piece by piece, and only the packed trees come to the driver.
    """
    shared.bound_batches(docs.sparkSession)
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~_held())
    fit = labelled.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    sizes = {r[0]: r[1] for r in fit.groupBy("lang").count().collect()}
    if not sizes:
        return None
    most = 1 << 40
    cut = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, int(most * min(1.0, 1.5 * per_language / n + 50 / n)))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(most))
    first = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    drawn = fit.withColumn("draw", draw).where(F.col("draw") < cut[F.col("lang")]).withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    rows = drawn.select("lang", "text").coalesce(1).mapInArrow(_fit, "model binary").collect()
    return bytes(rows[0].model) if rows else None


def keep_identified(docs: DataFrame, lang_col: str = "lang", languages: list[str] | None = None, per_language: int = 1500, scale: float = 64.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose predicted language is one of ``languages`` (by default any learned one).

    A text without a letter is ``und`` and goes. So does a text of LEAST_BYTES bytes or more for which the best tree's code takes
    RAW_BITS bits a byte or more: no language explains it any better than none. Without any learned language all rows go.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(learned(docs, lang_col, per_language))

    def judge():
        trees = shipped.value and ContextTrees.unpacked(shipped.value)
        shared.let_go(shipped)
        accepted = set(languages if languages is not None else trees.languages if trees else [])

        def keeps(texts: pa.Array) -> np.ndarray:
            got = Judged(trees, texts, scale)
            return np.array([x in accepted for x in got.language], bool) & ~((got.size >= LEAST_BYTES) & (got.bits >= RAW_BITS))

        return keeps

    return shared.kept_rows(docs, "text", judge)

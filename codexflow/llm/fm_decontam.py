"""Benchmark decontamination with an FM-index for each training shard.

A shard is a stretch of whole documents of one task. All its words are symbols, numbered in the shard's own vocabulary, with
a separator before each document and at the end. The shard's suffixes are sorted by prefix doubling, their
last-to-first column goes into a wavelet matrix, the benchmark's windows are searched backwards, many at once, and matches
are located by walking to sampled suffix positions. Matched words are merged into removal spans.

The benchmark is broadcast in blocks of bounded size. A task indexes a shard once and searches the blocks one after the
other, holding one at a time; documents are mapped once and never shuffled, whatever the size of either side.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
SAMPLE = 16
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True


def word_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words, lower-cased in A-Z, of all texts; bounds of each text's words; begins and ends in bytes; begins of texts."""
    data, offsets = shared.flat(texts)
    low = shared.LOWER[data]
    begins, ends = shared.words(low, offsets, IN_WORD)
    cuts = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(low[IN_WORD[low]])])
    return words, np.searchsorted(begins, offsets), begins, ends, offsets


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorts all suffixes by prefix doubling. Zeros separate runs: each counts as a symbol of its own, by position.

    A rank is the place of the first suffix of its group; after each round only groups of several suffixes are sorted on.
    """
    n = len(symbols)
    zero = symbols == 0
    own = np.where(zero, np.cumsum(zero) - 1, symbols + int(zero.sum())).astype(np.int64)
    wide = max(1, int(own.max(initial=0) + 1).bit_length())
    reach = max(1, 62 // wide)  # so many symbols fit one key; past the end stand zeros, below any symbol plus one
    key = np.zeros(n, np.int64)
    for k in range(reach):
        key <<= wide
        key[: max(0, n - k)] |= own[k:] + 1
    order = np.argsort(key, kind="stable")
    rank, slots = np.zeros(n, np.int64), np.arange(n)
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]]) if n else np.zeros(0, bool)
    while True:
        heads = slots[np.maximum.accumulate(np.where(same, 0, np.arange(len(slots))))]
        rank[order[slots]] = heads
        open_ = same | np.append(same[1:], False)
        slots = slots[open_]
        if not len(slots):
            return order
        at = order[slots]
        behind = np.where(at + reach < n, rank[np.minimum(at + reach, n - 1)] + 1, 0)
        again = np.lexsort((behind, rank[at]))
        before, behind = rank[at][again], behind[again]
        order[slots] = at[again]
        same = np.concatenate([[False], (before[1:] == before[:-1]) & (behind[1:] == behind[:-1])])
        reach *= 2


class FMIndex:
    """Backward search and location over one sequence of symbols in which 0 separates runs."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE):
        suffixes = suffix_array(symbols)
        column = symbols[suffixes - 1]  # at the first suffix this is the last symbol, a separator
        self.n, self.levels = len(symbols), max(1, int(sigma).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))]).astype(np.int64)
        self.ones, self.zeros = [], []
        rest = column
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.first = np.zeros(sigma + 1, np.int64)  # where a symbol's rows begin below the last level
        distinct, at = np.unique(rest, return_index=True)
        self.first[distinct] = at
        self.sampled = (suffixes % sample == 0) | (column == 0)
        self.places = suffixes[self.sampled]
        self.order = np.cumsum(self.sampled) - 1

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol occurs above each row of the column."""
        at = row
        for k in range(self.levels):
            bit = (symbol >> (self.levels - 1 - k)) & 1
            ones = self.ones[k][at]
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at - self.first[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        at, symbol = row, np.zeros(len(row), np.int64)
        for k in range(self.levels):
            ones = self.ones[k][at]
            bit = self.ones[k][at + 1] - ones
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return self.before[symbol] + at - self.first[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the patterns (rows) that occur: their numbers and their ranges of suffixes."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, k]
            low, high = self.before[symbol] + self.rank(symbol, low), self.before[symbol] + self.rank(symbol, high)
            going = low < high
            which, low, high = which[going], low[going], high[going]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes at ``rows``."""
        out, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        left, row = np.arange(len(rows)), rows
        while len(left):
            found = self.sampled[row]
            out[left[found]] = self.places[self.order[row[found]]] + steps[left[found]]
            left, row = left[~found], self.back(row[~found])
            steps[left] += 1
        return out


class Phrases:
    """The windows of one block of benchmark items, by length, and the items of each window."""

    def __init__(self, item_ids: list[str | None], texts: list[str | None], window: int = WINDOW):
        words, bounds, *_ = word_array(pa.array(texts, pa.large_string()))
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        by_length: dict[int, tuple[list, list]] = {}
        for item, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            size = min(window, e - b)
            if size:
                windows = np.lib.stride_tricks.sliding_window_view(codes[b:e], size)
                rows, items = by_length.setdefault(size, ([], []))
                rows.append(windows)
                items.append(np.full(len(windows), item))
        self.items = item_ids
        self.by_length = {}
        for size, (rows, items) in by_length.items():
            distinct, number = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([number.ravel(), np.concatenate(items)], 1), axis=0)
            self.by_length[size] = (distinct, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1])


class Shard:
    """The words of a batch of documents and the FM-index over all of them."""

    def __init__(self, texts: pa.Array):
        words, self.bounds, *_ = word_array(texts)
        self.n = len(words)
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.document = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        place = np.arange(self.n) + 1 + self.document  # a separator stands before each document
        symbols = np.zeros(self.n + len(self.bounds), np.int64)
        symbols[place] = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.word_of = np.zeros(len(symbols), np.int64)
        self.word_of[place] = np.arange(self.n)
        self.index = FMIndex(symbols, len(self.vocabulary)) if self.n else None

    def find(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """For each word (and the end) how many more occurrences begin than end there; the distinct pairs of document and item."""
        edges, found = np.zeros(self.n + 1, np.int64), [np.zeros((0, 2), np.int64)]
        if self.index is None:
            return edges, found[0]
        code = pc.fill_null(pc.index_in(phrases.vocabulary, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        for size, (patterns, item_begin, items) in phrases.by_length.items():
            symbols = code[patterns - 1]
            possible = np.flatnonzero((symbols > 0).all(1))  # a word that the shard lacks has no rows
            which, low, high = self.index.search(symbols[possible])
            if not len(which):
                continue
            which, count = possible[which], high - low
            ends = np.cumsum(count)
            at = self.word_of[self.index.locate(np.repeat(low - (ends - count), count) + np.arange(ends[-1]))]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + size, -1)
            pairs = np.unique(np.stack([self.document[at], np.repeat(which, count)], 1), axis=0)
            each = item_begin[pairs[:, 1] + 1] - item_begin[pairs[:, 1]]
            ends = np.cumsum(each)
            of = items[np.repeat(item_begin[pairs[:, 1]] - (ends - each), each) + np.arange(ends[-1])]
            found.append(np.stack([np.repeat(pairs[:, 0], each), of], 1))
        return edges, np.unique(np.concatenate(found), axis=0)


def searched(texts: pa.Array, blocks) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Over one shard and all blocks of the benchmark: which words are hit, the bounds of each document's words, and its items."""
    shard, items = Shard(texts), [set() for _ in range(len(texts))]
    edges = np.zeros(shard.n + 1, np.int64)
    for block in blocks:
        phrases = block.value
        own, pairs = shard.find(phrases)
        edges += own
        for doc, item in pairs.tolist():
            items[doc].add(phrases.items[item])
        if len(blocks) > 1:
            del phrases
            block.__dict__.pop("_value", None)
    return np.cumsum(edges)[:-1] > 0, shard.bounds, items


def spans_of(hit: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of hit words, none across documents: their documents, begins and ends, counted from the document's first word."""
    edge = np.concatenate([[False], hit, [False]])
    cut = np.zeros(len(hit) + 1, bool)
    cut[bounds] = True
    begins = np.flatnonzero(edge[1:] & (~edge[:-1] | cut))
    ends = np.flatnonzero(edge[:-1] & (~edge[1:] | cut))
    of = np.searchsorted(bounds, begins, side="right") - 1
    return of, begins - bounds[of], ends - bounds[of]


def broadcast_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    """The benchmark's windows as broadcasts, each of about BLOCK_BYTES of text."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()  # about BLOCK_BYTES of text
        out.append(benchmark.sparkSession.sparkContext.broadcast(Phrases([r["item"] for r in block], [r["text"] for r in block], window)))
    return out


FOUND = "doc_id long, n_words long, n_hit long, spans array<struct<begin:int,end:int>>, items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` for every document: hit words as merged spans of word numbers, and the items hit.

    Null and empty texts have no words; an item without words hits nothing; an item of fewer words than ``window`` is one
    window. Windows of items with a null id are hit like any other, but no item is listed for them. Repeated documents give
    a row each; rows that share an item id add up to one item. Empty tables on either side give rows without hits, or
    none. Other columns are not read.
    """
    blocks = broadcast_blocks(benchmark, item_col, text_col, window)

    def run(batches):
        for batch in shared.chunks(batches, limit=SHARD_BYTES):
            hit, bounds, items = searched(batch.column("text"), blocks)
            of, begins, ends = spans_of(hit, bounds)
            cuts = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32))], names=["begin", "end"])
            total = np.concatenate([[0], np.cumsum(hit)])[bounds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(np.diff(total), pa.int64()), pa.ListArray.from_arrays(pa.array(cuts), spans), pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "spans", "items"],
            )
        for block in blocks:
            shared.let_go(block)

    return shared.id_and_text(docs, id_col, text_col).mapInArrow(run, FOUND)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (word numbers) and what stands between them."""
    _, _, begins, ends, _ = word_array(pa.array([text], pa.large_string()))
    raw, out, at = text.encode(), [], 0
    for b, e in spans:
        out.append(raw[at : begins[b]])
        at = int(ends[e - 1])
    return b"".join([*out, raw[at:]]).decode()


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark window occurs; each row is judged by its text."""
    blocks = broadcast_blocks(benchmark, item_col, text_col, window)

    def judge():
        def keeps(texts: pa.Array) -> np.ndarray:
            hit, bounds, _ = searched(texts, blocks)
            total = np.concatenate([[0], np.cumsum(hit)])[bounds]
            return np.diff(total) == 0

        return keeps

    return shared.kept_rows(docs, text_col, judge, SHARD_BYTES)


def digest(items: list[str]) -> str:
    """The contract's digest of item ids, as ``sha2(array_join(items, ','), 256)`` gives it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

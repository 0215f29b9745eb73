"""SentencePiece encoding for merge-type vocabularies, and decoding.

Encoding keeps an agenda of adjacent symbol pairs ordered by score, highest first and leftmost among equals; the best
pair is merged and its neighbours enter the agenda, until no pair is left. A vocabulary in which no piece holds a word
mark after another character never merges across the begin of a word, so texts fall apart into words. The agenda runs in
lockstep over all distinct words of a batch, as arrays; very long words take the same agenda as a heap. Each Arrow batch
can be checked against the library.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from codexflow.llm import shared
from codexflow.llm.ppm_language import Table

MARK = "▁"
NONE = np.iinfo(np.int64).max
CODE = 32  # bits of a merged id beside its rank
LOCKSTEP = 64
CELLS = 120_000  # symbols of the words merged at once, padding included


class Agenda:
    """The merges of one vocabulary. Only BPE models with byte fallback, the identity normaliser and a dummy prefix."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser with a dummy prefix is known here")
        pieces = model.pieces
        if any(p.type not in (1, 2, 3, 6) for p in pieces):
            raise ValueError("user-defined and unused pieces are not known here")
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == 1}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a word mark after another character: words can't be encoded one by one")
        self.bytes = np.zeros(256, np.int64)
        for i, p in enumerate(pieces):
            if p.type == 6:
                self.bytes[int(p.piece[1:-1], 16)] = i
        self.size = len(pieces)
        order = {s: k for k, s in enumerate(sorted({pieces[i].score for i in self.ids.values()}, reverse=True))}
        rank = {p: order[pieces[i].score] for p, i in self.ids.items()}
        keys, ranks, merged = [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                if (a := self.ids.get(p[:cut])) is not None and (b := self.ids.get(p[cut:])) is not None:
                    keys.append(a * self.size + b)
                    ranks.append(rank[p])
                    merged.append(i)
        self.keys, self.rank, self.merged = (np.array(x, np.int64) for x in (keys, ranks, merged))
        self.code = np.append(self.rank << CODE | self.merged, NONE)
        self.ties = len(order) < len(self.ids)  # of different pieces; leftmost goes first among these too
        self.table = Table(self.keys)
        points = [(ord(p), i) for p, i in self.ids.items() if len(p) == 1]
        self.char = np.full(max(c for c, _ in points) + 1, -1, np.int64)
        for c, i in points:
            self.char[c] = i

    @functools.cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and merged id by key, for long words only."""
        return dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist(), strict=True), strict=True))

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and merged id of each pair, in one number; NONE where there is no such merge."""
        keys = a.astype(np.int64) * self.size + b
        keys[(a < 0) | (b < 0)] = -1
        return self.code[self.table.find(keys.ravel())].reshape(a.shape)  # the last code, of place -1, is NONE

    def in_lockstep(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges all rows at once. ``symbols``: rows of ids, -2-c for an unknown character c, -1 beyond ``length``."""
        out, left = symbols.copy(), length.copy()
        raw, rows, pairs = symbols, np.arange(len(symbols)), self.look_up(symbols[:, :-1], symbols[:, 1:])
        while True:
            best = (pairs >> CODE).argmin(1) if self.ties else pairs.argmin(1)
            code = pairs[np.arange(len(rows)), best]
            going = code != NONE
            if not going.all():
                done = ~going
                out[rows[done], : raw.shape[1]], left[rows[done]] = raw[done], length[done]
                rows, raw, pairs, length, best, code = rows[going], raw[going], pairs[going], length[going], best[going], code[going]
                if not len(rows):
                    return out, left
            # the merged symbol takes the left one's place; those after the right one, and their pairs, move up
            n, width = raw.shape
            here = np.arange(n)
            raw[here, best] = code & ((1 << CODE) - 1)
            column = np.arange(width)
            raw = raw[column != best[:, None] + 1].reshape(n, width - 1)
            length = length - 1
            if width == 2:
                out[rows, :1], left[rows] = raw, length
                return out, left
            pairs = pairs[column[:-1] != best[:, None]].reshape(n, width - 2)
            for at, ok in ((best - 1, best > 0), (best, best < length - 1)):
                r, c = here[ok], at[ok]
                pairs[r, c] = self.look_up(raw[r, c], raw[r, c + 1])

    def with_heap(self, chars: str) -> list[int]:
        """The same agenda for one long word, as a heap over a linked list of symbols; -2-c stands for unknown c."""
        symbol = [self.ids.get(c, -2 - ord(c)) for c in chars]
        before, after = list(range(-1, len(chars) - 1)), [*range(1, len(chars)), -1]
        heap = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and symbol[left] >= 0 and symbol[right] >= 0:
                got = self.pairs.get(symbol[left] * self.size + symbol[right])
                if got:
                    heapq.heappush(heap, (got[0], left, right, symbol[left], symbol[right], got[1]))

        for i in range(len(chars) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, a, b, new = heapq.heappop(heap)
            if symbol[left] != a or symbol[right] != b or after[left] != right:
                continue
            symbol[left], symbol[right] = new, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbol if s is not None]

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (binaries) end to end, and the number of ids of each. A word's marks are spaces here."""
        data, offsets = _bytes_of(texts)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        first, lengths = starts[:-1], np.diff(starts)
        points[points == 0x20] = ord(MARK)
        symbols = np.where(points < len(self.char), self.char[np.minimum(points, len(self.char) - 1)], -1)
        symbols = np.where(symbols < 0, -2 - points, symbols)
        order, flats, sizes = [], [], []
        for low, high in ((0, 2), (2, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 16), (16, 24), (24, 40), (40, LOCKSTEP)):
            chosen = np.flatnonzero((lengths > low) & (lengths <= high))
            step = CELLS // high
            for at in range(0, len(chosen), step):
                some = chosen[at : at + step]
                size, width = lengths[some], int(lengths[some].max())
                inside = np.arange(width)[None, :] < size[:, None]
                rows = np.where(inside, symbols[np.minimum(first[some][:, None] + np.arange(width)[None, :], len(symbols) - 1)], -1)
                merged, left = self.in_lockstep(rows, size) if width > 1 else (rows, size)
                order.append(some)
                flats.append(merged[np.arange(width)[None, :] < left[:, None]])
                sizes.append(left)
        for i in np.flatnonzero(lengths > LOCKSTEP).tolist():
            order.append(np.array([i]))
            flats.append(np.array(self.with_heap("".join(map(chr, points[first[i] : first[i] + lengths[i]].tolist()))), np.int64))
            sizes.append(np.array([len(flats[-1])]))
        if not order:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        order, sizes, flat = np.concatenate(order), np.concatenate(sizes), np.concatenate(flats)
        ids, size_of_symbol = self.fallen_back(flat)
        ends = np.cumsum(sizes)
        grown = np.concatenate([[0], np.cumsum(size_of_symbol)])[np.concatenate([[0], ends])]
        begin, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        begin[order], size[order] = grown[:-1], np.diff(grown)
        return gathered(ids, begin, size), size

    def fallen_back(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with each unknown character as the ids of its UTF-8 bytes; and the number of ids of each symbol."""
        point = -2 - symbols
        known = symbols >= 0
        size = np.where(known, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        if known.all():
            return symbols, size
        of = np.repeat(np.arange(len(symbols)), size)
        k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        shift = 6 * (size[of] - 1 - k)
        byte = (point[of] >> np.maximum(shift, 0)) & 0x3F | 0x80
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size[of]] | (point[of] >> np.maximum(shift, 0))
        byte = np.where(size[of] == 1, point[of] & 0x7F, np.where(k == 0, lead, byte))
        return np.where(known[of], symbols[of], self.bytes[byte & 0xFF]), size


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of large binaries, and where each begins (with the end)."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that start at ``begin`` and have ``size``, end to end."""
    ends = np.cumsum(size)
    return values[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def split_words(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All words (a run of spaces with what follows it) of all texts, each text with a space before it, and the number of words of each text."""
    data, offsets = shared.flat(pc.replace_substring(texts, MARK, " "))
    sizes = np.diff(offsets)
    some = sizes > 0
    starts = offsets[:-1] + np.cumsum(some) - some
    marked = np.full(len(data) + int(some.sum()), 0x20, np.uint8)
    keep = np.ones(len(marked), bool)
    keep[starts[some]] = False
    marked[keep] = data
    is_space = marked == 0x20
    begins = np.zeros(len(marked) + 1, bool)
    begins[1:-1] = is_space[1:] & ~is_space[:-1]
    begins[starts[some]] = True
    begins[-1] = True
    at = np.flatnonzero(begins)
    bounds = np.append(starts, len(marked))
    counts = np.diff(np.searchsorted(at[:-1], bounds))
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(marked)]), counts


class Encoder:
    """Encodes Arrow arrays of texts; each distinct word of an array is encoded once."""

    def __init__(self, path: str):
        self.agenda = Agenda(path)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin (with the end)."""
        words, counts = split_words(texts)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        ids, sizes = self.agenda.words(coded.dictionary)
        ids, begin = ids.astype(np.int32), np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy(zero_copy_only=False)
        size = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        return gathered(ids, begin[codes], size), ends[np.concatenate([[0], np.cumsum(counts)])]


class Decimals:
    """Writes arrays of ids as decimals joined by commas."""

    def __init__(self, size: int):
        width = len(str(size - 1)) + 1
        text = np.array([f"{i},".ljust(width, "\0") for i in range(size)], f"S{width}")
        self.cells = text.view(np.uint8).reshape(size, width)

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """One byte string for each stretch of ``ids``."""
        cells = self.cells[ids]
        used = cells != 0
        raw = cells[used]
        ends = np.concatenate([[0], np.cumsum(used.sum(1))])[bounds].tolist()
        raw = raw.tobytes()
        return [raw[b : max(b, e - 1)] for b, e in zip(ends[:-1], ends[1:], strict=True)]


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: str = "digests", check: bool = True) -> DataFrame:
    """Encodes and decodes every whole text, without begin or end ids.

    ``keep="digests"``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``; ``keep="ids"``: ``doc_id, ids, decoded``.
    ``check``: every Arrow batch is encoded by the library too, and a difference fails the job, naming the document.

    Null texts count as empty, with no ids and the empty text decoded. Texts of any length are encoded whole, also those
    without spaces. Repeated rows and null ids give a row each; an empty table gives an empty result; other columns of
    ``docs`` are not read.
    """

    def run(batches):
        import sentencepiece

        library, encoder = sentencepiece.SentencePieceProcessor(model_file=model_path), Encoder(model_path)
        decimals = Decimals(encoder.agenda.size)
        shared.trim()
        for batch in shared.chunks(batches):
            texts = pc.fill_null(batch.column("text"), "")
            ids, bounds = encoder(texts)
            columns = [[], []]
            for k, text in enumerate(texts):
                own = ids[bounds[k] : bounds[k + 1]]
                if check and not np.array_equal(own, library.EncodeAsNumpy(text.as_py())):
                    raise ValueError(f"document {batch.column('doc_id')[k]}: the agenda's ids differ from the library's")
                decoded = library.decode(own) if len(own) else ""
                columns[0].append(own if keep == "ids" else len(own))
                columns[1].append(decoded if keep == "ids" else hashlib.sha256(decoded.encode()).hexdigest())
            if keep == "ids":
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(columns[0], pa.list_(pa.int32())), pa.array(columns[1], pa.string())], names=["doc_id", "ids", "decoded"])
            else:
                digests = [hashlib.sha256(x).hexdigest() for x in decimals(ids, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(digests, pa.string()), pa.array(columns[1], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    schema = "doc_id long, ids array<int>, decoded string" if keep == "ids" else "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return shared.id_and_text(docs, id_col, text_col).mapInArrow(run, schema)

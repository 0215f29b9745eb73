"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text. Of a pair of labelled documents, one of label 1 and one
of label 0, the first is preferred; the weights minimise the logistic loss of the pairs' feature differences. Documents
are then parted at a quantile: which one, the labels of the fitted sample say, where they part best; its value is taken over
the strengths of all documents, in steps of STEP, and strengths are mapped to scores so that it is the cut at 0.7.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared

CUT = 0.7
STEP, STEPS_MOST = 1e-3, 50_000  # strengths are counted in steps, those beyond the last together
HINGES = 6
FEATURES = [
    "log_words", "word_bytes", "symbols", "stops", "digits", "capitals", "spaces", "distinct", "repeats", "bare", "tripled", "letterless",
    "top_word", "ended", "log_lines", "line_bytes", "same_lines", "longest", "high_bytes", "sentences",
]


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


STOPS, DIGITS, SYMBOLS = _class(".,;:!?'\"-()"), _class("0123456789"), _class("#$%&*+/<=>@[\\]^_`{|}~")
CAPITALS, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
CAPITALS[65:91] = LETTERS[65:91] = LETTERS[97:123] = LETTERS[0x80:] = True


def _per(begins_sorted: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For sorted places, the bounds of each text's places."""
    return np.searchsorted(begins_sorted, bounds)


def _shares(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of true flags in each stretch; 0 for an empty one."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(1, np.diff(bounds))


def _stretches(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of ``data`` (in order, not touching) as an array of binaries."""
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, begins, 1)
    np.add.at(inside, ends, -1)
    body = data[np.cumsum(inside)[:-1] > 0]
    return pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))])


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; null texts count as empty."""
    data, offsets = shared.flat(texts)
    n = len(offsets) - 1
    begins, ends = shared.words(data, offsets, ~shared.SPACE)
    words = _per(begins, offsets)
    count, size = np.diff(words), np.diff(offsets)
    document = np.repeat(np.arange(n), count)
    length = ends - begins
    codes = _stretches(shared.LOWER[data], begins, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pair = document * (int(codes.max(initial=0)) + 1) + codes
    distinct, times = np.unique(pair, return_counts=True)
    owner = distinct // (int(codes.max(initial=0)) + 1)
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (document[1:] == document[:-1])
    if len(data):
        last = data[ends - 1]
        before = np.where(length > 2, data[np.maximum(ends - 2, 0)], 0), np.where(length > 2, data[np.maximum(ends - 3, 0)], 0)
        tripled = SYMBOLS[last] & (last == before[0]) & (last == before[1])
        letters = np.concatenate([[0], np.cumsum(LETTERS[data])])
        letterless = letters[ends] == letters[begins]
        bare = (length == 1) & letterless
        ended = STOPS[last]
        stopped = (last == 0x2E) | (last == 0x21) | (last == 0x3F)
    else:
        tripled = letterless = bare = ended = stopped = np.zeros(0, bool)
    not_break = np.ones(256, bool)
    not_break[0x0A] = False
    line_begin, line_end = shared.words(data, offsets, not_break)
    lines = _per(line_begin, offsets)
    line_count = np.diff(lines)
    line_codes = _stretches(data, line_begin, line_end).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_owner = np.repeat(np.arange(n), line_count)
    line_kinds = np.bincount(np.unique(line_owner * (int(line_codes.max(initial=0)) + 1) + line_codes) // (int(line_codes.max(initial=0)) + 1), minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, document, length)
    columns = [
        np.log1p(count), np.minimum(40, np.bincount(document, length, n) / np.maximum(1, count)), _shares(SYMBOLS[data], offsets), _shares(STOPS[data], offsets),
        _shares(DIGITS[data], offsets), _shares(CAPITALS[data], offsets), _shares(shared.SPACE[data], offsets), np.bincount(owner, minlength=n) / np.maximum(1, count),
        _shares(again, words), _shares(bare, words), _shares(tripled, words), _shares(letterless, words), top / np.maximum(1, count), _shares(ended, words),
        np.log1p(line_count), np.log1p(size / np.maximum(1, line_count)), 1 - line_kinds / np.maximum(1, line_count), np.log1p(longest), _shares(data >= 0x80, offsets), _shares(stopped, words),
    ]
    return np.stack(columns, 1)


class Ranking:
    """A fitted ranking: strengths of feature rows, and scores in which the chosen quantile lies at CUT."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, pairs: int = 60_000, ridge: float = 1e-3, seed: int = 11):
        knots = np.quantile(rows, np.linspace(0.02, 0.98, HINGES), axis=0)
        self.knots = knots
        raw = self._expanded(rows)
        self.mean, self.scale = raw.mean(0), np.maximum(raw.std(0), 1e-6)
        wide = (raw - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        self.weights = np.zeros(wide.shape[1])
        self.at, self.slope, self.share, self.known = 0.0, 1.0, 0.0, len(better) > 0 and len(worse) > 0
        if not len(better) or not len(worse):
            return
        # each document of the rarer label stands in as many pairs as the others of it
        draws = max(pairs, len(better), len(worse))
        left = np.resize(rng.permutation(better), draws)
        right = rng.permutation(np.resize(rng.permutation(worse), draws))
        for _ in range(12):  # Newton steps on the penalised logistic loss of differences
            gradient, hessian = ridge * self.weights, ridge * np.eye(len(self.weights))
            for k in range(0, draws, 20_000):
                difference = wide[left[k : k + 20_000]] - wide[right[k : k + 20_000]]
                p = 1 / (1 + np.exp(np.clip(difference @ self.weights, -40, 40)))
                gradient = gradient - difference.T @ p / draws
                hessian = hessian + (difference * (p * (1 - p))[:, None]).T @ difference / draws
            step = np.linalg.solve(hessian, gradient)
            self.weights = self.weights - step
            if np.abs(step).max() < 1e-6:
                break
        strength = wide @ self.weights
        quantiles = np.quantile(strength, np.linspace(0.0005, 0.9995, 1999))
        parted = [((strength[better] >= q).mean() + (strength[worse] < q).mean()) for q in quantiles]
        self.at = float(quantiles[int(np.argmax(parted))])
        self.share = float((strength < self.at).mean())  # of the sample below the cut
        self.slope = float(1 / max(1e-6, np.std(strength)))

    def _expanded(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows, *(np.maximum(0, rows - k) for k in self.knots)], 1)

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return (self._expanded(rows) - self.mean) / self.scale @ self.weights

    def placed(self, steps: np.ndarray, counts: np.ndarray) -> None:
        """Takes the cut's value from counts of all documents' strengths by step (ascending)."""
        if len(steps) and self.known:
            below = np.cumsum(counts)
            self.at = float(steps[min(int(np.searchsorted(below, self.share * below[-1], side="right")), len(steps) - 1)]) * STEP

    def score(self, strength: np.ndarray) -> np.ndarray:
        """Scores in 0..1; at least CUT exactly where the strength is at least the cut's. Without a ranking all are 0.5."""
        if not self.known:
            return np.full(len(strength), 0.5)
        z = np.clip((strength - self.at) * self.slope * 2 + np.log(CUT / (1 - CUT)), -40, 40)
        score = 1 / (1 + np.exp(-z))
        return np.where(strength >= self.at, np.maximum(score, CUT), np.minimum(score, np.nextafter(CUT, 0)))


def _featured(batches):
    for batch in shared.chunks(batches):
        rows = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["label", "features"])


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``: ``predicted`` is 1 if ``score >= 0.7``.

    Rows whose crc32(doc_id) mod 4 is 2 are held out, as are null ids; the ranking is fitted to at most ``fit_rows`` of the
    other labelled rows, the first by a hash of the id. Labels other than 0 and 1 are passed over. Null texts count as empty.
    Repeated rows give a row each. Without labels of both kinds every score is 0.5, and nothing is predicted to be good.
    Features are of whole texts.
    """
    spark = docs.sparkSession
    held = F.coalesce(shared.crc_mod("doc_id", 4) == 2, F.lit(True))
    texts = shared.id_and_text(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)").where(~held)
    draw = F.xxhash64("doc_id", F.lit(23))
    drawn = known.distinct().orderBy(draw, "doc_id", "label").limit(fit_rows)  # which bounds the broadcast
    fit = texts.join(F.broadcast(drawn), "doc_id").orderBy(draw, "doc_id", "label", F.xxhash64("text")).limit(fit_rows).select("doc_id", "label", "text")
    sample = fit.mapInArrow(_featured, "label int, features array<double>").toArrow()  # at most fit_rows rows, in the order of the draw
    table = sample.column("features").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if sample.num_rows else np.zeros((1, len(FEATURES)))
    label = sample.column("label").to_numpy() if sample.num_rows else np.zeros(1)
    ranking = Ranking(table, label)
    del sample, table, label
    fitted = spark.sparkContext.broadcast(ranking)

    def measure(batches):
        for batch in shared.chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fitted.value.strength(features(batch.column("text"))))], names=["doc_id", "strength"])

    rows = shared.stored(texts.mapInArrow(measure, "doc_id long, strength double"), f"{shared.shared_dir(spark)}/strengths")
    step = F.least(F.greatest(F.floor(F.col("strength") / STEP), F.lit(-STEPS_MOST)), F.lit(STEPS_MOST))
    steps = rows.groupBy(step.alias("step")).count().orderBy("step").toArrow()  # at most 2 * STEPS_MOST + 1 rows
    ranking.placed(steps.column("step").to_numpy(), steps.column("count").to_numpy())
    placed = spark.sparkContext.broadcast(ranking)

    def run(batches):
        for batch in batches:
            score = placed.value.score(batch.column("strength").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held.alias("held_out"), "score", "predicted")

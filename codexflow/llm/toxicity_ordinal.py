"""Toxicity severity by cumulative-link ordinal regression.

A text's sparse features are the hashed words it holds and the hashed beginnings of those words. One weight vector is
shared by all thresholds: P(grade <= k) = logistic(threshold_k - w.x), with thresholds in ascending order. The expected
severity is the sum over k of P(grade > k).

Labels only say toxic or not, so that grades are derived from them in the fitted sample: 0 is not toxic; toxic texts are
graded 1 to 3 by thirds of the number of distinct features they hold that mark toxic texts in the sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm import shared

BITS = 18
GRADES = 4
LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def sparse(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row bounds and features, ascending and distinct in each row."""
    data, offsets = shared.flat(texts)
    data = shared.LOWER[data]
    begins, ends = shared.words(data, offsets, LETTERS)
    document = np.searchsorted(offsets, begins, side="right") - 1
    keys = [(document << BITS) | (shared.word_hashes(data, begins, ends) >> np.uint64(64 - BITS)).astype(np.int64)]
    for size in (4, 5, 6):
        some = ends - begins > size
        begun = shared.mixed(shared.word_hashes(data, begins[some], begins[some] + size) + np.uint64(size))
        keys.append((document[some] << BITS) | (begun >> np.uint64(64 - BITS)).astype(np.int64))
    keys = np.sort(np.concatenate(keys))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return np.searchsorted(keys, np.arange(len(offsets)) << BITS), keys & ((1 << BITS) - 1)


class Ordinal:
    """Shared weights and ascending thresholds, fitted by full-batch gradient steps on the penalised likelihood."""

    def __init__(self, bounds: np.ndarray, features: np.ndarray, grades: np.ndarray, ridge: float = 0.5, steps: int = 300, rate: float = 0.1, chi_square: float = 10.0):
        n, levels = len(grades), GRADES - 1
        self.weights = np.zeros(1 << BITS)
        share = np.clip([(grades <= k).mean() if n else 1.0 for k in range(levels)], 0.02, 0.995)
        base = np.log(share / (1 - share))
        free = np.concatenate([[base[0]], np.log(np.maximum(0.05, np.diff(base)))])  # differences stay positive
        self.thresholds = np.cumsum(np.concatenate([[free[0]], np.exp(free[1:])]))
        if not n or not len(features):
            return
        often = np.bincount(features, minlength=1 << BITS)
        rows = np.repeat(np.arange(n), np.diff(bounds))
        # features that occur at random among the grades only add noise: those kept differ by a chi-square test
        inside, share = np.bincount(features, grades[rows] > 0, 1 << BITS), (grades > 0).mean()
        with np.errstate(divide="ignore", invalid="ignore"):
            used = (often >= 3) & ((inside - often * share) ** 2 / (often * share * (1 - share)) > chi_square)
        keep = used[features]
        rows, features = rows[keep], features[keep]
        compact = np.cumsum(used) - 1
        columns, width = compact[features], int(used.sum())
        w = np.zeros(width)
        state = [np.zeros(width), np.zeros(width), np.zeros(levels), np.zeros(levels)]
        for step in range(1, steps + 1):
            z = np.bincount(rows, w[columns], n)
            thresholds = np.cumsum(np.concatenate([[free[0]], np.exp(free[1:])]))
            below = 1 / (1 + np.exp(-np.clip(np.concatenate([np.full((n, 1), -40.0), thresholds[None, :] - z[:, None], np.full((n, 1), 40.0)], 1), -40, 40)))
            below[:, 0], below[:, -1] = 0, 1
            at = np.arange(n)
            high, low = below[at, grades + 1], below[at, grades]
            p = np.maximum(high - low, 1e-12)
            slope = below * (1 - below)
            dz = (slope[at, grades + 1] - slope[at, grades]) / p  # of the negative log likelihood
            dt = np.zeros(levels)
            for k in range(levels):
                dt[k] = -(slope[grades == k, k + 1] / p[grades == k]).sum() + (slope[grades == k + 1, k + 1] / p[grades == k + 1]).sum()
            down = np.cumsum(dt[::-1])[::-1]
            df = np.concatenate([[down[0]], down[1:] * np.exp(free[1:])])
            dw = np.bincount(columns, dz[rows], width) + ridge * w
            for g, (m, v), x in ((dw, (state[0], state[1]), w), (df, (state[2], state[3]), free)):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights[used] = w
        self.thresholds = np.cumsum(np.concatenate([[free[0]], np.exp(free[1:])]))

    def above(self, bounds: np.ndarray, features: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and threshold."""
        n = len(bounds) - 1
        z = np.bincount(np.repeat(np.arange(n), np.diff(bounds)), self.weights[features], n)  # a row's own sum, whatever its batch
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))


def grades_of(bounds: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grade 0 for rows that aren't toxic; for the others 1 to 3 by thirds of how many marking features they hold."""
    rows = np.repeat(np.arange(len(toxic)), np.diff(bounds))
    inside = np.bincount(features[toxic[rows] == 1], minlength=1 << BITS)
    outside = np.bincount(features[toxic[rows] == 0], minlength=1 << BITS)
    marks = (inside >= 3) & (inside / max(1, (toxic == 1).sum()) > 20 * (outside + 0.5) / max(1, (toxic == 0).sum()))
    held = np.bincount(rows, marks[features], len(toxic))
    cuts = np.quantile(held[toxic == 1], [1 / 3, 2 / 3]) if (toxic == 1).any() else [0, 0]
    return np.where(toxic == 1, 1 + (held > cuts[0]) + (held > cuts[1]), 0).astype(np.int64)


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 12_000, flag_from: float = 0.35) -> DataFrame:
    """``doc_id, held_out, grade, expected_severity, p_toxic, toxic`` for every row of ``docs``.

    ``expected_severity`` lies between 0 and 3, ``grade`` is the most probable grade, ``p_toxic`` is P(grade > 0) and
    ``toxic`` is ``p_toxic >= flag_from``. Rows whose crc32(doc_id) mod 4 is 2 are held out, as are null ids; the model is
    fitted to at most ``fit_rows`` of the other labelled texts, whole, the first by a hash of id and text.
    Every row is scored on its whole text. Null and empty texts have no features. Repeated rows give a row each; labels
    other than 0 and 1 are passed over; without labels nothing is toxic.
    """
    spark = docs.sparkSession
    docs = shared.id_and_text(docs, id_col, text_col)
    held = F.coalesce(shared.crc_mod("doc_id", 4) == 2, F.lit(True))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)").where(~held)
    drawn = known.distinct().orderBy(F.xxhash64("doc_id", F.lit(31)), "doc_id", "label").limit(fit_rows)  # which bounds the broadcast
    fit = docs.join(F.broadcast(drawn), "doc_id").orderBy(F.xxhash64("doc_id", F.lit(31)), "doc_id", "label", F.xxhash64("text")).limit(fit_rows).select("doc_id", "label", "text")

    def read(batches):
        for batch in shared.chunks(batches):
            bounds, features = sparse(batch.column("text"))
            cuts = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(cuts, pa.array(features.astype(np.int32)))],
                names=["doc_id", "label", "features"],
            )

    sample = fit.mapInArrow(read, "doc_id long, label int, features array<int>").toArrow()  # at most fit_rows rows, in the order of the draw
    lists = sample.column("features").combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.int32()))
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = lists.flatten().to_numpy().astype(np.int64)
    label = sample.column("label").to_numpy()
    del sample, lists
    model = spark.sparkContext.broadcast(Ordinal(bounds, flat, grades_of(bounds, flat, label)))

    def score(batches):
        for batch in shared.chunks(batches):
            bounds, features = sparse(batch.column("text"))
            above = model.value.above(bounds, features)
            each = np.concatenate([np.ones((len(above), 1)), above], 1) - np.concatenate([above, np.zeros((len(above), 1))], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(each.argmax(1).astype(np.int32)), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= flag_from)], names=["doc_id", "grade", "expected_severity", "p_toxic", "toxic"]
            )

    scored = docs.mapInArrow(score, "doc_id long, grade int, expected_severity double, p_toxic double, toxic boolean")
    return scored.select("doc_id", held.alias("held_out"), "grade", "expected_severity", "p_toxic", "toxic")

"""Near duplicates by a Jaccard join of word shingles with adaptive multi-match prefixes.

Two documents link when 100 * |A and B| >= 80 * |A or B| over their sets of five-word shingles. All sets are sorted in one
global order: shingles that are frequent in the corpus come last, all others by their hash. With n shingles and the least
overlap o = ceil(0.8 n), linked documents share at least k shingles within their first n - o + k. Each document picks
k from 1 to MOST by the estimated cost of scanning and verifying what its prefix meets; a pair has to share as many
prefix shingles as the smaller k of the two before it is verified.

The join's result is the components of the link graph, so that links within a component need not all be listed:

1. documents with equal sets form classes; only one of a task's stretch goes on;
2. prefixes meet by shingle. Of each shingle's documents the one with the largest share of frequent shingles leads, first
   within a task and then among the tasks' leaders, so that a shingle of very many documents is no task's whole load; the
   others pair with their leader, pairs are verified, and links give components;
3. all pairs that share a prefix shingle and lie in different components, most of them met at the most crowded such shingle only,
   are filtered by size, position, number of shared prefix shingles and parity bits, and verified.

Step 3 alone is complete: any link not found there lies within one component. Step 2 keeps a group of m near copies from
giving m * m pairs. The frequency list decides only the order, hence speed, never the result.

A shingle is known by 128 bits, under a key, of its words; classes compare a 128-bit digest of the whole set and pairs the
128 bits of each shingle. The chance that any two of n different shingles agree is below n * n / 2**129: 2e-13 for 10**13.
The first 56 of these bits stand for a shingle where a collision costs time only: in the order and in the join of prefixes.
"""

from __future__ import annotations

import functools
import hashlib
import operator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexflow.llm import components, shared

SIZE = 5
MOST = 4
VERIFY_COST = 8.0
LOCAL_LEAST = 2
FREQUENT_MOST = 1 << 21
SEED = 5
HELD_PREFIXES = 500_000  # prefix rows of a task among which leaders are chosen at once
FACTORS = shared.mixed(np.arange(1, 2 * SIZE + 1, dtype=np.uint64)).reshape(2, SIZE) | np.uint64(1)


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """Each text's set of shingles: two rows of 64 bits, in ascending order. Fewer than SIZE words make one shingle, none make none."""
    data, offsets = shared.flat(texts)
    data = shared.LOWER[data]
    begins, ends = shared.words(data, offsets, ~shared.SPACE)
    words = np.stack(shared.word_digests(data, begins, ends, SEED))
    bounds = np.searchsorted(begins, offsets)
    n = max(0, words.shape[1] - SIZE + 1)
    total = np.zeros((2, n), np.uint64)
    for k in range(SIZE):
        total += words[:, k : k + n] * FACTORS[:, k : k + 1]
    total = shared.mixed(total)
    out = []
    for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if e - b >= SIZE:
            out.append(as_set(total[:, b : e - SIZE + 1]))
        elif e > b:
            out.append(shared.mixed((words[:, b:e] * FACTORS[:, : e - b]).sum(1, keepdims=True) + np.uint64(e - b)))
        else:
            out.append(total[:, :0])
    return out


def as_set(both: np.ndarray) -> np.ndarray:
    """Distinct columns in ascending order."""
    both = both[:, np.argsort(both[0])]
    same = both[0, 1:] == both[0, :-1]
    if same.any():
        if (both[1, 1:] != both[1, :-1])[same].any():
            both = both[:, np.lexsort((both[1], both[0]))]
        both = both[:, np.concatenate([[True], (both[:, 1:] != both[:, :-1]).any(0)])]
    return both


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """How many shingles two sets share."""
    if not x.shape[1] or not y.shape[1]:
        return 0
    if (y[0, 1:] == y[0, :-1]).any():  # different shingles with the same first half
        return len(set(zip(*x.tolist(), strict=True)) & set(zip(*y.tolist(), strict=True)))
    at = np.minimum(np.searchsorted(y[0], x[0]), y.shape[1] - 1)
    return int((y[:, at] == x).all(0).sum())


def short(s: np.ndarray) -> np.ndarray:
    """The 56 bits that stand for a shingle in order and prefixes; ascending as the set is."""
    return s[0] >> np.uint64(8)


PLACES = 1024  # bits of parity for each set
PARITY = [f"b{k}" for k in range(PLACES // 64)]
FOLDED = ["c0", "c1", "c2", "c3"]
CROWDED = [f"crowded{k}" for k in range(4)]
FIRST = "kind int, id long, n long, signature binary, local long, " + ", ".join(f"{c} long" for c in PARITY)
FIRST_NAMES = ["kind", "id", "n", "signature", "local", *PARITY]


def parities(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set PLACES bits, as columns of 64: whether an odd number of its shingles falls into each of as many bins.

    Sets differ in at least as many shingles as their bits differ in places.
    """
    bits = np.zeros((len(sets), PLACES), np.uint8)
    for row, s in zip(bits, sets, strict=True):
        row[:] = np.bincount((s[0] & np.uint64(PLACES - 1)).astype(np.int64), minlength=PLACES) & 1
    return list(np.packbits(bits, axis=1).reshape(len(sets), len(PARITY), 8).view(np.int64)[:, :, 0].T.copy()) if sets else [np.zeros(0, np.int64)] * len(PARITY)


def _members_and_frequent(batches):
    """Of each document its size, signature, class within the task's stretch and parity bits (kind 0), and the shingles that several sets of the stretch hold (kind 1)."""
    held, size = [], 0

    def frequent():
        keys, times = np.unique(np.concatenate(held), return_counts=True)
        some = times >= LOCAL_LEAST
        n = int(some.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, 1, np.int32)), pa.array(keys[some].astype(np.int64)), pa.array(times[some].astype(np.int64)), pa.nulls(n, pa.binary()), *[pa.nulls(n, pa.int64())] * (1 + len(PARITY))], names=FIRST_NAMES
        )

    seen: dict = {}
    task, serial = TaskContext.get().partitionId() << 40, 0
    for batch in shared.chunks(batches, limit=2 << 20):
        sets = shingles(batch.column("text"))
        signatures = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        local = []
        for signature, s in zip(signatures, sets, strict=True):
            if signature not in seen:
                seen[signature] = task + serial
                serial += 1
                held.append(short(s))
                size += s.shape[1]
            local.append(seen[signature])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(sets), np.int32)), batch.column("doc_id"), pa.array([s.shape[1] for s in sets], pa.int64()), pa.array(signatures, pa.binary()), pa.array(local, pa.int64()), *(pa.array(b) for b in parities(sets))],
            names=FIRST_NAMES,
        )
        if size > 2_000_000:
            yield from shared.pieces(frequent())
            held, size, seen = [], 0, {}
    if size:
        yield from shared.pieces(frequent())


class Order:
    """The global order: frequent shingles last, by frequency; within equal frequency by hash. A key is class << 56 | hash."""

    def __init__(self, frequent: np.ndarray, times: np.ndarray):
        order = np.argsort(frequent)
        self.frequent = frequent[order].astype(np.uint64)
        self.classes = np.clip(1 + np.log2(np.maximum(1, times[order])) * 8, 1, 127).astype(np.uint8)
        self.marked = np.zeros(1 << 16, bool)
        self.marked[(self.frequent >> np.uint64(40)).astype(np.int64)] = True

    def keys(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        """The sets as keys in this order."""
        flat = np.concatenate([short(s) for s in sets]) if sets else np.zeros(0, np.uint64)
        keys = flat.copy()
        if len(self.frequent):
            some = np.flatnonzero(self.marked[(flat >> np.uint64(40)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.frequent, flat[some]), len(self.frequent) - 1)
            hit = self.frequent[at] == flat[some]
            keys[some[hit]] |= self.classes[at[hit]].astype(np.uint64) << np.uint64(56)
        ends = np.cumsum([s.shape[1] for s in sets])
        return [np.sort(k) for k in np.split(keys, ends[:-1])] if sets else []


def least_overlap(n: int) -> int:
    """How many shingles a set of ``n`` shares at least with any set that links to it."""
    return -(-4 * n // 5)


def prefix_of(keys: np.ndarray) -> tuple[int, int]:
    """The number of matches that a set asks for, and the length of its prefix."""
    n = len(keys)
    base = n - least_overlap(n)
    classes = (keys[: base + MOST] >> np.uint64(56)).astype(np.float64)
    others = np.cumsum(np.where(classes > 0, np.exp2((classes - 1) / 8) - 1, 0.01))
    best = min(range(1, min(MOST, least_overlap(n)) + 1), key=lambda k: others[base + k - 1] * (1 + VERIFY_COST / k))
    return best, base + best


ROW = {"key": np.int64, "doc": np.int64, "n": np.int32, "pos": np.int32, "least": np.int32, "common": np.float64}
LEAD = {"lead": np.int64, "lead_n": np.int32, "lead_pos": np.int32}
PREFIX = "key long, doc long, n int, pos int, least int, common double, led boolean, deal long, lead long, lead_n int, lead_pos int"


def _with_leaders(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Prefix rows of a task's stretch: of each key the leader, with a note whether others follow it, and those others with their leader.

    Leaders of a key are dealt together, others anywhere.
    """
    order = np.lexsort((rows["doc"], -rows["common"], rows["key"]))
    rows = {k: x[order] for k, x in rows.items()}
    starts = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    sizes = np.diff(np.append(starts, len(order)))
    lead = np.repeat(starts, sizes)
    leads = lead == np.arange(len(order))
    columns = [pa.array(rows[c].astype(t)) for c, t in ROW.items()]
    columns += [pa.array(leads & np.repeat(sizes > 1, sizes)), pa.array(np.where(leads, 0, rows["doc"]))]
    columns += [pa.array(rows[c][lead].astype(t), mask=leads) for c, t in zip(("doc", "n", "pos"), LEAD.values(), strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*ROW, "led", "deal", *LEAD])


def _prefixes(order):
    def run(batches):
        held, size = [], 0
        for batch in shared.chunks(batches, limit=2 << 20):
            sets = shingles(batch.column("text"))
            seen = set()
            for doc, s, keys in zip(batch.column("doc_id").to_pylist(), sets, order.value.keys(sets), strict=True):
                if len(keys) < 2:
                    continue  # a set of one links to equal sets only, and those are one class
                content = s.tobytes()
                if content in seen:
                    continue
                seen.add(content)
                least, length = prefix_of(keys)
                held.append((keys[:length].astype(np.int64), doc, len(keys), np.arange(length), least, float((keys >> np.uint64(56) > 0).mean())))
                size += length
            if size >= HELD_PREFIXES:
                yield from shared.pieces(_with_leaders(_joined(held)))
                held, size = [], 0
        if held:
            yield from shared.pieces(_with_leaders(_joined(held)))
        shared.let_go(order)

    return run


def _joined(held: list[tuple]) -> dict[str, np.ndarray]:
    lengths = [len(x[0]) for x in held]
    return {c: np.concatenate([x[k] for x in held]) if c in ("key", "pos") else np.repeat(np.array([x[k] for x in held], t), lengths) for k, (c, t) in enumerate(ROW.items())}


MET = "key long, doc long, n int, pos int, least int, lead long, lead_n int, lead_pos int"
MET_NAMES = ["key", "doc", "n", "pos", "least", *LEAD]


def _met(batches):
    """Over rows sorted by key, leaders of a key by their rank: those whose key more than one row has, each with its leader."""
    state = None  # key, leader's row, whether the leader is still to be sent
    names = ("key", "doc", "n", "pos", "least", "led")
    for batch in batches:
        follows = batch.column("lead").is_valid()
        followers = batch.filter(follows)
        if followers.num_rows:
            yield followers.select(MET_NAMES)
        batch = batch.filter(pc.invert(follows))
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        again = False
        if state is not None and state[0] == rows[0][0]:
            rows = [np.concatenate([[x], y]) for x, y in zip(state[1], rows, strict=True)]
            again = not state[2]
        key, doc, n, pos, least, led = rows
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        lead = np.repeat(starts, sizes)
        keep = np.repeat(sizes > 1, sizes) | led
        if again:
            keep[0] = False
        last = starts[-1]
        state = (key[last], tuple(x[last] for x in rows), not keep[last] and not (again and last == 0))
        if keep.any():
            lead = lead[keep]
            values = [x[keep] for x in (key, doc, n, pos, least)] + [x[lead] for x in (doc, n, pos)]
            kinds = [ROW[c] for c in MET_NAMES[:5]] + list(LEAD.values())
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(values, kinds, strict=True)], names=MET_NAMES)


def _verify(batches):
    """Of pairs with their texts those whose sets link. A text that a batch holds many times, as a leader's, is cut into shingles once."""
    for batch in batches:
        texts = [pc.fill_null(batch.column(c), "") for c in ("text_a", "text_b")]
        coded = pa.concat_arrays(texts).dictionary_encode()
        sets, at = shingles(coded.dictionary), coded.indices.to_pylist()
        keep = []
        for i, j in zip(at[: batch.num_rows], at[batch.num_rows :], strict=True):
            both = overlap(sets[i], sets[j])
            keep.append(both > 0 and 100 * both >= 80 * (sets[i].shape[1] + sets[j].shape[1] - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    shared.trim()


def verified(docs: DataFrame, pairs: DataFrame, where: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets link, written at ``where``.

    Whole texts meet, not their shingles, which take 16 bytes for every word and can't be compressed. Texts are never broadcast.
    """
    needed = shared.stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{where}-needed")
    texts = shared.stored(docs.join(shared.small(needed), "doc_id", "left_semi").select("doc_id", "text"), f"{where}-texts", compression="zstd")
    with_b = pairs.join(texts.toDF("b", "text_b").hint("merge"), "b")
    both = with_b.join(texts.toDF("a", "text_a").hint("merge"), "a").select("a", "b", "text_a", "text_b")
    links = shared.stored(both.mapInArrow(_verify, "a long, b long"), where)
    shared.removed(docs.sparkSession, f"{where}-needed", f"{where}-texts")
    return links


def _may_link(n: str, m: str):
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m))


def _near_parities(columns: list[str]):
    """Whether two documents' parity bits leave room for a link: linked sets differ in (n + m) / 9 shingles at most."""
    apart = functools.reduce(operator.add, (F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in columns))
    return F.coalesce(9 * apart <= F.col("n_a") + F.col("n_b"), F.lit(True))


def _enough(n: str, m: str, i: str, j: str, before):
    """Whether sets of ``n`` and ``m``, with a shared shingle at places ``i`` and ``j``, can overlap enough."""
    most = before + 1 + F.least(F.col(n) - F.col(i) - 1, F.col(m) - F.col(j) - 1)
    return 9 * most >= 4 * (F.col(n) + F.col(m))


def _folded() -> list:
    """The parity of fewer, larger bins: those of each column are the sum of every fourth column's."""
    return [functools.reduce(lambda x, y: x.bitwiseXOR(y), (F.col(c) for c in PARITY[k :: len(FOLDED)])).alias(name) for k, name in enumerate(FOLDED)]


def _placed(rows: DataFrame) -> DataFrame:
    """Prefix rows (key, crowd, doc, pos, FOLDED) with the number of their document's rows before them, their rank among these by crowd, and its first keys by that rank, CROWDED.

    Ids with several sets, which have no parity bits, get no CROWDED keys.
    """
    by_crowd = Window.partitionBy("doc").orderBy(F.desc("crowd"), "key")
    whole = by_crowd.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    crowded = {c: F.when(F.col(FOLDED[0]).isNotNull(), F.nth_value("key", k + 1).over(whole)) for k, c in enumerate(CROWDED)}
    return rows.withColumns({"before": F.row_number().over(Window.partitionBy("doc").orderBy("pos")) - 1, "rank": F.row_number().over(by_crowd), **crowded}).drop("crowd")


def _apart(rows: DataFrame) -> DataFrame:
    """Pairs of placed rows that share a key, lie in different components and may link, as structs x and y, the smaller document first; with ``met``.

    A pair comes once for each key it shares, with ``met`` 1. If any of these is among the CROWDED keys of both, it comes from
    the most crowded one alone: all of its shared keys that rank before one in both lists are in both, so that this is the first
    equal one. How many it shares is then unknown, as is the first place: ``met`` is MOST, all that is ever asked for, the places 0.
    """
    left, right = (rows.withColumnsRenamed({c: f"{c}_{side}" for c in rows.columns if c != "key"}) for side in "ab")
    once = (F.col("label_b") == F.col("major_b")) | (F.col("doc_a") < F.col("doc_b"))
    again = functools.reduce(operator.or_, ((F.col(f"{c}_a") == F.col(f"{d}_b")) & (F.col("rank_a") > k + 1) for k, c in enumerate(CROWDED) for d in CROWDED))
    room = _enough("n_a", "n_b", "pos_a", "pos_b", F.least("before_a", "before_b"))
    apart = left.where("label_a <> major_a").join(right, "key").where(
        (F.col("label_a") != F.col("label_b")) & once & _may_link("n_a", "n_b") & room & _near_parities(FOLDED) & ~F.coalesce(again, F.lit(False))
    )
    alone = functools.reduce(operator.and_, (functools.reduce(operator.or_, (F.col(f"{c}_{side}") == F.col("key") for c in CROWDED)) for side in "ab"))
    ends = [F.struct(F.col(f"doc_{side}").alias("doc"), F.col(f"n_{side}").alias("n"), F.when(alone, 0).otherwise(F.col(f"pos_{side}")).alias("pos"), F.col(f"least_{side}").alias("least")) for side in "ab"]
    return apart.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y"), F.when(alone, MOST).otherwise(1).alias("met"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; the component is named by its smallest id.

    Null, empty and blank texts have no shingles and link with nothing. Rows that share an id are one node: they get one
    component, and a row each. A null id gives a null component. Equal texts, in any number, are one class and are not
    paired with each other. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    where = shared.shared_dir(spark)
    docs = shared.id_and_text(docs, id_col, text_col)
    first = shared.stored(docs.mapInArrow(_members_and_frequent, FIRST), f"{where}/first")
    members = first.where("kind = 0").select(F.col("id").alias("doc"), "n", "signature", "local", *PARITY)

    counted = first.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
    levels = counted.groupBy(F.floor(F.log2("n") * 4).alias("level")).count().orderBy(F.desc("level")).collect()  # at most 256 rows
    cut, room = 256, FREQUENT_MOST
    for level, n in levels:
        if n > room:
            break
        cut, room = level, room - n
    frequent = counted.where(F.floor(F.log2("n") * 4) >= cut).toArrow()  # at most FREQUENT_MOST rows
    order = spark.sparkContext.broadcast(Order(frequent.column("id").to_numpy(), frequent.column("n").to_numpy()))

    known = docs.where(F.col("doc_id").isNotNull())
    prefixes = known.mapInArrow(_prefixes(order), PREFIX).repartition("key", "deal").sortWithinPartitions("key", F.desc("common"), "doc")
    met = shared.stored(prefixes.mapInArrow(_met, MET), f"{where}/met")

    led = met.where((F.col("doc") != F.col("lead")) & _may_link("n", "lead_n"))
    led = led.groupBy("doc", "lead", "n", "lead_n").agg(F.min("pos").alias("pos"), F.min("lead_pos").alias("lead_pos"))
    led = led.where(_enough("n", "lead_n", "pos", "lead_pos", F.lit(0)))
    led = led.select(F.least("doc", "lead").alias("a"), F.greatest("doc", "lead").alias("b")).distinct()
    one = F.min("signature") == F.max("signature")  # an id with several sets has no parity bits, and all its pairs pass
    bits = shared.stored(members.where("n > 0 AND doc IS NOT NULL").groupBy("doc").agg(F.min("n").alias("n"), *(F.when(one, F.min(c)).alias(c) for c in PARITY)), f"{where}/bits")
    a, b = bits.withColumnsRenamed({"doc": "a", "n": "n_a", **{c: f"{c}_a" for c in PARITY}}), bits.withColumnsRenamed({"doc": "b", "n": "n_b", **{c: f"{c}_b" for c in PARITY}})
    led = shared.stored(led.join(a, "a").join(b, "b").where(_near_parities(PARITY)).select("a", "b"), f"{where}/led")
    links = verified(known, led, f"{where}/links")

    # classes of equal sets, and for each id the smallest document of its class: a class meets as one row for each task's stretch
    shingled = members.where("n > 0 AND doc IS NOT NULL")
    stretch = shared.stored(shingled.groupBy("local").agg(F.min("doc").alias("low"), F.min("signature").alias("signature"), F.min("n").alias("n")), f"{where}/stretch")
    whole = shared.stored(stretch.groupBy("signature", "n").agg(F.min("low").alias("rep")), f"{where}/whole")
    named = stretch.join(whole, ["signature", "n"]).select("local", "rep")
    classes = shared.stored(shingled.select("doc", "local").join(named, "local").select("doc", "rep"), f"{where}/classes")
    rep = shared.stored(classes.groupBy("doc").agg(F.min("rep").alias("rep")), f"{where}/rep")
    own = classes.join(rep.withColumnRenamed("rep", "least"), "doc").where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b"))

    def labelled(links: DataFrame, name: str) -> DataFrame:
        """doc, label: the component so far of every document with shingles."""
        a, b = rep.withColumnsRenamed({"doc": "a", "rep": "ra"}), rep.withColumnsRenamed({"doc": "b", "rep": "rb"})
        between = links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).unionByName(own)
        joined = components.connected(between, f"{where}/{name}")
        return rep.join(joined, F.col("rep") == F.col("node"), "left").select("doc", F.coalesce("component", "rep").alias("label"))

    labels = shared.stored(labelled(links, "round1"), f"{where}/labels1")
    # of each shingle's documents, those in the leader's component need only be compared with the others; a shingle whose
    # documents are all in one component is done with
    moved = shared.stored(labels.where("doc <> label"), f"{where}/moved")
    rows = met.select("key", "doc", "n", "pos", "least", "lead").join(shared.small(moved, 2), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("crowd"), F.max(F.when(F.col("doc") == F.col("lead"), F.col("label"))).alias("major"))
    keys = shared.stored(keys.where("low <> high").select("key", "major", "crowd"), f"{where}/keys")
    # shingles that two documents of different components share before a place lie in both prefixes and are among these rows
    rows = _placed(rows.drop("lead").join(shared.small(keys, 3), "key").join(bits.select("doc", *_folded()), "doc"))
    apart = _apart(rows)
    pairs = apart.groupBy(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).agg(
        F.sum("met").alias("met"), F.min("x.pos").alias("pos_a"), F.min("y.pos").alias("pos_b"), F.least(F.min("x.least"), F.min("y.least")).alias("least")
    )
    pairs = pairs.where((F.col("met") >= F.col("least")) & _enough("n_a", "n_b", "pos_a", "pos_b", F.lit(0)))
    pairs = shared.small(shared.stored(pairs.select("a", "b").distinct().join(led, ["a", "b"], "left_anti"), f"{where}/met-apart"), 2)
    pairs = shared.stored(pairs.join(a, "a").join(b, "b").where(_near_parities(PARITY)).select("a", "b"), f"{where}/apart")
    more = verified(known, pairs, f"{where}/more")
    labels = labelled(links.unionByName(more), "round2") if more.limit(1).count() else labels

    return members.join(labels, "doc", "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("label", "doc").alias("component_id"))


def keep_smallest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id names its component: one document of each group."""
    gone = near_duplicates(docs, id_col, text_col).where("component_id <> doc_id")
    return shared.without(docs, [F.col(id_col).cast("long")], gone.select("doc_id"))

import collections
import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from codexflow.llm import components, exact_dedup, shared, shingle_join
from tests.llm import cases


def test_exact_groups(spark):
    groups = collections.defaultdict(list)
    for i, t in cases.texts():
        groups[cases.ascii_lower(t)].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    got = [tuple(r) for r in exact_dedup.exact_dedup(cases.frame(spark)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("salts", [1, 2, 16])
def test_exact_groups_over_many_chunks(spark, salts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FLUSH_BYTES", 50)
    rows = [(k, ["Hot text", "hot TEXT", f"own {k}"][k % 3]) for k in range(300)]
    got = exact_dedup.exact_dedup(cases.frame(spark, rows).repartition(7), salts=salts).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3 < 2} == {(298, 200)} and all(r.kept and r.group_size == 1 for r in got if r.doc_id % 3 == 2)


def test_keep_winners_keeps_columns(spark):
    docs = cases.frame(spark, [(1, "A"), (2, "a"), (3, None), (4, ""), (5, "b")])
    kept = exact_dedup.keep_winners(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]
    assert exact_dedup.exact_dedup(cases.empty(spark)).count() == 0


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^ \t-\r]+", cases.ascii_lower(t))
        out.setdefault(i, []).append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute_components(rows):
    sets = sets_of([(i, t) for i, t in rows if i is not None])
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def compare(spark, rows):
    got = shingle_join.near_duplicates(cases.frame(spark, rows)).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want.get(i)) for i, _ in rows}
    sizes = sets_of(rows)
    assert all(r.n_shingles in {len(s) for s in sizes[r.doc_id]} for r in got)


def test_components_over_odd_rows(spark):
    compare(spark, cases.texts())


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"w{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_edited_copies(spark, seed):
    """Stars around a text that may itself be missing, chains, shared passages and unrelated texts, near the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(3000)]
    rows, next_id = [], 0
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([60, 120, 200]))]
        for k in range(rng.choice([2, 8, 30])):
            rows.append((next_id, " ".join(edited(rng, base, rng.randint(group % 2, max(1, len(base) // 40))))))
            next_id += 1
    chain = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(12):
        chain = edited(rng, chain, 2)
        rows.append((next_id, " ".join(chain)))
        next_id += 1
    for _ in range(40):
        rows.append((next_id, " ".join([rng.choice(vocabulary) for _ in range(rng.randint(5, 90))] + passage)))
        next_id += 1
    compare(spark, rows)


def test_components_with_two_texts_of_one_id(spark):
    base = [f"t{k}" for k in range(50)]
    other = [f"u{k}" for k in range(50)]
    compare(spark, [(1, " ".join(base)), (2, " ".join(base[1:])), (2, " ".join(other)), (3, " ".join(other[1:]))])


def test_no_links_and_no_rows(spark):
    compare(spark, [(1, "only one document of more than five words")])
    assert shingle_join.near_duplicates(cases.empty(spark)).count() == 0


def test_keep_smallest(spark):
    docs = cases.frame(spark)
    kept = shingle_join.keep_smallest(docs)
    want = brute_components(cases.texts())
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} | {None}


def test_words_of_unlike_shape_differ():
    """A word and its complement whose polynomial hashes agree modulo any power of two, at any base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    texts = [f"one two {word} four five", f"one two {other} four five"]
    x, y = shingle_join.shingles(pa.array(texts))
    assert shingle_join.overlap(x, y) == 0 and shingle_join.overlap(x, x) == 1


def test_word_digests_are_of_the_word_alone():
    rng = random.Random(7)
    words = [w for w in {"".join(rng.choice("ab\0é") for _ in range(rng.randint(1, 20))) for _ in range(3000)}]
    text = " ".join(words).encode()
    data = np.frombuffer(text, np.uint8)
    begins, ends = shared.words(data, np.array([0, len(data)]), ~shared.SPACE)
    high, low = shared.word_digests(data, begins, ends)
    assert len(set(high.tolist())) == len(set(low.tolist())) == len(words)
    alone = [shared.word_digests(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())])) for w in words]
    assert [(int(h[0]), int(v[0])) for h, v in alone] == list(zip(high.tolist(), low.tolist(), strict=True))


def test_sets_with_equal_halves():
    x = shingle_join.as_set(np.array([[3, 3, 1, 3], [5, 4, 9, 5]], np.uint64))
    assert x.tolist() == [[1, 3, 3], [9, 4, 5]]
    assert shingle_join.overlap(np.array([[3], [5]], np.uint64), x) == 1 and shingle_join.overlap(x, np.array([[3], [6]], np.uint64)) == 0


def test_prefixes_of_linked_sets_meet_often_enough():
    rng = np.random.default_rng(0)
    order = shingle_join.Order(np.arange(0, 4000, 7), np.arange(0, 4000, 7) + 2)

    def wide(values):
        return np.stack([values << np.uint64(8) | values % np.uint64(251), values])

    for _ in range(200):
        x = rng.choice(4000, int(rng.integers(2, 300)), replace=False).astype(np.uint64)
        y = np.unique(np.concatenate([rng.permutation(x)[: max(1, int(len(x) * rng.uniform(0.78, 1)))], rng.choice(4000, max(1, len(x) // 20)).astype(np.uint64)]))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        assert shingle_join.overlap(wide(x), wide(y)) == both
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        a, b = order.keys([wide(x), wide(y)])
        (ka, la), (kb, lb) = shingle_join.prefix_of(a), shingle_join.prefix_of(b)
        assert len(np.intersect1d(a[:la], b[:lb])) >= min(ka, kb)
        apart = sum(int(np.bitwise_count(c.view(np.uint64)[0] ^ c.view(np.uint64)[1])) for c in shingle_join.parities([wide(x), wide(y)]))
        assert apart <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("stretch", [1, 30, 1000])
def test_leaders_over_any_stretches_and_batches(stretch):
    """Every row of a key that several rows have comes out once, and leads from row to row end at one leader of the key."""
    rng = np.random.default_rng(4)
    key, common = rng.integers(0, 40, 300), rng.integers(0, 5, 300) / 4
    rows = {"key": key, "doc": np.arange(300), "n": np.full(300, 9), "pos": np.arange(300), "least": np.full(300, 1), "common": common}
    parts = pa.Table.from_batches([shingle_join._with_leaders({c: x[k : k + stretch] for c, x in rows.items()}) for k in range(0, 300, stretch)])
    dealt = parts.append_column("down", pc.negate(parts["common"])).sort_by([("key", "ascending"), ("down", "ascending"), ("doc", "ascending")]).drop_columns("down").combine_chunks()
    count = collections.Counter(key.tolist())
    for size in (1, 2, 3, 17, 300):
        batches = [dealt.slice(k, size).combine_chunks().to_batches()[0] for k in range(0, 300, size)]
        got = [r for b in shingle_join._met(iter(batches)) for r in b.to_pylist()]
        assert sorted(r["doc"] for r in got) == [i for i in range(300) if count[int(key[i])] > 1]
        lead = {r["doc"]: r["lead"] for r in got}
        for r in got:
            assert key[r["lead"]] == r["key"] and r["lead_pos"] == r["lead"]
            top = lead[r["lead"]]
            assert lead[top] == top and common[top] == max(common[key == r["key"]])


def test_components_of_many_equal_and_near_copies_over_small_stretches(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "HELD_PREFIXES", 40)
    rng = random.Random(11)
    base = [f"v{k}" for k in range(80)]
    rows = [(k, " ".join(base)) for k in range(30)] + [(100 + k, " ".join(edited(rng, base, 1))) for k in range(40)] + [(200 + k, " ".join(edited(rng, base, 20))) for k in range(10)]
    compare(spark, rows)


def test_connected(spark):
    edges = [(5, 4), (4, 3), (3, 2), (10, 11), (11, 12), (12, 10), (7, 7), (20, 21), (21, 20)] + [(100, 100 + k) for k in range(1, 30)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long"), shared.shared_dir(spark)).collect()}
    assert got == {5: 2, 4: 2, 3: 2, 11: 10, 12: 10, 21: 20, **{100 + k: 100 for k in range(1, 30)}}


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        names = [str(f) for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())]
        return {n for n in names if "shuffle_" in n}

    before, setting = files(), spark.conf.get(shared.CLEANUP_CONF, "false")
    rows = spark.range(1000).repartition(4, "id")
    table = shared.stored(rows, f"{shared.shared_dir(spark)}/rows")
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(shared.CLEANUP_CONF, "false") == setting
    assert table.count() == rows.count() == 1000


def test_unlinked_near_copies_meet_once_a_pair(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(200), rng.randint(2, 9)):
            words[k] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    met, apart = [], shingle_join._apart

    def counted(placed):
        pairs = apart(placed)
        met.extend((r.a, r.b) for r in pairs.select("x.doc", "y.doc").toDF("a", "b").collect())
        return pairs

    monkeypatch.setattr(shingle_join, "_apart", counted)
    compare(spark, rows)
    assert len(set(met)) > 50 and len(met) < 1.2 * len(set(met))


def test_the_pair_of_two_documents_comes_from_their_most_crowded_key(spark):
    keys = [(key, doc, pos, key % 5 + 2) for doc, first in ((1, 0), (2, 3), (3, 40)) for pos, key in enumerate(range(first, first + 20))]
    rows = spark.createDataFrame(keys, "key long, doc long, pos int, crowd long").selectExpr(
        "*", "100 AS n", "2 AS least", "doc AS label", "9L AS major", *(f"IF(doc = 3, NULL, 0L) AS {c}" for c in shingle_join.FOLDED)
    )
    got = [(r.x.doc, r.y.doc, r.met) for r in shingle_join._apart(shingle_join._placed(rows)).collect()]
    assert got == [(1, 2, shingle_join.MOST)]
    plain = rows.withColumns({c: shingle_join.F.lit(None).cast("long") for c in shingle_join.FOLDED})
    got = [(r.x.doc, r.y.doc, r.met) for r in shingle_join._apart(shingle_join._placed(plain)).collect()]
    assert got == [(1, 2, 1)] * 17

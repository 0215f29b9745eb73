import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from codexflow.llm import ppm_language, quality_ranking, shared, suffix_tree_lm, toxicity_ordinal
from tests.llm import cases

LOW = shared.LOWER


def brute_bits(text, sample, order):
    """PPM by method C, straight from the definition."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for s in sample:
        x = b" " * order + bytes(LOW[c] for c in s.encode())
        for i in range(order, len(x)):
            for k in range(order + 1):
                counts[k][x[i - k : i + 1]] += 1
    total, distinct = ([collections.Counter() for _ in range(order + 1)] for _ in range(2))
    for k in range(order + 1):
        for g, n in counts[k].items():
            total[k][g[:-1]] += n
            distinct[k][g[:-1]] += 1
    x, bits = b" " * order + bytes(LOW[c] for c in text.encode()), 0.0
    for i in range(order, len(x)):
        for k in range(order, -1, -1):
            g = x[i - k : i + 1]
            t, q = total[k][g[:-1]], distinct[k][g[:-1]]
            if counts[k][g]:
                bits += math.log2((t + q) / counts[k][g])
                break
            if t:
                bits += math.log2((t + q) / q)
        else:
            bits += 8
    return bits


def test_code_lengths_follow_the_definition():
    samples = {"a": ["hello world the", "abc Ab"], "b": ["hola mundo el", "xyz", "ñandú"]}
    trees = ppm_language.ContextTrees.of_texts(samples)
    texts = ["hello mundo", "zzz qq é", "", "abcabc", "ñ" * 30, "the " * 50]
    got = trees.code_lengths(pa.array([*texts, None]))
    want = [[brute_bits(t, samples[k], ppm_language.ORDER) for k in "ab"] for t in [*texts, ""]]
    assert np.allclose(got, want, atol=1e-3)


def test_code_lengths_do_not_depend_on_pieces(monkeypatch):
    trees = ppm_language.ContextTrees.of_texts({"a": ["some sample text of a few words"]})
    texts = pa.array(["some text", "of words " * 40, "other"])
    whole = trees.code_lengths(texts)
    monkeypatch.setattr(ppm_language, "PIECE", 7)
    assert np.allclose(whole, trees.code_lengths(texts))


def test_table_finds_all_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000))
    table = ppm_language.Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys + (1 << 41)) == -1).all()
    assert (ppm_language.Table(keys[:0]).find(keys) == -1).all()


def test_languages_of_odd_rows(spark):
    got = ppm_language.identify_with_training(cases.frame(spark)).collect()
    assert len(got) == len(cases.texts())
    by_text = {(i or -1, t) for i, t in cases.texts()}
    assert len(by_text) >= len({r.doc_id or -1 for r in got})
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (1, 2, 3, 15):
            assert r.lang_pred == "und" and r.score == 0
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    kept = ppm_language.keep_identified(cases.frame(spark))
    assert kept.columns == cases.frame(spark).columns and not {1, 2, 3, 15} & {r.doc_id for r in kept.collect()}
    assert ppm_language.identify_with_training(cases.empty(spark)).count() == 0


def test_without_languages_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in ppm_language.identify_with_training(docs).collect()] == ["und"]


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = ppm_language.identify_with_training(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


# --- language model ---------------------------------------------------------------------------------------------------


def base_of(rows):
    tokens = [(i, [*re.findall(r"[^ \t-\r]+", cases.ascii_lower(t)), "\0end"]) for i, t in rows]
    count = collections.Counter(w for i, ws in tokens if i is not None and zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(count.values()), len(count)
    return [(i, len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens]


@pytest.mark.parametrize("chunk", [200, 1 << 20])
def test_base_scores(spark, chunk, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", chunk)
    got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in suffix_tree_lm.score_texts(cases.frame(spark)).collect())
    assert got == sorted((i or -1, a, b, c, round(d, 6)) for i, a, b, c, d in base_of(cases.texts()))
    assert suffix_tree_lm.score_texts(cases.empty(spark)).count() == 0


def tree_of(texts, **kw):
    keys, counts = [], []
    for batch in suffix_tree_lm._count_grams([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]):
        keys.append(batch.column(0).to_numpy())
        counts.append(batch.column(1).to_numpy())
    key, n = suffix_tree_lm._summed(keys, counts)
    levels = []
    for depth in range(suffix_tree_lm.DEPTH + 1):
        k, c = suffix_tree_lm._summed([suffix_tree_lm.shortened(key, depth)], [n])
        context, of = np.unique(k >> 9, return_inverse=True)
        levels.append((context, np.bincount(of, c).astype(np.int64), np.bincount(of), k, c))
    return suffix_tree_lm.SuffixTree(levels, int(n.sum()), **kw), int(n.sum())


def test_probabilities_sum_to_one_in_every_context():
    rng = random.Random(2)
    tree, n = tree_of([" ".join(rng.choice(cases.WORDS) for _ in range(50)) for _ in range(60)])
    symbols, _, scored = suffix_tree_lm.symbols_of(pa.array(["the river zzz stone", "Q\0é", ""]))
    for context in suffix_tree_lm.keys_of(symbols)[scored] >> 9:
        each = 10 ** tree.logs((np.full(257, context) << 9) | np.arange(257))
        assert abs(each.sum() - 1) < 1e-5


def test_positions_count_every_byte_and_end():
    texts = ["abc", "", "é", None]
    _, n = tree_of(texts)
    assert n == sum(len((t or "").encode()) + 1 for t in texts)


def test_longer_contexts_help_and_pruning_keeps_suffixes():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(cases.WORDS) for _ in range(80)) for _ in range(80)]
    whole, _ = tree_of(texts)
    pruned, _ = tree_of(texts, penalty=1e9)
    probe = pa.array([" ".join(rng.choice(cases.WORDS) for _ in range(80))])
    assert len(pruned.contexts[1][1]) == 0 and whole.score(probe)[0] > pruned.score(probe)[0] + 50
    for depth in range(2, len(whole.contexts)):
        longer = whole.contexts[depth][0].slots
        longer = longer[longer >= 0]
        assert (whole.contexts[depth - 1][0].find(longer & ((1 << (8 * (depth - 1))) - 1)) >= 0).all()


def test_contexts_of_few_occurrences_count_in_a_large_corpus(spark):
    rng = random.Random(8)
    page = " ".join(rng.choice(cases.WORDS) for _ in range(180_000))
    trained = [k for k in range(1, 60) if zlib.crc32(str(k).encode()) % 10]
    rows = [(k, page) for k in trained[:16]] + [(k, "zqxjkvb") for k in trained[16:21]]
    got = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert len(page) * 16 * 5e-7 > 5 and got[trained[16]] > -8


def test_buckets_give_the_scores_of_one_tree(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "BUCKET_GRAMS", 20)
    monkeypatch.setattr(suffix_tree_lm, "SALT_CHUNKS", 1)
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(cases.WORDS) for _ in range(40))) for k in range(80)] + [(None, "the river zzz stone")]
    grams, total = collections.Counter(), 0
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            symbols, _, scored = suffix_tree_lm.symbols_of(pa.array([t]))
            grams.update(suffix_tree_lm.keys_of(symbols)[scored].tolist())
    key, n = np.array(list(grams)), np.array(list(grams.values()))
    tree = suffix_tree_lm.SuffixTree([suffix_tree_lm.level_of(key, n, d) for d in range(suffix_tree_lm.DEPTH + 1)], int(n.sum()))
    got = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert np.allclose([got[i] for i, _ in rows], tree.score(pa.array([t for _, t in rows])), atol=1e-3)


def brute_scores(rows, penalty=0.1):
    """The suffix tree straight from its definition: dictionaries of contexts, one symbol at a time."""
    depth_most, end = suffix_tree_lm.DEPTH, 256

    def symbols(text):
        return [0x20] * depth_most + [LOW[c] for c in (text or "").encode()] + [end]

    count, positions = collections.defaultdict(collections.Counter), 0
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            x = symbols(t)
            for at in range(depth_most, len(x)):
                positions += 1
                for d in range(depth_most + 1):
                    count[tuple(x[at - d : at])][x[at]] += 1
    candidates = {c: n for c, n in count.items() if sum(n.values()) >= suffix_tree_lm.LEAST_CONTEXT}
    kept = {c: {s: k for s, k in n.items() if k >= suffix_tree_lm.LEAST_SYMBOL} for c, n in candidates.items()}

    def spare(c):
        return len(candidates[c]) + sum(candidates[c].values()) - sum(kept[c].values())

    def p(c, s, tree):
        """Of symbol s in the longest suffix of c within ``tree``."""
        while c and c not in tree:
            c = c[1:]
        if c not in tree:
            return 1 / 257
        own, rest = kept[c].get(s), spare(c)
        whole = sum(kept[c].values()) + rest
        above = p(c[1:], s, candidates) if c else 1 / 257
        # a kept symbol's share is smoothed towards the candidate parent's; any other falls back to the retained parent's
        return (own + rest * above) / whole if own else rest / whole * (p(c[1:], s, tree) if c else 1 / 257)

    charge, tree = penalty * math.log(max(2, positions)), set()
    for c in sorted(candidates, key=len, reverse=True):
        total = sum(candidates[c].values())
        gain = sum(k * math.log(k / total / (p(c[1:], s, candidates) if c else 1 / 257)) for s, k in kept[c].items())
        if c in tree or not c or gain >= charge * max(1, len(candidates[c]) - 1):
            tree |= {c[d:] for d in range(len(c) + 1)}
    out = []
    for i, t in rows:
        x = symbols(t)
        out.append((i, sum(math.log10(p(tuple(x[at - depth_most : at]), x[at], tree)) for at in range(depth_most, len(x)))))
    return out


def test_scores_follow_the_definition(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "BUCKET_GRAMS", 200)
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", 3000)
    rng = random.Random(12)
    rows = [(k, " ".join(rng.choice(cases.WORDS) for _ in range(rng.randint(0, 40)))) for k in range(70)] + [(None, "Öl the RIVER\nzzz"), (500, None), (501, "")]
    want = brute_scores(rows)
    got = {(r.doc_id, r.n_tokens): r.score for r in suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for (i, t), (_, score) in zip(rows, want, strict=True):
        assert abs(got[(i, len((t or "").split()) + 1)] - score) < 1e-3 + 1e-5 * abs(score)


def test_held_out_scores_beat_the_base(spark):
    got = suffix_tree_lm.score_texts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


# --- classifiers ------------------------------------------------------------------------------------------------------


def test_quality_of_odd_rows(spark):
    got = quality_ranking.score_quality(cases.frame(spark), cases.labels(spark)).collect()
    assert len(got) == len(cases.texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = cases.labels(spark, [])
    assert {r.predicted for r in quality_ranking.score_quality(cases.frame(spark), none).collect()} == {0}
    assert quality_ranking.score_quality(cases.empty(spark), none).count() == 0


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_ranking.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.98


def test_ranking_prefers_the_better_of_pairs():
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 800)
    rows = rng.normal(size=(800, 5))
    rows[:, 2] += 1.5 * label
    ranking = quality_ranking.Ranking(rows, label)
    strength = ranking.strength(rows)
    pairs = (strength[label == 1][:, None] > strength[label == 0][None, :]).mean()
    assert pairs > 0.8 and ((ranking.score(strength) >= 0.7) == (strength >= ranking.at)).all()
    ranking.placed(np.arange(-5, 5), np.full(10, 7))
    assert ranking.at == quality_ranking.STEP * (int(10 * ranking.share) - 5)


def test_the_ranking_minimises_the_loss_of_differences():
    """Against plain gradient descent over the same pairs, drawn here by the same rule."""
    rng = np.random.default_rng(2)
    label = rng.integers(0, 2, 120)
    rows = rng.normal(size=(120, 3)) + label[:, None] * [0.4, 0, -0.3]
    ranking = quality_ranking.Ranking(rows, label, pairs=300, seed=5)
    wide = (ranking._expanded(rows) - ranking.mean) / ranking.scale
    rng = np.random.default_rng(5)
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    left = np.resize(rng.permutation(better), 300)
    right = rng.permutation(np.resize(rng.permutation(worse), 300))
    apart = wide[left] - wide[right]

    def loss(w):
        return np.logaddexp(0, -apart @ w).mean() + 1e-3 / 2 * w @ w

    w = np.zeros(wide.shape[1])
    for _ in range(4000):
        w -= 0.2 * (-(apart * (1 / (1 + np.exp(apart @ w)))[:, None]).mean(0) + 1e-3 * w)
    assert loss(ranking.weights) <= loss(w) + 1e-6
    for k in range(len(w)):
        step = np.zeros(len(w))
        step[k] = 1e-3
        assert loss(ranking.weights) < loss(ranking.weights + step) and loss(ranking.weights) < loss(ranking.weights - step)


def test_features_do_not_depend_on_neighbours():
    texts = [t for _, t in cases.texts()]
    whole = quality_ranking.features(pa.array(texts))
    alone = np.concatenate([quality_ranking.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, alone) and np.isfinite(whole).all()


def test_toxicity_of_odd_rows(spark):
    got = toxicity_ordinal.score_toxicity(cases.frame(spark), cases.labels(spark)).collect()
    assert len(got) == len(cases.texts())
    assert all(0 <= r.expected_severity <= 3 and 0 <= r.grade <= 3 and r.toxic == (r.p_toxic >= 0.35) for r in got)
    assert not any(r.toxic for r in toxicity_ordinal.score_toxicity(cases.frame(spark), cases.labels(spark, [])).collect())
    assert toxicity_ordinal.score_toxicity(cases.empty(spark), cases.labels(spark)).count() == 0


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity_ordinal.score_toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "is_toxic"), "doc_id").where("held_out").collect()
    caught, wrong = [r.toxic for r in got if r.is_toxic == 1], [r.toxic for r in got if r.is_toxic == 0]
    assert sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.01


def test_the_fit_minimises_the_penalised_likelihood():
    """Likelihood and gradient, written out one row at a time, against the fitted weights and thresholds."""
    rng = np.random.default_rng(3)
    n, width = 300, 12
    held = [np.flatnonzero(rng.random(width) < 0.3) for _ in range(n)]
    true = rng.normal(size=width) * 1.5
    grades = np.clip(np.array([sum(rng.logistic() + true[h].sum() > t for t in (0.5, 1.5, 3.0)) for h in held]), 0, 3)
    bounds, features = np.concatenate([[0], np.cumsum([len(h) for h in held])]), np.concatenate(held)
    model = toxicity_ordinal.Ordinal(bounds, features, grades, ridge=0.5, steps=6000, rate=0.005, chi_square=-1.0)

    def loss(w, thresholds):
        total = 0.25 * sum(x * x for x in w)
        for h, g in zip(held, grades.tolist(), strict=True):
            z = sum(w[j] for j in h)
            upto = [0.0, *(1 / (1 + math.exp(z - t)) for t in thresholds), 1.0]
            total -= math.log(upto[g + 1] - upto[g])
        return total

    w, t = model.weights[:width], model.thresholds
    at, e = loss(w, t), 1e-4
    slopes = [(loss(w + e * np.eye(width)[k], t) - loss(w - e * np.eye(width)[k], t)) / (2 * e) for k in range(width)]
    slopes += [(loss(w, t + e * np.eye(3)[k]) - loss(w, t - e * np.eye(3)[k])) / (2 * e) for k in range(3)]
    start = loss(np.zeros(width), t)
    assert at < start - 20 and max(map(abs, slopes)) < 0.05
    above = model.above(bounds, features)
    z = np.array([w[h].sum() for h in held])
    assert np.allclose(above, 1 / (1 + np.exp(t[None, :] - z[:, None])))


def test_thresholds_ascend_and_severity_follows_the_words():
    rng = random.Random(6)
    texts, toxic = [], []
    for k in range(600):
        bad = k % 3 == 0
        texts.append(" ".join([rng.choice(cases.WORDS[:-4]) for _ in range(30)] + ["scum", "vermin", "filthy"][: rng.randint(1, 3)] * bad))
        toxic.append(int(bad))
    bounds, features = toxicity_ordinal.sparse(pa.array(texts))
    grades = toxicity_ordinal.grades_of(bounds, features, np.array(toxic))
    model = toxicity_ordinal.Ordinal(bounds, features, grades)
    assert (np.diff(model.thresholds) > 0).all()
    b, f = toxicity_ordinal.sparse(pa.array(["the river", "the river scum", "the river scum vermin filthy"]))
    above = model.above(b, f)
    severity = above.sum(1)
    assert severity[0] < 0.2 < severity[1] < severity[2] and (np.diff(above, axis=1) <= 1e-12).all()

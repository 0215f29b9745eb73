import hashlib
import random
import re

import numpy as np
import pytest

from codexflow.llm import fm_decontam
from tests.llm import cases

ITEMS = [("b", "the of and river stone cloud winter garden letter seven open road"), ("a", "Quiet, MORNING window"), ("c", None), ("d", ""), ("e", "..."), (None, "the of"), ("f", "one"), ("a", "日本語 テキスト"), ("10", "one")]


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.ascii_lower(text).encode())


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        if w:
            size = min(window, len(w))
            for k in range(len(w) - size + 1):
                windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for i, text in rows:
        w = words_of(text)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if names := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= names - {None}
        out.append((-1 if i is None else i, len(w), len(hit), sorted(found)))
    return sorted(out)


def planted():
    rng = random.Random(9)
    rows = cases.texts()
    for k in range(30):
        own = [rng.choice(["alpha", "beta", "the", "of", "and", "river"]) for _ in range(rng.randint(0, 30))]
        rows.append((500 + k, " ".join(own + ITEMS[0][1].upper().split()[: rng.randint(8, 12)] + own)))
    rows.append((600, "Quiet morning--window! quiet morning window quiet\nmorning\twindow"))
    return rows


def found(spark, rows, items):
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    return fm_decontam.find_contamination(cases.frame(spark, rows), benchmark)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_hits_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(fm_decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(fm_decontam, "SHARD_BYTES", 400)
    if block == 1:
        items = ITEMS[:2]
        monkeypatch.setattr(fm_decontam, "BLOCK_BYTES", 40)
    else:
        items = ITEMS
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"])) for r in found(spark, planted(), items).collect())
    assert got == brute(planted(), items)


def test_spans_are_merged_and_cut(spark):
    row = found(spark, [(1, "x QUIET morning, window! y quiet morning window quiet morning window z")], ITEMS).first()
    assert [(s.begin, s.end) for s in row.spans] == [(1, 4), (5, 11)]
    assert fm_decontam.cut_spans("x QUIET morning, window! y", [(1, 4)]) == "x ! y"


def test_empty_sides(spark):
    assert found(spark, [], ITEMS).count() == 0
    assert {r.n_hit for r in found(spark, cases.texts(), []).collect()} == {0}
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = cases.frame(spark, planted())
    kept = fm_decontam.remove_contamination(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i for i, _, n, _ in brute(planted(), ITEMS) if n == 0)


def test_index_finds_and_locates_all_runs():
    rng = np.random.default_rng(3)
    for sigma, n in ((1, 30), (3, 200), (9, 500), (40, 500)):
        symbols = rng.integers(0, sigma + 1, n)
        symbols[0] = symbols[-1] = 0
        index = fm_decontam.FMIndex(symbols, sigma, sample=4)
        for size in (1, 2, 3):
            patterns = rng.integers(1, sigma + 1, (20, size))
            which, low, high = index.search(patterns)
            got = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high, strict=True)}
            for k, p in enumerate(patterns):
                want = [i for i in range(n - size + 1) if (symbols[i : i + size] == p).all()]
                assert got.get(k, []) == want


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(5)
    symbols = np.concatenate([[0], rng.integers(1, 3, 60), [0], rng.integers(1, 3, 60), [0]])
    zeros = np.cumsum(symbols == 0) - 1
    own = [(int(z),) if s == 0 else (1000 + int(s),) for s, z in zip(symbols, zeros, strict=True)]
    assert fm_decontam.suffix_array(symbols).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


def test_digest():
    assert fm_decontam.digest([]) == hashlib.sha256(b"").hexdigest() and fm_decontam.digest(["b", "a"]) == hashlib.sha256(b"a,b").hexdigest()

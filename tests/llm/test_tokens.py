import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from codexflow.llm import sentencepiece_bpe, shared, token_counts, token_planes
from tests.llm import cases

BPE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcdehinorst ABTE   \n\n\t.,;:0123'<>/s▁éßñÓ×÷…中日本가\x00\x01\x85  　 😀क्ष\x1c"


def odd_texts(n=3000, seed=5):
    rng = random.Random(seed)
    fixed = ["", "a", " ", "  ", "\n", "<|endoftext|>", "a <|endoftext|> b  ", "it's we'll  'twas", "ó.\nB", "ó \nB", "×.a", "a.\n\nB", "x" * 500, "ab" * 300, "  " * 40 + "x", "</s> <0x0A>", "▁▁a▁b", "a\x00b", "." * 70]
    return fixed + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_texts_encode_whole():
    texts = odd_texts(500)
    texts += texts[:9]
    ids, counts = token_planes.encoder(BPE)(pa.array([*texts, None]))
    own = np.split(ids, np.cumsum(counts)[:-1])
    want = Tokenizer.from_file(BPE).encode_batch([*texts, ""], add_special_tokens=False)
    assert [x.tolist() for x in own] == [x.ids for x in want]


def test_borders_are_those_of_the_pre_tokenizer():
    rng = random.Random(3)
    odd = ["".join(rng.choice("'''sstmdrevl  \n\t.1aA\u00a0\u3000é×中٣Ⅷ\u0301\x85\u200b😀") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts = [*odd_texts(500), *odd, "it'", "save", "''s", "a's's", "we'", "'ll", " 'save", "x'saved", "a  ", "  b", ""]
    data, offsets = shared.flat(pa.array(texts))
    want = set()
    for text, at in zip(texts, offsets.tolist(), strict=False):
        for _, (begin, _) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text):
            want |= {at + len(text[:begin].encode())} if begin else set()
    assert token_planes.borders(data, offsets).tolist() == sorted(want)


def test_the_library_cuts_only_texts_with_ids_across_a_border(monkeypatch):
    class Counted:
        def __init__(self, own):
            self.own = own

        def __getattr__(self, name):
            return getattr(self.own, name)

        def __setattr__(self, name, value):
            object.__setattr__(self, name, value) if name == "own" else setattr(self.own, name, value)

        def encode_batch_fast(self, texts, **options):
            got.extend([(json.loads(self.own.to_str())["pre_tokenizer"]["use_regex"], x) for x in texts])
            return self.own.encode_batch_fast(texts, **options)

    class Library:
        from_file = staticmethod(lambda path: Counted(Tokenizer.from_file(path)))

    got = []
    monkeypatch.setattr("tokenizers.Tokenizer", Library)
    texts = ["The mill stands by the river, and it's cold.", "he said 'save  me'", "a <|endoftext|> b"]
    ids, counts = token_planes.encoder(BPE)(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [Tokenizer.from_file(BPE).encode(x, add_special_tokens=False).ids for x in texts]
    assert sorted(x for cut, x in got if cut) == sorted(texts[1:]) and sorted(x for cut, x in got if not cut) == sorted(texts[:2])
    # where most texts have such ids, later ones are cut at once
    monkeypatch.setattr(token_planes, "FEW", 10)
    encode = token_planes.encoder(BPE)
    assert encode(pa.array(texts[1:2]))[0].tolist() == encode(pa.array(texts[1:2]))[0].tolist()
    assert sum(not cut for cut, _ in got[-3:]) == 1


def test_borders_are_looked_for_only_where_an_id_may_have_one(monkeypatch):
    rng = random.Random(8)
    odd = ["".join(rng.choice(["'s", "'save", "'re", "'l", "'", " ", "  ", "\n\n", "\t", "the", " mill", "1", ".", "é", " é", "中", "\u00a0", "\u3000", "😀", "ave", "e"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts = ["The mill stands by the río, and it's cold.", "a b's mill", "x'saved", "we'really", "", "the mill\n\nthe", *odd]
    encode, looked, borders = token_planes.encoder(BPE), [], token_planes.borders
    monkeypatch.setattr(token_planes, "borders", lambda data, offsets: looked.append(data.tobytes().decode()) or borders(data, offsets))
    plain = "The mill stands by the río, él dice\nthat 1,200 wheels (of it) turn.\nÉl."
    assert encode(pa.array([plain]))[0].tolist() == Tokenizer.from_file(BPE).encode(plain, add_special_tokens=False).ids
    assert not any(looked)
    ids, counts = encode(pa.array([plain, *texts, plain + " "]))
    want = Tokenizer.from_file(BPE).encode_batch([plain, *texts, plain + " "], add_special_tokens=False)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [x.ids for x in want]
    assert plain not in looked[-1] and "x'saved" in looked[-1]


def test_no_border_is_inside_an_id_that_counts_as_without():
    added, size, loose = token_planes.vocabulary_of(BPE, 0)
    tokenizer, cutter = Tokenizer.from_file(BPE), pre_tokenizers.ByteLevel(add_prefix_space=False)
    assert added == ["<|endoftext|>"] and 0 < loose.sum() < 1000
    for k in random.Random(4).sample(np.flatnonzero(~loose).tolist(), 4000):
        token = tokenizer.decode([k], skip_special_tokens=False)
        if "\ufffd" in token or size[k] != len(token.encode()):
            continue
        for before, behind in (("", ""), ("a", "a"), (" ", " "), ("1", "1"), ("\n", "\n"), (".", "."), ("a ", "\u00a0a")):
            for _, (begin, _) in cutter.pre_tokenize_str(before + token + behind):
                assert not len(before) < begin < len(before + token), (before, token, behind)


def test_plain_words_of_the_vocabulary_are_not_looked_at(monkeypatch):
    looked, borders = [], token_planes.borders
    monkeypatch.setattr(token_planes, "borders", lambda data, offsets: looked.extend(data[b:e].tobytes().decode() for b, e in zip(offsets[:-1], offsets[1:], strict=True)) or borders(data, offsets))
    token_planes.vocabulary_of.__wrapped__(BPE, 0)
    assert looked and not [x for x in looked if re.fullmatch(" ?[A-Za-z]+", x[:-1]) and len(x) > 2]
    assert not {"\n\na", " !a", "00a"} - set(looked)


def test_ids_have_to_be_those_of_their_own_text(monkeypatch):
    class Shifted:
        def encode_batch_fast(self, texts, **options):
            ids = [own.encode(x, add_special_tokens=False).ids for x in texts]
            return [type("Encoding", (), {"ids": x}) for x in (ids[0][:-1], ids[0][-1:] + ids[1], *ids[2:])]

    own = Tokenizer.from_file(BPE)
    monkeypatch.setattr(token_planes, "loaded", lambda *_: Shifted())
    with pytest.raises(ValueError, match="do not have its bytes"):
        token_planes.encoder(BPE)(pa.array(["the mill", " stands", " by"]))


@pytest.mark.parametrize("n", [1, 8, 1001])
def test_planes_are_the_bits_of_ids(n):
    ids = np.random.default_rng(n).integers(0, 60_000, n).astype(np.uint32)
    box = token_planes.Container(token_planes.packed([5], [n], ids, 1))
    unpack = token_planes.zstandard.ZstdDecompressor().decompress
    for k in range(box.planes):
        assert unpack(box.body[box.base + box.index[k] : box.base + box.index[k + 1]]) == np.packbits(ids >> k & 1 > 0, bitorder="little").tobytes()
    square = np.random.default_rng(n).integers(0, 1 << 63, 9).astype("<u8")
    bits = np.unpackbits(square.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 8, 8)
    assert np.packbits(bits.transpose(0, 2, 1).reshape(-1, 64), axis=1, bitorder="little").ravel().tobytes() == token_planes.turned(square).tobytes()


@pytest.mark.parametrize("kind", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_containers_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 60_000, n).astype(np.uint32)
    box = token_planes.Container(token_planes.packed([5, None, -3], [n // 2, 0, n - n // 2], ids, kind, block=64))
    assert box.ids().tolist() == ids.tolist() and box.doc_ids == [5, None, -3] and box.sizes.sum() == n
    if n > 64:
        assert box.ids_of(1).tolist() == ids[64:128].tolist()


def test_a_foreign_file_is_refused():
    with pytest.raises(ValueError):
        token_planes.Container(b"XXXX" + bytes(60))


@pytest.mark.parametrize("kind", [1, 8])
def test_planes_hold_every_document_in_order(spark, kind, monkeypatch):
    monkeypatch.setattr(token_planes, "CONTAINER", 2000)
    monkeypatch.setattr(token_planes, "GROUP", 2)
    monkeypatch.setattr(shared.partitions_for, "__defaults__", (30_000,))
    path = shared.shared_dir(spark) + "/planes"
    token_planes.write(cases.frame(spark), BPE, path, kind=kind)
    got = token_planes.read_documents(spark, path, with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(BPE)
    rows = sorted(cases.texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    want = sorted((i if i is not None else -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want


def test_where_ids_begin_is_found_without_the_bodies(spark):
    path = shared.shared_dir(spark) + "/planes"
    token_planes.write(cases.frame(spark), BPE, path)
    got = token_planes.read_documents(spark, path)
    scans = re.findall(r"ReadSchema: (struct<.*>)", got._jdf.queryExecution().executedPlan().toString())
    assert len(scans) > 1 and sum("body" in x for x in scans) == 1
    files = spark.read.schema(token_planes.FILES).parquet(path)
    assert [r.n for r in files.collect()] == [token_planes.Container(bytes(r.body)).n for r in files.collect()]
    wrong = shared.shared_dir(spark) + "/planes"
    files.withColumn("n", files.n + 1).write.parquet(wrong)
    with pytest.raises(Exception, match="ids, not"):
        token_planes.read_documents(spark, wrong).collect()


def test_planes_of_an_empty_table(spark):
    path = shared.shared_dir(spark) + "/planes"
    token_planes.write(cases.empty(spark), BPE, path)
    assert token_planes.read_documents(spark, path).count() == 0


def test_agenda_equals_the_library():
    texts = odd_texts()
    ids, bounds = sentencepiece_bpe.Encoder(PIECE)(pa.array(texts))
    own = [ids[b:e].tolist() for b, e in zip(bounds[:-1], bounds[1:], strict=True)]
    assert own == sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(texts)


def test_lockstep_and_heap_agree():
    agenda = sentencepiece_bpe.Agenda(PIECE)
    rng = random.Random(1)
    words = [" " + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    ids, sizes = agenda.words(pa.array([w.encode() for w in words], pa.large_binary()))
    own = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in own] == [agenda.fallen_back(np.array(agenda.with_heap(w.replace(" ", "▁"))))[0].tolist() for w in words]


def test_lockstep_and_heap_agree_on_pieces_of_equal_score():
    agenda = sentencepiece_bpe.Agenda(PIECE)
    agenda.rank = agenda.rank // 500
    agenda.code = np.append(agenda.rank << sentencepiece_bpe.CODE | agenda.merged, sentencepiece_bpe.NONE)
    agenda.ties = True
    rng = random.Random(2)
    words = [" " + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    ids, sizes = agenda.words(pa.array([w.encode() for w in words], pa.large_binary()))
    own = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in own] == [agenda.with_heap(w.replace(" ", "▁")) for w in words]


def test_a_word_of_three_megabytes_of_texts_is_merged_once(monkeypatch):
    class Frame:
        def mapInArrow(self, function, schema):
            return function

    merged, words = [], sentencepiece_bpe.Agenda.words
    monkeypatch.setattr(shared, "id_and_text", lambda *_: Frame())
    monkeypatch.setattr(sentencepiece_bpe.Agenda, "words", lambda self, some: merged.extend(some.to_pylist()) or words(self, some))
    rows = [pa.RecordBatch.from_pydict({"doc_id": pa.array([k]), "text": [f"the mill number {k} " * 20_000]}) for k in range(9)]
    got = pa.Table.from_batches(sentencepiece_bpe.encode_and_decode(Frame(), PIECE)(iter(rows)))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert got.column("n_tokens").to_pylist() == [len(library.encode(x.column("text")[0].as_py())) for x in rows]
    assert len(merged) == len(set(merged))


def test_sentencepiece_over_odd_rows(spark):
    got = sentencepiece_bpe.encode_and_decode(cases.frame(spark), PIECE).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for i, t in cases.texts():
        ids = library.encode(t or "")
        want.append((i or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((library.decode(ids) if ids else "").encode()).hexdigest()))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert sentencepiece_bpe.encode_and_decode(cases.empty(spark), PIECE, keep="ids").count() == 0


def test_counts_and_cache(spark):
    cache = shared.shared_dir(spark) + "/counts"
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = sorted((i or -1, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 100) for i, t in cases.texts())

    def counted():
        return sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(cases.frame(spark), PIECE, cache, limit=100).collect())

    assert counted() == want
    first = spark.read.parquet(cache).count()
    assert first == len({t or "" for _, t in cases.texts()})  # a text is encoded once
    assert counted() == want and spark.read.parquet(cache).count() == first  # and not again from the cache
    # another tokenizer has its own counts in the same cache
    other = token_counts.count_tokens(cases.frame(spark), BPE, cache).where("doc_id = 9").first()
    assert other.n_tokens == len(Tokenizer.from_file(BPE).encode(dict(cases.texts())[9], add_special_tokens=False).ids)
    assert token_counts.count_tokens(cases.empty(spark), PIECE).count() == 0

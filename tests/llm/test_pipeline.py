import hashlib

import duckdb
import public_tokenizers
import sentencepiece

import corpus_pipeline
from codexflow.llm import exact_dedup, fm_decontam, ppm_language
from codexflow.llm import queries as llm_queries
from tests.llm.test_dedup import brute_components
from tests.llm.test_decontamination import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT CAST(item_id AS VARCHAR), text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    best = {}
    for i, t in rows:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        best[key] = max(best.get(key, (-1, ""))[0], i), t
    winners = {i for i, _ in best.values()}
    rows = [(i, t) for i, t in rows if i in winners]
    component = brute_components(rows)
    rows = [(i, t) for i, t in rows if component[i] == i]
    clean = {i for i, _, n, _ in brute(rows, items) if n == 0}
    rows = [(i, t) for i, t in rows if i in clean]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(i, len(ids := library.encode(t)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()) for i, t in rows]
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_rows_are_judged_each_not_by_id(spark):
    rows = [(None, "no id here"), (None, None), (None, "one two three four five six seven eight nine ten"), (7, "Some text"), (7, "..."), (8, "some TEXT"), (7, "other words")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    items = spark.createDataFrame([("i", "One two three four five six seven eight nine ten")], "item_id string, text string")

    def left(kept):
        return sorted((r.doc_id or -1, r.text or "") for r in kept.collect())

    def want(*gone):
        return sorted((i or -1, t or "") for k, (i, t) in enumerate(rows) if k not in gone)

    assert left(ppm_language.keep_identified(docs)) == want(1, 4)
    assert left(exact_dedup.keep_winners(docs)) == want(3)
    assert left(fm_decontam.remove_contamination(docs, items)) == want(2)


def test_every_operator_has_a_query():
    names = llm_queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and set(llm_queries.oracle_sql()) <= set(names)


def test_sql_twins(spark):
    for table in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name, sql in llm_queries.oracle_sql().items():
        got = llm_queries.queries()[name](spark, SF)
        want = duckdb.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())

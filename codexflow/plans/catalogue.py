"""All registered queries of the corpus engine over the test tables, each with its DuckDB twin where SQL can express it.

There are no PDFs among the tables. A document with pages is a ``source`` of ``documents`` (a page is a row) or a
conversation (a page is a turn); a file is a row whose text length stands for its size; harvested metadata stand in for
each other by the columns named in the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexflow.functions import rights as R
from codexflow.functions import signatures as S
from codexflow.functions import text as T
from codexflow.functions.partitions import spread
from codexflow.operators import audits, bindings, harvest, near_duplicates, profiling, retrieval, segmentation, structure
from codexflow.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents whose turns are pages."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.col("turn").cast("int").alias("page"), "text")


FOLD = "replace(lower(text), 'ß', 'ss')"
NORM = f"trim(regexp_replace({FOLD}, '\\s+', ' ', 'g'))"
BINS = [1, 2, 5, 10, 20, 50]  # bounds in thousands of characters, as text lengths stand for file sizes
BIN_SQL = "CASE " + " ".join(f"WHEN n_chars < {b * 1000} THEN '<{b} k'" for b in BINS) + f" ELSE '>={BINS[-1]} k' END"


def bin_of(column: str = "n_chars"):
    return profiling.bin_label(F.col(column), BINS, 1000, "k")


# --- text and projections ---------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, sha256({NORM}) AS normalized_sha256 FROM documents")
def normalized_hash(spark, d):
    return spread(table(spark, d, "documents")).select("doc_id", S.normalized_sha256(F.col("text")).alias("normalized_sha256"))


@query("""SELECT item_id, sha256(trim(regexp_replace(lower(nfc_normalize(replace(text, 'ß', 'z') || ' CAFE' || chr(769) || ' ΣΟΦΟΣ Škoda')), '\\s+', ' ', 'g'))) AS normalized_sha256 FROM benchmark""")
def normalized_hash_marks(spark, d):
    """Passages with decomposed marks and Greek capitals at their end."""
    text = F.concat(F.replace("text", F.lit("ß"), F.lit("z")), F.lit(" CAFE\u0301 ΣΟΦΟΣ Škoda"))
    return table(spark, d, "benchmark").select("item_id", S.normalized_sha256(text).alias("normalized_sha256"))


@query(f"""SELECT digest, count(*) AS copies, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM (SELECT doc_id, sha256({NORM}) AS digest FROM documents) GROUP BY digest HAVING count(*) > 1""")
def exact_duplicates(spark, d):
    rows = spread(table(spark, d, "documents")).select("doc_id", S.normalized_sha256(F.col("text")).alias("digest"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("copies > 1")


@query("""SELECT doc_id, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS alnum_chars,
length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 40 AS low_text FROM documents""")
def sparse_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.alnum_count(F.col("text")).cast("long").alias("alnum_chars"), T.is_sparse(F.col("text")).alias("low_text"))


HEAD_SQL = f"""CASE WHEN regexp_matches(line, '^(?i:{T.HEADING_TITLES})$') THEN 1
WHEN regexp_matches(line, '{T.NUMBERED}') AND length(line) <= 110 AND NOT regexp_matches(line, '[.;,]$')
THEN least(6, length(regexp_extract(line, '{T.NUMBERED}', 1)) - length(replace(regexp_extract(line, '{T.NUMBERED}', 1), '.', '')) + 1) END"""


@query(f"""WITH lines AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents
UNION ALL SELECT c.conv_id, h FROM conversations c, (VALUES ('1.2 Methods and data'), ('Abstract'), ('3. Results.'), ('Appendix B'), ('2.3.4.5 Deep')) v(h) WHERE turn = 0)
SELECT CAST({HEAD_SQL} AS INTEGER) AS level, count(*) AS lines, count(DISTINCT doc_id) AS documents FROM lines GROUP BY 1""")
def heading_levels(spark, d):
    lines = spread(table(spark, d, "documents")).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    titles = F.array(*map(F.lit, ["1.2 Methods and data", "Abstract", "3. Results.", "Appendix B", "2.3.4.5 Deep"]))
    more = table(spark, d, "conversations").where("turn = 0").select(F.col("conv_id").alias("doc_id"), F.explode(titles).alias("line"))
    rows = lines.unionByName(more).select("doc_id", T.heading_level(F.col("line")).alias("level"))
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("doc_id").alias("documents"))


@query("""WITH l AS (SELECT doc_id, i, ls[i] AS line, len(ls) AS n FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
w AS (SELECT *, length(line) + CASE WHEN i < n THEN 1 ELSE 0 END AS size FROM l)
SELECT * FROM (SELECT CAST(doc_id AS VARCHAR) AS document_id, CAST(i - 1 AS INTEGER) AS line_no, CAST(sum(size) OVER p - size AS INTEGER) AS raw_start, CAST(sum(size) OVER p AS INTEGER) AS raw_end, i < n OR line <> '' AS keep
FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)) WHERE keep""")
def line_blocks_offsets(spark, d):
    pages = spread(table(spark, d, "documents")).select(F.col("doc_id").cast("string").alias("document_id"), F.lit(1).alias("page"), "text")
    return segmentation.lines_of(pages).select("document_id", "line_no", "raw_start", "raw_end", F.lit(True).alias("keep"))


@query(f"""WITH p AS (SELECT source AS d, doc_id AS page, 'Journal of ' || source || chr(10) || text || chr(10) || 'Abstract' || chr(10) || lang AS text FROM documents),
l AS (SELECT d, page, i, trim(ls[i], ' ') AS line FROM (SELECT d, page, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT d, page, string_split(text, chr(10)) AS ls FROM p))),
f AS (SELECT *, row_number() OVER (PARTITION BY d, page ORDER BY i) AS a, row_number() OVER (PARTITION BY d, page ORDER BY i DESC) AS b FROM l WHERE line <> ''),
s AS (SELECT d, count(DISTINCT page) AS n FROM p GROUP BY 1), c AS (SELECT d, line, count(DISTINCT page) AS pages FROM f WHERE a <= 2 OR b <= 2 GROUP BY 1, 2)
SELECT d AS document_id, line, pages FROM c JOIN s USING (d) WHERE pages >= greatest(3, floor((n * 3 + 4) / 5)) AND length(line) <= 160 AND ({HEAD_SQL}) IS NULL""")
def page_margins(spark, d):
    """Each source is a document whose pages bear its name above, and a heading and their language below."""
    text = F.concat(F.lit("Journal of "), "source", F.lit("\n"), "text", F.lit("\nAbstract\n"), "lang")
    pages = spread(table(spark, d, "documents")).select(F.col("source").alias("document_id"), F.col("doc_id").alias("page"), text.alias("text"))
    return segmentation.margins(pages)


@query("""SELECT doc_id, i AS chunk_no, i * 5800 AS char_start, least(i * 5800 + 6000, length(text)) AS char_end, sha256(substr(text, i * 5800 + 1, 6000)) AS chunk_sha256
FROM (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 6000 THEN 1 ELSE CAST(ceil((length(text) - 200) / 5800.0) AS INTEGER) END)) AS i FROM documents)""")
def char_chunks(spark, d):
    n = T.chunk_count(F.length("text"), 6000, 200)
    rows = table(spark, d, "documents").select("doc_id", "text", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("i"))
    begin = F.col("i") * 5800
    return rows.select("doc_id", F.col("i").cast("long").alias("chunk_no"), begin.cast("long").alias("char_start"), F.least(begin + 6000, F.length("text")).cast("long").alias("char_end"), F.sha2(F.substring(F.col("text"), begin + 1, F.lit(6000)), 256).alias("chunk_sha256"))


ROLE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(title), '{w}') THEN '{r}'" for r, w in T.ROLE_WORDS) + " WHEN title <> '' THEN 'body' ELSE 'front_or_unclassified' END"


@query(f"""SELECT p_partkey, {ROLE_SQL} AS content_role FROM (SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN 'Bibliography' WHEN 2 THEN 'Acknowledgements'
WHEN 3 THEN 'ABSTRACT' WHEN 4 THEN 'Appendix A' WHEN 5 THEN p_name ELSE p_type || ' References' END AS title FROM part)""")
def content_roles(spark, d):
    title = F.expr("CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN 'Bibliography' WHEN 2 THEN 'Acknowledgements' WHEN 3 THEN 'ABSTRACT' WHEN 4 THEN 'Appendix A' WHEN 5 THEN p_name ELSE concat(p_type, ' References') END")
    path = F.when(title == "", F.array().cast("array<string>")).otherwise(F.array(title))
    return table(spark, d, "part").select("p_partkey", T.content_role(path).alias("content_role"))


def rule_sql(text: str, rules: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '(?i){p}') THEN '{n}'" for n, p in rules) + f" ELSE '{otherwise}' END"


@query(f"SELECT doc_id, {rule_sql('text', R.LEVEL_WORDS, 'unspecified')} AS level FROM documents")
def level_classes(spark, d):
    return spread(table(spark, d, "documents")).select("doc_id", R.level(F.col("text")).alias("level"))


@query(f"""SELECT doc_id, {rule_sql('text', [('restricted_or_embargo', R.CLOSED_WORDS), ('open', R.OPEN_WORDS)], 'unknown')} AS access_guess,
{rule_sql('text', R.LICENCE_WORDS, 'unknown')} AS licence_class FROM documents""")
def rights_classes(spark, d):
    return spread(table(spark, d, "documents")).select("doc_id", R.access(F.col("text")).alias("access_guess"), R.licence_class(F.col("text")).alias("licence_class"))


EVIDENCE_RULES = [*((f"cc-{p}", rf"creativecommons\.org/licenses/{p}/") for p in R.EVIDENCE_PATHS), ("cc0", r"creativecommons\.org/publicdomain/zero/"), ("all-rights-reserved", "all rights reserved|all-rights-reserved")]


@query(f"SELECT licence, count(*) AS documents FROM (SELECT {rule_sql('lower(text)', EVIDENCE_RULES, 'unknown')} AS licence FROM documents) GROUP BY licence")
def licence_evidence(spark, d):
    return table(spark, d, "documents").groupBy(R.licence_from_evidence(F.col("text")).alias("licence")).agg(F.count(F.lit(1)).alias("documents"))


@query("SELECT doc_id, c.name AS common_licence FROM documents, (VALUES (0, 'cc0'), (1, 'all-rights-reserved'), (2, 'unknown'), (3, 'cc-by')) c(k, name) WHERE doc_id % 4 = k")
def licence_vocabularies(spark, d):
    given = F.element_at(F.array(*map(F.lit, ["cc0/public-domain", "in-copyright", "open-unspecified", "cc-by"])), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", R.common_licence(given).alias("common_licence"))


@query("""SELECT year, CASE WHEN year = '' THEN 'unknown' ELSE substr(year, 1, 3) || '0s' END AS decade, count(*) AS orders
FROM (SELECT regexp_extract(strftime(o_orderdate, '%Y-%m-%d'), '(1[6-9][0-9]{2}|20[0-4][0-9])', 1) AS year FROM orders) GROUP BY year""")
def year_decade_rollup(spark, d):
    year = T.year_of(F.lit(None).cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("orders")).select("year", T.decade_of(F.col("year")).alias("decade"), "orders")


TERMS_SQL = f"list_distinct(regexp_extract_all({FOLD}, '[\\p{{L}}\\p{{N}}]+'))"


@query("""SELECT item_id, len(t) AS n_terms, array_to_string(list_sort(t), ' ') AS terms FROM
(SELECT item_id, (SELECT list(x) FROM (SELECT x, min(i) AS first FROM (SELECT unnest(w) AS x, unnest(range(len(w))) AS i) GROUP BY x ORDER BY first LIMIT 64)) AS t
FROM (SELECT item_id, regexp_extract_all(""" + FOLD + """, '[\\p{L}\\p{N}]+') AS w FROM benchmark))""")
def query_terms(spark, d):
    terms = T.query_terms(F.col("text"))
    return table(spark, d, "benchmark").select("item_id", F.size(terms).cast("long").alias("n_terms"), F.array_join(F.array_sort(terms), " ").alias("terms"))


@query("""SELECT page_id, trim(regexp_replace(string_split(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ' — ')[1], '\\s+', ' ', 'g')) AS title,
len(regexp_extract_all(html, '(?i)<meta ')) AS n_meta,
len(list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', chr(10), 'g'), chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')) AS n_lines FROM pages""")
def html_title_meta(spark, d):
    rows = harvest.html_title_meta(spread(table(spark, d, "pages")))
    return rows.select("page_id", "title", F.col("n_meta").cast("long").alias("n_meta"), F.col("n_lines").cast("long").alias("n_lines"))


PAGE_END = ["<p>Authors:</p><i>Ann ", "; Bob;Ann ", "</i><p>Year:</p><p>", "</p><h2>Abstract</h2><p>First &amp;amp; ", '.</p><p>Last.</p><h2>Files</h2><a class=x href="/f', '.PDF">f</a><a href="https://creativecommons.org/licenses/by/4.0/">cc</a>']


@query("""SELECT page_id, trim(regexp_replace(replace(replace(string_split(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ' — ')[1], '&amp;', '&'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title,
2::BIGINT AS n_fields, 'Ann ' || page_id || '|Bob' AS authors, CAST(page_id AS VARCHAR) AS year, 'First & ' || page_id || '. Last.' AS abstract, '/f' || page_id || '.PDF' AS files, 'open' AS access_guess, 'cc-by' AS licence_class FROM pages""")
def html_page_records(spark, d):
    """Each page with a record at its end: labelled lines, an abstract, a file and a licence."""
    number = F.col("page_id").cast("string")
    end = F.concat(*[x for k, part in enumerate(PAGE_END) for x in ([F.lit(part)] if k + 1 == len(PAGE_END) else [F.lit(part), number])])
    rows = harvest.page_records(spread(table(spark, d, "pages")).select(number.alias("url"), F.concat("html", end).alias("html")))
    fields = F.col("fields")
    return rows.select(
        F.col("url").cast("long").alias("page_id"), "title", F.size("fields").cast("long").alias("n_fields"), F.array_join(fields["authors"], "|").alias("authors"), F.array_join(fields["year"], "|").alias("year"), "abstract",
        F.array_join("file_urls", "|").alias("files"), "access_guess", "licence_class",
    )


@query("""SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, ''), c_mktsegment) AS source_url, CASE WHEN c_custkey % 5 = 0 THEN 'und' ELSE lower(c_mktsegment) END AS language,
CASE WHEN c_custkey % 5 = 0 THEN 'unknown' ELSE 'source_metadata' END AS language_method, 'unknown' AS license FROM customer""")
def metadata_coalesce(spark, d):
    json = F.to_json(F.struct(
        F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_name")).alias("source_url"), F.col("c_mktsegment").alias("landing_url"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.lower("c_mktsegment")).alias("language"),
    ))
    raw = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("path"), json.alias("json"))
    return readers.sidecars(raw).select(F.col("path").cast("long").alias("c_custkey"), "source_url", "language", "language_method", "license")


@query("SELECT p_partkey, p_brand || ' | ' || p_type || ' | ' || p_name AS flat FROM part")
def flat_values(spark, d):
    return table(spark, d, "part").select("p_partkey", T.flat_values(F.array("p_brand", "p_type", "p_name")).alias("flat"))


@query("""SELECT doc_id, page, sha256(t) AS page_sha256 FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS page, unnest(p) AS t FROM
(SELECT doc_id, string_split(replace(text, '. ', chr(12)), chr(12)) AS p FROM documents)) WHERE NOT (page > 1 AND trim(t) = '')""")
def form_feed_pages(spark, d):
    """Sentences as pages: a form feed stands for what ends them."""
    docs = spread(table(spark, d, "documents")).withColumn("text", F.replace("text", F.lit(". "), F.lit("\f")))
    return readers.pages_of(docs, "doc_id", "text").select(F.col("document_id").cast("long").alias("doc_id"), F.col("page").cast("long").alias("page"), F.sha2("text", 256).alias("page_sha256"))


# --- signatures and near duplicates -----------------------------------------------------------------------------------

MD5_SQL = f"""w AS (SELECT doc_id, regexp_extract_all({NORM}, '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents),
t AS (SELECT doc_id, md5(array_to_string(w[i : i + 2], ' ')) AS m FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
h AS (SELECT doc_id, CAST('0x' || substr(m, 1, 15) AS BIGINT) AS h FROM t),
sig AS (SELECT doc_id, CAST({' + '.join(f'CASE WHEN sum(CASE WHEN (h >> {b}) & 1 = 1 THEN 1 ELSE -1 END) > 0 THEN {1 << b}::BIGINT ELSE 0 END' for b in range(60))} AS BIGINT) AS simhash FROM h GROUP BY doc_id)"""


@query(f"WITH {MD5_SQL} SELECT doc_id, simhash FROM sig")
def simhash_md5_signature(spark, d):
    return S.simhash_md5(spread(table(spark, d, "documents")))


@query(f"""WITH {MD5_SQL}, c AS (SELECT simhash, min(doc_id) AS doc_id FROM sig GROUP BY simhash)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS hamming_distance
FROM c a JOIN c b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.simhash, b.simhash)) <= 3
UNION ALL SELECT c.doc_id, sig.doc_id, CAST(0 AS INTEGER) FROM c JOIN sig USING (simhash) WHERE sig.doc_id <> c.doc_id""")
def simhash_near_pairs(spark, d):
    return near_duplicates.near_pairs(S.simhash_md5(spread(table(spark, d, "documents"))))


@query(f"""WITH {MD5_SQL}, p AS (SELECT a.doc_id AS left_id, b.doc_id AS right_id, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS hamming_distance
FROM sig a JOIN sig b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.simhash, b.simhash)) <= 3), n AS (SELECT doc_id, sha256({NORM}) AS digest FROM documents)
SELECT left_id, right_id, hamming_distance, x.digest = y.digest AS normalized_exact, 'review_candidate' AS action, (SELECT count(*) > 100000 FROM p) AS truncated
FROM p JOIN n x ON x.doc_id = left_id JOIN n y ON y.doc_id = right_id ORDER BY left_id, right_id LIMIT 100000""")
def dedup_report(spark, d):
    docs = spread(table(spark, d, "documents"))
    return near_duplicates.candidate_report(S.simhash_md5(docs), docs.select("doc_id", S.normalized_sha256(F.col("text")).alias("digest")))


@query()
def simhash_blake2b_pairs(spark, d):
    signatures = spread(table(spark, d, "documents")).select("doc_id", S.simhash_blake2b(F.col("text")).alias("simhash"))
    return near_duplicates.near_pairs(signatures)


# --- retrieval --------------------------------------------------------------------------------------------------------

TOK = "regexp_extract_all(strip_accents(" + FOLD + "), '[\\p{L}\\p{N}]+')"
BM25_SQL = f"""c AS (SELECT doc_id, {TOK} AS w FROM documents),
len AS (SELECT doc_id, len(w) + 2 AS length FROM c),
tot AS (SELECT count(*) AS n, avg(length) AS mean FROM len),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM c) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, unnest(list_distinct({TOK})) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, round(sum(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 9) AS score
FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (doc_id), tot GROUP BY item_id, doc_id)"""


def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Each document as one chunk; all are untitled, and the stand-in title lengthens each alike."""
    docs = spread(table(spark, d, "documents"))
    return docs.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("document_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"), (F.col("doc_id") % 50 + 1).cast("int").alias("page_start"), (F.col("doc_id") % 50 + 1).cast("int").alias("page_end"))


def benchmark_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(F.array_distinct(retrieval.tokens(F.col("text")))).alias("term"))


@query(f"""SELECT CAST(doc_id AS BIGINT) AS chunk_id, term, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT doc_id, unnest({TOK}) AS term FROM documents) GROUP BY doc_id, term""")
def postings(spark, d):
    return retrieval.postings(document_chunks(spark, d))


@query("""SELECT item_id AS chunk_id, term, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT item_id,
unnest(regexp_extract_all(strip_accents(replace(lower(text || ' Škoda CAFE' || chr(769) || ' Ångström ἀγάπη'), 'ß', 'ss')), '[\\p{L}\\p{N}]+')) AS term FROM benchmark) GROUP BY 1, 2""")
def postings_marks(spark, d):
    """Passages with marks beyond Latin-1 at their end, composed and not."""
    body = F.concat("text", F.lit(" Škoda CAFE\u0301 Ångström ἀγάπη"))
    return retrieval.postings(table(spark, d, "benchmark").select(F.col("item_id").alias("chunk_id"), F.lit(None).cast("string").alias("title"), body.alias("body")))


def nine(scored: DataFrame) -> DataFrame:
    """Scores as the SQL ranks them: to nine decimals."""
    return scored.withColumn("score", F.round("score", 9))


@query(f"""WITH {BM25_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM r WHERE item_id = (SELECT min(item_id) FROM benchmark) AND rank <= 10""")
def bm25_search(spark, d):
    """The ten best documents for the first benchmark passage."""
    first = table(spark, d, "benchmark").orderBy("item_id").limit(1).select(F.explode(F.array_distinct(retrieval.tokens(F.col("text")))).alias("term"))
    terms = [r["term"] for r in first.collect()]  # the terms of one passage
    best = nine(retrieval.scores(document_chunks(spark, d), terms)).orderBy(F.desc("score"), "chunk_id").limit(10)
    return best.select(F.row_number().over(Window.orderBy(F.desc("score"), "chunk_id")).alias("rank"), F.col("chunk_id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"""WITH {BM25_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 5""")
def bm25_all_passages(spark, d):
    """The five best documents for every benchmark passage at once."""
    rows = retrieval.scores(document_chunks(spark, d), benchmark_terms(spark, d))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "chunk_id"))
    return rows.withColumn("rank", rank).where("rank <= 5").select(F.col("query_id").alias("item_id"), "rank", F.col("chunk_id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"""WITH {BM25_SQL}, h AS (SELECT s.doc_id, score, source, s.doc_id % 50 + 1 AS page FROM s JOIN documents USING (doc_id) WHERE item_id = (SELECT min(item_id) FROM benchmark)),
pool AS (SELECT * FROM h ORDER BY score DESC, doc_id LIMIT 100), once AS (SELECT *, row_number() OVER (PARTITION BY source, page ORDER BY score DESC, doc_id) AS n FROM pool)
SELECT CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, source AS document_id, CAST(page AS INTEGER) AS page_start, round(score, 6) AS score FROM once WHERE n = 1 ORDER BY score DESC, doc_id LIMIT 5""")
def page_deduped_topk(spark, d):
    chunks = document_chunks(spark, d)
    first = table(spark, d, "benchmark").orderBy("item_id").limit(1).select(F.explode(F.array_distinct(retrieval.tokens(F.col("text")))).alias("term"))
    hits = nine(retrieval.scores(chunks, [r["term"] for r in first.collect()])).join(chunks, "chunk_id")
    return retrieval.page_hits(hits, 5).select("rank", F.col("chunk_id").alias("doc_id"), "document_id", "page_start", F.round("score", 6).alias("score"))


@query()
def search_with_citations(spark, d):
    passage = table(spark, d, "benchmark").orderBy("item_id").limit(1).first()["text"]
    return retrieval.search(document_chunks(spark, d), passage, 5).select("rank", "chunk_id", "document_id", "page_start", "excerpt")


@query("""SELECT count(DISTINCT conv_id) AS documents, count(*) FILTER (WHERE turn > 0 AND trim(text) <> '' AND length(text) >= 40) AS chunks,
count(*) FILTER (WHERE NOT (turn > 0 AND trim(text) <> '' AND length(text) >= 40)) AS excluded FROM conversations""")
def index_receipt(spark, d):
    flags = F.when(F.length("text") < 40, F.array(F.lit("low_text_page"))).otherwise(F.array().cast("array<string>"))
    rows = source_pages(spark, d).select("document_id", F.col("page").alias("page_start"), F.col("text").alias("body"), flags.alias("quality_flags"))
    return retrieval.index_receipt(rows)


# --- export, bindings, state ------------------------------------------------------------------------------------------


def corpus_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents with metadata: a document is ready if its label says so, its licence follows from its source."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    status = F.when(F.col("quality") == 1, "ready").when(F.col("quality") == 0, "needs_review").otherwise("needs_ocr")
    licence = F.element_at(F.array(F.lit("cc-by"), F.lit("cc0"), F.lit(None), F.lit("all-rights-reserved")), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("p"), (F.col("doc_id") % 2).cast("string")).alias("profile"), status.alias("status"), licence.alias("license"),
        F.col("lang").alias("language"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("source_url"), "text",
    )


CORPUS_SQL = """corpus AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS document_id, 'p' || (doc_id % 2) AS profile, CASE quality WHEN 1 THEN 'ready' WHEN 0 THEN 'needs_review' ELSE 'needs_ocr' END AS status,
CASE doc_id % 4 WHEN 0 THEN 'cc-by' WHEN 1 THEN 'cc0' WHEN 2 THEN NULL ELSE 'all-rights-reserved' END AS license, lang AS language, 'Document ' || doc_id AS title, source AS source_url, text FROM documents LEFT JOIN labels USING (doc_id))"""


@query(f"WITH {CORPUS_SQL} SELECT document_id, coalesce(license, 'unknown') AS license, length(text) AS chars FROM corpus WHERE status = 'ready' AND coalesce(license, 'unknown') IN ('cc-by', 'unknown')")
def licence_filtered_export(spark, d):
    return writers.export_rows(corpus_documents(spark, d), licenses=["cc-by", "unknown"]).select("document_id", "license", F.length("text").cast("long").alias("chars"))


@query(f"WITH {CORPUS_SQL} SELECT document_id || ':' || profile AS record_id, document_id, profile, title, coalesce(license, 'unknown') AS license, language, source_url, text FROM corpus WHERE status = 'ready' AND profile = 'p1'")
def export_rows_documents(spark, d):
    return writers.export_rows(corpus_documents(spark, d), profile="p1")


@query(f"""WITH {CORPUS_SQL}, ch AS (SELECT document_id, profile, title, license, i, substr(text, i * 5800 + 1, 6000) AS text FROM
(SELECT *, unnest(range(0, CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 6000 THEN 1 ELSE CAST(ceil((length(text) - 200) / 5800.0) AS INTEGER) END)) AS i FROM corpus WHERE status = 'ready'))
SELECT document_id || ':default:p1:c' || i AS record_id, document_id, profile, coalesce(license, 'unknown') AS license, 'sha256:' || document_id || '#page=1' AS anchor, sha256(text) AS text_sha256 FROM ch""")
def export_rows_chunks(spark, d):
    docs = corpus_documents(spark, d)
    chunks = segmentation.page_chunks(docs.select("document_id", F.lit(1).alias("page"), "text")).join(docs.select("document_id", "profile"), "document_id")
    extra = {"content_role": F.lit("body"), "page_start": F.col("page"), "page_end": F.col("page"), "token_count": F.lit(None).cast("int"), "section_path": F.array().cast("array<string>")}
    rows = writers.export_rows(docs, chunks.withColumns(extra))
    return rows.select("record_id", "document_id", "profile", "license", "anchor", F.sha2("text", 256).alias("text_sha256"))


@query("""WITH m AS (SELECT o_orderkey AS line, CAST(o_custkey AS VARCHAR) AS uuid, 'f' || o_orderkey || '.pdf' AS name, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'other' END || '/g' || o_orderkey || '.pdf' AS path,
CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_totalprice AS BIGINT) END AS expected FROM orders WHERE o_orderstatus <> 'P'),
inv AS (SELECT o_custkey || '/' || CASE WHEN o_orderkey % 2 = 0 THEN 'f' ELSE 'g' END || o_orderkey || '.pdf' AS relative, CAST(o_totalprice AS BIGINT) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS size FROM orders),
k AS (SELECT line, expected, uuid || '/' || name AS relative FROM m UNION SELECT line, expected, path FROM m WHERE string_split(path, '/')[1] = uuid)
SELECT line, relative, size, CASE WHEN expected IS NULL THEN 'missing size' WHEN expected <> size THEN 'size mismatch' END AS error FROM k JOIN inv USING (relative)""")
def manifest_binding_join(spark, d):
    orders = table(spark, d, "orders")
    uuid = F.col("o_custkey").cast("string")
    size = F.bround("o_totalprice", 0).cast("long")
    file = F.struct(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("name"),
        F.concat(F.when(F.col("o_orderkey") % 3 == 0, uuid).otherwise(F.lit("other")), F.lit("/g"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("path"),
        F.lit("downloaded").alias("download_status"), F.when(F.col("o_orderkey") % 7 != 0, size).alias("sizeBytes"), F.lit(None).cast("string").alias("content_url"),
    )
    manifest = orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("line"), uuid.alias("uuid"), F.array(file).alias("downloaded_files"))
    stored = F.concat(uuid, F.lit("/"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("f")).otherwise(F.lit("g")), F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    inventory = orders.select(stored.alias("relative"), (size + F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(0)).alias("size"))
    return bindings.bind_downloads(manifest, inventory).select("line", "relative", "size", "error")


@query("""SELECT count(DISTINCT CASE WHEN error IS NULL THEN o_orderkey END) AS matched, (SELECT count(*) FROM orders) - count(DISTINCT CASE WHEN error IS NULL THEN o_orderkey END) AS unmatched, count(error) AS errors
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'path leaves the root' WHEN o_orderkey % 5 = 0 THEN 'size mismatch' END AS error FROM orders WHERE o_orderstatus = 'F')""")
def link_summary(spark, d):
    orders = table(spark, d, "orders")
    path = F.concat(F.when(F.col("o_orderkey") % 13 == 0, F.lit("../")).otherwise(F.lit("")), F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    manifest = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("line"), path.alias("pdf_path"), (F.lit(10) + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)).alias("size_bytes"))
    inventory = orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("relative"), F.lit(10).cast("long").alias("size"))
    return bindings.link_summary(bindings.bind_paths(manifest, inventory), inventory)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_version_upsert(spark, d):
    return bindings.latest(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = d.n_chars % 2)")
def cache_antijoin(spark, d):
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), (F.col("n_chars") % 2).cast("string").alias("fingerprint"))
    sources = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("path"), F.col("quality").cast("string").alias("fingerprint"))
    return bindings.uncached(files, sources).select(F.col("path").cast("long").alias("doc_id"))


@query(f"WITH {CORPUS_SQL} SELECT document_id, profile FROM corpus WHERE status = 'ready' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = corpus.doc_id AND l.toxic = 1)")
def receipts_antijoin(spark, d):
    manifests = corpus_documents(spark, d).select("document_id", "profile", "status", F.lit("m1").alias("manifest_sha"))
    receipts = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("p"), (F.col("doc_id") % 2).cast("string")).alias("profile"), F.lit("m1").alias("manifest_sha"), F.lit("store").alias("remote"))
    return bindings.to_upload(manifests, receipts, "store").select("document_id", "profile")


@query("SELECT CAST(conv_id AS VARCHAR) AS document_id, count(DISTINCT role) AS profiles FROM conversations GROUP BY conv_id HAVING count(DISTINCT role) > 1")
def multi_version_guard(spark, d):
    return audits.versions(table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.col("role").alias("profile")))


@query("SELECT l_orderkey AS line, min(l_suppkey) AS first_supplier, count(*) AS parts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey")
def first_source_path(spark, d):
    jobs = table(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"))
    sources = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_suppkey").alias("path"))
    counts = sources.groupBy("document_id").agg(F.count(F.lit(1)).alias("parts"))
    return bindings.first_path(jobs, sources).join(counts, "document_id").select(F.col("document_id").alias("line"), F.col("original_path").alias("first_supplier"), "parts")


@query("SELECT event_id AS generation FROM (SELECT event_id FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id DESC LIMIT 5)")
def generation_retention(spark, d):
    rows = table(spark, d, "events").where("event_type = 'signup'").select(F.col("event_id").alias("generation"), F.col("ts").alias("created_at"))
    return bindings.keep_newest(rows, 5).select("generation")


# --- audits and profiling ---------------------------------------------------------------------------------------------


@query(f"WITH {CORPUS_SQL} SELECT profile, status, count(*) AS jobs FROM corpus GROUP BY profile, status")
def status_rollup(spark, d):
    return audits.status_rollup(corpus_documents(spark, d))


@query("""WITH p AS (SELECT conv_id, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 40 AS low, strlen(text) AS b FROM conversations),
c AS (SELECT conv_id, count(*) AS pages, count(*) FILTER (WHERE low) AS low, sum(b) AS bytes FROM p GROUP BY conv_id)
SELECT count(*) AS documents, CAST(sum(pages) AS BIGINT) AS pages, count(*) FILTER (WHERE low > 0) AS documents_with_candidates, CAST(sum(low) AS BIGINT) AS candidate_pages,
round(count(*) FILTER (WHERE low > 0) / count(*), 6) AS document_fraction, round(sum(low) / sum(pages), 6) AS page_fraction, round(avg(bytes), 4) AS mean_bytes FROM c""")
def audit_summary(spark, d):
    return audits.audit_summary(source_pages(spark, d))


@query("""WITH p AS (SELECT conv_id, turn, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 40 AS low FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS document_id, count(*) AS page_count, count(*) FILTER (WHERE low) AS low_pages, CASE WHEN bool_or(low) THEN 'needs_ocr' ELSE 'ready' END AS status FROM p GROUP BY conv_id""")
def document_statuses(spark, d):
    return segmentation.statuses(source_pages(spark, d)).select("document_id", "page_count", F.size("low_text_pages").cast("long").alias("low_pages"), "status")


@query(f"""SELECT b.bin, count(n_chars) AS files, coalesce(sum(n_chars), 0)::BIGINT AS bytes FROM (SELECT unnest([{', '.join(f"'{x}'" for x in profiling.labels(BINS, 'k'))}]) AS bin) b
LEFT JOIN (SELECT n_chars, {BIN_SQL} AS bin FROM documents) d USING (bin) GROUP BY b.bin""")
def size_histogram(spark, d):
    return profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k")


HISTO_SQL = f"h AS (SELECT {BIN_SQL} AS bin, count(*) AS files, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY 1)"


@query(f"WITH {HISTO_SQL} SELECT bin, files, bytes, CAST(least(files, greatest(5, round_even(60.0::DOUBLE * bytes / (SELECT sum(bytes) FROM h), 0))) AS BIGINT) AS quota FROM h")
def sample_allocation(spark, d):
    return profiling.allocate(profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k"), 60)


STRATA_SQL = f"""{HISTO_SQL}, q AS (SELECT bin, least(files, greatest(5, round_even(60.0::DOUBLE * bytes / (SELECT sum(bytes) FROM h), 0))) AS quota FROM h),
drawn AS (SELECT {BIN_SQL} AS bin, lang AS category, n_chars AS bytes, row_number() OVER (PARTITION BY {BIN_SQL} ORDER BY md5(doc_id || ':42'), doc_id) AS place FROM documents),
s AS (SELECT bin, category, drawn.bytes AS bytes FROM drawn JOIN q USING (bin) WHERE place <= quota),
b AS (SELECT bin, count(*) AS n, sum(bytes) AS sampled FROM s GROUP BY bin)"""


def strata_sample(spark: SparkSession, d: str) -> DataFrame:
    """The files that the allocation draws, categorised by their language."""
    files = table(spark, d, "documents").select("doc_id", bin_of().alias("bin"), F.col("lang").alias("category"), F.col("n_chars").alias("bytes"))
    quotas = profiling.allocate(profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k"), 60)
    return profiling.stratified_sample(files, quotas, "doc_id").select("bin", "category", "bytes")


@query(f"""WITH {STRATA_SQL}, c AS (SELECT bin, category, sum(bytes) AS own FROM s GROUP BY bin, category),
r AS (SELECT category, sum(h.bytes * (own / sampled)) AS est, 1.96 * sqrt(sum(h.bytes::DOUBLE * h.bytes * (own / sampled) * (1 - own / sampled) / greatest(n - 1, 1) * greatest(0.0, 1 - n / files))) AS half
FROM c JOIN b USING (bin) JOIN h USING (bin) GROUP BY category)
SELECT category, CAST(round_even(est, 0) AS BIGINT) AS estimated_bytes, round_even(est / (SELECT sum(bytes) FROM h), 4) AS estimated_share, CAST(round_even(half, 0) AS BIGINT) AS ci95_bytes, round_even(half / (SELECT sum(bytes) FROM h), 4) AS ci95_share FROM r""")
def stratified_byte_share(spark, d):
    return profiling.stratified_estimates(strata_sample(spark, d), profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k"))


@query(f"WITH {STRATA_SQL} SELECT bin, files, bytes, coalesce(n, 0) AS sampled, coalesce(n, 0) = files AS censused, coalesce(n, 0) < 5 AND coalesce(n, 0) < files AS insufficient FROM h LEFT JOIN b USING (bin)")
def strata_coverage(spark, d):
    return profiling.strata(strata_sample(spark, d), profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k"))


@query(f"""WITH {HISTO_SQL}, q AS (SELECT bin, least(files, greatest(5, round_even(60.0::DOUBLE * bytes / (SELECT sum(bytes) FROM h), 0))) AS quota FROM h),
r AS (SELECT doc_id, {BIN_SQL} AS bin, row_number() OVER (PARTITION BY {BIN_SQL} ORDER BY md5(doc_id || ':42'), doc_id) AS n FROM documents) SELECT doc_id, bin FROM r JOIN q USING (bin) WHERE n <= quota""")
def stratified_sample(spark, d):
    files = table(spark, d, "documents").select("doc_id", bin_of().alias("bin"))
    quotas = profiling.allocate(profiling.histogram(table(spark, d, "documents"), "n_chars", BINS, 1000, "k"), 60)
    return profiling.stratified_sample(files, quotas, "doc_id").select("doc_id", "bin")


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 50")
def uniform_sample(spark, d):
    return profiling.uniform_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 50)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 20")
def top20_largest(spark, d):
    return table(spark, d, "documents").orderBy(F.desc("n_chars"), F.desc("doc_id")).limit(20).select("doc_id", "n_chars")


@query(f"""SELECT count(*) FILTER (WHERE n > 1) AS groups, coalesce(sum(n - 1) FILTER (WHERE n > 1), 0)::BIGINT AS extra_copies, coalesce(sum((n - 1) * size) FILTER (WHERE n > 1), 0)::BIGINT AS extra_bytes, sum(n)::BIGINT AS hashed
FROM (SELECT sha256(text) AS h, count(*) AS n, min(n_chars) AS size FROM documents GROUP BY 1)""")
def duplicate_summary(spark, d):
    return profiling.duplicate_summary(table(spark, d, "documents").select(F.sha2("text", 256).alias("digest"), "n_chars"), "digest", "n_chars")


@query("""SELECT p_partkey, CAST(greatest(1, least(16, count, greatest(3, ceil(sqrt(count) / 2)))) AS INTEGER) AS planned FROM (SELECT p_partkey, CAST(p_retailprice AS BIGINT) + p_size AS count FROM part)""")
def page_plan(spark, d):
    count = F.bround("p_retailprice", 0).cast("long") + F.col("p_size")
    return table(spark, d, "part").select("p_partkey", profiling.page_count_plan(count).alias("planned"))


@query("""WITH p AS (SELECT l_orderkey, l_quantity * 2 < 40 AS low, l_linenumber % 3 = 0 AS image, l_tax > 0.06 AS form FROM lineitem)
SELECT l_orderkey AS document_id, count(*) AS pages_examined, count(*) FILTER (WHERE low) AS low_pages, CASE WHEN bool_and(low) THEN CASE WHEN bool_or(image) THEN 'low_text_image_candidate' WHEN bool_or(form) THEN 'low_text_form_candidate' ELSE 'low_text_unknown' END
WHEN bool_or(low) THEN 'mixed_text_candidate' ELSE 'text_present' END AS category FROM p GROUP BY l_orderkey""")
def inspection_categories(spark, d):
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), (F.col("l_quantity") * 2).alias("alnum_chars"), (F.col("l_linenumber") % 3 == 0).cast("int").alias("images"), (F.col("l_tax") > 0.06).cast("int").alias("forms"))
    return profiling.inspect(pages)


# --- harvest ----------------------------------------------------------------------------------------------------------


def harvested(spark: SparkSession, d: str) -> DataFrame:
    """Documents as harvested records; rights evidence is what their texts say."""
    docs = table(spark, d, "documents")
    return docs.select(
        F.col("source").alias("repo"), F.col("doc_id").cast("string").alias("oai_identifier"), F.concat((F.lit(1950) + F.col("doc_id") % 80).cast("string"), F.lit("-01-01")).alias("date"),
        F.lit("2020-05-05").alias("datestamp"), R.licence_class(F.col("text")).alias("licence_class"), R.access(F.col("text")).alias("access_guess"),
        F.slice(F.split("text", " "), 1, 25).alias("authors"), F.slice(F.split("lang", ""), 1, 2).alias("advisors"), F.lit("").alias("qualification"), F.array(F.lit("Thesis")).alias("types"), F.array("lang").alias("sets"), F.lit(None).cast("string").alias("level"),
    )


LICENCE_SQL, ACCESS_SQL = rule_sql("text", R.LICENCE_WORDS, "unknown"), rule_sql("text", [("restricted_or_embargo", R.CLOSED_WORDS), ("open", R.OPEN_WORDS)], "unknown")


@query(f"""WITH r AS (SELECT source AS repo, {LICENCE_SQL} AS l, {ACCESS_SQL} AS a FROM documents)
SELECT repo, count(*) AS records, count(*) FILTER (WHERE a = 'open') AS open, count(*) FILTER (WHERE a = 'restricted_or_embargo') AS restricted, count(*) FILTER (WHERE a = 'unknown') AS unknown,
count(*) FILTER (WHERE l LIKE 'cc%') AS cc, count(*) FILTER (WHERE l = 'in-copyright') AS in_copyright FROM r GROUP BY repo""")
def catalog_counts(spark, d):
    return harvest.catalogue_counts(harvested(spark, d))


@query(f"""SELECT repo, licence_class, records, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY records DESC, licence_class) AS rank
FROM (SELECT source AS repo, {LICENCE_SQL} AS licence_class, count(*) AS records FROM documents GROUP BY 1, 2)) WHERE rank <= 8""")
def catalog_top_licences(spark, d):
    return harvest.top_licences(harvested(spark, d))


@query("SELECT source AS repo, substr(CAST(1950 + doc_id % 80 AS VARCHAR), 1, 3) || '0s' AS decade, count(*) AS records FROM documents GROUP BY 1, 2")
def catalog_decades(spark, d):
    return harvest.decades(harvest.catalogue(harvested(spark, d)))


@query("""SELECT repo, oai_identifier, role, name FROM (SELECT source AS repo, CAST(doc_id AS VARCHAR) AS oai_identifier, 'author' AS role, unnest(string_split(text, ' ')[1:20]) AS name FROM documents
UNION ALL SELECT source, CAST(doc_id AS VARCHAR), 'advisor', unnest([substr(lang, 1, 1), substr(lang, 2, 1)]) FROM documents)""")
def people_explode(spark, d):
    return harvest.people(harvested(spark, d))


@query(f"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root FROM pages)
SELECT page_id, endpoint_no, endpoint FROM (SELECT page_id, 0 AS endpoint_no, url AS endpoint FROM p UNION ALL SELECT page_id, 1, root || '/oai' FROM p UNION ALL SELECT page_id, 2, root || '/oai/request' FROM p)""")
def candidate_endpoints(spark, d):
    registry = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.array("url").alias("oai"))
    rows = harvest.candidate_endpoints(registry, ["/oai", "/oai/request"])
    return rows.select(F.col("id").alias("page_id"), "endpoint_no", F.col("url").alias("endpoint"))


@query("""SELECT n_nationkey AS id, n_name AS name, n_regionkey AS nobel, CAST(row_number() OVER (ORDER BY n_regionkey DESC, n_nationkey) AS INTEGER) AS place FROM nation WHERE n_regionkey <> 2""")
def registry_order(spark, d):
    rows = harvest.ordered_registry(table(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("nobel")))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc("nobel"), "id")))


@query("""WITH y AS (SELECT CAST(n_nationkey AS VARCHAR) AS repo, make_date(y, 1, 1) AS b, make_date(y, 12, 31) AS e FROM (SELECT n_nationkey, unnest(range(2015 + n_nationkey % 5, 2021)) AS y FROM nation))
SELECT repo, CAST(m AS DATE) AS "begin", last_day(CAST(m AS DATE)) AS "end" FROM (SELECT repo, unnest(generate_series(b, e, INTERVAL 1 MONTH)) AS m FROM y)""")
def date_windows(spark, d):
    earliest = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("repo"), F.concat((F.lit(2015) + F.col("n_nationkey") % 5).cast("string"), F.lit("-03-04")).alias("earliest"))
    return harvest.split_windows(harvest.year_windows(earliest, 2020))


@query("SELECT r_name AS repo, sum(kept)::BIGINT AS kept, sum(seen)::BIGINT AS seen, sum(bytes)::BIGINT AS bytes FROM (SELECT r_name, n_nationkey AS kept, n_nationkey + 3 AS seen, length(n_name) AS bytes FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY ROLLUP (r_name)")
def harvest_stats(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return harvest.harvest_stats(rows.select(F.col("r_name").alias("repo"), F.col("n_nationkey").cast("long").alias("kept"), (F.col("n_nationkey") + 3).cast("long").alias("seen"), F.length("n_name").cast("long").alias("bytes")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS oai_identifier, o_orderpriority AS title, CASE WHEN o_orderkey % 2 = 0 THEN ['A ' || o_custkey, 'B'] ELSE ['B'] END AS authors,
CASE WHEN o_orderstatus = 'F' THEN 'doctoral' ELSE 'unspecified' END AS level, o_orderstatus IN ('F', 'O') AS is_thesis, CASE WHEN o_orderkey % 3 = 0 THEN 'cc-by' ELSE 'unknown' END AS licence_class FROM orders""")
def normalise_records(spark, d):
    def values(*v):
        return F.array(*v)

    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    fields = F.map_from_arrays(
        F.array(*map(F.lit, ["dc.title", "dc.contributor.author", "dc.creator", "dc.type", "dc.rights.uri"])),
        F.array(
            values(F.col("o_orderpriority")), F.when(key % 2 == 0, values(F.concat(F.lit("A "), F.col("o_custkey").cast("string")))).otherwise(F.array().cast("array<string>")), values(F.lit("B")),
            values(F.when(status == "F", "Doctoral thing").when(status == "O", "Thesis").otherwise("Report")), F.when(key % 3 == 0, values(F.lit("https://creativecommons.org/licenses/by/4.0/"))).otherwise(F.array().cast("array<string>")),
        ),
    )
    records = table(spark, d, "orders").select(F.lit("r").alias("repo"), key.cast("string").alias("oai_identifier"), F.lit("2020-01-01").alias("datestamp"), F.array().cast("array<string>").alias("sets"), F.lit("dim").alias("prefix"), F.lit(False).alias("deleted"), fields.alias("fields"))
    return harvest.normalise(records).select("oai_identifier", "title", "authors", "level", "is_thesis", "licence_class")


@query("SELECT doc_id FROM documents WHERE regexp_extract(source, '[0-9]+') <> '3'")
def seen_antijoin(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("oai_identifier"), "source")
    return harvest.unseen(docs, docs.where("source = 'src3'")).select(F.col("oai_identifier").cast("long").alias("doc_id"))


# --- records and folds ------------------------------------------------------------------------------------------------


@query("""SELECT 'document' AS type, count(*) AS records, count(DISTINCT conv_id) AS documents, NULL::BIGINT AS chars FROM (SELECT DISTINCT conv_id FROM conversations)
UNION ALL SELECT 'page', count(*), count(DISTINCT conv_id), sum(length(text))::BIGINT FROM conversations""")
def union_records(spark, d):
    pages = source_pages(spark, d)
    rows = audits.union_records(document=pages.select("document_id").distinct(), page=pages)
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("document_id").alias("documents"), F.sum(F.length("text")).alias("chars"))


@query("SELECT CAST(conv_id AS VARCHAR) AS document_id, role AS content_role, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn) || chr(10)) AS text_sha256 FROM conversations GROUP BY conv_id, role")
def role_concat(spark, d):
    rows = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.col("role").alias("content_role"), F.col("turn").alias("ordinal"), "text")
    return segmentation.role_texts(rows).select("document_id", "content_role", F.sha2("text", 256).alias("text_sha256"))


@query("SELECT event_type AS label, count(*) AS blocks FROM events GROUP BY event_type")
def label_counts(spark, d):
    return audits.label_counts(table(spark, d, "events").select(F.col("event_type").alias("label")))


@query("SELECT event_type AS label, count(*) AS blocks FROM events WHERE user_id BETWEEN 3 AND 8 GROUP BY event_type")
def page_range_review(spark, d):
    blocks = table(spark, d, "events").where("user_id BETWEEN 3 AND 8").select(F.col("event_type").alias("label"), F.array(F.col("user_id").cast("int")).alias("pages"))
    return writers.review(blocks, 3, 8)


@query()
def packed_chunks(spark, d):
    return segmentation.chunks(source_pages(spark, d)).select("document_id", "ordinal", "page_start", "page_end", "content_role", "section_method", F.length("text").alias("chars"), F.size("source_spans").alias("blocks"))


@query("""WITH p AS (SELECT CAST(conv_id AS VARCHAR) AS id, 'Session ' || conv_id AS head, text, CAST(turn AS VARCHAR) AS foot, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS page, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT id AS document_id, page, 0 AS raw_start, CAST(length(head) + 1 AS INTEGER) AS raw_end, 'repeated_margin' AS reason, head AS text FROM p WHERE n >= 3
UNION ALL SELECT id, page, CAST(length(head) + length(text) + 2 AS INTEGER), CAST(length(head) + length(text) + 2 + length(foot) AS INTEGER), 'page_number', foot FROM p WHERE foot = CAST(page AS VARCHAR)""")
def cleanup_audit(spark, d):
    """Conversations as documents with their name above and their turn below each page."""
    pages = source_pages(spark, d).withColumn("text", F.concat(F.lit("Session "), "document_id", F.lit("\n"), "text", F.lit("\n"), F.col("page").cast("string")))
    return segmentation.removed_lines(pages)


@query()
def chunk_metrics(spark, d):
    return audits.manifest_metrics(segmentation.chunks(source_pages(spark, d)))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS document_id, CAST(page AS INTEGER) AS page, string_agg(l_returnflag || l_linestatus, chr(10) ORDER BY l_linenumber, l_returnflag || l_linestatus) AS text
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, unnest(list_distinct([l_linenumber % 3 + 1, l_suppkey % 2 + 1])) AS page FROM lineitem) GROUP BY l_orderkey, page""")
def page_reassembly(spark, d):
    """Order lines as layout blocks that lie on one or two pages."""
    pages = F.array((F.col("l_linenumber") % 3 + 1).cast("int"), (F.col("l_suppkey") % 2 + 1).cast("int"))
    blocks = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_linenumber").alias("item"), F.concat("l_returnflag", "l_linestatus").alias("text"), pages.alias("pages"))
    return structure.page_texts(blocks)


@query("""SELECT l_orderkey AS document_id, min(l_linenumber) AS page_start, max(l_linenumber) AS page_end, 'sha256:' || l_orderkey || '#page=' || min(l_linenumber) AS anchor FROM lineitem GROUP BY l_orderkey""")
def coordinate_ranges(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("document_id")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("page"), F.col("l_tax").alias("x"))).alias("coords"))
    return structure.anchored(structure.page_range(rows)).drop("coords")


@query("""SELECT c_custkey AS document_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END) AS title,
coalesce(coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END), 'Document') AS heading, CASE WHEN c_custkey % 5 = 0 THEN 'own' ELSE 'found' END AS author FROM customer""")
def provenance_fallback(spark, d):
    rows = table(spark, d, "customer")
    documents = rows.select(F.col("c_custkey").alias("document_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.lit("")).alias("title"), F.when(F.col("c_custkey") % 5 == 0, F.array(F.lit("own"))).otherwise(F.array().cast("array<string>")).alias("authors"))
    found = rows.select(F.col("c_custkey").alias("document_id"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("title"), F.array(F.lit("found")).alias("authors"))
    return structure.with_structure(documents, found).select("document_id", "title", "heading", F.get("authors", F.lit(0)).alias("author"))


@query("SELECT n_nationkey AS id, CASE n_nationkey % 4 WHEN 0 THEN 'dim' WHEN 1 THEN 'etdms' WHEN 2 THEN 'oai_dc' ELSE 'oai_dc' END AS prefix FROM nation")
def prefix_choice(spark, d):
    kinds = F.array(F.array(F.lit("oai_dc"), F.lit("dim")), F.array(F.lit("qdc"), F.lit("etdms")), F.array(F.lit("oai_dc")), F.array(F.lit("marc")))
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), harvest.chosen_prefix(F.element_at(kinds, (F.col("n_nationkey") % 4 + 1).cast("int"))).alias("prefix"))


@query("SELECT n_regionkey AS id, list_sort(list(n_name))[1:60] AS thesis_sets FROM nation WHERE regexp_matches(n_name, '(?i)thes|dissert|etd|doctor|phd|promot|論文|学位') GROUP BY n_regionkey UNION ALL SELECT r_regionkey + 100, ['etd_' || r_name] FROM region")
def thesis_like_sets(spark, d):
    sets = table(spark, d, "nation").select(F.col("n_regionkey").alias("id"), F.col("n_name").alias("set_spec"), F.lit("").alias("set_name"))
    more = table(spark, d, "region").select((F.col("r_regionkey") + 100).alias("id"), F.concat(F.lit("etd_"), "r_name").alias("set_spec"), F.lit("x").alias("set_name"))
    return harvest.thesis_sets(sets.unionByName(more))


@query("SELECT doc_id FROM documents WHERE doc_id % 4 <> 2")
def level_filter(spark, d):
    level = F.element_at(F.array(*map(F.lit, ["doctoral", "unspecified", "master", "doctoral"])), (F.col("doc_id") % 4 + 1).cast("int"))
    return harvest.level_filter(table(spark, d, "documents").withColumn("level", level), "doctoral").select("doc_id")


@query("""SELECT user_id, count(*) AS events, CASE WHEN max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 THEN 'file changed since it was bound' WHEN count(*) FILTER (WHERE event_type = 'signup') = 0 THEN 'no binding' END AS error FROM events GROUP BY user_id""")
def binding_revalidation(spark, d):
    """Users as files: one with an error event has changed since it was bound, one without a signup was never bound."""
    users = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.max((F.col("event_type") == "error").cast("int")).alias("changed"), F.max((F.col("event_type") == "signup").cast("int")).alias("signed"))
    sources = users.select(F.col("user_id").alias("path"), F.concat(F.lit("v"), F.col("changed").cast("string")).alias("fingerprint"), "events")
    links = users.where("signed = 1 OR changed = 1").select(F.col("user_id").alias("path"), F.lit("v0").alias("fingerprint"))
    return bindings.bound(sources, links).select(F.col("path").alias("user_id"), "events", "error")

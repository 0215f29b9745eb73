"""A postings index over chunks and BM25 search with page citations.

Scores follow the public Okapi/BM25 formula with column weights: k1 = 1.2, b = 0.75, length over all three columns, and an
idf floor of 1e-6. Higher is better here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexflow.functions.text import CJK, casefold, fold_marks, query_terms

K1, B, IDF_FLOOR = 1.2, 0.75, 1e-6
# How much a match counts in the body and in the helper terms. The title only lengthens a chunk.
WEIGHTS = {"body": 1.0, "terms": 0.2}
UNTITLED = "Untitled document"
BROADCAST_TERMS = 500_000


def tokens(column: Column, parity: bool = False) -> Column:
    """Index tokens: runs of letters and digits without case or diacritics. Sharp s is ss unless ``parity`` keeps it."""
    folded = fold_marks(column) if parity else fold_marks(casefold(column))
    return F.regexp_extract_all(F.coalesce(folded, F.lit("")), F.lit(r"([\p{L}\p{N}]+)"), 1)


def indexable(page: Column, flags: Column, text: Column) -> Column:
    """Chunks with a page, not flagged as low text, and not blank."""
    return F.coalesce(page > 0, F.lit(False)) & ~F.coalesce(F.array_contains(flags, "low_text_page"), F.lit(False)) & (F.trim(F.coalesce(text, F.lit(""))) != "")


def _weighted(terms: Column, weight: float) -> Column:
    return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(weight).alias("w")))


def postings(chunks: DataFrame, parity: bool = False, wanted: DataFrame | list[str] | None = None) -> DataFrame:
    """``chunk_id, term, tf`` of body and helper terms (columns chunk_id, title, body), weighted; only of ``wanted`` terms if given.

    Unwanted terms go before anything is grouped. A frame of wanted terms is broadcast if it is small, and joined otherwise.
    """
    helper = F.when(F.col("body").rlike(f"[{CJK}]"), query_terms(F.col("body"), None)).otherwise(F.array().cast("array<string>"))
    columns = {"body": tokens(F.col("body"), parity), "terms": F.flatten(F.transform(helper, lambda t: tokens(t, parity)))}
    weighted = [_weighted(found, WEIGHTS[name]) for name, found in columns.items()]
    rows = chunks.select("chunk_id", F.explode(F.concat(*weighted)).alias("p")).select("chunk_id", "p.term", "p.w")
    if isinstance(wanted, DataFrame):
        rows = rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted, "term", "left_semi")
    elif wanted is not None:
        rows = rows.where(F.col("term").isin(wanted)) if wanted else rows.where(F.lit(False))
    return rows.groupBy("chunk_id", "term").agg(F.sum("w").alias("tf"))


def lengths(chunks: DataFrame, parity: bool = False) -> DataFrame:
    """``chunk_id, length``: tokens of title, body and helper terms."""
    helper = F.when(F.col("body").rlike(f"[{CJK}]"), F.array_join(query_terms(F.col("body"), None), " ")).otherwise(F.lit(""))
    total = sum((F.size(tokens(c, parity)) for c in (F.col("body"), helper)), F.size(tokens(F.coalesce(F.col("title"), F.lit(UNTITLED)), parity)))
    return chunks.select("chunk_id", total.cast("long").alias("length"))


def write_index(chunks: DataFrame, destination: str, parity: bool = False) -> None:
    """Writes chunks, their postings in order of terms, and their lengths, once for all searches, at a new place."""
    chunks.write.mode("errorifexists").parquet(f"{destination}/chunks")
    stored = chunks.sparkSession.read.schema(chunks.schema).parquet(f"{destination}/chunks")
    postings(stored, parity).repartition("term").sortWithinPartitions("term").write.mode("errorifexists").parquet(f"{destination}/postings")
    lengths(stored, parity).write.mode("errorifexists").parquet(f"{destination}/lengths")


def scores(chunks: DataFrame, terms: list[str] | DataFrame, parity: bool = False, stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``chunk_id, score`` (with ``query_id`` for a frame of query_id, term) of all chunks that hold a term in body or helper terms.

    Only postings of the queries' terms are shuffled. With ``stored`` postings and lengths no chunk is read, and only the
    row groups of postings that may hold the terms are.
    """
    spark = chunks.sparkSession
    many = isinstance(terms, DataFrame)
    wanted = terms if many else spark.createDataFrame([(0, t) for t in terms], "query_id int, term string")
    stats = stored[1] if stored else lengths(chunks, parity)
    total = stats.agg(F.count(F.lit(1)).alias("N"), F.avg("length").alias("mean")).first()
    size, mean = total["N"], total["mean"] or 1.0
    if stored:
        found = stored[0].join(wanted.select("term").distinct(), "term", "left_semi") if many else stored[0].where(F.col("term").isin(terms))
    else:
        found = postings(chunks, parity, wanted.select("term").distinct() if many else terms)
    df = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(size) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(idf <= 0, F.lit(IDF_FLOOR)).otherwise(idf)
    rows = found.join(df, "term").join(stats, "chunk_id").join(wanted, "term")
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    keys = ["query_id", "chunk_id"] if many else ["chunk_id"]
    whole = F.sum(part.cast("decimal(28,18)")).cast("double")  # equal chunks tie, in whatever order their parts are summed
    return rows.groupBy(*keys).agg(whole.alias("score"))


def search(chunks: DataFrame, query: str, limit: int = 5, license: str | None = None, role: str | None = None, parity: bool = False, stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``rank, score, excerpt, text`` and citation columns of the best ``limit`` pages.

    ``chunks``: chunk_id, document_id, title, body, page_start, page_end, and optionally license, content_role and further
    citation columns. A page counts once, by its best chunk, within a pool of the best 20 * limit (2000 at most) chunks, so
    fewer than ``limit`` may be found. A query without terms finds nothing.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be from 1 to 100")
    spark = chunks.sparkSession
    row = spark.range(1).select(query_terms(F.lit(query)).alias("t")).first()["t"]
    terms = spark.createDataFrame([(t,) for t in row], "t string").select(F.explode(tokens(F.col("t"), parity)).alias("term")).distinct()
    terms = [r["term"] for r in terms.collect()]  # 64 terms at most
    hits = scores(chunks, terms, parity, stored).join(chunks, "chunk_id")
    if license is not None:
        hits = hits.where(F.coalesce(F.col("license"), F.lit("unknown")) == license)
    if role is not None:
        hits = hits.where(F.col("content_role") == role)
    return page_hits(hits, limit).withColumn("excerpt", excerpt(F.col("body"), terms)).withColumnRenamed("body", "text")


def page_hits(hits: DataFrame, limit: int) -> DataFrame:
    """The best ``limit`` pages of scored chunks, ranked, from a pool of min(20 * limit, 2000)."""
    pool = hits.orderBy(F.desc("score"), "chunk_id").limit(min(20 * limit, 2000))
    once = F.row_number().over(Window.partitionBy("document_id", "page_start", "page_end").orderBy(F.desc("score"), "chunk_id"))
    best = pool.withColumn("__n", once).where("__n = 1").drop("__n").orderBy(F.desc("score"), "chunk_id").limit(limit)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "chunk_id")))  # limit rows


def excerpt(body: Column, terms: list[str], size: int = 40) -> Column:
    """The ``size`` words around the first match, with matches in brackets."""
    pattern = "|".join(sorted(terms, key=lambda t: (-len(t), t))) or "$^"  # terms are letters and digits only
    parts = F.split(F.trim(body), r"\s+")
    first = F.coalesce(F.array_position(F.transform(parts, lambda w: fold_marks(casefold(w)).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{pattern})(?![\p{{L}}\p{{N}}])")), F.lit(True)), F.lit(1))
    begin = F.greatest(F.lit(1), first - size // 4).cast("int")
    window = F.transform(F.slice(parts, begin, size), lambda w: F.when(fold_marks(casefold(w)).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{pattern})(?![\p{{L}}\p{{N}}])"), F.concat(F.lit("["), w, F.lit("]"))).otherwise(w))
    return F.concat(F.when(begin > 1, F.lit(" … ")).otherwise(F.lit("")), F.array_join(window, " "), F.when(begin + size <= F.size(parts), F.lit(" … ")).otherwise(F.lit("")))


def guard_versions(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` (document_id, profile); a document with several profiles fails the job."""
    twice = documents.select("document_id", "profile").distinct().groupBy("document_id").count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError("a document has several versions: choose one profile")
    return documents


def index_receipt(chunks: DataFrame) -> DataFrame:
    """``documents, chunks, excluded`` of chunks (document_id, page_start, quality_flags, body)."""
    good = indexable(F.col("page_start"), F.col("quality_flags"), F.col("body"))
    return chunks.agg(F.count_distinct("document_id").alias("documents"), F.count_if(good).alias("chunks"), F.count_if(~good).alias("excluded"))


def render(query: str, hits: DataFrame) -> str:
    """A small Markdown report of at most 100 hits."""
    out = [f"# Evidence for: {query}", ""]
    for r in hits.orderBy("rank").limit(100).collect():
        out += [f"## [{r['rank']}] {r['title'] or r['document_id']}, pages {r['page_start']} to {r['page_end']}", "", r["excerpt"], ""]
    return "\n".join(out) + "\n"

"""Near-duplicate candidates by SimHash: classes of equal signatures, and close classes found by permuted bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexflow.functions.signatures import DISTANCE, bands
from codexflow.sources.shared import stored

ACTION = "review_candidate"
# Texts in a batch: bytes of those that go to Python, and number of those read at once. Spark takes 64 MB or 10,000, and 4,096.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20), "spark.sql.parquet.columnarReaderBatchSize": "256"}


def _hamming(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))).cast("int")


def _known(signatures: DataFrame) -> DataFrame:
    """Signed documents, written down once: every step below reads them again.

    Null signatures are left out of what is read, not of what is written: Spark would push that filter below a signature made in
    Python, and make each one twice. Meanwhile texts are held in small batches.
    """
    conf = signatures.sparkSession.conf
    before = {k: conf.get(k) for k in BATCHES}
    try:
        for k, v in BATCHES.items():
            conf.set(k, v)
        known = stored(signatures.select("doc_id", "simhash"))
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return known.where(F.col("simhash").isNotNull())


def close_classes(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b, hamming_distance`` of distinct signatures (column simhash) at most ``distance`` bits apart, a < b.

    Three differing bits touch three of six blocks at most, so that two signatures agree in one of the 20 choices of three
    blocks. A band holds 30 bits or more: at 10^9 signatures a bucket still holds one on average. A pair comes from its
    first common band alone, which saves a distinct over all candidates. Bands are never broadcast: Spark estimates an exploded
    table at the size of its input, a twentieth of what the driver would have to hold.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the bands find pairs of up to {DISTANCE} bits only")
    banded = classes.select("simhash", F.posexplode(bands(F.col("simhash"))).alias("band", "value"))
    left, right = banded.withColumnRenamed("simhash", "a"), banded.withColumnRenamed("simhash", "b")
    same = F.transform(F.arrays_zip(bands(F.col("a")).alias("x"), bands(F.col("b")).alias("y")), lambda z: z["x"] == z["y"])
    met = left.join(right.hint("merge"), ["band", "value"]).where("a < b").where(_hamming("a", "b") <= distance)
    return met.where(F.array_position(same, F.lit(True)) == F.col("band") + 1).select("a", "b", _hamming("a", "b").alias("hamming_distance"))


def near_pairs(signatures: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``left_id, right_id, hamming_distance`` that link all signatures (doc_id, simhash) at most ``distance`` bits apart.

    The document with the smallest id represents those of an equal signature. Rows are pairs of representatives, the smaller
    one left, and each further document right of its representative at distance 0. All pairs follow from these rows: m copies
    take m - 1 of them, not m * (m - 1) / 2. Documents without a signature, null, are in no row; ids are distinct and not null.
    """
    known = _known(signatures)
    classes = known.groupBy("simhash").agg(F.min("doc_id").alias("rep"))
    close = close_classes(classes, distance)
    close = close.join(classes.select(F.col("simhash").alias("a"), F.col("rep").alias("x")), "a").join(classes.select(F.col("simhash").alias("b"), F.col("rep").alias("y")), "b")
    copies = known.join(classes, "simhash").where("doc_id <> rep").select(F.col("rep").alias("left_id"), F.col("doc_id").alias("right_id"), F.lit(0).alias("hamming_distance"))
    return close.select(F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id"), "hamming_distance").unionByName(copies)


def _ranked(known: DataFrame, most: int) -> DataFrame:
    """The ``most`` smallest ids of each signature with their ranks; first within salts, so that no task ranks a hot signature alone."""
    salts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = known.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    first = salted.withColumn("at", F.row_number().over(Window.partitionBy("simhash", "salt").orderBy("doc_id"))).where(F.col("at") <= most).select("doc_id", "simhash")
    return first.withColumn("at", F.row_number().over(Window.partitionBy("simhash").orderBy("doc_id"))).where(F.col("at") <= most)


def candidate_report(signatures: DataFrame, digests: DataFrame, most: int = 100_000, distance: int = DISTANCE) -> DataFrame:
    """All pairs of documents (doc_id, simhash) at most ``distance`` bits apart, in order of their ids, at most ``most``.

    ``digests``: doc_id, digest of the normalised text; ``normalized_exact`` tells whether a pair's digests agree, and
    ``truncated`` whether there are more pairs. Their number follows from the sizes of classes. Only pairs that may be among
    the first ``most`` are made: the i-th id of a class with the j-th of another comes after all i * j - 1 other pairs of
    ranks up to these, and within one class after i * j - i * (i + 1) / 2 - 1 of them.
    """
    known = _known(signatures)
    classes = stored(known.groupBy("simhash").agg(F.count(F.lit(1)).alias("n")))
    close = stored(close_classes(classes, distance))
    n = classes.select(F.col("simhash").alias("a"), F.col("n").alias("na")), classes.select(F.col("simhash").alias("b"), F.col("n").alias("nb"))
    sized = close.join(n[0], "a").join(n[1], "b").unionByName(classes.select(F.col("simhash").alias("a"), F.col("simhash").alias("b"), F.lit(0).alias("hamming_distance"), F.col("n").alias("na"), F.col("n").alias("nb")).where("na > 1"))
    number = F.when(F.col("a") == F.col("b"), F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("double")
    truncated = (sized.agg(F.sum(number).alias("s")).first()["s"] or 0) > most
    ranked = _ranked(known, most + 1)
    left, right = ranked.select(F.col("simhash").alias("a"), F.col("doc_id").alias("x"), F.col("at").alias("i")), ranked.select(F.col("simhash").alias("b"), F.col("doc_id").alias("y"), F.col("at").alias("j"))
    alone = F.col("a") == F.col("b")
    low = F.when(alone, F.col("i") + 1).otherwise(F.lit(1)).cast("long")
    high = F.least(F.col("nb"), F.when(alone, F.floor(F.lit(most) / F.col("i") + (F.col("i") + 1) / 2)).otherwise(F.floor(F.lit(most) / F.col("i")))).cast("long")
    ranks = sized.join(left, "a").withColumn("low", low).withColumn("high", high).where("low <= high")
    pairs = ranks.select("b", "x", "hamming_distance", F.explode(F.sequence("low", "high")).alias("j")).join(right.hint("merge"), ["b", "j"])  # exploded rows are more than Spark estimates
    kept = pairs.select(F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id"), "hamming_distance").orderBy("left_id", "right_id").limit(most)
    a, b = digests.select(F.col("doc_id").alias("left_id"), F.col("digest").alias("da")), digests.select(F.col("doc_id").alias("right_id"), F.col("digest").alias("db"))
    rows = kept.join(a, "left_id").join(b, "right_id")
    return rows.select("left_id", "right_id", "hamming_distance", (F.col("da") == F.col("db")).alias("normalized_exact"), F.lit(ACTION).alias("action"), F.lit(truncated).alias("truncated"))

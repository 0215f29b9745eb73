"""Text signatures: a digest of normalised text, and SimHash over word trigrams."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions.text import normalized

DISTANCE = 3
_STRETCH = 1 << 16
# A band is a choice of three of six blocks of a signature, as a mask.
_BLOCKS = [((1 << (64 * (k + 1) // 6)) - 1) ^ ((1 << (64 * k // 6)) - 1) for k in range(6)]
BANDS = [sum(kept) for kept in combinations(_BLOCKS, 6 - DISTANCE)]


def normalized_sha256(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def simhash_of(text: str | None) -> int | None:
    """The 64-bit SimHash of a text by 64-bit BLAKE2b of its word trigrams; None below three words."""
    words = re.findall(r"\w+", " ".join(unicodedata.normalize("NFC", text or "").casefold().split()))
    if len(words) < 3:
        return None
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    ones = np.zeros(64, np.int64)
    for start in range(0, len(grams), _STRETCH):
        raw = b"".join([hashlib.blake2b(g.encode(), digest_size=8).digest() for g in grams[start : start + _STRETCH]])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def _simhashes(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash_of(t) for t in texts], dtype="Int64")


def simhash_blake2b(text: Column) -> Column:
    """SimHash as a signed 64-bit number; null below three words."""
    return F.pandas_udf(_simhashes, "long")(text)


def hex16(signature: Column) -> Column:
    return F.lower(F.lpad(F.hex(signature), 16, "0"))


def simhash_md5(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, simhash`` by the first 60 bits of MD5 of the word trigrams: the same construction inside the JVM.

    Bits are counted in lanes of 21, three to a number, over stretches of 2^20 trigrams, so that no lane runs over. A text's
    trigrams are summed up in the task that made them: what is shuffled is a row for each text and stretch.
    """
    words = F.regexp_extract_all(normalized(F.col(text_col)), F.lit(r"(?U)(\w+)"), 1)
    rows = docs.select(F.col(id_col).alias("doc_id"), words.alias("w")).where(F.size("w") >= 3)
    trigrams = rows.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, 3), " "))).alias("at", "t"))
    hashed = trigrams.select("doc_id", F.shiftright("at", 20).alias("stretch"), F.conv(F.substring(F.md5(F.col("t").cast("binary")), 1, 15), 16, 10).cast("long").alias("h"))

    def bit(k: int) -> Column:
        return F.shiftright("h", k).bitwiseAND(1)

    lanes = [F.sum(bit(k).bitwiseOR(F.shiftleft(bit(k + 20), 21)).bitwiseOR(F.shiftleft(bit(k + 40), 42))).alias(f"l{k}") for k in range(20)]
    packed = hashed.groupBy("doc_id", "stretch").agg(F.count(F.lit(1)).alias("n"), *lanes)
    ones = [F.sum(F.shiftright(f"l{k % 20}", 21 * (k // 20)).bitwiseAND((1 << 21) - 1)).alias(f"b{k}") for k in range(60)]
    whole = packed.groupBy("doc_id").agg(F.sum("n").alias("n"), *ones)
    value = F.lit(0).cast("long")
    for k in range(60):
        value = value + F.when(2 * F.col(f"b{k}") > F.col("n"), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return whole.select("doc_id", value.alias("simhash"))


def bands(signature: Column) -> Column:
    """The signature under each mask of BANDS: two that differ in up to DISTANCE bits agree under one of them."""
    return F.array(*(signature.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")) for mask in BANDS))

"""Frames that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score string, n_tokens string, label string, component_id int, text_sha256 int, gone_id int, gone0 string, Gone1 string, doc int, rep int, content int, held_out string, lang_pred int, row int, spans int, token int, chunk int, bucket int, signature int, local int"
WORDS = "the of and river stone cloud winter garden letter seven open road quiet morning window paper small light north idiot water field".split()


def ascii_lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)

    def prose(n: int) -> str:
        return " ".join(rng.choice(WORDS) for _ in range(n))

    base = prose(120).split()
    near = base[:60] + ["changed"] + base[61:]
    out: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "One"), (5, "one"), (6, "ONE"), (7, "a b c d"), (8, "a  b\nc d"), (9, " ".join(base)), (10, " ".join(base).upper()), (11, " ".join(near)), (12, prose(6000)),
        (13, "x" * 5000), (14, "日本語 テキスト ñandú É ß"), (15, "12345 !!! ??? ..."), (None, "no id here"), (None, None), (16, "same row"), (16, "same row"), (17, " ".join(base[:40] + prose(40).split())), (18, "<|endoftext|> </s> <unk> ▁ marks"),
    ]
    out.append((19, "river  stone\n" * 9000 + "end"))  # more than any piece or chunk of a test, and many equal grams
    out += [(100 + k, prose(rng.randint(1, 60))) for k in range(40)]
    out += [(200 + k, " ".join(base[: 110 + k])) for k in range(8)]
    return out


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, ["en", "de", None][k % 3], "s", len(t or ""), "x", None, "y", None, 5, 6, 7, "a", "b", 8, 9, 10, "z", *range(8)) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=None):
    rows = [(i, k % 2, int("idiot" in (t or "")), "z") for k, (i, t) in enumerate(texts())] if rows is None else rows
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")

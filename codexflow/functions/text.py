"""Column functions over page text, headings, sections, years and query terms."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The titles that count as unnumbered headings.
HEADING_TITLES = (
    r"abstract|introduction|background|related work|methods?|methodology|materials and methods|results|discussion|conclusions?|"
    r"references|bibliography|acknowledg[e]?ments|appendix(?: [A-Z])?|摘要|緒論|結論|參考文獻"
)
# The form of numbered headings, and how long one may be.
NUMBERED = r"^([0-9]+(?:\.[0-9]+){0,5})[.)]?\s+([A-Za-z\x{3400}-\x{9fff}].{1,100})$"
HEADING_MOST = 110
# Words in a section path that give a content role, in order of precedence.
ROLE_WORDS = [
    ("references", "reference|bibliograph|參考文獻"),
    ("acknowledgements", "acknowledg|dedication|致謝"),
    ("abstract", "abstract|摘要"),
    ("appendix", "appendix|appendices|附錄"),
]
# Latin ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
CJK = r"\x{3400}-\x{9fff}"


def casefold(column: Column) -> Column:
    """Lower case with sharp s as ss: equal to full case folding on Latin text."""
    return F.replace(F.lower(column), F.lit("ß"), F.lit("ss"))


def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(column: Column) -> Column:
    """Canonical composition; Spark has no such function."""
    return F.pandas_udf(_composed, "string")(column)


def normal(column: Column, compose: bool = True) -> Column:
    """Composed text with ligatures spelled out and no-break spaces as spaces. ``compose=False`` keeps it in the JVM."""
    out = nfc(column) if compose else column
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return F.replace(out, F.lit(" "), F.lit(" "))


def alnum_count(column: Column) -> Column:
    """How many letters and digits a text has."""
    return F.length(F.regexp_replace(F.coalesce(column, F.lit("")), r"[^\p{L}\p{N}]", ""))


def is_sparse(column: Column, min_chars: int = 40) -> Column:
    """Whether a page has fewer letters and digits than ``min_chars``."""
    return alnum_count(column) < min_chars


def heading_level(line: Column) -> Column:
    """1 for a common title, the depth of its number for a numbered heading, null for any other line."""
    line = F.trim(line)
    number = F.regexp_extract(line, NUMBERED, 1)
    depth = F.least(F.lit(6), F.length(number) - F.length(F.replace(number, F.lit("."))) + 1)
    numbered = line.rlike(NUMBERED) & (F.length(line) <= HEADING_MOST) & ~line.rlike(r"[.;,]$")
    return F.when(line.rlike(f"(?i)^(?:{HEADING_TITLES})$"), F.lit(1)).when(numbered, depth).cast("int")


def content_role(section_path: Column) -> Column:
    """The role of a section by its path (array of titles)."""
    title = F.lower(F.array_join(section_path, " "))
    out = F.when(title.rlike(ROLE_WORDS[0][1]), F.lit(ROLE_WORDS[0][0]))
    for role, words in ROLE_WORDS[1:]:
        out = out.when(title.rlike(words), F.lit(role))
    return out.when(F.size(section_path) > 0, F.lit("body")).otherwise(F.lit("front_or_unclassified"))


def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t).casefold())


def normalized(column: Column) -> Column:
    """Composed, case-folded text with every run of white space as one space.

    Only texts with characters whose composition or folding the JVM's ``lower`` does not give (the micro sign, and all from
    U+0149 or U+017F on) pass through Python.
    """
    text = F.coalesce(column, F.lit(""))
    odd = text.rlike(r"[\x{B5}\x{149}\x{17F}-\x{10FFFF}]")
    folded = F.coalesce(F.pandas_udf(_folded, "string")(F.when(odd, text)), casefold(text))
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def year_of(date: Column, datestamp: Column) -> Column:
    """The first year from 1600 to 2049 in a date, else in a datestamp, else the empty text."""
    pattern = r"(1[6-9][0-9]{2}|20[0-4][0-9])"
    found = [F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1), F.lit("")) for c in (date, datestamp)]
    return F.coalesce(*found, F.lit(""))


def decade_of(year: Column) -> Column:
    """A year's decade, as in 1990s, or unknown."""
    return F.when(year == "", F.lit("unknown")).otherwise(F.concat(F.substring(year, 1, 3), F.lit("0s")))


def query_terms(column: Column, limit: int | None = 64) -> Column:
    """Distinct search terms in order: case-folded runs of letters and digits, and the pairs of runs of Chinese characters."""
    runs = F.regexp_extract_all(casefold(F.coalesce(column, F.lit(""))), F.lit(rf"([{CJK}]+|[\p{{L}}\p{{N}}&&[^{CJK}]]+)"), 1)

    def terms(run: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
        return F.when(run.rlike(rf"^[{CJK}]{{2,}}$"), pairs).otherwise(F.array(run))

    # a run that mixes Chinese with other characters begins with what the pattern meets first and stops where that ends
    found = F.array_distinct(F.flatten(F.transform(runs, terms)))
    return found if limit is None else F.slice(found, 1, limit)


def chunk_count(length: Column, size: int, overlap: int) -> Column:
    """How many windows of ``size`` characters, ``overlap`` shared, cover a text without paragraph breaks."""
    return F.when(length <= 0, F.lit(0)).when(length <= size, F.lit(1)).otherwise(F.ceil((length - overlap) / (size - overlap))).cast("int")


def flat_values(column: Column) -> Column:
    """An array as one text with bars between, white space collapsed."""
    return F.trim(F.regexp_replace(F.array_join(column, " | "), r"\s+", " "))


def _marked() -> tuple[str, str]:
    """Lower-case letters below U+2000 that are a letter with marks, and those letters."""
    parts = {c: unicodedata.normalize("NFD", c) for c in map(chr, range(0xC0, 0x2000)) if c == c.lower()}
    marked = {c: d[0] for c, d in parts.items() if len(d) > 1 and all(unicodedata.category(x) == "Mn" for x in d[1:])}
    return "".join(marked), "".join(marked.values())


MARKED, BARE = _marked()


def fold_marks(column: Column) -> Column:
    """Lower case without diacritics, composed or not, as index tokens are folded; sharp s stays."""
    return F.regexp_replace(F.translate(F.lower(column), MARKED, BARE), r"\p{Mn}+", "")

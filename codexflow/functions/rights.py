"""Levels, access and licence classes from metadata, and licences from explicit evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a level of study, in order of precedence.
LEVEL_WORDS = [
    ("doctoral", r"doctor|ph\.?\s?d|dr\.?rer|dissertation|habilitation|博士|doktor"),
    ("master", r"master|m\.?sc|m\.?phil|m\.?a\b|magister|licentiate|碩士"),
    ("bachelor", r"bachelor|undergraduate|diplomarbeit|學士"),
]
# Words that mark a thesis by type, and sets that look like theses.
THESIS_TYPES = r"thes|dissert|doctoral|ph\.?d|masters?|学位論文|etd"
THESIS_SETS = r"thes|dissert|etd|doctor|phd|promot|論文|学位"
# Words of open and of closed access; closed words win.
OPEN_WORDS = r"open.?access|openaccess|creative ?commons|cc[ -]?by|public domain|no restriction"
CLOSED_WORDS = r"embargo|restricted|closed access|controlled.?access|metadata.?only|request a copy|not available"
# Licence classes and their marks, in order of precedence.
LICENCE_WORDS = [
    ("cc0/public-domain", r"creativecommons\.org/publicdomain|\bcc0\b|public domain"),
    ("cc-by-nc-nd", r"licenses/by-nc-nd|cc[ -]?by[ -]?nc[ -]?nd"),
    ("cc-by-nc-sa", r"licenses/by-nc-sa|cc[ -]?by[ -]?nc[ -]?sa"),
    ("cc-by-nc", r"licenses/by-nc|cc[ -]?by[ -]?nc"),
    ("cc-by-nd", r"licenses/by-nd|cc[ -]?by[ -]?nd"),
    ("cc-by-sa", r"licenses/by-sa|cc[ -]?by[ -]?sa"),
    ("cc-by", r"licenses/by/|cc[ -]?by\b"),
    ("in-copyright", r"rightsstatements\.org|in ?copyright|all rights reserved|©"),
    ("open-unspecified", OPEN_WORDS),
]
# Licence paths that count as explicit evidence, most specific first.
EVIDENCE_PATHS = ["by-nc-nd", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by"]
# What an exact licence filter calls the classes that metadata rules name otherwise.
TO_EVIDENCE_NAMES = {"cc0/public-domain": "cc0", "in-copyright": "all-rights-reserved", "open-unspecified": "unknown"}


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str, flags: str = "(?i)") -> Column:
    """The name of the first rule whose pattern occurs in ``text``."""
    out = F.when(text.rlike(flags + rules[0][1]), F.lit(rules[0][0]))
    for name, pattern in rules[1:]:
        out = out.when(text.rlike(flags + pattern), F.lit(name))
    return out.otherwise(F.lit(otherwise))


def level(text: Column) -> Column:
    return first_match(text, LEVEL_WORDS, "unspecified")


def access(text: Column) -> Column:
    return first_match(text, [("restricted_or_embargo", CLOSED_WORDS), ("open", OPEN_WORDS)], "unknown")


def licence_class(text: Column) -> Column:
    return first_match(text, LICENCE_WORDS, "unknown")


def licence_from_evidence(text: Column) -> Column:
    """Only a licence URL, the CC0 URL or the words all rights reserved are evidence; open access is none."""
    rules = [(f"cc-{path}", rf"creativecommons\.org/licenses/{path}/") for path in EVIDENCE_PATHS]
    return first_match(F.lower(text), [*rules, ("cc0", r"creativecommons\.org/publicdomain/zero/"), ("all-rights-reserved", r"all rights reserved|all-rights-reserved")], "unknown", "")


def common_licence(licence: Column) -> Column:
    """A metadata licence class in the vocabulary of the evidence rule."""
    out = licence
    for name, other in TO_EVIDENCE_NAMES.items():
        out = F.when(licence == name, F.lit(other)).otherwise(out)
    return out


def is_thesis(types: Column, qualification: Column, sets: Column, thesis_sets: list[str] = (), strict: bool = False) -> Column:
    """By type words, by membership of a thesis set, or (unless ``strict``) by any qualification at all."""
    text = F.concat_ws(" ", types, F.array(F.coalesce(qualification, F.lit(""))), sets)
    out = text.rlike(f"(?i){THESIS_TYPES}")
    if thesis_sets:
        out = out | F.arrays_overlap(sets, F.array(*map(F.lit, thesis_sets)))
    return out if strict else out | (F.coalesce(qualification, F.lit("")) != "")

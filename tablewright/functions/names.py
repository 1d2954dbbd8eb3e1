"""Postal codes and organisation names (native expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.text import found, pattern, removed, trimmed
from tablewright.rules import (
    NAME_SPELLINGS,
    NAME_TAILS,
    POSTAL_AFTER_BLANK,
    POSTAL_AFTER_COMMA,
    TOWN_SUFFIXES,
)


def split_postal_code(column: Column) -> tuple[Column, Column]:
    """``(name without the postal tail, postal code or null)``.

    The comma form wins; the blank form needs a town behind the code.
    """
    name = trimmed(column)
    by_comma = found(name, POSTAL_AFTER_COMMA, 1)
    by_blank = found(name, POSTAL_AFTER_BLANK, 1)
    bare = (
        F.when(by_comma.isNotNull(), removed(name, POSTAL_AFTER_COMMA))
        .when(by_blank.isNotNull(), removed(name, POSTAL_AFTER_BLANK))
        .otherwise(name)
    )
    return trimmed(bare), F.coalesce(by_comma, by_blank)


def without_town(column: Column) -> Column:
    """Drop a trailing ``, <town>`` for the known towns."""
    return removed(column, rf",\s+(?:{TOWN_SUFFIXES})$")


def tidy_punctuation(column: Column) -> Column:
    """Trailing dot, comma runs, trailing comma, blank runs, blanks after hyphens."""
    column = removed(column, r"\s*\.\s*$")
    column = F.regexp_replace(column, pattern(r",\s*,+"), ",")
    column = removed(column, r",\s*$")
    column = F.regexp_replace(column, pattern(r"\s+"), " ")
    return F.regexp_replace(column, pattern(r"-\s+"), "- ")


def unify_spellings(column: Column) -> Column:
    """Whole-word spellings of legal forms and institution nouns."""
    for word, spelling in NAME_SPELLINGS:
        column = F.regexp_replace(column, pattern(rf"\b{word}\b"), spelling)
    return column


def without_tail(column: Column) -> Column:
    """Drop redundant department, site and library suffixes."""
    for tail in NAME_TAILS:
        column = removed(column, tail)
    return column


def normalize_name(column: Column) -> Column:
    """All name rules in order; null stays null."""
    column = without_town(trimmed(column))
    return trimmed(without_tail(unify_spellings(tidy_punctuation(column))))

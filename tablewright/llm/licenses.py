"""License scan by a positional index of rare words, in DataFrame functions only.

A template is a sequence of words with a mandatory key phrase in it.  The inverse document
frequencies of the key phrases' words come from the whole corpus; each template is looked up
by its rarest key word.  Where a file has that word, the place at which the template would
have to begin follows from the word's position in it, and the template's other words must
stand at their relative positions: all words of the key phrase, and a share of the rest.
Every true place has every key word, so looking at the rarest alone loses none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import narrowed

# The phrases that are always looked for, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further texts (label, words, key phrase) of common licences.
TEXTS = (
    ("apache", "licensed under the apache license version 2 0", "apache license version 2"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted", "redistribution and use in source and binary forms"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license",
     "terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)

#: What separates words: every ASCII character but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        size = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + size] == self.key)


def templates() -> list[Template]:
    base = [Template(label, tuple(p.split()), tuple(p.split()), True)
            for p, label in PHRASES.items()]
    return base + [Template(label, tuple(words.split()), tuple(key.split()))
                   for label, words, key in TEXTS]


def _lowered(word: Column) -> Column:
    return F.translate(word, _UPPER, _LOWER)


def _any_of(words: set[str]) -> str:
    return f"(?i)^(?:{'|'.join(sorted(words))})$"  # without (?u): ASCII letters only


def words_of(text: Column) -> Column:
    """The words of a text as written; null as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def document_frequencies(df: DataFrame, found: list[Template], text: str = "text") -> dict[str, int]:
    """In how many rows each word of the key phrases stands; a row for each word at most."""
    wanted = {w for t in found for w in t.key}
    rows = (
        narrowed(df, text=text).select(words_of(F.col("text")).alias("words"))
        .select(F.explode(F.array_distinct(F.transform(
            F.filter("words", lambda w: w.rlike(_any_of(wanted))), _lowered))).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
    )
    return {r["word"]: r["n"] for r in rows.collect()}


def scan(
    df: DataFrame, found: list[Template] | None = None, least: float = 0.8,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(key, n_words, places, labels, score)`` of every row.

    ``places``: ``(label, first, words, coverage, base)`` of every place where a template's
    key phrase stands whole and at least ``least`` of all its words stand where they belong;
    ``first`` is the number of the key phrase's first word, from 0.  ``labels``: the distinct
    labels, sorted.  ``score``: the largest coverage, 0 without a place.  Null and empty texts
    have no words and no places.  Repeated rows and null keys stay rows of their own; an empty
    table gives an empty table.
    """
    found = templates() if found is None else found
    counts = document_frequencies(df, found, text)
    anchors = [min(range(len(t.key)), key=lambda i: (counts.get(t.key[i], 0), i)) for t in found]
    rare = {t.key[a] for t, a in zip(found, anchors, strict=True)}

    rows = narrowed(df, key=key, text=text)
    rows = rows.select("key", words_of(F.col("text")).alias("words"))
    rows = rows.select(
        "key", "words",
        F.filter(
            F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
            lambda s: s["w"].rlike(_any_of(rare))).alias("rare"))
    rows = rows.select("key", "words", F.transform(
        "rare", lambda s: F.struct(_lowered(s["w"]).alias("w"), s["i"].alias("i"))).alias("rare"))

    def at(begin: Column, count: int) -> Column:
        """``count`` words from ``begin`` (from 0) on, fewer at the end of the text."""
        return F.transform(F.slice("words", begin + 1, count), _lowered)

    def places(t: Template, anchor: int) -> Column:
        wanted = F.array(*map(F.lit, t.key))
        whole = F.array(*map(F.lit, t.words))
        begins = F.transform(
            F.filter("rare", lambda s: (s["w"] == t.key[anchor]) & (s["i"] >= anchor)),
            lambda s: s["i"] - anchor)
        begins = F.filter(begins, lambda b: at(b, len(t.key)) == wanted)

        def place(b: Column) -> Column:
            begin = b - t.key_at  # of the template; its first words may be cut off
            cut = F.greatest(-begin, F.lit(0))
            read = at(F.greatest(begin, F.lit(0)), len(t.words))
            same = F.zip_with(
                read, F.slice(whole, cut + 1, len(t.words)),
                lambda a, c: F.when(a == c, F.lit(1)).otherwise(F.lit(0)))
            matched = F.aggregate(same, F.lit(0), lambda x, y: x + y)
            return F.struct(
                F.lit(t.label).alias("label"), b.alias("first"),
                F.lit(len(t.key)).alias("words"),
                (matched / F.lit(float(len(t.words)))).alias("coverage"),
                F.lit(t.base).alias("base"))

        kind = "array<struct<label:string,first:int,words:int,coverage:double,base:boolean>>"
        return F.filter(F.transform(begins, place), lambda p: p["coverage"] >= least).cast(kind)

    all_places = F.concat(*[places(t, a) for t, a in zip(found, anchors, strict=True)])
    none = F.filter(all_places, lambda p: F.lit(False))
    rows = rows.select(
        "key", F.size("words").cast("long").alias("n_words"),
        F.when(F.size("rare") > 0, all_places).otherwise(none).alias("places"))
    return rows.select(
        F.col("key").alias(key), "n_words", "places",
        F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["coverage"])),
                   F.lit(0.0)).alias("score"))

"""Merge near-identical names into their most frequent spelling.

Blocking follows from the similarity itself.  Two strings of lengths a and b whose
indel similarity is at least t share at least (1.5 t - 1)(a + b) - 1 bigrams, counted
with repetition, and the shorter one has at least t / (2 - t) times the length of the
longer.  With all bigrams in one global order (rarest first), any two similar names
therefore meet in the first few bigrams of both, and the longer the required overlap,
the more of them they share: most names are blocked by *pairs* of rare bigrams.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.similarity import Beginnings, indel_score, length_allows
from tablewright.operators.leaders import absorb_blocks, absorb_crowds
from tablewright.rules import DEFAULT_RULES
from tablewright.shared import written

_LONG = 64
_LOWEST_SCORE = 75


class _Bounds:
    """Length limits that follow from the similarity threshold (in percent)."""

    def __init__(self, score: int) -> None:
        if not _LOWEST_SCORE <= score <= 100:
            raise ValueError(f"the similarity threshold has to be {_LOWEST_SCORE} to 100")
        t = score / 100
        self.slope = (1.5 * t - 1) * 2 / (2 - t)
        self.ratio = t / (2 - t)
        # longest names for which no shared bigram / only one is guaranteed
        self.none = floor(1 / self.slope + 1e-9)
        self.single = floor(2 / self.slope + 1e-9)

    def overlap(self, length: Column) -> Column:
        """Bigrams a name of this length shares with any similar name, at least."""
        return F.ceil(length * self.slope - 1 - 1e-9)

    def partner(self, length: int) -> int:
        """Longest name that can be similar to one of this length."""
        return floor(length / self.ratio + 1e-9)


def name_blocks(names: DataFrame, score: int = DEFAULT_RULES.name_score) -> DataFrame:
    """``names(node, rank)`` to ``(block, node, rank)``: every two names that are at
    least ``score`` percent similar (lower-cased) share a block."""
    bounds = _Bounds(score)
    text = F.lower("node")
    low = names.select("node", text.alias("low"), F.length(text).alias("length"))

    # Bigrams counted with repetition: the k-th occurrence is an element of its own.
    grams = (
        low.filter("length >= 2")
        .select(
            "node",
            "length",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.col("length") - 1),
                    lambda i: F.substring(F.col("low"), i, F.lit(2)),
                )
            ).alias("gram"),
        )
        .groupBy("node", "length", "gram")
        .agg(F.count("*").alias("times"))
        .select(
            "node", "length", "gram",
            F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"),
        )
    )
    grams = written(grams, "grams")
    frequency = grams.groupBy("gram", "nth").agg(F.count("*").alias("names"))
    ordered = (
        grams.join(frequency, ["gram", "nth"])
        .groupBy("node", "length")
        .agg(F.array_sort(F.collect_list(F.struct("names", "gram", "nth"))).alias("grams"))
        .withColumn("overlap", bounds.overlap(F.col("length")))
    )
    keys = F.transform("grams", lambda g: F.concat_ws("#", g["gram"], g["nth"]))

    def prefix(shared: int) -> Column:
        size = F.size("grams") - F.col("overlap") + shared
        return F.slice(keys, 1, F.least(F.size("grams"), size).cast("int"))

    single = ordered.filter(
        (F.col("overlap") >= 1)
        & (
            (F.col("length") <= bounds.partner(bounds.single))
            | (F.col("length") >= floor(_LONG * bounds.ratio))
        )
    ).select("node", F.explode(F.transform(prefix(1), lambda g: F.concat(F.lit("1 "), g))).alias("block"))

    pairs = ordered.filter((F.col("overlap") >= 2) & (F.col("length") <= _LONG)).select(
        "node", prefix(2).alias("prefix")
    )
    both = F.flatten(
        F.transform(
            F.col("prefix"),
            lambda a, i: F.transform(
                F.slice(F.col("prefix"), i + 2, F.size("prefix")),
                lambda b: F.concat_ws(" ", F.lit("2"), a, b),
            ),
        )
    )
    pairs = pairs.select("node", F.explode(both).alias("block"))

    # Very short names: similar ones share at least a character.
    short = low.filter(F.col("length").between(1, bounds.partner(bounds.none))).select(
        "node",
        F.explode(
            F.array_distinct(
                F.transform(F.split("low", ""), lambda c: F.concat(F.lit("0 "), c))
            )
        ).alias("block"),
    )
    blocks = single.unionByName(pairs).unionByName(short)
    return blocks.join(names, "node").select("block", "node", "rank")


def similar_names(score: int):
    """Pair check for names: native filters first, then the exact similarity."""

    def check(pairs: DataFrame) -> DataFrame:
        near = pairs.filter(
            # The edit distance never exceeds the indel distance.
            F.expr(
                "levenshtein(lower(lo), lower(hi), "
                f"cast(({100 - score} * (length(lo) + length(hi))) div 100 + 1 as int)) >= 0"
            )
        )
        found = indel_score(F.lower("lo"), F.lower("hi"), score)
        return near.withColumn("score", found).filter(F.col("score") >= score)

    return check


def name_mapping(
    df: DataFrame, column: str, score: int = DEFAULT_RULES.name_score,
    head: int = DEFAULT_RULES.block_head,
) -> DataFrame:
    """``(name, canonical)`` for every name that is rewritten.

    Names lead in order of frequency (equal frequency: by value).  A group takes the
    spelling of its most frequent member, the shortest of them if several.
    """
    counts = written(
        df.select(F.col(f"`{column}`").alias("node"))
        .filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count("*").alias("count")),
        "name-counts",
    )
    rank = F.struct((-F.col("count")).alias("minus_count"), F.col("node").alias("name"))
    ranked = counts.select("node", rank.alias("rank"))
    plausible = length_allows(F.lower("lo"), F.lower("hi"), score)
    crowds, rest = absorb_crowds(
        ranked.withColumn("text", F.lower("node")),
        lambda texts: Beginnings(texts, score).percents)
    groups = absorb_blocks(name_blocks(rest, score), similar_names(score), head, plausible)
    groups = written(groups if crowds is None else groups.unionByName(crowds), "name-groups")
    members = groups.select("leader", "node").unionByName(
        groups.select("leader", F.col("leader").alias("node")).distinct()
    )
    order = F.struct(-F.col("count"), F.length("node"), F.col("node"))
    canonical = (
        members.join(counts, "node")
        .groupBy("leader")
        .agg(F.min_by("node", order).alias("canonical"))
    )
    return (
        members.join(canonical, "leader")
        .filter(F.col("node") != F.col("canonical"))
        .select(F.col("node").alias("name"), "canonical")
    )


def consolidate_names(
    df: DataFrame, column: str, score: int = DEFAULT_RULES.name_score,
    head: int = DEFAULT_RULES.block_head,
) -> DataFrame:
    """Rewrite every name to the spelling of its group; null stays null.

    The mapping is a written table of rewritten names only; whether it is broadcast
    is decided by its size.
    """
    mapping = written(name_mapping(df, column, score, head), "name-mapping").select(
        F.col("name").alias("__name"), F.col("canonical").alias("__canonical")
    )
    value = F.col(f"`{column}`")
    return (
        df.join(mapping, value == F.col("__name"), "left")
        .withColumn(column, F.coalesce("__canonical", value))
        .drop("__name", "__canonical")
    )

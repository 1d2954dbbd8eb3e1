"""Mixing sources to target weights by weighted fair queueing.

Every source has a queue: its documents in a shuffled order, pass after pass, each pass
shuffled anew.  A document's virtual finish time is the number of its source's words up to its
end divided by the source's target, so all queues run from 0 to 1.  The documents of all
queues are sorted by that time and the mix is cut off at the total budget.

Targets are shares of the budget by weight.  A target above ``most_passes`` times the size of
its source stops there and the excess is shared by the other sources, again by weight, until
none is above; in closed form, with running totals over the sources by the budget at which
each of them stops.

Nothing is gathered in one place: sources and documents are sorted by range, ranges are summed
up on their own and shifted by the sums of the ranges before.  A source of any size is spread
over many ranges, and so are repeated rows.

Defined results:

* a null or empty text has size 0; it is never queued and 0 of its words are taken;
* a null source is a source of its own, after all others;
* null and repeated keys, and repeated rows, are documents like all others;
* the document in which a queue reaches its target is cut there, so what is taken of a source
  differs from its target by less than a word for each source;
* equal finish times are ordered by source, pass and shuffle; the shuffle depends on key and
  text only, so reruns agree;
* columns other than the named ones play no part; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import narrowed
from tablewright.shared import fan_out, written

WORD = "[^\\x20\\x09-\\x0D]+"


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                   **totals: str) -> DataFrame:
    """``df`` with sums over the rows before each row in its group: ``name="column"``.

    Rows are sorted by range over group and order, so a large group fills many ranges; only
    the sums of the ranges, a row for each range and group in it, are summed up in sequence.
    """
    keys = [F.col(g).asc_nulls_last() for g in group]
    ranges = written(
        df.repartitionByRange(*keys, *order).withColumn("range", F.spark_partition_id()),
        "ranges")
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = ranges.groupBy(*group, "range").agg(
        *[F.sum(column).alias(f"sum_{name}") for name, column in totals.items()])
    shifts = sums.select(*group, "range", *[
        F.coalesce(F.sum(f"sum_{name}").over(before), F.lit(0)).alias(f"shift_{name}")
        for name in totals])
    within = Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    return ranges.join(shifts, [*group, "range"]).select(*df.columns, *[
        (F.coalesce(F.sum(column).over(within), F.lit(0)) + F.col(f"shift_{name}")).alias(name)
        for name, column in totals.items()])


def targets(sizes: DataFrame, weights: Sequence[int], most_passes: int,
            budget: int | None = None) -> DataFrame:
    """``sizes(source, source_size)`` with ``number`` (from 0, in code point order, null last),
    ``weight`` and ``target``.  ``weights`` repeat in the order of the sources."""
    sizes = running_totals(
        sizes.withColumn("one", F.lit(1)), [], [F.col("source").asc_nulls_last()], number="one")
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int"))
    weighed = written(
        sizes.drop("one").withColumn("weight", weight)
        .withColumn("most", F.lit(most_passes) * F.col("source_size"))
        .withColumn("stops", F.col("most").cast("double") / F.col("weight")), "sources")
    whole = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if whole[1] is None:
        return weighed.select("source", "source_size", "number", "weight",
                              F.lit(0.0).alias("target"))
    budget = whole[0] if budget is None else min(budget, most_passes * whole[0])
    filled = written(
        running_totals(weighed, [], ["stops", "number"], most_before="most",
                       weight_before="weight")
        # the level if this source and those that stop later share what is left
        .withColumn("level", (F.lit(budget) - F.col("most_before")).cast("double")
                    / (F.lit(whole[1]) - F.col("weight_before")))
        .withColumn("stopped", F.col("level") * F.col("weight") >= F.col("most")), "targets")
    level = filled.filter(~F.col("stopped")).agg(F.max("level")).first()[0]
    target = F.when(F.col("stopped"), F.col("most").cast("double")).otherwise(
        F.lit(level or 0.0) * F.col("weight"))
    return filled.select("source", "source_size", "number", "weight", target.alias("target"))


class Mix:
    """A mix: the rows of the documents, the targets of their sources, and what is taken."""

    def __init__(self, rows: DataFrame, sources: DataFrame, taken: DataFrame) -> None:
        #: ``(row, key, source, size)``
        self.rows = rows
        #: ``(source, source_size, number, weight, target)``
        self.sources = sources
        #: ``(row, key, source, pass, finish, position, words)``: a row for each document and
        #: pass in the mix; ``position`` counts the words of the mix before it.
        self.taken = taken

    def by_document(self) -> DataFrame:
        """``(key, source, size, source_size, target, taken)``, documents left out included."""
        words = self.taken.groupBy("row").agg(F.sum("words").alias("taken"))
        # new names: rows and sources come from the same table
        sources = self.sources.select(
            F.col("source").alias("of"), "source_size", "target")
        return (
            self.rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
            .join(words, "row", "left")
            .select("key", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix(
    documents: DataFrame, weights: Sequence[int] = (1, 2, 3), most_passes: int = 3,
    budget: int | None = None, key: str = "doc_id", text: str = "text", source: str = "source",
) -> Mix:
    """The mix of all documents; the budget in words is the size of all of them unless given
    (at most ``most_passes`` times that can be taken)."""
    narrow = fan_out(narrowed(documents, key=key, text=text, source=source))
    rows = written(
        narrow.select(
            F.monotonically_increasing_id().alias("row"), "key", "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce("text", F.lit(""))).alias("mark")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(targets(sizes, weights, most_passes, budget), "weighed")
    ends = F.ceil("target")
    passes = F.ceil(F.col("target") / F.col("source_size")).cast("int")
    known = sources.filter("target > 0").select(
        F.col("source").alias("of"), "number", "target", passes.alias("passes"))
    queued = (
        rows.filter("size > 0").join(known, F.col("source").eqNullSafe(F.col("of")))
        .select("row", "key", "source", "size", "mark", "number", "target",
                F.explode(F.sequence(F.lit(1), "passes")).alias("pass")))
    place = F.md5(F.concat_ws(":", "pass", F.col("key").cast("string"), "mark"))
    # ``row`` only tells apart rows that are alike
    queued = queued.withColumn("place", place).drop("mark")
    queued = running_totals(queued, ["number"], ["pass", "place", "row"], begin="size")
    served = queued.filter(F.col("begin") < ends).withColumn(
        "words", F.least(F.col("size"), ends - F.col("begin")))
    served = served.withColumn("finish", (F.col("begin") + F.col("words")) / F.col("target"))
    sorted_mix = running_totals(
        served.select("row", "key", "source", "number", "pass", "place", "finish", "words"),
        [], ["finish", "number", "pass", "place", "row"], position="words")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    total = total if budget is None else min(budget, most_passes * total)
    taken = sorted_mix.filter(F.col("position") < total).select(
        "row", "key", "source", "pass", "finish", "position",
        F.least(F.col("words"), F.lit(total) - F.col("position")).alias("words"))
    return Mix(rows.drop("mark"), sources, written(taken, "mix"))

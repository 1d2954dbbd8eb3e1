"""Filter interaction audit: what every filter removes in every order of the filters.

Each document gets a mask of the filters that it fails.  Masks are counted for each part, and
the counts of a part become a decision diagram: a level for each filter, a branch for passing
and one for failing it, equal branches shared, the counts summed up from the leaves.  The
diagram is taken from order to order by swapping two adjacent levels, which changes only the
nodes of these levels.  In every order the path on which all filters are passed tells each
step: what reaches it, what fails it there, and what would have failed it alone.

Defined results:

* a null text is empty, a null part is the part ``""``;
* of identical texts the smallest key passes the copy filter, so repeated rows of that key
  all pass; a null key passes and is no other row's smaller one;
* a document is good or toxic if any of its labels says so; without labels it is neither;
* columns other than the named ones play no part, whatever they are called;
* an empty table has no parts and no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import narrowed
from tablewright.shared import fan_out, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Filters at most: an audit has a row for each part, order and filter.
MOST_FILTERS = 7

STEPS = ("part string, filter_order string, step int, kept long, removed long, "
         "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")

Condition = Callable[[Column, Column], Column]


def five_filters() -> dict[str, Condition | None]:
    """Failure conditions by letter, on the text and its words; ``None`` marks the copy filter."""
    return {
        "A": lambda text, words: F.size(words) < 50,
        "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        "D": lambda text, words: text.rlike("[#$%&*|]"),
        "E": None,
    }


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda word: word != "")


# --- masks ------------------------------------------------------------------------------

def failure_counts(
    documents: DataFrame, labels: DataFrame, filters: dict[str, Condition | None],
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """``(part, mask, documents, good, toxic)``: at most a row for each part and mask.

    Bit i of the mask is set if the i-th filter fails.  Rows are counted before any join, so
    repeated rows of one key are one; copies meet only in the partial minimum of their keys.
    """
    rows = fan_out(narrowed(documents, key=key, text=text, part=part))
    whole = F.coalesce("text", F.lit(""))
    rows = rows.select("key", F.coalesce("part", F.lit("")).alias("part"), whole.alias("text"))
    rows = rows.select("*", words_of(F.col("text")).alias("words"))
    mask = F.lit(0)
    copies = 0
    for i, condition in enumerate(filters.values()):
        if condition is None:
            copies = 1 << i
            continue
        failed = condition(F.col("text"), F.col("words"))
        mask = mask + F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
    counted = written(
        rows.select("key", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                    mask.alias("mask"))
        .groupBy("key", "part", "digest", "mask").agg(F.count("*").alias("documents")),
        "failures")
    known, unknown = counted.filter("key IS NOT NULL"), counted.filter("key IS NULL")
    marks = narrowed(labels, key="doc_id", quality="quality", toxic="toxic")
    marks = marks.groupBy("key").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    first = known.groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(1))
    judged = known.join(first, ["digest", "key"], "left").join(marks, "key", "left")
    unknown = unknown.select(
        "part", "mask", "documents", F.lit(1).alias("first"), F.lit(0).alias("good"),
        F.lit(0).alias("toxic"))
    judged = judged.select(*unknown.columns).unionByName(unknown)
    repeated = F.when(F.col("first").isNull(), F.lit(copies)).otherwise(F.lit(0))
    share = {name: F.sum(F.when(F.col(name) == 1, F.col("documents")).otherwise(0))
             for name in ("good", "toxic")}
    return judged.withColumn("mask", F.col("mask") + repeated).groupBy("part", "mask").agg(
        F.sum("documents").alias("documents"), share["good"].alias("good"),
        share["toxic"].alias("toxic"))


# --- diagrams ---------------------------------------------------------------------------

class Diagram:
    """A count-weighted decision diagram.  A node is ``(counts, passed, failed)``, a leaf
    ``(counts, None, None)``; branches that nothing takes are ``None``.  Equal nodes are one."""

    def __init__(self, counts: dict[int, tuple], letters: str) -> None:
        self.order = list(letters)
        self.nothing = tuple(0 for _ in next(iter(counts.values())))
        self._nodes: dict[tuple, tuple] = {}
        bits = {letter: 1 << i for i, letter in enumerate(letters)}
        self.root = self._built(counts, [bits[letter] for letter in self.order])

    def _node(self, passed, failed):
        if passed is None and failed is None:
            return None
        counts = tuple(map(sum, zip(self.counts(passed), self.counts(failed))))
        return self._shared((counts, passed, failed))

    def _shared(self, node: tuple) -> tuple:
        name = (node[0], id(node[1]), id(node[2]))
        return self._nodes.setdefault(name, node)

    def _built(self, counts: dict[int, tuple], bits: list[int]):
        if not counts:
            return None
        if not bits:
            (leaf,) = counts.values()
            return self._shared((leaf, None, None))
        passed = {m: n for m, n in counts.items() if not m & bits[0]}
        failed = {m: n for m, n in counts.items() if m & bits[0]}
        return self._node(self._built(passed, bits[1:]), self._built(failed, bits[1:]))

    def counts(self, node) -> tuple:
        return node[0] if node else self.nothing

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and ``level + 1``."""
        done: dict[int, tuple] = {}

        def swapped(node, depth):
            if node is None:
                return None
            if id(node) not in done:
                _, passed, failed = node
                if depth:
                    new = self._node(swapped(passed, depth - 1), swapped(failed, depth - 1))
                else:
                    _, both, second = passed or (None, None, None)
                    _, first, neither = failed or (None, None, None)
                    new = self._node(self._node(both, first), self._node(second, neither))
                done[id(node)] = new
            return done[id(node)]

        self.root = swapped(self.root, level)
        order = self.order
        order[level], order[level + 1] = order[level + 1], order[level]

    def steps(self) -> Iterator[tuple]:
        """``(filter, counts kept, counts removed, counts failing this filter only)`` along the
        path on which every filter is passed."""
        node = self.root
        for letter in self.order:
            _, node, failed = node or (None, None, None)
            only = failed
            while only and (only[1] or only[2]):
                only = only[1]
            yield letter, self.counts(node), self.counts(failed), self.counts(only)

    def failing(self) -> dict[str, tuple]:
        """Counts that fail each filter, whatever else they fail."""
        found, level = {}, {id(self.root): (self.root, 1)}
        for letter in self.order:
            total, below = list(self.nothing), {}
            for node, ways in level.values():
                total = [t + ways * c for t, c in zip(total, self.counts(node[2]))]
                for child in node[1:]:
                    if child:
                        _, before = below.get(id(child), (child, 0))
                        below[id(child)] = (child, before + ways)
            found[letter], level = tuple(total), below
        return found


def level_swaps(levels: int) -> Iterator[int]:
    """Levels to swap with the next one so that every order is met once: the last filter
    walks through each order of the others, to and fro (Steinhaus, Johnson, Trotter)."""
    inner = level_swaps(levels - 1) if levels > 2 else iter(())
    down = True
    while True:
        yield from range(levels - 2, -1, -1) if down else range(levels - 1)
        level = next(inner, None)
        if level is None:
            return
        yield level + 1 if down else level
        down = not down


def order_steps(counts: dict[int, tuple], letters: str) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``
    for all orders of one part; ``counts`` maps masks to (documents, good, toxic)."""
    diagram = Diagram(counts, letters)
    failing = {letter: c[0] for letter, c in diagram.failing().items()}
    rows, shapley = [], dict.fromkeys(letters, 0)

    def note() -> None:
        order = "".join(diagram.order)
        for step, (letter, kept, removed, only) in enumerate(diagram.steps(), 1):
            shapley[letter] += removed[0]
            rows.append((order, step, kept[0], removed[0], failing[letter] - removed[0],
                         only[0], removed[1], removed[2]))

    note()
    for level in level_swaps(len(letters)):
        diagram.swap(level)
        note()
    return [(*row, shapley[row[0][row[1] - 1]]) for row in rows]


def audit(
    documents: DataFrame, labels: DataFrame, filters: dict[str, Condition | None] | None = None,
    key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """One row for each part, order of the filters and step (see :data:`STEPS`).

    ``filters`` maps one letter each to its failure condition on text and words, or to ``None``
    for texts that are identical to one with a smaller key.  The diagram of a part is built
    from its masks, at most two to the number of filters, so no task holds more than that.
    """
    filters = filters or five_filters()
    letters = "".join(filters)
    if not 0 < len(filters) <= MOST_FILTERS or len(letters) != len(filters):
        raise ValueError(f"1 to {MOST_FILTERS} filters, each named by one letter")

    def steps(masks: pa.Table) -> pa.Table:
        rows = masks.to_pylist()
        counts = {r["mask"]: (r["documents"], r["good"], r["toxic"]) for r in rows}
        found = list(zip(*order_steps(counts, letters)))
        kinds = [pa.string(), pa.int32()] + [pa.int64()] * 7
        arrays = [pa.array(values, kind) for values, kind in zip(found, kinds)]
        part_name = pa.array([rows[0]["part"]] * len(arrays[0]), pa.string())
        return pa.table([part_name, *arrays], names=[f.split()[0] for f in STEPS.split(", ")])

    return failure_counts(documents, labels, filters, key, text, part).groupBy(
        "part").applyInArrow(steps, STEPS)

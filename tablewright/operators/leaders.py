"""Leader clustering: every node either leads or is absorbed by a leader.

Going through the nodes in rank order, a node is absorbed by the lowest-ranked
leader it is similar to, and leads if there is none.  That sequential rule is the
lexicographically first maximal independent set, which is computed here in rounds
of joins: whoever has no undecided better-ranked neighbour leads, and the
neighbours of new leaders are absorbed.

Rounds take as long as the longest chain of nodes, so they are for large components only:
nodes that no chain connects cannot matter to each other, and a component of up to
:data:`TASK_EDGES` edges is settled in one go by one task.  Components come from a logarithmic
number of star contractions, whatever the chains.

Entry points:

* :func:`absorb_edges` - the similar pairs are already known (bounded per node);
* :func:`absorb_blocks` - similar nodes share a block, and blocks may be huge.  Only
  the best-ranked ``head`` members of a block are compared with each other; the rest
  of a block is compared with confirmed leaders only, round after round, so no block
  is ever expanded into all of its pairs and nothing is left out.  If all pairs of all
  blocks are known to be few, they are compared at once;
* :func:`absorb_crowds` - blocks do not help where most nodes are similar to a few leaders:
  these are found first, and what they leave is handed back;
* :func:`absorb_groups` - every node is in one group, and a join finds the similar pairs of
  what the first leaders leave.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.shared import spread, written

# Executors need not have this package installed: its few lines travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges that one task settles at most (some hundred bytes each).
TASK_EDGES = 250_000
#: Pairs of all blocks up to which they are compared at once.
FEW_PAIRS = 1_000_000
#: Best-ranked nodes of a crowd among which one task finds leaders, leaders found at once, and
#: rounds of that at most; nodes up to which no crowd is looked for.
CROWD_HEAD, CROWD_LEADERS, CROWD_ROUNDS, CROWD_LEAST = 65_536, 512, 32, 8192


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _settle(edges: DataFrame, may_lead: DataFrame | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Rounds over directed edges ``(lo, hi)``, ``lo`` being the better-ranked end.

    Returns the absorbed nodes (disjoint parts) and the edges still open, which are
    empty unless ``may_lead`` keeps some nodes from leading.
    """
    open_edges = written(edges.select("lo", "hi").distinct(), "open-edges")
    parts: list[DataFrame] = []
    while not open_edges.isEmpty():
        leaders = open_edges.select(F.col("lo").alias("node")).join(
            open_edges.select(F.col("hi").alias("node")), "node", "left_anti"
        )
        if may_lead is not None:
            leaders = leaders.join(may_lead, "node", "left_semi")
        gone = (
            open_edges.join(leaders, open_edges.lo == leaders.node, "left_semi")
            .select(F.col("hi").alias("node"))
            .distinct()
        )
        gone = written(gone, "absorbed")
        if gone.isEmpty():
            break
        parts.append(gone)
        open_edges = written(
            open_edges.join(gone, open_edges.lo == gone.node, "left_anti").join(
                gone, F.col("hi") == gone.node, "left_anti"
            ),
            "open-edges",
        )
    return parts, open_edges


def _assigned(edges: DataFrame, absorbed: DataFrame) -> DataFrame:
    """Each absorbed node with its best-ranked leader: ``(node, leader, score)``."""
    from_leaders = edges.join(
        absorbed.select(F.col("node").alias("lo")), "lo", "left_anti"
    )
    best = F.min_by(F.struct("lo", "score", "lo_rank"), "lo_rank").alias("best")
    return (
        from_leaders.groupBy(F.col("hi").alias("node"))
        .agg(best)
        .select("node", F.col("best.lo").alias("leader"), "best.score", "best.lo_rank")
    )


def orderable(rank):
    """A rank as something that Python can order: structs become tuples."""
    return tuple(map(orderable, rank.values())) if isinstance(rank, dict) else rank


def components(edges: DataFrame) -> DataFrame:
    """``edges(lo, hi)`` to ``(node, component)``: each node with the smallest one it is
    connected with.

    Alternately every node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows (large-star and small-star, Kiveris et al. 2014): after a logarithmic number
    of steps, even on a chain, each component is a star.  Edges are sums over neighbours at
    most, and a node's minimum is aggregated before it is shuffled.
    """
    pairs = written(
        edges.filter(F.col("lo") != F.col("hi"))
        .select(F.least("lo", "hi").alias("low"), F.greatest("lo", "hi").alias("high")).distinct(),
        "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("high").alias("low"), F.col("low").alias("high")))
        both = both.toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        centre = F.least("node", "least")
        starred = written(
            both.join(least, "node").filter(F.col("other") > F.col("node"))
            .select(centre.alias("low"), F.col("other").alias("high")).distinct(), "links")
        # now towards the smallest of the smaller neighbours, the node itself included
        least = starred.groupBy("high").agg(F.min("low").alias("least"))
        joined = starred.join(least, "high")
        contracted = joined.filter(F.col("low") != F.col("least")).select(
            F.col("least").alias("low"), F.col("low").alias("high"))
        contracted = written(
            contracted.unionByName(least.select(F.col("least").alias("low"), "high")).distinct(),
            "links")
        if _digest(contracted) == _digest(pairs):
            break
        pairs = contracted
    inner = contracted.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return written(
        inner.unionByName(contracted.select(F.col("high").alias("node"),
                                            F.col("low").alias("component"))), "components")


def _digest(links: DataFrame) -> tuple:
    """Number of links and an order-free sum of their hashes."""
    code = F.xxhash64("low", "high").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(code)).first())


def _settle_together(edges: DataFrame, by: list[str]) -> DataFrame:
    """The sequential rule over all edges of a group, in one task: ``(node, leader, score)``."""
    kinds = {f.name: f.dataType.simpleString() for f in edges.schema.fields}

    def settled(table: pa.Table) -> pa.Table:
        lo, hi, score, rank = (table.column(c).to_pylist() for c in ("lo", "hi", "score", "lo_rank"))
        rank = list(map(orderable, rank))
        leader: dict = {}
        found: list[int] = []
        for i in sorted(range(len(lo)), key=rank.__getitem__):
            # better-ranked neighbours of ``lo`` have had their turn
            if lo[i] not in leader and hi[i] not in leader:
                leader[hi[i]] = lo[i]
                found.append(i)
        taken = table.take(pa.array(found, pa.int64()))
        return pa.table({"node": taken.column("hi"), "leader": taken.column("lo"),
                         "score": taken.column("score")})

    return edges.groupBy(*by).applyInArrow(
        settled, f"node {kinds['hi']}, leader {kinds['lo']}, score {kinds['score']}")


def absorb_edges(edges: DataFrame) -> DataFrame:
    """``edges(lo, hi, lo_rank, score)`` to ``(node, leader, score)``."""
    edges = written(edges.select("lo", "hi", "lo_rank", "score"), "edges")
    count = edges.count()
    if count <= TASK_EDGES:
        return _settle_together(edges.withColumn("all", F.lit(0)), ["all"])
    dealt = written(
        edges.join(components(edges).withColumnRenamed("node", "lo"), "lo"), "component-edges")
    sizes = dealt.groupBy("component").agg(F.count("*").alias("size"))
    giants = written(sizes.filter(F.col("size") > TASK_EDGES).select("component"), "giants")
    # many components are settled together: a call for each of them would cost more than its work
    bundle = F.pmod(F.xxhash64("component"), F.lit(1 + count * 10 // max(TASK_EDGES, 1)))
    small = _settle_together(
        dealt.join(giants, "component", "left_anti").withColumn("bundle", bundle), ["bundle"])
    if giants.isEmpty():
        return small
    return small.unionByName(_absorb_in_rounds(
        written(dealt.join(giants, "component", "left_semi").drop("component"), "edges")))


def _absorb_in_rounds(edges: DataFrame) -> DataFrame:
    parts, _ = _settle(edges)
    return _assigned(edges, _union(parts)).select("node", "leader", "score")


def absorb_groups(
    groups: DataFrame,
    similar: Callable[[DataFrame], DataFrame],
    near: Callable[[DataFrame], DataFrame],
    head: int = 256,
) -> DataFrame:
    """``groups(grp, node, rank)`` to ``(node, leader, score)``; every node is in one group.

    The best-ranked ``head`` members of a group are compared with each other and its other
    members with the leaders among them, which absorbs large crowds of similar nodes without
    listing their pairs.  ``near`` turns the rest ``(grp, node, rank)`` into pairs ``(lo, hi,
    lo_rank)`` of which the similar ones are a part, without trying all of them.
    """
    index = written(groups.select("grp", "node", "rank"), "groups")
    by_rank = Window.partitionBy("grp").orderBy("rank")
    heads = written(index.withColumn("place", F.row_number().over(by_rank)).filter(
        F.col("place") <= head).drop("place"), "heads")
    first = heads.select("grp", F.col("node").alias("lo"), F.col("rank").alias("lo_rank"))
    second = heads.select("grp", F.col("node").alias("hi"), F.col("rank").alias("hi_rank"))

    def edges_of(pairs: DataFrame) -> DataFrame:
        pairs = written(spread(pairs.select("lo", "hi", "lo_rank"), "lo", "hi"), "pairs")
        return similar(pairs).select("lo", "hi", "lo_rank", "score")

    among = edges_of(first.join(second, "grp").filter(F.col("lo_rank") < F.col("hi_rank")))
    taken = [written(absorb_edges(among), "absorbed")]
    if index.count() == heads.count():
        return taken[0]
    leaders = heads.join(taken[0], "node", "left_anti").select(
        "grp", F.col("node").alias("lo"), F.col("rank").alias("lo_rank"))
    others = written(index.join(heads.select("node"), "node", "left_anti"), "others")
    star = edges_of(others.select("grp", F.col("node").alias("hi")).join(leaders, "grp"))
    taken.append(written(
        star.groupBy(F.col("hi").alias("node"))
        .agg(F.min_by(F.struct("lo", "score"), "lo_rank").alias("best"))
        .select("node", F.col("best.lo").alias("leader"), "best.score"), "absorbed"))
    rest = written(others.join(taken[1], "node", "left_anti"), "rest")
    if not rest.isEmpty():
        taken.append(absorb_edges(edges_of(near(rest))))
    return _union(taken)


def absorb_crowds(
    nodes: DataFrame, compared: Callable[[list[str]], Callable[[str], np.ndarray]]
) -> tuple[DataFrame | None, DataFrame]:
    """``nodes(node, rank, text)`` to the absorbed ``(node, leader, score)`` (or None) and the
    rest ``(node, rank)``, in which nobody leads or is led by a node outside.

    One task finds the first leaders among the best-ranked nodes, and all others are compared
    with these, in rounds while the first leaders absorb a good part of the best-ranked.  So every
    absorbed node has its best-ranked leader, and the number of leaders that a node is compared
    with is bounded.  ``compared`` prepares texts for the comparison with one text after the other,
    which scores them, below 0 for those that are not similar.
    """
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}

    class Open:
        """Texts that no leader has absorbed yet."""

        def __init__(self, texts: list[str]) -> None:
            self.texts, self.rows = texts, np.arange(len(texts))
            self.prepare()

        def prepare(self) -> None:
            self.scores = compared([self.texts[i] for i in self.rows])
            self.open = np.full(len(self.rows), True)

        def absorbed(self, text: str) -> tuple[np.ndarray, np.ndarray]:
            """Places and scores of those that the text absorbs."""
            scores = self.scores(text)
            gone = np.flatnonzero((scores >= 0) & self.open)
            found = self.rows[gone], scores[gone]
            self.open[gone] = False
            if self.open.sum() * 2 < len(self.rows):
                self.rows = self.rows[self.open]
                self.prepare()
            return found

        def left(self) -> np.ndarray:
            return self.rows[self.open]

    def first_leaders(table: pa.Table) -> pa.Table:
        ranks = list(map(orderable, table.column("rank").to_pylist()))
        table = table.take(pa.array(sorted(range(len(ranks)), key=ranks.__getitem__), pa.int64()))
        texts = table.column("text").to_pylist()
        others = Open(texts)
        found: list[int] = []
        while len(found) < CROWD_LEADERS and len(left := others.left()):
            found.append(int(left[0]))
            others.absorbed(texts[found[-1]])  # itself, too
        leaders = table.select(["node", "text"]).take(pa.array(found, pa.int64()))
        return leaders.append_column("place", pa.array(range(len(found)), pa.int32())).append_column(
            "open", pa.array([len(others.left())] * len(found), pa.int32()))

    rest, taken = written(nodes.select("node", "rank", "text"), "nodes"), []
    left = rest.count()
    for _ in range(CROWD_ROUNDS if left > min(CROWD_HEAD, CROWD_LEAST) else 0):
        heads = rest.orderBy("rank").limit(CROWD_HEAD).withColumn("all", F.lit(0))
        leaders = written(heads.groupBy("all").applyInArrow(
            first_leaders, f"node {kinds['node']}, text {kinds['text']}, place int, open int"),
            "leaders").orderBy("place").collect()  # CROWD_LEADERS rows at most
        tried = min(left, CROWD_HEAD)
        if tried - len(leaders) - leaders[0]["open"] < tried / 4:
            break
        names, texts = [r["node"] for r in leaders], [r["text"] for r in leaders]

        def absorbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                others = Open(batch.column("text").to_pylist())
                rows, places, scores = [], [], []
                for place, text in enumerate(texts):
                    if not len(others.rows):
                        break
                    gone, found = others.absorbed(text)
                    rows.append(gone)
                    places.append(np.full(len(gone), place))
                    scores.append(found)
                if not rows:
                    continue
                rows, places, scores = map(np.concatenate, (rows, places, scores))
                node = batch.column("node")
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(rows)), pa.array(names, node.type).take(pa.array(places)),
                     pa.array(scores, pa.int32())],
                    names=["node", "leader", "score"])

        others = written(rest.filter(~F.col("node").isin(names)), "others")
        dealt = spread(others.select("node", "text"), "node").sortWithinPartitions("text")
        gone = written(dealt.mapInArrow(
            absorbed, f"node {kinds['node']}, leader {kinds['node']}, score int"), "absorbed")
        taken.append(gone)
        rest = written(others.join(gone, "node", "left_anti"), "rest")
        left = rest.count()
        if not left:
            break
    return (_union(taken) if taken else None), rest.select("node", "rank")


def absorb_blocks(
    blocks: DataFrame,
    similar: Callable[[DataFrame], DataFrame],
    head: int = 256,
    plausible: Column | None = None,
) -> DataFrame:
    """``blocks(block, node, rank)`` to ``(node, leader, score)``.

    ``rank`` is unique per node and orders the nodes; every similar pair shares at
    least one block.  ``similar`` turns pairs ``(lo, hi, lo_rank)`` into the similar
    ones with a ``score`` column; ``plausible`` is a cheap condition on ``lo`` and
    ``hi`` that similar pairs always meet and that is applied inside the join.
    """

    def checked(pairs: DataFrame) -> DataFrame:
        if plausible is not None:
            pairs = pairs.filter(plausible)
        # Written, because a costly check on top of the join would be evaluated once
        # per shared block instead of once per pair.
        pairs = written(spread(pairs, "lo", "hi").distinct(), "pairs")
        return similar(pairs).select("lo", "hi", "lo_rank", "score")

    index = written(blocks.select("block", "node", "rank"), "blocks")
    sizes = index.groupBy("block").agg(F.count("*").cast("double").alias("n"))
    if (sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0) <= FEW_PAIRS:
        return absorb_edges(checked(_better_pairs(index, index)))
    by_rank = Window.partitionBy("block").orderBy("rank")
    edges: list[DataFrame] = []
    absorbed: list[DataFrame] = []
    all_blocks, rounds = index, 0
    while True:
        rounds += 1
        heads = written(
            index.withColumn("place", F.row_number().over(by_rank)).filter(
                F.col("place") <= head
            ),
            "heads",
        )
        found = written(checked(_better_pairs(heads, heads)), "edges")
        edges.append(found)

        if index.count() == heads.count():  # no block is longer than its head
            absorbed.extend(_settle(found)[0])
            break

        # A node may lead if it is in the head of each of its blocks: then every
        # better-ranked candidate has been compared with it.
        complete = (
            index.groupBy("node")
            .agg(F.count("*").alias("blocks"))
            .join(heads.groupBy("node").agg(F.count("*").alias("headed")), "node")
            .filter("blocks = headed")
            .select("node")
        )
        complete = written(complete, "complete")
        parts, open_edges = _settle(found, complete)
        leaders = complete.join(
            open_edges.select(F.col("hi").alias("node")), "node", "left_anti"
        )
        if parts:
            leaders = leaders.join(_union(parts), "node", "left_anti")
        leaders = written(leaders, "leaders")

        star = written(checked(_star_pairs(index, leaders, heads)), "edges")
        edges.append(star)
        reached = star.select(F.col("hi").alias("node")).distinct()
        if parts:
            reached = reached.join(_union(parts), "node", "left_anti")
        parts = parts + [written(reached, "absorbed")]
        absorbed.extend(parts)
        index = written(
            index.join(_union([leaders, *parts]), "node", "left_anti"), "blocks"
        )
        if index.isEmpty():
            break

    every_edge = _union(edges)
    if not absorbed:
        return every_edge.select(
            F.col("hi").alias("node"), F.col("lo").alias("leader"), "score"
        ).filter("false")
    gone = _union(absorbed)
    assigned = _assigned(every_edge, gone)
    if rounds > 1:
        assigned = _better_leaders(all_blocks, gone, assigned, checked)
    return assigned.select("node", "leader", "score")


def _better_pairs(these: DataFrame, those: DataFrame) -> DataFrame:
    """Pairs of members of a block, the better-ranked first."""
    first = these.select("block", F.col("node").alias("lo"), F.col("rank").alias("lo_rank"))
    second = those.select("block", F.col("node").alias("hi"), F.col("rank").alias("hi_rank"))
    return first.join(second, "block").filter(
        F.col("lo_rank") < F.col("hi_rank")).select("lo", "hi", "lo_rank")


def _star_pairs(index: DataFrame, leaders: DataFrame, heads: DataFrame) -> DataFrame:
    """New leaders against the members of their blocks that are outside the head."""
    led = index.join(leaders, "node", "left_semi").select(
        "block", F.col("node").alias("lo"), F.col("rank").alias("lo_rank")
    )
    rest = index.join(heads.select("block", "node"), ["block", "node"], "left_anti")
    return (
        rest.select("block", F.col("node").alias("hi"))
        .join(led, "block")
        .select("lo", "hi", "lo_rank")
    )


def _better_leaders(
    blocks: DataFrame,
    absorbed: DataFrame,
    assigned: DataFrame,
    checked: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """A leader confirmed in a later round may outrank the one that absorbed a node
    first; look those up so that the assignment equals the sequential rule."""
    assigned = written(assigned, "assigned")
    led = blocks.join(absorbed, "node", "left_anti").select(
        "block", F.col("node").alias("lo"), F.col("rank").alias("lo_rank")
    )
    taken = blocks.join(assigned, "node").select(
        "block", F.col("node").alias("hi"), F.col("lo_rank").alias("taken_rank")
    )
    pairs = (
        taken.join(led, "block")
        .filter(F.col("lo_rank") < F.col("taken_rank"))
        .select("lo", "hi", "lo_rank")
    )
    better = checked(pairs).select(
        F.col("hi").alias("node"), F.col("lo").alias("leader"), "score", "lo_rank"
    )
    return (
        assigned.unionByName(better)
        .groupBy("node")
        .agg(F.min_by(F.struct("leader", "score", "lo_rank"), "lo_rank").alias("best"))
        .select("node", "best.leader", "best.score", "best.lo_rank")
    )

"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are dealt to a few lists; a list knows only its own part of a score.

1. Every list names its best candidates of each query, block by block; their whole scores
   are resolved, and a query's k-th best of them is a safe cutoff: nothing below it can be
   among the k best.
2. A whole score that reaches the cutoff has a part of at least cutoff / lists in some list,
   so each list gives all entries that reach this uniform threshold - and no others.
3. Entries of one candidate are added up; where the lists that kept silent could still lift
   it to the cutoff, its whole score is resolved, and the k best are taken.

Equal vectors form a class; its k + 1 smallest ids stand for all of it, since ties go to the
smaller id.  Queries and candidates meet in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.shared import written

_EXACT = float(1 << 53)


def scaled(vector: str, factor: int = 256) -> Column:
    """floor(factor * x) of every component; null if the vector or a component is null or not
    finite."""
    parts = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    bad = F.exists(
        parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(
        parts.isNotNull() & ~bad,
        F.transform(parts, lambda x: F.floor(x * F.lit(float(factor)))))


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return np.asarray(column.flatten()).reshape(rows, -1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with the rows of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max())
    if bound * a.shape[1] < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    lists: int = 2, query_block: int = 1024, candidate_block: int = 8192,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows for each row of ``is_query``
    by integer inner product, ties to the smaller id; all if there are fewer.

    Null vectors, vectors with null or non-finite components and rows without a key take no
    part.  Vectors of different lengths are not compared.  Scores must fit 64 bits.
    Repeated keys: equal rows count once, a query never meets a row of its own id, and a pair
    of ids is listed once, by its best score.  An empty table, or one without queries, gives
    an empty table.
    """
    rows = (
        df.select(F.col(f"`{key}`").cast("long").alias("id"), scaled(vector).alias("v"),
                  is_query.alias("asks"))
        .filter("id IS NOT NULL AND v IS NOT NULL")
        .dropDuplicates(["id", "v"])
        .select("id", "v", "asks", F.size("v").alias("dim"), F.xxhash64("v").alias("h"),
                F.monotonically_increasing_id().alias("row"))
    )
    rows = written(rows, "vectors")
    by_vector = Window.partitionBy("dim", "h", "v").orderBy("id")
    members = rows.withColumn("place", F.row_number().over(by_vector)).filter(
        F.col("place") <= k + 1)
    queries = written(_blocked(rows.filter("asks").select(
        "dim", F.col("row").alias("q"), F.col("id").alias("query_id"), "v"), "q", query_block),
        "queries")
    candidates = written(_blocked(members.select(
        "dim", F.col("row").alias("c"), F.col("id").alias("vec_id"), "v"), "c",
        candidate_block), "candidates")
    each_list = F.explode(F.sequence(F.lit(0), F.lit(lists - 1)))
    keys = ["dim", "asked", "block", "list"]
    held = candidates.join(
        queries.select("dim", F.col("block").alias("asked")).distinct(), "dim"
    ).withColumn("list", each_list).groupBy(*keys)
    # new names for the columns of one side: both sides come from the candidates
    held_blocks = candidates.groupBy(F.col("dim").alias("d"), F.col("block").alias("b")).agg(
        F.lit(1).alias("one"))

    def asked(rows: DataFrame, *more: str):
        """Query blocks, once for every block of candidates and list."""
        return (
            rows.join(held_blocks, F.col("dim") == F.col("d"))
            .select(F.col("dim").alias("dim"), F.col("block").alias("asked"),
                    F.col("b").alias("block"), "q", "query_id", "v", *more,
                    each_list.alias("list"))
            .groupBy(*keys)
        )

    kind = "q long, c long, score long"
    # 1. local lists, resolved to whole scores, give a safe cutoff
    local = asked(queries).cogroup(held).applyInArrow(_entries(lists, k + 1), kind)
    firsts = _resolved(local.select("q", "c").distinct(), queries, candidates)
    best = Window.partitionBy("q").orderBy(F.desc("score"))
    cutoffs = (
        firsts.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(best)).filter(F.col("place") == k)
        .select("q", F.col("score").alias("cutoff"))
    )
    lowest = F.lit(-(1 << 63)).cast("long")
    limits = written(
        queries.join(cutoffs, "q", "left").withColumn("threshold", F.coalesce(
            -F.floor(-F.col("cutoff") / F.lit(lists)), lowest)), "limits")

    # 2. all entries that reach the uniform threshold
    sufficient = asked(limits, "threshold").cogroup(held).applyInArrow(
        _entries(lists, None), kind)

    # 3. what could still reach the cutoff is resolved
    silent = F.lit(lists) - F.col("told")
    open_ = (
        sufficient.groupBy("q", "c")
        .agg(F.sum("score").alias("known"), F.count("*").alias("told"))
        .join(limits.select("q", "cutoff", "threshold"), "q")
        .filter(F.col("cutoff").isNull() | (
            F.col("known") + silent * (F.col("threshold") - 1) >= F.col("cutoff")))
        .select("q", "c")
    )
    whole = _resolved(open_, queries, candidates)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        whole.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _entries(lists: int, best: int | None):
    """Entries of one list for a block of queries and a block of candidates: the ``best`` of
    every query, or all that reach the query's threshold."""

    def part(values: np.ndarray, number: int) -> np.ndarray:
        size = -(-values.shape[1] // lists)
        return values[:, number * size:(number + 1) * size]

    def give(names: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        number = names[3].as_py()
        q, c = np.asarray(asked.column("q")), np.asarray(held.column("c"))
        if not len(q) or not len(c):
            return pa.table({n: pa.array([], pa.int64()) for n in ("q", "c", "score")})
        scores = _product(part(_matrix(asked.column("v"), len(q)), number),
                          part(_matrix(held.column("v"), len(c)), number))
        same = np.asarray(asked.column("query_id"))[:, None] == np.asarray(
            held.column("vec_id"))[None, :]
        if best is None:
            i, j = np.nonzero((scores >= np.asarray(asked.column("threshold"))[:, None]) & ~same)
        else:
            wanted = min(best, len(c))
            j = np.argpartition(scores, len(c) - wanted, axis=1)[:, -wanted:].ravel()
            i = np.repeat(np.arange(len(q)), wanted)
            other = ~same[i, j]
            i, j = i[other], j[other]
        return pa.table({"q": pa.array(q[i]), "c": pa.array(c[j]),
                         "score": pa.array(scores[i, j], pa.int64())})

    return give


def _blocked(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` with ``block``: rows of one length in hash-dealt blocks of about ``size``."""
    counts = df.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(size)).alias("blocks"))
    return df.join(counts, "dim").withColumn(
        "block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")).drop("blocks")


def _resolved(pairs: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(q, query_id, c, vec_id, score)``: whole scores of pairs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            sums = np.concatenate([[0], np.cumsum(np.asarray(a.flatten())
                                                  * np.asarray(b.flatten()))])
            ends = np.cumsum(np.asarray(a.value_lengths()))
            whole = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("q", "query_id", "c", "vec_id")),
                 pa.array(whole.astype(np.int64))],
                names=["q", "query_id", "c", "vec_id", "score"])

    joined = pairs.join(
        queries.select("q", "query_id", F.col("v").alias("a")), "q"
    ).join(candidates.select("c", "vec_id", F.col("v").alias("b")), "c")
    return joined.select("q", "query_id", "c", "vec_id", "a", "b").mapInArrow(
        score, "q long, query_id long, c long, vec_id long, score long")

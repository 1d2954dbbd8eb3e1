"""Helpers of the corpus operators: text blocks of bounded size, durable tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.shared import work_folder

#: Bytes of text that a task holds at a time; a longer single text forms a block of its own.
BLOCK_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names an operator uses inside; so other columns
    of the input, whatever they are called, cannot clash with its own."""
    return df.select(*[F.col(f"`{given}`").alias(inner) for inner, given in columns.items()])


def text_blocks(
    batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of at most ``limit`` bytes of the column ``text`` (one row at least)."""
    for batch in batches:
        start, held = 0, 0
        sizes = batch.column(text).cast(pa.large_binary())
        sizes = pa.compute.binary_length(sizes).fill_null(0).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts, null as empty."""
    return batch.column(text).fill_null("").to_pylist()


def rows_kept(
    df: DataFrame, judge: Callable[[], Callable[[list[str]], list[bool]]], text: str = "text",
    limit: int = 1 << 20,
) -> DataFrame:
    """The rows of ``df``, all columns, whose text is kept.  ``judge`` is called once in every
    task and gives a function from texts to decisions; it sees at most ``limit`` bytes of text
    at a time (one text at least), and what it keeps leaves the task before it sees more."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = judge()
        for block in text_blocks(batches, limit, text):
            yield block.filter(pa.array(decide(texts_of(block, text)), pa.bool_()))

    return df.mapInArrow(choose, df.schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written_in_buckets(df: DataFrame, column: str, label: str) -> DataFrame:
    """A durable table in the shared folder whose files are dealt by the hash of ``column``,
    so that a join or grouping on that column reads it without a shuffle."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (
        df.write.bucketBy(partitions(spark), column)
        .option("path", f"{work_folder(spark)}/{name}")
        .format("parquet").saveAsTable(name)
    )
    return spark.table(name)


def field(name: str, kind) -> str:
    """One column of a DDL schema."""
    return f"`{name}` {kind if isinstance(kind, str) else kind.simpleString()}"

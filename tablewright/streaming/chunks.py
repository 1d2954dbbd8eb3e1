"""Chunked ingest: the same scan as a file stream, chunk by chunk with progress."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablewright.rules import DEFAULT_RULES, NA_STRINGS, Rules
from tablewright.sources.delimited import (
    DATE_FORMAT,
    SEPARATOR,
    header_line,
    line_options,
    split_lines,
    typed,
)


@dataclass(frozen=True)
class Ingested:
    """The ingested table and the rows read after each chunk."""

    table: DataFrame
    rows_read: list[int]


def stream_table(
    spark: SparkSession,
    path: str,
    *,
    files_per_chunk: int = 1,
    date_format: str = DATE_FORMAT,
    separator: str = SEPARATOR,
    na_strings: tuple[str, ...] = NA_STRINGS,
    long_rows: str = "fail",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Streaming counterpart of ``read_table`` over the files of a directory."""
    header = header_line(spark, path)
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_chunk).csv(
        path, **line_options(header)
    )
    raw = split_lines(lines, header, separator, na_strings, long_rows)
    return typed(raw, date_format, rules)


def ingest_chunks(
    spark: SparkSession, path: str, target: str, checkpoint: str, **options
) -> Ingested:
    """Ingest everything available below ``path`` into a parquet table at ``target``.

    The checkpoint remembers finished files, so a restarted ingest continues where it
    stopped and new files are added exactly once.
    """
    stream = stream_table(spark, path, **options)
    kept = "spark.sql.streaming.numRecentProgressUpdates"  # else only the last hundred chunks
    before = spark.conf.get(kept)
    spark.conf.set(kept, str(2**31 - 1))
    try:
        run = (
            stream.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        spark.conf.set(kept, before)
    rows, total = [], 0
    for progress in run.recentProgress:
        if progress["numInputRows"]:
            total += progress["numInputRows"]
            rows.append(total)
    return Ingested(spark.read.schema(stream.schema).parquet(target), rows)

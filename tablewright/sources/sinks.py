"""Sinks: cleaned table, error report, duplicate list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.sources.delimited import SEPARATOR


def write_cleaned(df: DataFrame, path: str, format: str = "parquet") -> None:
    _writer(df, format).save(path)


def write_report(report: DataFrame, path: str, format: str = "parquet") -> None:
    _writer(report, format).save(path)


def _writer(df: DataFrame, format: str):
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    return writer


def write_delimited(df: DataFrame, path: str, separator: str = SEPARATOR) -> None:
    """Header, multi-character separator, ``\\n`` line ends, UTF-8.

    Fields holding a quote, a line end or the separator are quoted, so every value
    survives a round trip through :func:`read_delimited_export`.
    """
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    text.write.mode("overwrite").options(
        sep=separator,
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        lineSep="\n",
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def read_delimited_export(spark, path: str, schema, separator: str = SEPARATOR) -> DataFrame:
    """Read back what :func:`write_delimited` wrote."""
    return spark.read.csv(
        path, schema=schema, sep=separator, header=True, quote='"', escape='"',
        multiLine=True, encoding="UTF-8",
    )

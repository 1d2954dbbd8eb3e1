"""Replace codes by the places they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import trimmed


def resolve_codes(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Where the whole trimmed value is a code (in any case), put the place.

    Everything else, null included, stays as it was.  Whether the
    dimension is broadcast is left to the join planner, which knows its size.
    """
    dimension = codes.groupBy("code").agg(F.min("place").alias("place"))
    dimension = dimension.select(
        F.col("code").alias("__code"), F.col("place").alias("__place")
    )
    value = F.col(f"`{column}`")
    return (
        df.join(
            dimension, F.upper(trimmed(value)) == F.col("__code"), "left"
        )
        .withColumn(column, F.coalesce("__place", value))
        .drop("__code", "__place")
    )

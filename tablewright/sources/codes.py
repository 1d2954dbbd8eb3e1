"""Code-to-place dimension: scan, build, choice and sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODE_PATTERN = r"(?d)^[A-Z]{1,3}$"
MIN_STORED_CODES = 10
_SCHEMA = "code string, place string"


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{code: place}``; missing or unreadable gives no rows."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return spark.createDataFrame([], _SCHEMA)
        raise
    return text.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("code", "place")
    )


def codes_from_bindings(spark: SparkSession, path: str) -> DataFrame:
    """Dimension from a stored query response (``results.bindings[]``).

    Both fields are needed, a code is one to three capitals, the last binding wins.
    """
    cell = "struct<value:string>"
    schema = (
        "results struct<bindings:array<struct<"
        f"licencePlate:{cell},itemLabel:{cell}>>>"
    )
    bindings = spark.read.json(path, schema=schema, multiLine=True).select(
        F.posexplode("results.bindings").alias("pos", "binding")
    )
    return (
        bindings.select(
            "pos",
            F.col("binding.licencePlate.value").alias("code"),
            F.col("binding.itemLabel.value").alias("place"),
        )
        .filter(F.col("place").isNotNull() & F.col("code").rlike(CODE_PATTERN))
        .groupBy("code")
        .agg(F.max_by("place", "pos").alias("place"))
    )


def choose_codes(stored: DataFrame, refreshed: DataFrame) -> DataFrame:
    """The stored dimension if it has enough entries, else the refreshed one if it
    has any, else whatever is stored."""
    if stored.limit(MIN_STORED_CODES).count() >= MIN_STORED_CODES:
        return stored
    return stored if refreshed.isEmpty() else refreshed


def write_codes(codes: DataFrame, path: str, format: str = "parquet") -> None:
    codes.select("code", "place").write.mode("overwrite").format(format).save(path)

"""Delimited text with a multi-character separator: scan, casts, rejected values."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import trimmed
from tablewright.rules import DEFAULT_RULES, NA_STRINGS, Rules

SEPARATOR = "_§_"
DATE_FORMAT = "%d-%m-%Y"
# No line of text contains this, so the CSV reader hands over whole lines while
# still dropping the header of every file.
_NEVER = "\u0001\u0002\u0003"

_DATE_PARTS = {
    "d": "d", "m": "M", "Y": "yyyy", "y": "yy", "H": "H", "I": "h", "M": "m",
    "S": "s", "f": "SSSSSS", "b": "MMM", "B": "MMMM", "j": "D", "p": "a", "z": "xx",
    "%": "%",
}
_TIME_PARTS = set("HIMSfpz")


def spark_date_format(date_format: str) -> tuple[str, bool]:
    """Translate a ``strftime`` format; also tell whether it carries a time of day."""
    parts, has_time = [], False
    for directive, literal in re.findall(r"%(.)|([^%]+)", date_format):
        if literal:
            parts.append(re.sub(r"[A-Za-z']+", lambda m: f"'{m.group()}'", literal))
        elif directive in _DATE_PARTS:
            parts.append(_DATE_PARTS[directive])
            has_time = has_time or directive in _TIME_PARTS
        else:
            raise ValueError(f"unsupported date directive %{directive}")
    return "".join(parts), has_time


# ------------------------------------------------------------------------ casts

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(column: Column) -> Column:
    """Number or null; what cannot be parsed and NaN both become null."""
    text = trimmed(column.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double")).when(
        F.lower(text).rlike(r"^[+-]?inf(inity)?$"),
        F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(
            F.lit(float("inf"))
        ),
    )


def to_integer(column: Column) -> Column:
    """Integer or null.  ``1.0`` counts as 1; a fraction counts as unparsable."""
    text = trimmed(column.cast("string"))
    number = to_number(column)
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 9.2e18), number)
    return F.when(
        text.rlike("^[+-]?[0-9]{1,18}$"), text.try_cast("bigint")
    ).otherwise(whole.cast("bigint"))


def to_date(column: Column, date_format: str = DATE_FORMAT) -> Column:
    """Date (or timestamp if the format has a time) in exactly this format, else null."""
    spark_format, has_time = spark_date_format(date_format)
    moment = F.try_to_timestamp(column.cast("string"), F.lit(spark_format))
    return moment if has_time else moment.cast("date")


def _named(column: str) -> Column:
    """A column by a name that may hold dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def typed(raw: DataFrame, date_format: str = DATE_FORMAT, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Cast the columns with a typed role; the others stay text."""
    casts = _casts(raw, date_format, rules)
    return raw.select(*[casts.get(c, _named(c)).alias(c) for c in raw.columns])


def _casts(raw: DataFrame, date_format: str, rules: Rules) -> dict[str, Column]:
    present = set(raw.columns)
    casts = {c: to_integer(_named(c)) for c in rules.integer_columns if c in present}
    casts |= {c: to_number(_named(c)) for c in rules.number_columns if c in present}
    casts |= {
        c: to_date(_named(c), date_format) for c in rules.date_columns if c in present
    }
    return casts


def rejected_values(
    raw: DataFrame, date_format: str = DATE_FORMAT, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Distinct raw values the integer and date casts turned into null.

    One scan, one shuffle of the offending values only.
    """
    bad = _rejected_cells(raw, date_format, rules)
    return raw.select(F.explode(bad).alias("bad")).select("bad.*").distinct()


def _rejected_cells(raw: DataFrame, date_format: str, rules: Rules) -> Column:
    """``(column, value)`` of every cell of a row that the integer and date casts turn to null."""
    casts = _casts(raw, date_format, rules)
    checked = [c for c in (*rules.integer_columns, *rules.date_columns) if c in casts]
    cells = [
        F.when(
            casts[c].isNull() & _named(c).isNotNull(),
            F.struct(F.lit(c).alias("column"), _named(c).alias("value")),
        )
        for c in checked
    ]
    return F.array_compact(F.array(*cells).cast("array<struct<column:string,value:string>>"))


@dataclass(frozen=True)
class Loaded:
    """A loaded table, the distinct rejected values, and the rows of both kinds."""

    table: DataFrame
    rejected: DataFrame
    rows: int
    faulty_rows: int


def load_table(
    raw: DataFrame, target: str, date_format: str = DATE_FORMAT, rules: Rules = DEFAULT_RULES
) -> Loaded:
    """Casts and writes a table and lists what it rejects in one pass over ``raw``.

    Rows with a rejected cell go to a folder of their own below ``target``, along with these
    cells, so the list of rejected values reads nothing else; rows are counted on the way.
    """
    cells = "rejected"
    while cells in raw.columns or f"{cells}_row" in raw.columns:
        cells += "_"
    faulty = f"{cells}_row"
    bad = _rejected_cells(raw, date_format, rules)
    checked = typed(raw.withColumn(cells, bad), date_format, rules).withColumn(
        faulty, F.size(_named(cells)) > 0)
    seen = Observation()
    checked.observe(
        seen, F.count("*").alias("rows"), F.count_if(_named(faulty)).alias("faulty")
    ).write.partitionBy(faulty).parquet(target)
    spark = raw.sparkSession
    both = spark.read.schema(checked.schema).parquet(target)
    found = both.filter(_named(faulty)).select(F.explode(_named(cells)).alias("bad"))
    return Loaded(both.drop(cells, faulty), found.select("bad.*").distinct(),
                  seen.get["rows"], seen.get["faulty"])


# ------------------------------------------------------------------------- scan

def normalized_names(header: list[str]) -> list[str]:
    """Strip ``_`` and ``*`` at both ends and lower-case; names must stay distinct."""
    names = [name.strip("_*").lower() for name in header]
    twins = [name for i, name in enumerate(names) if name in names[:i]]
    if twins:
        raise ValueError(f"Duplicate column names after normalisation: {twins}")
    return names


def header_line(spark: SparkSession, path: str) -> str:
    """First line below ``path``; a missing path or an empty file is an error."""
    try:
        first = spark.read.text(path).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise FileNotFoundError(f"input not found: {path}") from error
        raise
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first[0]


def line_options(header: str) -> dict[str, object]:
    """Reader options and schema that yield raw lines without the header.

    The only column is named like the header line, and ``enforceSchema=False`` makes
    Spark compare the two in every file, so files with other columns are refused.
    """
    return {
        "schema": T.StructType([T.StructField(header, T.StringType())]),
        "sep": _NEVER,
        "header": True,
        "quote": "",
        "encoding": "UTF-8",
        "enforceSchema": False,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def split_lines(
    lines: DataFrame,
    header: str,
    separator: str = SEPARATOR,
    na_strings: tuple[str, ...] = NA_STRINGS,
    long_rows: str = "fail",
) -> DataFrame:
    """Lines to text columns: short rows are padded with null, quotes mean nothing.

    A row with too many fields stops the job (``long_rows="fail"``) or is left to
    :func:`long_rows_of` (``long_rows="skip"``).
    """
    names = normalized_names(header.strip().split(separator))
    line = trimmed(_named(lines.columns[0]))
    fields = F.split(line, re.escape(separator), -1)
    rows = lines.select(line.alias("line"), fields.alias("fields"))
    too_long = F.size("fields") > len(names)
    if long_rows == "skip":
        rows = rows.filter(~too_long)
    else:
        message = F.concat(
            F.lit(f"expected {len(names)} fields, saw "),
            F.size("fields").cast("string"),
            F.lit(" in line: "),
            F.col("line"),
        )
        checked = F.when(too_long, F.raise_error(message)).otherwise(F.col("fields"))
        rows = rows.select(checked.cast("array<string>").alias("fields"))
    columns = []
    for i, name in enumerate(names):
        value = F.get("fields", F.lit(i))
        columns.append(F.when(~value.isin(*na_strings), value).alias(name))
    return rows.select(*columns)



def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    header = header_line(spark, path)
    return spark.read.csv(path, **line_options(header)), header


def read_raw(
    spark: SparkSession,
    path: str,
    separator: str = SEPARATOR,
    na_strings: tuple[str, ...] = NA_STRINGS,
    long_rows: str = "fail",
) -> DataFrame:
    """The file (or every file of a directory) as normalised text columns."""
    lines, header = read_lines(spark, path)
    return split_lines(lines, header, separator, na_strings, long_rows)


def long_rows_of(spark: SparkSession, path: str, separator: str = SEPARATOR) -> DataFrame:
    """Lines with more fields than the header."""
    lines, header = read_lines(spark, path)
    line = trimmed(_named(lines.columns[0]))
    width = len(header.strip().split(separator))
    return lines.select(line.alias("line")).filter(
        F.size(F.split("line", re.escape(separator), -1)) > width
    )


def read_table(
    spark: SparkSession,
    path: str,
    *,
    date_format: str = DATE_FORMAT,
    separator: str = SEPARATOR,
    na_strings: tuple[str, ...] = NA_STRINGS,
    long_rows: str = "fail",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Scan, normalise the header and cast the typed columns."""
    raw = read_raw(spark, path, separator, na_strings, long_rows)
    return typed(raw, date_format, rules)

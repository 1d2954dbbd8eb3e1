"""Column profile, error detectors and error report.

Two passes over the data serve every column at once:

* one aggregate without a value shuffle for everything that is a count of cells
  (missing values, markers, pattern detectors), and
* one ``groupBy(column, value)`` for everything that depends on distinct values.

Long values enter the second pass as a prefix plus a SHA-256, so the shuffle never
carries whole texts.

With a permitted error of the distinct counts, values are not shuffled at all but for the few
that can be among the most frequent ones: distinct values are then estimated by mergeable
registers, and a mergeable summary of hash buckets tells which values need to be counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import rules as R
from tablewright.functions.text import trimmed
from tablewright.rules import DEFAULT_RULES, Rules
from tablewright.shared import written

_SHORT = 64


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _cell(df: DataFrame, name: str) -> Column:
    """The value as text; NaN counts as missing."""
    value = _column(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value.cast("string")


def value_key(text: Column) -> Column:
    """The value itself when short, else its start and SHA-256 (96 characters)."""
    return F.when(F.length(text) <= _SHORT, text).otherwise(
        F.concat(F.substring(text, 1, 32), F.sha2(text, 256))
    )


def normal_form(text: Column) -> Column:
    """Lower case without anything that is not a word character."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]", "")


# ------------------------------------------------------------------ frequencies

def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Count of every distinct non-null value, most frequent first."""
    value = _cell(df, column).alias("value")
    counts = df.select(value).filter("value IS NOT NULL").groupBy("value").count()
    return counts.orderBy(F.desc("count"), "value")


def _cells(df: DataFrame, columns: list[str], with_normal_form: tuple[str, ...]) -> DataFrame:
    """``(column, key, normal)`` of every non-null cell."""
    cells = []
    for name in columns:
        text = _cell(df, name)
        normal = (
            value_key(normal_form(text))
            if name.lower() in with_normal_form
            else F.lit(None).cast("string")
        )
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                value_key(text).alias("key"),
                normal.alias("normal"),
            )
        )
    return (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .filter("key IS NOT NULL")
    )


def _counted(cells: DataFrame) -> DataFrame:
    # The normal form follows from the value.  As one of the keys it is counted by hash; as an
    # aggregate, being text, it would make every task sort all its cells in memory.
    return cells.groupBy("column", "key", "normal").agg(F.count("*").alias("count"))


def key_counts(
    df: DataFrame, columns: list[str], with_normal_form: tuple[str, ...] = ()
) -> DataFrame:
    """``(column, key, normal, count)`` over the given columns in one shuffle."""
    return _counted(_cells(df, columns, with_normal_form))


def frequent_counts(
    df: DataFrame, columns: list[str], wanted: int, with_normal_form: tuple[str, ...] = (),
    buckets: int = 4096, first: int = 64,
) -> DataFrame:
    """Like :func:`key_counts`, with exact counts of the ``wanted`` most frequent values of each
    column (ties included) and of some others.

    The cells of every hash bucket are counted first, a summary of bounded size in each task.
    Values of the ``first`` heaviest buckets are counted exactly; a value elsewhere cannot be
    more frequent than its bucket is full, so only buckets that hold at least as many cells as
    the least wanted value are looked at after that.  On a column without frequent values that
    is every bucket, otherwise hardly any value that occurs once is shuffled.
    """
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    cells = _cells(df, columns, with_normal_form).withColumn("bucket", bucket)
    held = written(cells.groupBy("column", "bucket").agg(F.count("*").alias("held")), "buckets")
    heaviest = Window.partitionBy("column").orderBy(F.desc("held"), "bucket")
    ranked = held.withColumn("place", F.row_number().over(heaviest))  # buckets of a column

    def counts_in(chosen: DataFrame) -> DataFrame:
        # at most ``buckets`` rows for each column
        some = cells.join(F.broadcast(chosen.select("column", "bucket")), ["column", "bucket"])
        return _counted(some.select("column", "key", "normal"))

    counts = written(counts_in(ranked.filter(F.col("place") <= first)), "heavy-counts")
    by_count = Window.partitionBy("column").orderBy(F.desc("count"), "key")
    least = counts.withColumn("nth", F.row_number().over(by_count)).filter(
        F.col("nth") == wanted).select("column", F.col("count").alias("least"))
    more = written(
        ranked.filter(F.col("place") > first).join(F.broadcast(least), "column", "left")
        .filter(F.col("held") >= F.coalesce("least", F.lit(0))).select("column", "bucket"),
        "open-buckets")
    return counts if more.isEmpty() else counts.unionByName(counts_in(more))


def distinct_estimates(df: DataFrame, columns: list[str], error: float) -> DataFrame:
    """``(column, distinct, filled)``: distinct values estimated with a relative standard
    deviation of ``error`` by mergeable registers, in one aggregate of a row for each task."""
    numbers, rows = [], []
    for i, name in enumerate(columns):
        key = value_key(_cell(df, name))
        numbers += [F.approx_count_distinct(key, error).alias(f"distinct_{i}"),
                    F.count(key).alias(f"filled_{i}")]
        rows.append(F.struct(F.lit(name).alias("column"), F.col(f"distinct_{i}").alias("distinct"),
                             F.col(f"filled_{i}").alias("filled")))
    return df.agg(*numbers).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def distinct_and_top(counts: DataFrame) -> DataFrame:
    """Distinct values, non-null cells and the most frequent key per column."""
    return counts.groupBy("column").agg(
        F.count("*").alias("distinct"),
        F.sum("count").alias("filled"),
        F.min_by(
            F.struct("key", "count"), F.struct(-F.col("count"), F.col("key"))
        ).alias("top"),
    )


def conflicting_cells(counts: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per column: for each of the most frequent values, the cells of the most frequent
    other value that has the same normal form (longer than three characters)."""
    by_frequency = Window.partitionBy("column").orderBy(F.desc("count"), "key")
    # At most conflict_top rows per column, so the broadcast is bounded by the schema.
    top = (
        counts.filter(F.length("normal") > 3)
        .select("column", "key", "normal")
        .join(
            counts.withColumn("rank", F.row_number().over(by_frequency))
            .filter(F.col("rank") <= rules.conflict_top)
            .select("column", "key"),
            ["column", "key"],
            "left_semi",
        )
        .select("column", "normal", F.col("key").alias("top_key"))
    )
    return (
        counts.join(F.broadcast(top), ["column", "normal"])
        .filter(F.col("key") != F.col("top_key"))
        .groupBy("column", "top_key")
        .agg(
            F.min_by("count", F.struct(-F.col("count"), F.col("key"))).alias("count")
        )
        .groupBy("column")
        .agg(F.sum("count").alias("conflicts"))
    )


# -------------------------------------------------------------------- detectors

def _any_of(terms: tuple[str, ...], text: Column) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(t) for t in terms])


def _year_outside(df: DataFrame, name: str, rules: Rules) -> Column:
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        year = F.year(_column(name))
    else:
        text = trimmed(_column(name).cast("string"))
        read = [F.try_to_timestamp(text, F.lit(form)) for form in rules.date_forms]
        year = F.year(F.coalesce(*read, text.try_cast("timestamp")))
    return (year > rules.last_year) | (year < rules.first_year)


def missing_value(df: DataFrame, name: str) -> Column:
    text = _cell(df, name)
    return text.isNull() | text.isin(*R.ERROR_MARKERS)


def detectors(df: DataFrame, name: str, rules: Rules = DEFAULT_RULES) -> list[tuple[str, Column]]:
    """``(error type, condition on one cell)`` for every per-cell detector that applies
    to this column, in the fixed order that also breaks ties."""
    text = _cell(df, name)
    role = name.lower()
    found: list[tuple[str, Column]] = [("Fehlende Werte", missing_value(df, name))]
    if role == rules.latitude_column:
        found.append(("Unzulässige Werte", F.abs(text.try_cast("double")) > 90))
    elif role == rules.longitude_column:
        found.append(("Unzulässige Werte", F.abs(text.try_cast("double")) > 180))
    elif role == rules.country_column:
        found.append(("Unzulässige Werte", ~F.length(text).between(2, 50)))
    if role == rules.place_column:
        found.append(("Kryptische Werte", trimmed(text).rlike(r"^\p{L}{1,3}\z")))
    if role == rules.name_column:
        found.append(("Eingebettete Werte", text.rlike(r"(?dU)\d.*,.*\d")))
    if role in (rules.name_column, rules.place_column, rules.description_column):
        odd = text.rlike(r"(?d)&#[0-9]+;|&[a-zA-Z]+;|(.)\1{3,}")
        found.append(("Schreibfehler", odd))
    if role in rules.date_columns:
        found.append(("Widersprüchliche Werte", _year_outside(df, name, rules)))
    if role == rules.category_column:
        found.append(("Falsche Zuordnungen", _any_of(R.MISPLACED_TERMS, F.lower(text))))
    if role == rules.country_column:
        found.append(("Falsche Werte", F.lower(text).isin(*R.DUMMY_VALUES)))
    return found


def _cell_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per column: total, missing, marker counts, detector counts.

    A single aggregate; its shuffle is one row per task.
    """
    numbers, rows = [F.count("*").alias("total")], []
    for position, name in enumerate(df.columns):
        text = _cell(df, name)
        numbers.append(F.count_if(text.isNull()).alias(f"missing_{position}"))
        for m, marker in enumerate(R.ERROR_MARKERS):
            numbers.append(F.count_if(text == marker).alias(f"marker_{position}_{m}"))
        errors = []
        for d, (label, condition) in enumerate(detectors(df, name, rules)):
            numbers.append(F.count_if(condition).alias(f"error_{position}_{d}"))
            errors.append(
                F.struct(F.lit(label).alias("type"), F.col(f"error_{position}_{d}").alias("count"))
            )
        markers = [
            F.struct(
                F.col(f"marker_{position}_{m}").alias("count"),
                F.lit(-m).alias("order"),
                F.lit(marker).alias("marker"),
            )
            for m, marker in enumerate(R.ERROR_MARKERS)
        ] + [
            F.struct(
                F.col(f"missing_{position}").alias("count"),
                F.lit(-len(R.ERROR_MARKERS)).alias("order"),
                F.lit("None").alias("marker"),
            )
        ]
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.col(f"missing_{position}").alias("missing"),
                F.array_max(F.array(*markers)).alias("marker"),
                F.array(*errors).alias("errors"),
            )
        )
    return (
        df.agg(*numbers)
        .select("total", F.explode(F.array(*rows)).alias("row"))
        .select("total", "row.*")
    )


def _error_position(label: Column) -> Column:
    """Order in which detectors report, used for equal rates."""
    order = (
        "Fehlende Werte", "Eindeutigkeitsverletzungen", "Unzulässige Werte",
        "Kryptische Werte", "Eingebettete Werte", "Schreibfehler",
        "Widersprüchliche Werte", "Falsche Zuordnungen", "Falsche Werte",
        "Datenkonflikte",
    )
    return F.array_position(F.array(*[F.lit(x) for x in order]), label)


def _with_errors(cells: DataFrame, tops: DataFrame, conflicts: DataFrame, rules: Rules) -> DataFrame:
    """Attach value-based detectors and sort each column's errors by rate."""
    is_key = F.lower(F.col("column")).isin(*rules.unique_columns)
    value_errors = F.array(
        F.struct(
            F.lit("Eindeutigkeitsverletzungen").alias("type"),
            F.when(is_key, F.col("filled") - F.col("distinct")).alias("count"),
        ),
        F.struct(F.lit("Datenkonflikte").alias("type"), F.col("conflicts").alias("count")),
    )
    every = F.filter(
        F.concat("errors", value_errors), lambda e: F.coalesce(e["count"], F.lit(0)) > 0
    )
    # rows of tops and conflicts: one per column of the table
    joined = cells.join(F.broadcast(tops), "column", "left").join(
        F.broadcast(conflicts), "column", "left"
    )
    ranked = F.array_sort(
        F.transform(
            every,
            lambda e: F.struct(
                (-(e["count"] / F.col("total") * 100)).alias("minus_rate"),
                _error_position(e["type"]).alias("order"),
                e["type"].alias("type"),
            ),
        )
    )
    return joined.withColumn("errors", ranked)


def _prepared(
    df: DataFrame, columns: list[str], rules: Rules, distinct_error: float | None = None
) -> tuple[DataFrame, DataFrame]:
    conflict_columns = (rules.place_column, rules.name_column)
    if distinct_error is None:
        counts = written(key_counts(df, columns, conflict_columns), "value-counts")
        tops = distinct_and_top(counts)
    else:
        counts, tops = _estimated(df, columns, conflict_columns, rules, distinct_error)
    cells = _cell_counts(df, rules)
    return _with_errors(cells, tops, conflicting_cells(counts, rules), rules), tops


def _estimated(
    df: DataFrame, columns: list[str], conflict_columns: tuple[str, ...], rules: Rules,
    error: float,
) -> tuple[DataFrame, DataFrame]:
    """Counts of the values that matter, and tops with estimated distinct values.  Columns whose
    values must be unique are counted exactly, an estimate would be taken for an error."""
    exact = [c for c in columns if c.lower() in rules.unique_columns]
    rest = [c for c in columns if c not in exact]
    wanted = max(1, rules.conflict_top)
    parts = [key_counts(df, exact)] if exact else []
    if rest:
        frequent = written(frequent_counts(df, rest, wanted, conflict_columns), "frequent")
        parts.append(frequent)
        compared = [c for c in rest if c.lower() in conflict_columns]
        if compared:
            # values with the normal form of a frequent one: a few forms for each column
            by_count = Window.partitionBy("column").orderBy(F.desc("count"), "key")
            forms = frequent.withColumn("nth", F.row_number().over(by_count)).filter(
                F.col("normal").isNotNull() & (F.col("nth") <= wanted)
            ).select("column", "normal").distinct()
            alike = _cells(df, compared, conflict_columns).join(
                F.broadcast(forms), ["column", "normal"], "left_semi")
            parts.append(_counted(alike).join(frequent, ["column", "key"], "left_anti"))
    counts = written(reduce(DataFrame.unionByName, parts), "value-counts")
    tops = distinct_and_top(counts)
    if rest:
        estimates = distinct_estimates(df, rest, error)
        tops = tops.join(F.broadcast(estimates.withColumnsRenamed(
            {"distinct": "estimate", "filled": "cells"})), "column", "left").select(
            "column", F.coalesce("estimate", "distinct").alias("distinct"),
            F.coalesce("cells", "filled").alias("filled"), "top")
    return counts, tops


def _value_columns(df: DataFrame, rules: Rules) -> list[str]:
    """Columns whose detectors need distinct values."""
    wanted = {*rules.unique_columns, rules.place_column, rules.name_column}
    return [c for c in df.columns if c.lower() in wanted]


def column_errors(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``(column, type, rate)``: every detected error, rates in percent, unrounded.

    An empty table reports ``Keine Daten`` for every column.
    """
    checked = _checked(df, rules)
    listed = F.when(
        F.col("total") == 0,
        F.array(F.struct(F.lit(-0.0).alias("minus_rate"), F.lit(R.NO_DATA).alias("type"))),
    ).otherwise(
        F.transform(
            "errors",
            lambda e: F.struct(e["minus_rate"].alias("minus_rate"), e["type"].alias("type")),
        )
    )
    return checked.select("position", "column", F.explode_outer(listed).alias("e")).select(
        "position",
        "column",
        F.col("e.type").alias("type"),
        F.abs("e.minus_rate").alias("rate"),
    )


def _checked(df: DataFrame, rules: Rules) -> DataFrame:
    columns = _value_columns(df, rules)
    if columns:
        return _prepared(df, columns, rules)[0]
    spark = df.sparkSession
    tops = spark.createDataFrame([], "column string, distinct long, filled long")
    conflicts = spark.createDataFrame([], "column string, conflicts long")
    return _with_errors(_cell_counts(df, rules), tops, conflicts, rules)


def main_errors(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The primary error of every column: ``(column, type, rate)``."""
    first = F.get("errors", F.lit(0))
    return _checked(df, rules).select(
        "column",
        F.when(F.col("total") == 0, F.lit(R.NO_DATA))
        .otherwise(F.coalesce(first["type"], F.lit(R.NO_ERRORS)))
        .alias("type"),
        F.abs(F.coalesce(first["minus_rate"], F.lit(0.0))).alias("rate"),
    )


def error_report(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per column and error type (or one "no errors" row), rates rounded."""
    rate = F.bround(F.coalesce("rate", F.lit(0.0)), 2)
    return (
        column_errors(df, rules)
        .select(
            F.col("column").alias("Attribut"),
            F.coalesce("type", F.lit(R.NO_ERRORS)).alias("Fehlertyp"),
            rate.alias("Relative Fehlerquote (%)"),
        )
        .orderBy("Attribut", F.desc("Relative Fehlerquote (%)"))
    )


def top_markers(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Most frequent missing marker per column: ``(column, marker, count)``."""
    return _cell_counts(df, rules).select(
        "column",
        F.when(F.col("marker.count") > 0, F.col("marker.marker")).otherwise("").alias("marker"),
        F.col("marker.count").alias("count"),
    )


# ---------------------------------------------------------------------- profile

def _whole_top_values(df: DataFrame, tops: DataFrame) -> DataFrame:
    """``(column, value)``: the most frequent value in full.

    Short values are their own key.  For the columns whose top value is long (their
    number is bounded by the schema) the text is fetched from the data by its key.
    """
    best = tops.select("column", F.col("top.key").alias("key"))
    long_keys = {
        row["column"]: row["key"] for row in best.filter(F.length("key") > _SHORT).collect()
    }
    short = best.filter(F.length("key") <= _SHORT).select("column", F.col("key").alias("value"))
    if not long_keys:
        return short
    cells = [
        F.when(
            (F.length(_cell(df, name)) > _SHORT)
            & _cell(df, name).startswith(key[:32])
            & (value_key(_cell(df, name)) == key),
            F.struct(F.lit(name).alias("column"), _cell(df, name).alias("value")),
        )
        for name, key in long_keys.items()
    ]
    fetched = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .select("cell.*")
        .groupBy("column")
        .agg(F.first("value").alias("value"))
    )
    return short.unionByName(fetched)


def profile(
    df: DataFrame, rules: Rules = DEFAULT_RULES, distinct_error: float | None = None
) -> DataFrame:
    """One row per column with the twelve profile metrics.

    With ``distinct_error`` the numbers of distinct values (but for columns whose values must be
    unique) are estimates with that relative standard deviation; all else stays exact."""
    checked, tops = _prepared(df, df.columns, rules, distinct_error)
    tops = written(tops, "top-values")

    def percent(count: Column) -> Column:
        share = F.bround(count / F.col("total") * 100, 2)
        return F.when(F.col("total") > 0, share).otherwise(0.0)

    first = F.get("errors", F.lit(0))
    marker = F.col("marker.count")
    top_count = F.coalesce("top.count", F.lit(0))
    return (
        checked.join(F.broadcast(_whole_top_values(df, tops)), "column", "left")
        .orderBy("position")
        .select(
            F.col("column").alias("Spalte"),
            F.col("total").alias("Zeilen"),
            F.col("missing").alias("Fehlende Werte"),
            percent(F.col("missing")).alias("Fehlende Werte %"),
            F.coalesce("distinct", F.lit(0)).alias("Eindeutige Werte"),
            F.when(marker > 0, F.col("marker.marker")).otherwise("").alias("Häufigste Fehlerart"),
            marker.alias("Fehler Häufigkeit"),
            percent(marker).alias("Fehler %"),
            F.coalesce("value", F.lit("")).alias("Häufigster Wert"),
            percent(top_count).alias("Häufigster Wert %"),
            F.when(F.col("total") == 0, F.lit(R.NO_DATA))
            .otherwise(F.coalesce(first["type"], F.lit(R.NO_ERRORS)))
            .alias("Hauptfehlertyp (Naumann/Leser)"),
            F.bround(F.abs(F.coalesce(first["minus_rate"], F.lit(0.0))), 2).alias(
                "Hauptfehlerrate %"
            ),
        )
    )

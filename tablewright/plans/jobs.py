"""Composed batch jobs: load, clean, search duplicates, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.jobs import job_facts
from tablewright.functions.names import normalize_name, split_postal_code
from tablewright.functions.text import clean_markup
from tablewright.operators.consolidate import consolidate_names
from tablewright.operators.lookup import resolve_codes
from tablewright.rules import DEFAULT_RULES, Rules


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def backfill_postal_codes(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Move postal codes out of the name column; existing codes are kept."""
    name, code = split_postal_code(F.col(f"`{rules.name_column}`").cast("string"))
    if rules.postal_column in df.columns:
        code = F.coalesce(F.col(f"`{rules.postal_column}`").cast("string"), code)
    return df.withColumns({rules.postal_column: code, rules.name_column: name})


def add_job_facts(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Contract term, working time and pay from the description column."""
    return df.withColumns(job_facts(F.col(f"`{rules.description_column}`")))


def clean_table(
    df: DataFrame, codes: DataFrame | None = None, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Postal codes, markup, place codes, organisation names, job facts - in this order.

    Only the columns that were text at the start are cleaned.  Everything but the name
    consolidation is one chain of native expressions without a shuffle.
    """
    texts = text_columns(df)
    if rules.name_column in df.columns:
        df = backfill_postal_codes(df, rules)
    df = df.withColumns({c: clean_markup(F.col(f"`{c}`")) for c in texts})
    if rules.place_column in texts and codes is not None:
        df = resolve_codes(df, rules.place_column, codes)
    if rules.name_column in texts:
        df = df.withColumn(rules.name_column, normalize_name(F.col(f"`{rules.name_column}`")))
        df = consolidate_names(df, rules.name_column, rules.name_score, rules.block_head)
    if rules.description_column in df.columns:
        df = add_job_facts(df, rules)
    return df

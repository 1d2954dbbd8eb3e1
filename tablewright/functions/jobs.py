"""Facts in free text: contract term, working time, pay (native expressions only).

All patterns are matched case-insensitively on the original text, so an extracted
piece keeps its spelling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright import rules as R
from tablewright.functions.text import found, pattern, removed, squeezed, trimmed


def contract_term(text: Column) -> Column:
    """Open-ended wins; otherwise the fixed-term phrase with its tail cleaned."""
    phrase = found(text, R.FIXED_TERM + R.FIXED_TERM_EXCLUSION)
    for tail in R.FIXED_TERM_TAILS:
        phrase = removed(phrase, tail)
    return F.coalesce(
        found(text, R.OPEN_ENDED),
        F.when(~text.rlike(pattern(R.FIXED_TERM_RAISE)), trimmed(phrase)),
    )


def _number(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit(".")).try_cast("double")


def working_time(text: Column) -> Column:
    """Full or part time; the first kind of statement found decides."""

    def rated(is_full: Column) -> Column:
        return F.when(is_full, F.lit(R.FULL_TIME)).otherwise(F.lit(R.PART_TIME))

    weekly = found(text, R.HOURS_PER_WEEK, 1)
    monthly = found(text, R.HOURS_PER_MONTH, 1)
    percent = found(text, R.PERCENT, 1)
    bare = found(text, R.HOURS_BARE, 1)
    return (
        F.when(text.rlike(pattern(R.FULL_TIME_WORD)), F.lit(R.FULL_TIME))
        .when(text.rlike(pattern(R.PART_TIME_WORD)), F.lit(R.PART_TIME))
        .when(weekly.isNotNull(), rated(_number(weekly) >= R.FULL_TIME_HOURS))
        .when(
            monthly.isNotNull(),
            rated(_number(monthly) / R.WEEKS_PER_MONTH >= R.FULL_TIME_HOURS),
        )
        .when(percent.isNotNull(), rated(_number(percent) >= R.FULL_TIME_PERCENT))
        .when(
            _number(bare) <= R.MAX_WEEK_HOURS,
            rated(_number(bare) >= R.FULL_TIME_HOURS),
        )
    )


def _grade(text: Column, grade_pattern: str, group: int, highest: int) -> Column:
    """Condition: the first match carries a grade from 1 to ``highest``."""
    return found(text, grade_pattern, group).try_cast("int").between(1, highest)


def tariff_pay(text: Column) -> Column:
    """Collective tariff with grade, for example ``TV-L E13``."""
    label = F.upper(found(text, R.TARIFF_GRADE))
    label = F.regexp_replace(label, r"(?U)\s+", " ")
    label = F.regexp_replace(label, "TV-?[LÖD]+", "TV-L")
    label = F.regexp_replace(label, "TV[ÖO]D", "TVöD")
    return F.when(_grade(text, R.TARIFF_GRADE, 2, 15), label)


def grade_pay(text: Column) -> Column:
    """Bare E/EG grade; a grade at the very end of the text does not count."""
    whole = found(text, R.BARE_GRADE)
    grade = F.upper(found(text, R.BARE_GRADE, 1))
    behind = F.get(F.split(text, pattern(R.BARE_GRADE), 2), F.lit(1))
    prefix = F.when(F.lower(whole).contains("eg"), F.lit("EG ")).otherwise(F.lit("E "))
    return F.when(
        _grade(text, R.BARE_GRADE, 2, 15) & (behind != ""), F.concat(prefix, grade)
    )


def civil_pay(text: Column) -> Column:
    """Civil-service grade ``A n``."""
    return F.when(
        _grade(text, R.CIVIL_GRADE, 1, 16),
        F.concat(F.lit("A "), found(text, R.CIVIL_GRADE, 1)),
    )


def mini_job_pay(text: Column) -> Column:
    return F.when(text.rlike(pattern(R.MINI_JOB)), F.lit(R.MINI_JOB_LABEL))


def amount_pay(text: Column) -> Column:
    """Euro amount: the first of five ordered patterns that matches."""
    whole = found(text, R.SPLIT_AMOUNT)
    units = found(text, R.SPLIT_AMOUNT, 1)
    cents = found(text, R.SPLIT_AMOUNT, 2)
    tail = F.substring(
        whole, F.length(units) + F.length(cents) + 2, F.length(whole)
    )
    amount = F.coalesce(
        F.concat(units, F.lit(","), cents, tail), *[found(text, p) for p in R.AMOUNTS]
    )
    amount = F.regexp_replace(squeezed(amount), "[,;-]+$", "")
    amount = F.replace(amount, F.lit("eur "), F.lit("Euro "))
    return F.replace(amount, F.lit("€"), F.lit("Euro"))


def pay(text: Column) -> Column:
    """Pay statement, most specific kind first."""
    return F.coalesce(
        tariff_pay(text),
        grade_pay(text),
        civil_pay(text),
        mini_job_pay(text),
        amount_pay(text),
    )


def job_facts(text: Column) -> dict[str, Column]:
    """The three derived columns of a description column."""
    return {
        "fixedterm": contract_term(text),
        "workinghours": working_time(text),
        "salary": pay(text),
    }

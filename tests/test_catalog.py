"""Registered queries against their SQL on the smallest benchmark tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__

SF_DIR = Path("/root/testdata/sf0.001")
SLOW = {"candidate_pairs", "exact_duplicates", "without_exact_duplicates", "profile_documents",
        "profile_part", "top_markers", "main_errors"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", sorted(set(__spark_entry__.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect())
    cursor = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    assert columns == sorted(names)
    assert got == expected


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_returns_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_plans_keep_work_native_and_avoid_cross_products(spark):
    """Native queries run without Python; no query plans a product of its inputs."""
    for name in ("clean_markup", "normalize_names", "job_facts", "delimited_parse", "error_rates"):
        df = __spark_entry__.queries()[name](spark, str(SF_DIR))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_names_of_a_small_file_are_cleaned_on_all_cores(spark):
    """The parts are one short file; cleaning them was the work of one task (F17)."""
    df = __spark_entry__.queries()["clean_organisations"](spark, str(SF_DIR))
    assert "RoundRobinPartitioning" in df._jdf.queryExecution().executedPlan().toString()

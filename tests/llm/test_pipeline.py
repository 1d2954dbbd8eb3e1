"""The pipeline and the registered queries of the corpus operators."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tablewright.llm import queries

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not present")


def test_stages_keep_columns_and_only_drop_rows(spark, tmp_path):
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, str(SF_DIR))
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= {r[0] for r in docs.select("doc_id").collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        else:
            assert ids == {r[0] for r in docs.select("doc_id").collect()}
        docs = after


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(1, None, None, "s", 0), (None, "", "en", None, 0), (2, "x", None, None, None)]
    rows += [(i, "the cat sat on a mat " + "word%d " % i * 4, "en", "s", 9) for i in range(3, 40)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part, table in (("some", df), ("none", df.limit(0))):
        table.write.parquet(str(tmp_path / part / "documents.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / part))
        assert found.count() >= 0 and "sequence_id" in found.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, str(SF_DIR))
    cursor = connection.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(cursor.fetchall())
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == expected


def test_language_accuracy_on_held_out_rows(spark):
    found = queries.QUERIES["op2_language"](spark, str(SF_DIR)).alias("f")
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet")).alias("d")
    rows = found.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL").select(
        "lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)

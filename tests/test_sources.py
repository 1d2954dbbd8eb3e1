import datetime
import json

import pytest
from pyspark.sql import functions as F

from tablewright.sources import codes, delimited, sinks
from tablewright.streaming.chunks import ingest_chunks

SEP = "_§_"


def write(path, *rows):
    path.write_text("\n".join(SEP.join(row) for row in rows) + "\n", encoding="utf-8")
    return str(path)


def test_casts_and_names(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("*JobID*", "date", "geo_lat", "geo_lon"),
                 ("1", "01-02-2020", "52.5", "13.4"))
    df = delimited.read_table(spark, path)
    assert dict(df.dtypes) == {
        "jobid": "bigint", "date": "date", "geo_lat": "double", "geo_lon": "double"}
    assert df.first() == (1, datetime.date(2020, 2, 1), 52.5, 13.4)


def test_unparsable_values_become_null_and_are_listed(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("_JobID_", "date", "geo_lat", "geo_lon"),
                 ("abc", "01-02-2020", "52", "13"), ("abc", "2020/01/01", "x", "nan"),
                 ("2.0", "1-2-2020", "1e1", " 7 "), ("2.5", "31-02-2020", "", "inf"))
    rows = delimited.read_table(spark, path).orderBy("geo_lat").collect()
    assert [r.jobid for r in rows] == [None, None, 2, None]
    assert [r.date for r in rows] == [None, None, datetime.date(2020, 2, 1), datetime.date(2020, 2, 1)]
    rejected = delimited.rejected_values(delimited.read_raw(spark, path))
    assert {tuple(r) for r in rejected.collect()} == {
        ("jobid", "abc"), ("jobid", "2.5"), ("date", "2020/01/01"), ("date", "31-02-2020")}


def test_custom_date_format(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("_JobID_", "date"), ("1", "2020/01/02"))
    df = delimited.read_table(spark, path, date_format="%Y/%m/%d")
    assert df.first().date == datetime.date(2020, 1, 2)
    assert delimited.spark_date_format("%d.%m.%Y %H:%M") == ("d.M.yyyy H:m", True)
    with pytest.raises(ValueError):
        delimited.spark_date_format("%Q")


def test_colliding_names_are_refused(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("_JobID_", "_Dup_", "_dup_"), ("1", "a", "b"))
    with pytest.raises(ValueError, match="Duplicate column names"):
        delimited.read_table(spark, path)


def test_all_rows_of_a_long_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("_JobID_", "date", "geo_lat"),
                 *[(str(i), "01-02-2020", "5") for i in range(2500)])
    df = delimited.read_table(spark, path)
    assert df.count() == 2500
    assert df.agg(F.sum("jobid")).first()[0] == sum(range(2500))


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        delimited.read_table(spark, str(tmp_path / "none.csv"))


def test_short_and_long_rows_quotes_and_markers(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("a", "b", "c"), ('"x', 'y"'), ("1", "NaN", "na"), ("",),
                 ("1", "2", "3", "4"))
    df = delimited.read_raw(spark, path, long_rows="skip")
    assert {tuple(r) for r in df.collect()} == {('"x', 'y"', None), ("1", None, "na")}
    assert [r.line for r in delimited.long_rows_of(spark, path).collect()] == ["1_§_2_§_3_§_4"]
    with pytest.raises(Exception, match="expected 3 fields, saw 4"):
        delimited.read_raw(spark, path).collect()


def test_directory_of_files_with_headers(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"{i}.csv", ("_JobID_", "x"), (str(i), "v"))
    assert {r.jobid for r in delimited.read_table(spark, str(tmp_path)).collect()} == {0, 1, 2}
    write(tmp_path / "9.csv", ("x", "_JobID_"), ("v", "9"))
    with pytest.raises(Exception):
        delimited.read_table(spark, str(tmp_path)).collect()


def test_chunked_ingest_reports_progress_and_resumes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        write(source / f"{i}.csv", ("_JobID_", "x"), *[(str(10 * i + j), "v") for j in range(4)])
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    result = ingest_chunks(spark, str(source), target, state)
    assert result.rows_read == [4, 8, 12]
    write(source / "3.csv", ("_JobID_", "x"), ("99", "v"))
    again = ingest_chunks(spark, str(source), target, state)
    assert again.rows_read == [1]
    assert again.table.count() == 13


def test_code_table_scan_build_choice_sink(spark, tmp_path):
    stored = tmp_path / "codes.json"
    stored.write_text(json.dumps({"B": "Berlin", "MZ": "Mainz"}))
    small = codes.read_codes(spark, str(stored))
    assert {tuple(r) for r in small.collect()} == {("B", "Berlin"), ("MZ", "Mainz")}
    assert codes.read_codes(spark, str(tmp_path / "none.json")).isEmpty()
    (tmp_path / "bad.json").write_text("{not json")
    assert codes.read_codes(spark, str(tmp_path / "bad.json")).isEmpty()

    def cell(value):
        return {"type": "literal", "value": value}

    bindings = [{"licencePlate": cell(c), "itemLabel": cell(p)} for c, p in
                [("B", "Bonn"), ("abc", "x"), ("ABCD", "x"), ("B", "Berlin"), ("HH", "Hamburg")]]
    bindings.append({"licencePlate": cell("M")})
    response = tmp_path / "response.json"
    response.write_text(json.dumps({"results": {"bindings": bindings}}))
    fresh = codes.codes_from_bindings(spark, str(response))
    assert {tuple(r) for r in fresh.collect()} == {("B", "Berlin"), ("HH", "Hamburg")}

    assert codes.choose_codes(small, fresh) is fresh
    assert codes.choose_codes(small, fresh.limit(0)) is small
    many = spark.range(10).selectExpr("cast(id as string) code", "'x' place")
    assert codes.choose_codes(many, fresh) is many
    codes.write_codes(fresh, str(tmp_path / "dim"))
    codes.write_codes(small, str(tmp_path / "dim"))
    assert spark.read.parquet(str(tmp_path / "dim")).count() == 2


def test_delimited_export_round_trip(spark, tmp_path):
    rows = [("a_§_b", 'say "x"', "line\nbreak"), (" pad ", None, "\\ back"), ("x,y", "'", "ü")]
    df = spark.createDataFrame(rows, "_A_ string, _B_ string, _C_ string")
    path = str(tmp_path / "out")
    sinks.write_delimited(df, path)
    back = sinks.read_delimited_export(spark, path, df.schema)
    assert {tuple(r) for r in back.collect()} == set(rows)


def test_table_and_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ('q"x', 2)], "s string, n int")
    sinks.write_cleaned(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    sinks.write_report(df, str(tmp_path / "c"), "csv")
    back = spark.read.csv(str(tmp_path / "c"), header=True, escape='"')
    assert {r.s for r in back.collect()} == {"a", 'q"x'}


def test_names_with_dots(spark, tmp_path):
    path = write(tmp_path / "a.csv", ("_JobID_", "_geo.x_"), ("1", "a"), ("x", "b"))
    raw = delimited.read_raw(spark, path)
    assert raw.columns == ["jobid", "geo.x"]
    assert delimited.typed(raw).collect()[0][1] == "a"
    assert [tuple(r) for r in delimited.rejected_values(raw).collect()] == [("jobid", "x")]


def test_progress_over_more_chunks_than_the_session_remembers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        write(tmp_path / "in" / f"{i:02d}.csv", ("_JobID_", "date"),
              *[(str(4 * i + j), "01-02-2020") for j in range(4)])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        got = ingest_chunks(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert got.rows_read == list(range(4, 49, 4)) and got.table.count() == 48


def test_a_load_writes_rows_and_rejects_in_one_pass(spark, tmp_path):
    lines = [(str(i) if i % 5 else f"x{i % 3}", "01-02-2020" if i % 4 else "soon", "a") for i in range(40)]
    path = write(tmp_path / "a.csv", ("_JobID_", "date", "rejected"), *lines)
    raw = delimited.read_raw(spark, path)
    (tmp_path / "in").mkdir()
    found = delimited.load_table(raw, str(tmp_path / "out"))
    (tmp_path / "a.csv").write_text("")  # nothing is read again
    assert found.table.columns == raw.columns
    assert sorted(map(repr, found.table.collect())) == sorted(map(repr, (
        (None if i % 5 == 0 else i, datetime.date(2020, 2, 1) if i % 4 else None, "a")
        for i in range(40))))
    assert {tuple(r) for r in found.rejected.collect()} == {
        ("date", "soon"), *{("jobid", f"x{i % 3}") for i in range(0, 40, 5)}}
    assert (found.rows, found.faulty_rows) == (40, sum(not (i % 5 and i % 4) for i in range(40)))
    plan = found.rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected__row" in plan and "date:" not in plan
    empty = delimited.load_table(raw.limit(0), str(tmp_path / "none"))
    assert empty.table.count() == empty.rejected.count() == empty.rows == 0

import collections
import datetime
import random

import pytest

from tablewright import rules as R
from tablewright.operators import profile


def by_column(df, name="Spalte"):
    return {r[name]: r for r in df.collect()}


def errors(df):
    return {(r["column"], r["type"]): r["rate"] for r in profile.column_errors(df).collect()}


def one(spark, name, items, kind="string"):
    return spark.createDataFrame([(v,) for v in items], f"{name} {kind}")


def test_metrics(spark):
    df = spark.createDataFrame(
        [("1", "x"), ("2", "y"), (None, "x"), ("??", "na")], "a string, b string")
    rows = by_column(profile.profile(df))
    a, b = rows["a"], rows["b"]
    assert (a["Zeilen"], a["Fehlende Werte"], a["Fehlende Werte %"], a["Eindeutige Werte"]) == (
        4, 1, 25.0, 3)
    assert (b["Häufigste Fehlerart"], b["Fehler Häufigkeit"], b["Fehler %"]) == ("na", 1, 25.0)
    assert (b["Häufigster Wert"], b["Häufigster Wert %"]) == ("x", 50.0)
    assert profile.profile(df).columns[0] == "Spalte" and len(profile.profile(df).columns) == 12


def test_null_marker_and_empty_table(spark):
    df = one(spark, "c", [None, None, "x"])
    row = by_column(profile.top_markers(df), "column")["c"]
    assert (row["marker"], row["count"]) == ("None", 2)
    empty = by_column(profile.profile(df.limit(0)))["c"]
    assert empty["Hauptfehlertyp (Naumann/Leser)"] == R.NO_DATA
    assert (empty["Fehlende Werte %"], empty["Häufigster Wert"]) == (0.0, "")


def test_long_top_value_is_shown_in_full(spark):
    long = "wort " * 100
    df = one(spark, "c", [long, long, "a", long + "x"])
    row = by_column(profile.profile(df))["c"]
    assert row["Häufigster Wert"] == long and row["Eindeutige Werte"] == 3


def test_detectors(spark):
    assert errors(one(spark, "x", [None, None, "??", "ok"]))[("x", "Fehlende Werte")] == 75.0
    assert errors(one(spark, "jobid", [1, 2, 2, 3], "long")) == {
        ("jobid", "Eindeutigkeitsverletzungen"): 25.0}
    assert errors(one(spark, "geo_lat", [91.0, -91.0, 5.0, None], "double"))[
        ("geo_lat", "Unzulässige Werte")] == 50.0
    assert errors(one(spark, "geo_lon", ["-181", "x", "5", "7"])) == {
        ("geo_lon", "Unzulässige Werte"): 25.0}
    assert errors(one(spark, "country", ["x", "TEST", "y" * 51, "Land"])) == {
        ("country", "Unzulässige Werte"): 50.0, ("country", "Falsche Werte"): 25.0}
    assert errors(one(spark, "location", [" HH ", "B2", "Ulm1", "ÖP"])) == {
        ("location", "Kryptische Werte"): 50.0}
    assert errors(one(spark, "company", ["12 A, B 3", "A, 3", "ok", "gut"])) == {
        ("company", "Eingebettete Werte"): 25.0}
    assert errors(one(spark, "company", ["ok", "&#8222;t&#8220;", "gut", "&auml;", "aaaa", "aaa"]))[
        ("company", "Schreibfehler")] == 50.0
    assert errors(one(spark, "date", ["2030-01-01", "1999-12-31", "2020-01-01", "kaputt"])) == {
        ("date", "Widersprüchliche Werte"): 50.0}
    dates = [datetime.date(2026, 1, 1), datetime.date(2000, 1, 1)]
    assert errors(one(spark, "date", dates, "date")) == {("date", "Widersprüchliche Werte"): 50.0}
    assert errors(one(spark, "jobtype", ["Foo GmbH", "Praktikum", "Auftrag", "x"])) == {
        ("jobtype", "Falsche Zuordnungen"): 50.0}
    assert errors(one(spark, "name", ["clean", "data", "here"])) == {("name", None): None}


def test_conflicting_spellings(spark):
    items = ["Uni X"] * 3 + ["uni-x"] * 2 + ["UNI X"] + ["abc", "a-bc", "Haus"]
    # Uni X -> uni-x (2), uni-x -> Uni X (3), UNI X -> Uni X (3); three letters are too short
    assert abs(errors(one(spark, "company", items))[("company", "Datenkonflikte")] - 8 / 9 * 100) < 1e-9


def test_report(spark):
    df = spark.createDataFrame(
        [(1.0, "&#8222;test&#8220;", 1, "value1"), (None, "normal", 2, "value2"), (3.0, "x", 2, "v3")],
        "a double, company string, jobid long, clean_col string")
    rows = [tuple(r) for r in profile.error_report(df).collect()]
    assert rows == [
        ("a", "Fehlende Werte", 33.33),
        ("clean_col", R.NO_ERRORS, 0.0),
        ("company", "Schreibfehler", 33.33),
        ("jobid", "Eindeutigkeitsverletzungen", 33.33),
    ]


def test_value_frequency(spark):
    rows = profile.value_frequency(one(spark, "c", ["b", "a", "b", None]), "c").collect()
    assert [tuple(r) for r in rows] == [("b", 2), ("a", 1)]


def test_text_dates_in_several_forms(spark):
    outside = ["01-02-2030", "15.06.1999", "2031-01-01", "06/15/1999", "June 3, 2040"]
    assert errors(one(spark, "date", outside)) == {("date", "Widersprüchliche Werte"): 100.0}
    inside = ["01-02-2020", "31.12.2019", "12/31/2021", "3 June 2020", "nie"]
    assert errors(one(spark, "date", inside)) == {("date", None): None}


def test_frequent_counts_hold_the_most_frequent_values(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("abc") if rnd.random() < 0.3 else f"x{rnd.randint(0, 3000)}", f"u{i}",
             rnd.choice([None, "k", "K.", "l"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "often string, once string, company string").repartition(3)
    for wanted, first in ((1, 2), (10, 64), (10, 5000)):
        got = profile.frequent_counts(df, df.columns, wanted, ("company",), 512, first).collect()
        assert len({(r["column"], r["key"]) for r in got}) == len(got)
        for i, name in enumerate(df.columns):
            exact = collections.Counter(r[i] for r in rows if r[i] is not None)
            mine = {r["key"]: r["count"] for r in got if r["column"] == name}
            assert all(exact[k] == n for k, n in mine.items())
            top = sorted(exact, key=lambda k: (-exact[k], k))[:wanted]
            assert set(top) <= set(mine)
    assert {(r["key"], r["normal"]) for r in got if r["column"] == "company"} == {
        ("k", "k"), ("K.", "k"), ("l", "l")}


def test_cells_are_counted_without_sorting_them(spark):
    """As an aggregate the normal form made every task sort all its cells in memory (F18)."""
    df = one(spark, "company", ["Uni X", "uni-x", "Uni X", None, "z" * 100])
    found = profile.key_counts(df, ["company"], ("company",))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r["normal"], r["count"]) for r in found.collect() if r["key"].lower()[0] == "u"} == {
        ("unix", 2), ("unix", 1)}
    assert found.count() == 3


def test_frequent_counts_shuffle_few_values_that_occur_once(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN concat('t', id % 50) ELSE concat('s', id) END AS c")
    found = profile.frequent_counts(df, ["c"], 10)
    assert found.filter("count = 1").count() < 0.05 * 20_000


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_estimated_profile(spark, error):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 20_000), rnd.choice(["Ulm", "ULM", "Kiel", None, "??"]))
            for i in range(15_000)]
    df = spark.createDataFrame(rows, "jobid long, salary long, location string")
    exact = {r["Spalte"]: r.asDict() for r in profile.profile(df).collect()}
    found = {r["Spalte"]: r.asDict() for r in profile.profile(df, distinct_error=error).collect()}
    for name, row in found.items():
        distinct, true = row.pop("Eindeutige Werte"), exact[name].pop("Eindeutige Werte")
        assert abs(distinct - true) <= 3 * error * true
        assert row == exact[name]
    assert profile.profile(df.limit(0), distinct_error=error).count() == 3

import html
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.functions import jobs, names, text
from tablewright.operators.lookup import resolve_codes
from tablewright.plans.jobs import backfill_postal_codes, clean_table


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def column(spark, items, name="s"):
    return spark.createDataFrame(list(enumerate(items)), f"i int, {name} string")


def apply(spark, items, function):
    return values(column(spark, items).select("i", function(F.col("s")).alias("o")), "o")


PIECES = st.sampled_from(
    ["&", "&amp;", "&amp", "&lt;", "&#", "&#x", "&#65;", "&#x41", "&#8222;", "&#128;", "&#0;",
     "&#xD800;", "&#x110000;", "&#1;", "&#13;", "&#xFFFE;", "&notit;", "&notin;", "&not",
     "&hellip;", "&bogus;", "&Aacute", "&#99999999999999999999;", "&#x000000041;", ";", "a", "Z9",
     " ", "<b>", "</b>", "<", ">", "\n", "ü", "😀", "&ThickSpace;", "&nGt;"])


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=40, max_size=40))
def test_markup_cleaning_matches_the_standard_library(spark, items):
    expected = [html.unescape(re.sub(r"<.*?>", "", s)) for s in items]
    assert apply(spark, items, text.clean_markup) == expected


def test_markup_examples(spark):
    assert apply(spark, ["AT&amp;T", "<b>Bold</b>", None], text.clean_markup) == [
        "AT&T", "Bold", None]


def test_trimming(spark):
    items = [" \t\nB\xa0 ", "a b", "", "\x1c x", None, "   "]
    assert apply(spark, items, text.trimmed) == ["B", "a b", "", "x", None, ""]


def test_postal_codes(spark):
    rows = [("Haus, 12345 Bad Köln-Süd", None), ("Haus, 12345", None), (" Haus 12345 Ulm", None),
            ("Haus 12345", None), ("Haus,12345 Ulm", "999"), (None, None), ("A, 123456 Ulm", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, company string, plz string")
    out = backfill_postal_codes(df).orderBy("i").collect()
    assert [r.company for r in out] == [
        "Haus", "Haus", "Haus", "Haus 12345", "Haus", None, "A, 123456 Ulm"]
    assert [r.plz for r in out] == ["12345", "12345", "12345", None, "999", None, None]


@pytest.mark.parametrize("raw, clean", [
    ("Uni Köln, KÖLN", "Uni Köln"),
    ("Uni,Köln", "Uni,Köln"),
    ("Verein eV", "Verein e.V."),
    ("Verein e.V.", "Verein e.V"),
    ("Firma gmbh .", "Firma GmbH"),
    ("A,, B, ", "A, B"),
    ("A  B-   C", "A B- C"),
    ("hochschule X, Hochschulbibliothek", "Hochschule X"),
    ("X, Standort Süd", "X"),
    ("X, Softwarehersteller für Bibliotheken AG", "X AG"),
    ("X, Referat Benutzung", "X"),
])
def test_name_rules(spark, raw, clean):
    assert apply(spark, [raw], names.normalize_name) == [clean]


def test_code_lookup(spark):
    dimension = spark.createDataFrame(
        [("B", "Berlin"), ("MZ", "Mainz"), ("HH", "Hamburg"), ("AM", "Amberg")],
        "code string, place string")
    items = ["B", "MZ", "b", "AM", "Frankfurt", "Frankfurt am Main", "Berlin Mitte", "  B  ",
             "HH-City", None, "", "\tB\t", "\nB\n", "  HH  "]
    expected = ["Berlin", "Mainz", "Berlin", "Amberg", "Frankfurt", "Frankfurt am Main",
                "Berlin Mitte", "Berlin", "HH-City", None, "", "Berlin", "Berlin", "Hamburg"]
    df = column(spark, items, "location")
    assert values(resolve_codes(df, "location", dimension), "location") == expected
    assert values(resolve_codes(df, "location", dimension.limit(0)), "location") == items


FACTS = [
    ("befristet bis 31.12.2025, Vollzeit, Vergütung nach TV-L E13",
     "befristet bis 31.12.2025", "Vollzeit", "TV-L E13"),
    ("unbefristet, Teilzeit (50%), E9 TV-L", "unbefristet", "Teilzeit", "E 9"),
    (None, None, None, None),
    ("befristet, 20 Stunden/Woche, 3000 € monatlich", "befristet", "Teilzeit", "3000 Euro monat"),
    ("Befristet für 2 Jahre mit 39 Std. pro Woche", "Befristet für 2 Jahr", "Vollzeit", None),
    ("befristete Erhöhung, befristet", None, None, None),
    ("befristet auf zwei Jahre in Vollzeit", None, "Vollzeit", None),
    ("befristet bis 31.12.2025 Vollzeit", "befristet", "Vollzeit", None),
    ("zunächst befristet als Elternzeitvertretung", "befristet als Elternzeitvertretung", None, None),
    ("38,5 Stunden pro Woche", None, "Vollzeit", None),
    ("35.9 Std./Woche", None, "Teilzeit", None),
    ("160 Stunden im Monat", None, "Vollzeit", None),
    ("zu 89,9 %", None, "Teilzeit", None),
    ("Umfang von 61 Stunden", None, None, None),
    ("Umfang von 40 Stunden", None, "Vollzeit", None),
    ("TVöD E9 b", None, None, "TV-L E9 B"),
    ("TV-L E9 bis E11", None, None, "TV-L E9 B"),
    ("tvod  eg 5", None, None, "TVöD EG 5"),
    ("TV-L E16 dann E9 x", None, None, None),
    ("nach E9", None, None, None),
    ("E9 bis x", None, None, "E 9"),
    ("EG 9b x", None, None, "EG 9B"),
    ("Besoldung A 13", None, None, "A 13"),
    ("A 17", None, None, None),
    ("1450 € im Jahr", None, None, "450 Euro-Job"),
    ("8 50 Euro/Stunde", None, None, "8,50 Euro/Stunde"),
    ("12,50 €/h", None, None, "12,50 Euro/h"),
    ("Stundenlohn von 12,50 Euro", None, None, "Stundenlohn von 12,50 Eur"),
    ("3000 Euro", None, None, "3000 Eur"),
    ("3000 €-job", None, None, None),
    ("2500 eur / Monat", None, None, "2500 Euro / Monat"),
]


def test_job_facts(spark):
    df = column(spark, [f[0] for f in FACTS], "jobdescription")
    out = clean_table(df).orderBy("i").collect()
    assert [(r.jobdescription, r.fixedterm, r.workinghours, r.salary) for r in out] == FACTS


def test_long_text_does_not_overflow(spark):
    long = "befristet " + "wort " * 40_000 + "x" * 50_000
    out = column(spark, [long]).select(*jobs.job_facts(F.col("s")).values()).collect()
    assert out[0][0] == "befristet"


def test_clean_table_location_and_other(spark):
    dimension = spark.createDataFrame([("B", "Berlin"), ("MZ", "Mainz")], "code string, place string")
    df = spark.createDataFrame(
        [(0, "B", "<b>Test</b>"), (1, "MZ", "Normal"), (2, "Frankfurt", "AT&amp;T")],
        "i int, location string, other string")
    out = clean_table(df, dimension)
    assert values(out, "location") == ["Berlin", "Mainz", "Frankfurt"]
    assert values(out, "other") == ["Test", "Normal", "AT&T"]


def test_clean_table_adds_postal_column(spark):
    df = spark.createDataFrame([(0, "Frankfurt", "<b>Test &amp; Co</b>"), (1, None, None)],
                               "i int, location string, company string")
    out = clean_table(df)
    assert out.columns == ["i", "location", "company", "plz"]
    assert values(out, "company") == ["Test & Co", None]
    assert values(out, "plz") == [None, None]

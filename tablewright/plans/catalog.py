"""Registered queries over the benchmark tables, each with its SQL where SQL can say it.

The benchmark tables hold no job ads, so some queries first derive ad-like columns from
whole tables with plain expressions; the SQL derives the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import rules as R
from tablewright.functions import jobs, names, similarity, text
from tablewright.operators import candidates, consolidate, dedupe, lookup, profile
from tablewright.plans.jobs import add_job_facts, backfill_postal_codes, clean_table
from tablewright.rules import DEFAULT_RULES
from tablewright.shared import fan_out, work_folder, written
from tablewright.sources import codes, delimited, sinks
from tablewright.streaming.chunks import ingest_chunks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The needed columns of a table, on every core even if the file is one row group."""
    return fan_out(table(spark, sf_dir, name).select(*columns))


# ----------------------------------------------------------------- derived inputs
# Every expression below is valid in Spark SQL and in DuckDB alike.

_AD_TEXT = """
    concat(
        CASE o_orderkey % 8
            WHEN 0 THEN 'Unbefristet'
            WHEN 1 THEN concat('befristet bis ', CAST(day(o_orderdate) AS VARCHAR(2)), '.',
                               CAST(month(o_orderdate) AS VARCHAR(2)), '.',
                               CAST(year(o_orderdate) AS VARCHAR(4)))
            WHEN 2 THEN concat('Befristet für ', CAST(o_custkey % 9 + 1 AS VARCHAR(9)), ' Monate')
            WHEN 3 THEN 'befristete Erhöhung, befristet'
            WHEN 4 THEN 'zunächst befristet als Krankheitsvertretung'
            WHEN 5 THEN 'befristet auf zwei Jahre in Vollzeit'
            WHEN 6 THEN 'befristet in'
            ELSE 'Stelle' END,
        CASE o_custkey % 9
            WHEN 0 THEN ', Vollzeit'
            WHEN 1 THEN ', Teilzeit'
            WHEN 2 THEN concat(', ', CAST(o_orderkey % 45 AS VARCHAR(9)), ',5 Stunden pro Woche')
            WHEN 3 THEN concat(', ', CAST(o_orderkey % 200 AS VARCHAR(9)), ' Std. im Monat')
            WHEN 4 THEN concat(', ', CAST(o_orderkey % 101 AS VARCHAR(9)), ' %')
            WHEN 5 THEN concat(', Umfang von ', CAST(o_orderkey % 80 AS VARCHAR(9)), ' Stunden')
            ELSE '' END,
        CASE o_orderkey % 11
            WHEN 0 THEN concat(', TV-L E', CAST(o_custkey % 18 AS VARCHAR(9)), ' b')
            WHEN 1 THEN concat(', TVöD EG ', CAST(o_custkey % 18 AS VARCHAR(9)), 'ü Gehalt')
            WHEN 2 THEN concat(', nach eg ', CAST(o_custkey % 20 AS VARCHAR(9)), 'a Vergütung')
            WHEN 3 THEN concat(', Gruppe E', CAST(o_custkey % 20 AS VARCHAR(9)))
            WHEN 4 THEN concat(', Besoldung A ', CAST(o_custkey % 20 AS VARCHAR(9)))
            WHEN 5 THEN ', 450 EUR-Job'
            WHEN 6 THEN concat(', ', CAST(o_custkey % 90 + 10 AS VARCHAR(9)), ' 50 Euro pro Stunde')
            WHEN 7 THEN concat(', ', CAST(o_custkey + 1 AS VARCHAR(9)), ',25  eur / Monat')
            WHEN 8 THEN concat(', ', CAST(o_custkey % 40 + 1 AS VARCHAR(9)), ' € / h')
            WHEN 9 THEN concat(', Monatslohn von ', CAST(o_custkey % 4000 + 1 AS VARCHAR(9)), ' €')
            ELSE concat(', ', CAST(o_custkey % 4000 + 1000 AS VARCHAR(9)), ' Euro') END,
        '.')
"""

_AD_COLUMNS = {
    "jobid": "o_custkey",
    "date": "CAST(o_orderdate AS DATE)",
    "geo_lat": "o_totalprice / 1000",
    "geo_lon": "o_totalprice / 500 - 300",
    "country": "CASE o_orderkey % 7 WHEN 0 THEN 'X' WHEN 1 THEN 'Unknown' WHEN 2 THEN NULL"
               " WHEN 3 THEN 'na' ELSE 'Deutschland' END",
    "location": "CASE o_orderkey % 9 WHEN 0 THEN 'HH' WHEN 1 THEN 'Köln' WHEN 2 THEN 'KÖLN'"
                " WHEN 3 THEN 'Aaaaachen' WHEN 4 THEN ' ÖP ' WHEN 5 THEN 'Berlin-Mitte'"
                " WHEN 6 THEN 'Berlin Mitte' WHEN 7 THEN '' ELSE '??' END",
    "company": "CASE o_orderkey % 6 WHEN 0 THEN 'Uni X' WHEN 1 THEN 'uni-x'"
               " WHEN 2 THEN concat('Haus ', CAST(o_custkey AS VARCHAR(9)), ', Weg 7')"
               " WHEN 3 THEN 'A &#38; B' WHEN 4 THEN 'C &amp D' ELSE 'E &uuml; F' END",
    "jobtype": "CASE WHEN o_orderkey % 4 = 0 THEN 'Verlag' ELSE o_orderpriority END",
}


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


_ADS_SQL = _select(_AD_COLUMNS, "orders")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as job ads with every kind of error the detectors know."""
    orders = spread_table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    )
    return orders.select(*[F.expr(e).alias(n) for n, e in _AD_COLUMNS.items()])


def ad_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return orders.select("o_orderkey", F.expr(_AD_TEXT).alias("ad"))


_AD_TEXTS_SQL = f"SELECT o_orderkey, {_AD_TEXT} AS ad FROM orders"

# ------------------------------------------------------------------ scan and casts

_LINE = (
    "concat_ws('_§_', CAST(o_orderkey AS VARCHAR(20)), o_orderstatus, "
    "CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE o_orderpriority END, "
    "CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(year(o_orderdate) AS VARCHAR(4)), '/1/1') "
    "ELSE concat(CAST(day(o_orderdate) AS VARCHAR(2)), '-', "
    "CAST(month(o_orderdate) AS VARCHAR(2)), '-', CAST(year(o_orderdate) AS VARCHAR(4))) END, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR(20)) END)"
)


@query(
    "delimited_parse",
    """SELECT o_orderkey AS jobid, o_orderstatus AS status,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
              CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS geo_lat,
              CAST(NULL AS VARCHAR) AS extra
       FROM orders""",
)
def delimited_parse(spark, sf_dir):
    orders = spread_table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
        "o_orderpriority",
    )
    lines = orders.select(F.expr(_LINE).alias("line"))
    header = "_JobID_ _§_*STATUS*_§_Priority_§__Date__§_geo_lat_§_extra".replace(" ", "")
    return delimited.typed(delimited.split_lines(lines, header))


@query(
    "rejected_values",
    """WITH parts AS (SELECT regexp_extract(url, '/([^/]*)$', 1) AS jobid,
                             regexp_extract(url, '^https?://([^/]*)', 1) AS date FROM pages)
       SELECT DISTINCT 'jobid' AS "column", jobid AS value FROM parts
       WHERE NOT regexp_matches(jobid, '^[0-9]+$')
       UNION SELECT DISTINCT 'date', date FROM parts""",
)
def rejected_values(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "/([^/]*)$", 1).alias("jobid"),
        F.regexp_extract("url", "^https?://([^/]*)", 1).alias("date"),
    )
    return delimited.rejected_values(raw)


@query(
    "rejected_on_load",
    """SELECT DISTINCT 'date' AS "column", concat(year(o_orderdate), '/1/1') AS value
       FROM orders WHERE o_orderkey % 3 = 0""",
)
def rejected_on_load(spark, sf_dir):
    """Rejected values of a table that is cast and written in the same pass."""
    orders = spread_table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
        "o_orderpriority",
    )
    header = "_JobID_ _§_*STATUS*_§_Priority_§__Date__§_geo_lat_§_extra".replace(" ", "")
    raw = delimited.split_lines(orders.select(F.expr(_LINE).alias("line")), header)
    return delimited.load_table(raw, f"{work_folder(spark)}/loaded-{uuid.uuid4().hex}").rejected


@query(
    "delimited_export",
    """SELECT page_id AS _page_id_, url AS _url_, html AS _html_ FROM pages""",
)
def delimited_export(spark, sf_dir):
    source = table(spark, sf_dir, "pages")
    path = f"{work_folder(spark)}/export-{uuid.uuid4().hex}"
    sinks.write_delimited(dedupe.export_names(source), path)
    schema = "_page_id_ bigint, _url_ string, _html_ string"
    return sinks.read_delimited_export(spark, path, schema)


# --------------------------------------------------------------------- text cleaning

def _unescape_sql(column: str) -> str:
    """The references that occur in the pages; the ampersand itself comes last."""
    sql = column
    for name, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
        ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"),
        ("&hellip;", "…"), ("&euro;", "€"), ("&eacute;", "é"), ("&amp;", "&"),
    ):
        sql = f"replace({sql}, '{name}', '{character}')"
    return sql


@query("strip_tags", "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS plain FROM pages")
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.strip_tags(F.col("html")).alias("plain")
    )


@query(
    "clean_markup",
    "SELECT page_id, "
    + _unescape_sql("regexp_replace(html, '<.*?>', '', 'g')")
    + " AS plain FROM pages",
)
def clean_markup(spark, sf_dir):
    return spread_table(spark, sf_dir, "pages", "page_id", "html").select(
        "page_id", text.clean_markup(F.col("html")).alias("plain")
    )


_POSTAL_NAME = (
    "CASE c_custkey % 5 "
    "WHEN 0 THEN concat(' ', c_name, ', 1', substr(c_name, 15, 4), ' Bad Köln-Süd ') "
    "WHEN 1 THEN concat(c_name, ',2', substr(c_name, 15, 4)) "
    "WHEN 2 THEN concat(c_name, '  3', substr(c_name, 15, 4), ' BERLIN') "
    "WHEN 3 THEN concat(c_name, ' 4', substr(c_name, 15, 4)) ELSE c_name END"
)
_POSTAL_PLZ = "CASE WHEN c_custkey % 7 = 0 THEN '99999' END"


@query(
    "postal_codes",
    f"""WITH t AS (SELECT c_custkey, trim({_POSTAL_NAME}) AS n, {_POSTAL_PLZ} AS plz FROM customer),
        m AS (SELECT *, '(?i),\\s*(\\d{{5}})(?:\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+)?$' AS p1,
                     '(?i)\\s+(\\d{{5}})\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+$' AS p2 FROM t),
        x AS (SELECT *, nullif(regexp_extract(n, '(?i),\\s*(\\d{{5}})(?:\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+)?$', 1), '') AS a,
                     nullif(regexp_extract(n, '(?i)\\s+(\\d{{5}})\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+$', 1), '') AS b FROM m)
        SELECT c_custkey,
               trim(CASE WHEN a IS NOT NULL THEN regexp_replace(n, '(?i),\\s*(\\d{{5}})(?:\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+)?$', '')
                         WHEN b IS NOT NULL THEN regexp_replace(n, '(?i)\\s+(\\d{{5}})\\s+[A-ZÄÖÜ][a-zäöüß\\s-]+$', '')
                         ELSE n END) AS company,
               coalesce(plz, a, b) AS plz
        FROM x""",
)
def postal_codes(spark, sf_dir):
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(_POSTAL_NAME).alias("company"), F.expr(_POSTAL_PLZ).alias("plz")
    )
    return backfill_postal_codes(named)


_RAW_NAME = (
    "CASE c_custkey % 10 "
    "WHEN 0 THEN concat('institut ', c_name, ', KÖLN') "
    "WHEN 1 THEN concat(c_name, ' gmbh .') "
    "WHEN 2 THEN concat(c_name, ' eV') "
    "WHEN 3 THEN concat(c_name, ' e.v.') "
    "WHEN 4 THEN concat(c_name, ', , Bibliothek') "
    "WHEN 5 THEN concat('  ', c_name, '-  stadt , standort Nord') "
    "WHEN 6 THEN concat(c_name, ', Softwarehersteller für Bibliotheken AG') "
    "WHEN 7 THEN concat('UNIVERSITÄT ', c_name, ', Hochschulbibliothek') "
    "WHEN 8 THEN concat(c_name, ', Referat benutzung,') ELSE NULL END"
)


def _name_sql(column: str) -> str:
    def replaced(sql: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({sql}, '(?i){pattern}', '{by}', 'g')"

    sql = replaced(f"trim({column})", rf",\s+(?:{R.TOWN_SUFFIXES})$")
    for pattern, by in (
        (r"\s*\.\s*$", ""), (r",\s*,+", ","), (r",\s*$", ""), (r"\s+", " "), (r"-\s+", "- "),
    ):
        sql = replaced(sql, pattern, by)
    for word, by in R.NAME_SPELLINGS:
        sql = replaced(sql, rf"\b{word}\b", by)
    for tail in R.NAME_TAILS:
        sql = replaced(sql, tail.replace("WORD", text.WORD))
    return f"trim({sql})"


@query(
    "normalize_names",
    f"SELECT c_custkey, {_name_sql(_RAW_NAME)} AS company FROM customer",
)
def normalize_names(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", names.normalize_name(F.expr(_RAW_NAME)).alias("company")
    )


_PLACE = (
    "CASE c_custkey % 4 WHEN 0 THEN concat(' ', lower(substr(c_mktsegment, 1, 2)), ' ') "
    "WHEN 1 THEN substr(c_mktsegment, 1, 2) WHEN 2 THEN concat(substr(c_mktsegment, 1, 2), '-City') "
    "ELSE c_mktsegment END"
)


@query(
    "resolve_codes",
    f"""WITH codes AS (SELECT substr(c_mktsegment, 1, 2) AS code, min(c_mktsegment) AS place
                       FROM customer GROUP BY 1),
             t AS (SELECT c_custkey, {_PLACE} AS location FROM customer)
        SELECT c_custkey, coalesce(place, location) AS location
        FROM t LEFT JOIN codes ON upper(trim(location)) = code""",
)
def resolve_codes(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    codes = customer.select(
        F.substring("c_mktsegment", 1, 2).alias("code"), F.col("c_mktsegment").alias("place")
    )
    places = customer.select("c_custkey", F.expr(_PLACE).alias("location"))
    return lookup.resolve_codes(places, "location", codes)


# ---------------------------------------------------------------------- job facts

def _found_sql(pattern: str, group: int = 0, column: str = "ad") -> str:
    return f"nullif(regexp_extract({column}, '(?i){pattern.replace('WORD', text.WORD)}', {group}), '')"


def _term_sql() -> str:
    exclusion = "^" + R.FIXED_TERM_EXCLUSION[len("(?!"):-1].replace("[\\sWORD]", "[\\s\\p{L}\\p{N}_]")
    phrase = _found_sql(R.FIXED_TERM)
    sql = phrase
    for tail in R.FIXED_TERM_TAILS:
        sql = f"regexp_replace({sql}, '(?i){tail}', '')"
    behind = f"substr(ad, instr(ad, {phrase}) + length({phrase}))"
    return (
        f"CASE WHEN regexp_matches(ad, '(?i){R.OPEN_ENDED}') THEN {_found_sql(R.OPEN_ENDED)} "
        f"WHEN regexp_matches(ad, '(?i){R.FIXED_TERM_RAISE}') THEN NULL "
        f"WHEN regexp_matches({behind}, '(?i){exclusion}') THEN NULL "
        f"ELSE trim({sql}) END"
    )


def _time_sql() -> str:
    def number(pattern: str) -> str:
        return f"CAST(replace({_found_sql(pattern, 1)}, ',', '.') AS DOUBLE)"

    def rated(condition: str) -> str:
        return f"CASE WHEN {condition} THEN '{R.FULL_TIME}' ELSE '{R.PART_TIME}' END"

    weekly, monthly = number(R.HOURS_PER_WEEK), number(R.HOURS_PER_MONTH)
    percent, bare = number(R.PERCENT), number(R.HOURS_BARE)
    return (
        f"CASE WHEN regexp_matches(ad, '(?i){R.FULL_TIME_WORD}') THEN '{R.FULL_TIME}' "
        f"WHEN regexp_matches(ad, '(?i){R.PART_TIME_WORD}') THEN '{R.PART_TIME}' "
        f"WHEN {weekly} IS NOT NULL THEN {rated(f'{weekly} >= 36')} "
        f"WHEN {monthly} IS NOT NULL THEN {rated(f'{monthly} / CAST(4.33 AS DOUBLE) >= 36')} "
        f"WHEN {percent} IS NOT NULL THEN {rated(f'{percent} >= 90')} "
        f"WHEN {bare} <= 60 THEN {rated(f'{bare} >= 36')} END"
    )


def _pay_sql() -> str:
    tariff = f"regexp_replace(upper({_found_sql(R.TARIFF_GRADE)}), '\\s+', ' ', 'g')"
    tariff = f"regexp_replace(regexp_replace({tariff}, 'TV-?[LÖD]+', 'TV-L', 'g'), 'TV[ÖO]D', 'TVöD', 'g')"
    whole = _found_sql(R.BARE_GRADE)
    grade = (
        f"concat(CASE WHEN contains(lower({whole}), 'eg') THEN 'EG ' ELSE 'E ' END, "
        f"upper({_found_sql(R.BARE_GRADE, 1)}))"
    )
    split = (
        f"concat({_found_sql(R.SPLIT_AMOUNT, 1)}, ',', {_found_sql(R.SPLIT_AMOUNT, 2)}, "
        f"substr({_found_sql(R.SPLIT_AMOUNT)}, 6))"
    )
    amounts = [_found_sql(p.replace("(?![/-]job)", "")) for p in R.AMOUNTS]
    split = f"CASE WHEN {_found_sql(R.SPLIT_AMOUNT)} IS NOT NULL THEN {split} END"
    amount = f"trim(regexp_replace(coalesce({', '.join([split, *amounts])}), '\\s+', ' ', 'g'))"
    amount = f"regexp_replace({amount}, '[,;-]+$', '')"
    amount = f"replace(replace({amount}, 'eur ', 'Euro '), '€', 'Euro')"

    def within(pattern: str, group: int, highest: int) -> str:
        return f"CAST({_found_sql(pattern, group)} AS INTEGER) BETWEEN 1 AND {highest}"

    return (
        f"CASE WHEN {within(R.TARIFF_GRADE, 2, 15)} THEN {tariff} "
        f"WHEN {within(R.BARE_GRADE, 2, 15)} "
        f"AND regexp_matches(ad, '(?i){R.BARE_GRADE}.') THEN {grade} "
        f"WHEN {within(R.CIVIL_GRADE, 1, 16)} THEN concat('A ', {_found_sql(R.CIVIL_GRADE, 1)}) "
        f"WHEN regexp_matches(ad, '(?i){R.MINI_JOB}') THEN '{R.MINI_JOB_LABEL}' "
        f"ELSE {amount} END"
    )


@query("contract_term", f"SELECT o_orderkey, {_term_sql()} AS fixedterm FROM ({_AD_TEXTS_SQL})")
def contract_term(spark, sf_dir):
    return ad_texts(spark, sf_dir).select(
        "o_orderkey", jobs.contract_term(F.col("ad")).alias("fixedterm")
    )


@query("working_time", f"SELECT o_orderkey, {_time_sql()} AS workinghours FROM ({_AD_TEXTS_SQL})")
def working_time(spark, sf_dir):
    return ad_texts(spark, sf_dir).select(
        "o_orderkey", jobs.working_time(F.col("ad")).alias("workinghours")
    )


@query("pay", f"SELECT o_orderkey, {_pay_sql()} AS salary FROM ({_AD_TEXTS_SQL})")
def pay(spark, sf_dir):
    return ad_texts(spark, sf_dir).select("o_orderkey", jobs.pay(F.col("ad")).alias("salary"))


@query(
    "job_facts",
    f"SELECT o_orderkey, ad AS jobdescription, {_term_sql()} AS fixedterm, "
    f"{_time_sql()} AS workinghours, {_pay_sql()} AS salary FROM ({_AD_TEXTS_SQL})",
)
def job_facts(spark, sf_dir):
    return add_job_facts(ad_texts(spark, sf_dir).withColumnRenamed("ad", "jobdescription"))


@query(
    "clean_table",
    f"""WITH codes AS (SELECT substr(c_mktsegment, 1, 2) AS code, min(c_mktsegment) AS place
                       FROM customer GROUP BY 1),
             t AS (SELECT o_orderkey, {_AD_TEXT} AS ad, concat(' <i>', lower(substr(c_mktsegment, 1, 2)), '</i>') AS l
                   FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT o_orderkey, coalesce(place, concat(' ', upper(trim(regexp_replace(l, '<.*?>', '', 'g'))))) AS location,
               ad AS jobdescription, {_term_sql()} AS fixedterm, {_time_sql()} AS workinghours, {_pay_sql()} AS salary
        FROM t LEFT JOIN codes ON upper(trim(regexp_replace(l, '<.*?>', '', 'g'))) = code""",
)
def clean_orders(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    codes = customer.select(
        F.substring("c_mktsegment", 1, 2).alias("code"), F.col("c_mktsegment").alias("place")
    )
    raw = table(spark, sf_dir, "orders").join(customer, F.expr("o_custkey = c_custkey")).select(
        "o_orderkey",
        F.expr("concat(' <i>', lower(substr(c_mktsegment, 1, 2)), '</i>')").alias("location"),
        F.expr(_AD_TEXT).alias("jobdescription"),
    )
    return clean_table(raw, codes)


# ------------------------------------------------------------------------ profiling

@query(
    "value_frequency",
    'SELECT p_name AS value, count(*) AS "count" FROM part WHERE p_name IS NOT NULL GROUP BY 1',
)
def value_frequency(spark, sf_dir):
    return profile.value_frequency(table(spark, sf_dir, "part"), "p_name")


def _key_sql(value: str) -> str:
    return (
        f"CASE WHEN length({value}) <= 64 THEN {value} "
        f"ELSE concat(substr({value}, 1, 32), sha256({value})) END"
    )


# Conditions of the per-cell detectors on ``v`` (the cell as text), in report order.
_FOUR_EQUAL = (
    "length(v) > 3 AND list_bool_or(list_transform(range(1, length(v) - 2), "
    "lambda i: substr(v, i, 1) <> chr(10) AND substr(v, i, 1) = substr(v, i + 1, 1) AND "
    "substr(v, i, 1) = substr(v, i + 2, 1) AND substr(v, i, 1) = substr(v, i + 3, 1)))"
)
_SPELLING = f"regexp_matches(v, '&#[0-9]+;|&[a-zA-Z]+;') OR ({_FOUR_EQUAL})"
_MISPLACED = " OR ".join(f"contains(lower(v), '{t}')" for t in R.MISPLACED_TERMS)
_DUMMIES = ", ".join(f"'{v}'" for v in R.DUMMY_VALUES)
_DETECTOR_SQL = {
    "geo_lat": [(3, "Unzulässige Werte", "abs(CAST(v AS DOUBLE)) > 90")],
    "geo_lon": [(3, "Unzulässige Werte", "abs(CAST(v AS DOUBLE)) > 180")],
    "country": [
        (3, "Unzulässige Werte", "length(v) < 2 OR length(v) > 50"),
        (9, "Falsche Werte", f"lower(v) IN ({_DUMMIES})"),
    ],
    "location": [
        (4, "Kryptische Werte", r"regexp_matches(trim(v), '^\p{L}{1,3}$')"),
        (6, "Schreibfehler", _SPELLING),
    ],
    "company": [
        (5, "Eingebettete Werte", r"regexp_matches(v, '\d+.*,.*\d+')"),
        (6, "Schreibfehler", _SPELLING),
    ],
    "jobdescription": [(6, "Schreibfehler", _SPELLING)],
    "date": [(7, "Widersprüchliche Werte", "year(CAST(v AS DATE)) > 2025 OR year(CAST(v AS DATE)) < 2000")],
    "jobtype": [(8, "Falsche Zuordnungen", _MISPLACED)],
}
_MARKERS = ", ".join(f"'{m}'" for m in R.ERROR_MARKERS)


def _conflict_sql(column: str) -> str:
    """Cells of the most frequent other spelling, summed over the ten top values."""
    return f"""(WITH c AS (SELECT v, count(*) AS n,
                                  regexp_replace(lower(v), '[^\\p{{L}}\\p{{N}}_]', '', 'g') AS f
                           FROM cells WHERE "column" = '{column}' AND v IS NOT NULL GROUP BY v),
                     top AS (SELECT * FROM c ORDER BY n DESC, v LIMIT 10),
                     other AS (SELECT top.v, max(c.n) AS n FROM top JOIN c ON top.f = c.f AND top.v <> c.v
                               WHERE length(top.f) > 3 GROUP BY top.v)
                SELECT coalesce(sum(n), 0) FROM other)"""


def _errors_sql(source: str, columns: list[str]) -> str:
    """CTEs ``cells``, ``totals`` and ``errors(column, type, rate, pos)``."""
    cells = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM source"
        for i, c in enumerate(columns)
    )
    counts = [
        f"SELECT \"column\", 'Fehlende Werte' AS type, 1 AS pos, "
        f"count(*) FILTER (v IS NULL OR v IN ({_MARKERS})) AS n FROM cells GROUP BY 1"
    ]
    for c in columns:
        if c in ("jobid", "url"):
            counts.append(
                f"SELECT '{c}', 'Eindeutigkeitsverletzungen', 2, count(v) - count(DISTINCT v) "
                f"FROM cells WHERE \"column\" = '{c}'"
            )
        for pos, label, condition in _DETECTOR_SQL.get(c, []):
            counts.append(
                f"SELECT '{c}', '{label}', {pos}, count(*) FILTER ({condition}) "
                f"FROM cells WHERE \"column\" = '{c}'"
            )
        if c in ("location", "company"):
            counts.append(f"SELECT '{c}', 'Datenkonflikte', 10, CAST({_conflict_sql(c)} AS BIGINT)")
    return f"""WITH source AS ({source}), cells AS ({cells}),
        totals AS (SELECT count(*) AS total FROM source),
        errors AS (SELECT "column", type, pos, n / total * 100 AS rate
                   FROM ({' UNION ALL '.join(counts)}) CROSS JOIN totals WHERE n > 0),
        names AS (SELECT DISTINCT position, "column" FROM cells)"""


def _profile_sql(source: str, columns: list[str]) -> str:
    marker_rows = " UNION ALL ".join(
        [
            f"SELECT \"column\", '{m}' AS marker, {i} AS pos, count(*) FILTER (v = '{m}') AS n FROM cells GROUP BY 1"
            for i, m in enumerate(R.ERROR_MARKERS)
        ]
        + ['SELECT "column", \'None\', 9, count(*) FILTER (v IS NULL) FROM cells GROUP BY 1']
    )
    return f"""{_errors_sql(source, columns)},
        markers AS (SELECT * FROM ({marker_rows}) QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, pos) = 1),
        counted AS (SELECT "column", v, count(*) AS n FROM cells WHERE v IS NOT NULL GROUP BY 1, 2),
        tops AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, {_key_sql('v')}) = 1),
        main AS (SELECT * FROM errors QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY rate DESC, pos) = 1),
        basic AS (SELECT position, "column", count(*) AS rows_, count(*) FILTER (v IS NULL) AS missing, count(DISTINCT v) AS uniq
                  FROM cells GROUP BY 1, 2)
        SELECT b."column" AS "Spalte", rows_ AS "Zeilen", missing AS "Fehlende Werte",
               round_even(missing / rows_ * 100, 2) AS "Fehlende Werte %", uniq AS "Eindeutige Werte",
               CASE WHEN m.n > 0 THEN m.marker ELSE '' END AS "Häufigste Fehlerart", m.n AS "Fehler Häufigkeit",
               round_even(m.n / rows_ * 100, 2) AS "Fehler %", coalesce(t.v, '') AS "Häufigster Wert",
               round_even(coalesce(t.n, 0) / rows_ * 100, 2) AS "Häufigster Wert %",
               coalesce(e.type, '{R.NO_ERRORS}') AS "Hauptfehlertyp (Naumann/Leser)",
               round_even(coalesce(e.rate, 0.0), 2) AS "Hauptfehlerrate %"
        FROM basic b JOIN markers m USING ("column") LEFT JOIN tops t USING ("column") LEFT JOIN main e USING ("column")"""


@query("profile_ads", _profile_sql(_ADS_SQL, list(_AD_COLUMNS)))
def profile_ads(spark, sf_dir):
    return profile.profile(ads(spark, sf_dir))


# Distinct values are estimated; how many they are within is tested, all else is exact.
@query(
    "profile_ads_estimated",
    f"""SELECT * EXCLUDE ("Eindeutige Werte") FROM ({_profile_sql(_ADS_SQL, list(_AD_COLUMNS))})""",
)
def profile_ads_estimated(spark, sf_dir):
    return profile.profile(ads(spark, sf_dir), distinct_error=0.02).drop("Eindeutige Werte")


_PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("profile_part", _profile_sql("SELECT * FROM part", _PART_COLUMNS))
def profile_part(spark, sf_dir):
    return profile.profile(table(spark, sf_dir, "part"))


_DOCUMENT_ROLES = "SELECT doc_id AS jobid, text AS url, lang AS location, source AS company, n_chars FROM documents"


@query(
    "profile_documents",
    _profile_sql(_DOCUMENT_ROLES, ["jobid", "url", "location", "company", "n_chars"]),
)
def profile_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS jobid", "text AS url", "lang AS location", "source AS company", "n_chars"
    )
    return profile.profile(documents)


@query(
    "top_markers",
    f"""{_errors_sql(_ADS_SQL, list(_AD_COLUMNS))},
        m AS ({' UNION ALL '.join(
            f'''SELECT "column", '{m}' AS marker, {i} AS pos, count(*) FILTER (v = '{m}') AS n FROM cells GROUP BY 1'''
            for i, m in enumerate(R.ERROR_MARKERS))}
            UNION ALL SELECT "column", 'None', 9, count(*) FILTER (v IS NULL) FROM cells GROUP BY 1)
        SELECT "column", CASE WHEN n > 0 THEN marker ELSE '' END AS marker, n AS "count" FROM m
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, pos) = 1""",
)
def top_markers(spark, sf_dir):
    return profile.top_markers(ads(spark, sf_dir))


@query(
    "error_rates",
    f"""{_errors_sql(_ADS_SQL, list(_AD_COLUMNS))}
        SELECT position, n."column", type, rate FROM names n LEFT JOIN errors USING ("column")""",
)
def error_rates(spark, sf_dir):
    return profile.column_errors(ads(spark, sf_dir))


@query(
    "main_errors",
    f"""{_errors_sql(_ADS_SQL, list(_AD_COLUMNS))}
        SELECT n."column", coalesce(type, '{R.NO_ERRORS}') AS type, coalesce(rate, 0.0) AS rate
        FROM names n LEFT JOIN (SELECT * FROM errors QUALIFY row_number() OVER (
            PARTITION BY "column" ORDER BY rate DESC, pos) = 1) USING ("column")""",
)
def main_errors(spark, sf_dir):
    return profile.main_errors(ads(spark, sf_dir))


@query(
    "error_report",
    f"""{_errors_sql(_ADS_SQL, list(_AD_COLUMNS))}
        SELECT n."column" AS "Attribut", coalesce(type, '{R.NO_ERRORS}') AS "Fehlertyp",
               round_even(coalesce(rate, 0.0), 2) AS "Relative Fehlerquote (%)"
        FROM names n LEFT JOIN errors USING ("column")""",
)
def error_report(spark, sf_dir):
    return profile.error_report(ads(spark, sf_dir))


@query(
    "spelling_errors_in_conversations",
    f"""{_errors_sql('SELECT text AS jobdescription, role AS location FROM conversations', ['jobdescription', 'location'])}
        SELECT n."column" AS "Attribut", coalesce(type, '{R.NO_ERRORS}') AS "Fehlertyp",
               round_even(coalesce(rate, 0.0), 2) AS "Relative Fehlerquote (%)"
        FROM names n LEFT JOIN errors USING ("column")""",
)
def spelling_errors(spark, sf_dir):
    return profile.error_report(
        table(spark, sf_dir, "conversations").selectExpr("text AS jobdescription", "role AS location")
    )


# ---------------------------------------------------- similarity and consolidation

def _score_sql(source: str) -> str:
    """``source(id, a, b)`` to ``(id, score)``: common subsequence by bit arithmetic, for
    strings of up to 60 characters."""
    place = (
        "CAST(list_sum(list_transform(range(0, length(a)), lambda i: CASE WHEN "
        "substr(a, CAST(i + 1 AS BIGINT), 1) = c THEN CAST(1 AS BIGINT) << CAST(i AS INTEGER) "
        "ELSE CAST(0 AS BIGINT) END)) AS BIGINT)"
    )
    return f"""
    (WITH s AS (SELECT id, a, b, (CAST(1 AS BIGINT) << CAST(length(a) AS INTEGER)) - 1 AS full_row,
                       list_transform(string_split(b, ''), lambda c: {place}) AS places FROM ({source})),
          r AS (SELECT id, a, b, list_reduce(list_prepend(full_row, places), lambda x, m:
                    ((x + (x & m)) | (x - (x & m))) & full_row) AS bits FROM s),
          d AS (SELECT id, length(a) + length(b) AS total,
                       length(a) + length(b) - 2 * (length(a) - bit_count(bits)) AS distance FROM r)
     SELECT id, CAST(floor((CAST(1 AS DOUBLE) - distance / total) * 100) AS INTEGER) AS score FROM d)"""


_TOKENS = "array_to_string(list_sort(list_filter(string_split({}, ' '), lambda t: t <> '')), ' ')"
_NAME_PAIRS = (
    "SELECT DISTINCT p_name AS a, lower(concat(p_type, ' ', p_name)) AS b FROM part"
)


@query(
    "name_scores",
    f"""WITH pairs AS (SELECT row_number() OVER () AS id, * FROM ({_NAME_PAIRS}))
        SELECT a, b, x.score AS score, y.score AS token_score FROM pairs
        JOIN {_score_sql("SELECT id, a, b FROM pairs")} x USING (id)
        JOIN {_score_sql(f"SELECT id, {_TOKENS.format('a')} AS a, {_TOKENS.format('b')} AS b FROM pairs")} y USING (id)""",
)
def name_scores(spark, sf_dir):
    pairs = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("a"), F.lower(F.concat("p_type", F.lit(" "), "p_name")).alias("b")
    )
    return pairs.distinct().select(
        "a", "b",
        similarity.indel_score(F.col("a"), F.col("b")).alias("score"),
        similarity.indel_score(
            similarity.sorted_tokens(F.col("a")), similarity.sorted_tokens(F.col("b"))
        ).alias("token_score"),
    )


def _name_groups_sql(source: str) -> str:
    """``nodes``, ``member`` and ``canonical`` of the names of ``source(name)``: the sequential
    leader rule as a walk over the names in rank order."""
    return f"""
    WITH RECURSIVE counted AS (SELECT name, count(*) AS n FROM ({source}) WHERE name IS NOT NULL GROUP BY 1),
    nodes AS (SELECT row_number() OVER (ORDER BY n DESC, name) AS place, name, n FROM counted),
    pairs AS (SELECT lo.place * 1000000 + hi.place AS id, lower(lo.name) AS a, lower(hi.name) AS b
              FROM nodes lo JOIN nodes hi ON lo.place < hi.place),
    near AS (SELECT id // 1000000 AS lo, id % 1000000 AS hi FROM {_score_sql("SELECT * FROM pairs")} WHERE score >= 85),
    steps AS (SELECT place, coalesce((SELECT list(lo) FROM near WHERE hi = place), []) AS better FROM nodes),
    walk AS (SELECT CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS led
             UNION ALL
             SELECT s.place, CASE WHEN len(list_intersect(w.led, s.better)) > 0 THEN w.led ELSE list_append(w.led, s.place) END
             FROM walk w JOIN steps s ON s.place = w.place + 1),
    led AS (SELECT led FROM walk ORDER BY place DESC LIMIT 1),
    member AS (SELECT place, coalesce(list_min(list_intersect(led, better)), place) AS leader FROM steps, led),
    canonical AS (SELECT leader, first(name ORDER BY n DESC, length(name), name) AS canonical
                  FROM member JOIN nodes USING (place) GROUP BY 1)"""


_CONSOLIDATED = f"""{_name_groups_sql("SELECT p_name AS name FROM part")}
    SELECT p_partkey, coalesce(canonical, p_name) AS p_name
    FROM part LEFT JOIN nodes ON name = p_name LEFT JOIN member USING (place) LEFT JOIN canonical USING (leader)"""


@query("consolidate_names", _CONSOLIDATED)
def consolidate_part_names(spark, sf_dir):
    return consolidate.consolidate_names(table(spark, sf_dir, "part"), "p_name").select(
        "p_partkey", "p_name"
    )


@query(
    "name_mapping_of_customers",
    f"""{_name_groups_sql("SELECT c_name AS name FROM customer")}
    SELECT name, canonical FROM nodes JOIN member USING (place) JOIN canonical USING (leader)
    WHERE name <> canonical""",
)
def name_mapping_of_customers(spark, sf_dir):
    return consolidate.name_mapping(table(spark, sf_dir, "customer"), "c_name")


@query(
    "clean_organisations",
    f"""{_name_groups_sql("SELECT concat(p_name, ' & e.V.') AS name FROM part")}
    SELECT p_partkey, canonical AS company, '12345' AS plz
    FROM part JOIN nodes ON name = concat(p_name, ' & e.V.')
    JOIN member USING (place) JOIN canonical USING (leader)""",
)
def clean_organisations(spark, sf_dir):
    raw = spread_table(spark, sf_dir, "part", "p_partkey", "p_name").select(
        "p_partkey",
        F.concat(F.lit("<b>"), F.col("p_name"), F.lit(" &amp; eV</b>, 12345 Köln")).alias("company"),
    )
    return clean_table(raw)


# ------------------------------------------------------------------ duplicate search

def _documents(spark, sf_dir) -> DataFrame:
    return spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select(
        "doc_id", F.col("text").alias("jobdescription"), F.col("lang").alias("country"),
        F.col("source").alias("url"),
    )


def _vectors_cte(source: str) -> str:
    """``sims(i, j, sim)`` of ``source(doc_id, lang, text)`` by plain relational TF-IDF."""
    return f"""
    docs AS ({source}),
    tok AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM docs),
    tf AS (SELECT doc_id, lang, term, count(*) AS tf FROM (
               SELECT doc_id, lang, unnest(t) AS term FROM tok
               UNION ALL
               SELECT doc_id, lang, unnest(list_transform(range(1, len(t)), lambda i: concat(t[i], ' ', t[i + 1]))) FROM tok)
           GROUP BY 1, 2, 3),
    n AS (SELECT lang, count(*) AS n FROM docs GROUP BY 1),
    df AS (SELECT lang, term, count(*) AS df FROM tf GROUP BY 1, 2),
    w AS (SELECT doc_id, lang, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
          FROM tf JOIN df USING (lang, term) JOIN n USING (lang) WHERE df <= 0.95 * n),
    u AS (SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
    sims AS (SELECT a.doc_id AS i, b.doc_id AS j, round(sum(a.w * b.w), 9) AS sim
             FROM u a JOIN u b ON a.lang = b.lang AND a.term = b.term AND a.doc_id <> b.doc_id GROUP BY 1, 2)"""


def _nearest_sql(floor: float) -> str:
    return f"""SELECT i, j FROM sims WHERE sim > 0 AND sim >= {floor}
             QUALIFY row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) <= 4"""


def _neighbour_sql(floor: float) -> str:
    """Nearest neighbours of the documents (groups of more than five rows)."""
    return f"""
    WITH {_vectors_cte("SELECT doc_id, lang, text FROM documents")},
    near AS ({_nearest_sql(floor)})
    SELECT DISTINCT least(i, j) AS lo, greatest(i, j) AS hi FROM near"""


@query("candidate_pairs", _neighbour_sql(0.0))
def candidate_pairs(spark, sf_dir):
    return candidates.candidate_pairs(_documents(spark, sf_dir), "doc_id", ["jobdescription"], ["country"])


@query("candidate_pairs_above_floor", _neighbour_sql(0.3))
def candidate_pairs_above_floor(spark, sf_dir):
    return candidates.candidate_pairs(
        _documents(spark, sf_dir), "doc_id", ["jobdescription"], ["country"], min_cosine=0.3
    )


# With every threshold at 100 a duplicate is a record with the same sorted tokens.
_EXACT_RULES = DEFAULT_RULES.with_(description_score=100, field_score=100, min_probability=100)
_COPIES_SQL = r"""
    WITH s AS (SELECT doc_id, lang, array_to_string(list_sort(list_filter(
                      regexp_split_to_array(text, '\s+'), lambda t: t <> '')), ' ') AS k,
                      lower(text) AS l FROM documents),
         vetoed AS (SELECT *, (contains(l, 'vollzeit') AND contains(l, 'teilzeit')) OR contains(l, 'unbefristet') OR
                      (contains(l, 'ausbildung') AND contains(l, 'arbeitsstelle')) OR
                      (contains(l, 'leitung') AND contains(l, 'mitarbeiter')) OR
                      (contains(l, 'e13') AND contains(l, 'e9')) OR (contains(l, 'e12') AND contains(l, 'e8')) OR
                      (contains(l, 'e11') AND contains(l, 'e7')) OR (contains(l, 'e10') AND contains(l, 'e6')) OR
                      (contains(l, 'e9') AND contains(l, 'e5')) AS veto FROM s),
         lead AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, k) AS leader, veto FROM vetoed)
    SELECT doc_id AS node, leader, 100 AS score FROM lead WHERE doc_id <> leader AND NOT veto"""


@query("exact_duplicates", _COPIES_SQL)
def exact_duplicates(spark, sf_dir):
    found = dedupe.find_duplicates(_documents(spark, sf_dir), "doc_id", _EXACT_RULES)
    return found.dropped.select("node", "leader", "score")


@query(
    "without_exact_duplicates",
    f"SELECT doc_id, lang AS country, text AS jobdescription, source AS url FROM documents "
    f"WHERE doc_id NOT IN (SELECT node FROM ({_COPIES_SQL}))",
)
def without_exact_duplicates(spark, sf_dir):
    return dedupe.find_duplicates(_documents(spark, sf_dir), "doc_id", _EXACT_RULES).cleaned


@query("duplicate_records")
def duplicate_records(spark, sf_dir):
    return dedupe.find_duplicates(_documents(spark, sf_dir), "doc_id").listing


@query("remaining_records")
def remaining_records(spark, sf_dir):
    return dedupe.find_duplicates(_documents(spark, sf_dir), "doc_id").cleaned


@query("duplicate_export")
def duplicate_export(spark, sf_dir):
    found = dedupe.find_duplicates(_documents(spark, sf_dir), "doc_id").listing
    certain = dedupe.certain_duplicates(found)
    return dedupe.duplicate_export(certain, dedupe.preselected(certain))


@query("pair_scores")
def pair_scores(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    pairs = candidates.candidate_pairs(documents, "doc_id", ["jobdescription"], ["country"])
    return dedupe.pair_scores(documents, "doc_id", pairs)


# Orders as ads whose text holds no search term: digits with blanks between them.  The groups
# are order states, thousands of records each; a duplicate has the same digits.
@query(
    "termless_duplicates",
    r"""WITH ads AS (SELECT o_orderkey AS id, array_to_string(list_sort(
                       regexp_extract_all(CAST(o_custkey AS VARCHAR), '[0-9]')), ' ') AS digits,
                       o_orderstatus AS state FROM orders),
             led AS (SELECT id, min(id) OVER (PARTITION BY state, digits) AS leader FROM ads)
        SELECT id AS node, leader, 100 AS score FROM led WHERE id <> leader""",
)
def termless_duplicates(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    digits = F.regexp_extract_all(F.col("o_custkey").cast("string"), F.lit("[0-9]"), F.lit(0))
    ads_ = orders.select("o_orderkey", F.array_join(digits, " ").alias("jobdescription"),
                         F.col("o_orderstatus").alias("country"))
    return dedupe.find_duplicates(ads_, "o_orderkey", _EXACT_RULES).dropped.select(
        "node", "leader", "score")


# Parts seen as ads in families of four: near-equal texts, grades, places and coordinates, so
# that every check both accepts and rejects pairs.  Valid in Spark SQL and in DuckDB.
_FAMILY = (
    "SELECT p_partkey, c, j, md5(CAST(c AS VARCHAR(20))) AS h FROM (SELECT p_partkey, "
    "CAST(floor(p_partkey / 4) AS BIGINT) AS c, CAST(p_partkey % 4 AS INTEGER) AS j FROM part) f"
)
_FAMILY_COLUMNS = {
    "jobid": "p_partkey",
    "jobdescription": """concat(CASE WHEN c % 7 = 3 THEN 'Vollzeit Teilzeit ' ELSE 'Leitung ' END,
        substr(h, 1, 9), ' ', substr(h, 10, 9), ' ', substr(h, 19, 9),
        CASE j WHEN 1 THEN 'x' WHEN 3 THEN CASE WHEN c % 5 = 0 THEN ' qqq' ELSE 'yz' END
               ELSE '' END)""",
    "jobtype": "CASE c % 3 WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE NULL END",
    "company": """CASE WHEN c % 6 = 0 THEN NULL ELSE concat('Haus ', substr(h, 20, 7),
        CASE WHEN j = 1 AND c % 3 = 0 THEN ' AG' WHEN j = 2 AND c % 3 = 1 THEN ' GmbH'
             ELSE '' END, ' ', substr(h, 3, 6)) END""",
    "location": """concat(CASE WHEN j = 2 AND c % 8 = 2 THEN 'ORT ' ELSE 'Ort ' END,
        substr(h, 5, 8), CASE WHEN j = 3 AND c % 4 = 1 THEN 's' ELSE '' END)""",
    "country": "'DE'",
    "plz": """CASE WHEN c % 5 = 2 THEN NULL WHEN j = 1 AND c % 11 = 4 THEN '00000'
        ELSE lpad(CAST(c % 100000 AS VARCHAR(9)), 5, '1') END""",
    "salary": """CASE c % 4 WHEN 0 THEN NULL WHEN 1 THEN 'TV-L E 9'
        WHEN 2 THEN concat('TV-L E 9', CASE j WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE '' END)
        ELSE concat('Entgeltgruppe im Haus E ', CASE j WHEN 3 THEN '10' WHEN 2 THEN '12'
                    ELSE '9' END) END""",
    "geo_lat": """CASE WHEN c % 9 = 5 OR c % 9 = 6 AND j = 2 THEN NULL ELSE CAST(52.5 AS DOUBLE)
        + CAST(j * (c % 3) AS DOUBLE) / CAST(10000 AS DOUBLE) END""",
    "geo_lon": "CAST(13.4 AS DOUBLE) + CAST(j * (c % 2) AS DOUBLE) / CAST(10000 AS DOUBLE)",
    "note": "CASE WHEN j = 2 THEN NULL ELSE 'n' END",
}


def _both(first: str, second: str, score: str) -> str:
    """A score that applies only where both values are there."""
    return f"CASE WHEN {first} IS NOT NULL AND {second} IS NOT NULL THEN {score} END"


def _stop_words_sql(column: str) -> str:
    sql = f"lower({column})"
    for word in R.COMPANY_STOP_WORDS:
        sql = f"replace({sql}, '{word}', '')"
    return f"trim(regexp_replace({sql}, '\\s+', ' ', 'g'))"


def _found_sql() -> str:
    """``dropped(node, leader, score)`` of the families, after all checks, and what leads to it."""
    fuzzy, numbers = DEFAULT_RULES.fuzzy_columns, DEFAULT_RULES.numeric_columns
    filled = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _FAMILY_COLUMNS)
    text = "concat_ws(' ', " + ", ".join(f"coalesce({c}, '')" for c in fuzzy) + ")"
    compared = {c: (_TOKENS.format(f"x.{c}"), _TOKENS.format(f"y.{c}")) for c in fuzzy}
    compared["bare"] = tuple(
        _TOKENS.format(_stop_words_sql(f"{t}.company")) for t in ("x", "y"))
    compared["lower"] = tuple(_TOKENS.format(f"lower({t}.jobdescription)") for t in ("x", "y"))
    compared["place_name"] = ("lower(trim(x.location))", "lower(trim(y.location))")
    scores = " ".join(
        f"LEFT JOIN {_score_sql(f'SELECT id, {a} AS a, {b} AS b FROM (SELECT id, lo, hi FROM cand) c JOIN ranked x ON x.place = lo JOIN ranked y ON y.place = hi WHERE {a} IS NOT NULL AND {b} IS NOT NULL')} s_{c} ON s_{c}.id = cand.id"
        for c, (a, b) in compared.items())
    near = {c: _both(f"x.{c}", f"y.{c}", f"greatest(CAST(0 AS DOUBLE), 100 * (1 - least(abs(x.{c} - y.{c}) / CAST({DEFAULT_RULES.numeric_tolerance} AS DOUBLE), CAST(1 AS DOUBLE))))") for c in numbers}
    grade = "TRY_CAST(nullif(regexp_extract(upper({}.salary), '" + R.GRADE_IN_SALARY + "', {}), '') AS INTEGER)"
    letters = "regexp_extract(upper({}.salary), '" + R.GRADE_IN_SALARY + "', 2)"
    gx, gy = grade.format("x", 1), grade.format("y", 1)
    lx, ly = letters.format("x"), letters.format("y")
    least = {c: DEFAULT_RULES.field_score for c in fuzzy}
    least[DEFAULT_RULES.description_column] = DEFAULT_RULES.description_score
    checks = [
        f"({gx} IS NULL OR {gy} IS NULL OR abs({gx} - {gy}) = 1 OR {gx} = {gy} AND "
        f"(contains({lx}, {ly}) OR contains({ly}, {lx})))",
        *[f"(s_{c}.score >= {n} OR x.{c} IS NULL AND y.{c} IS NULL)" for c, n in least.items()],
        *[f"coalesce({near[c]} >= {DEFAULT_RULES.numeric_score}, x.{c} IS NULL AND y.{c} IS NULL)"
          for c in numbers],
        f"(s_bare.score >= {DEFAULT_RULES.company_score} OR s_bare.score IS NULL OR least("
        f"length({_stop_words_sql('x.company')}), length({_stop_words_sql('y.company')})) <= "
        f"{DEFAULT_RULES.min_compare_length})",
        f"s_lower.score >= {DEFAULT_RULES.description_score}",
        f"s_place_name.score >= {DEFAULT_RULES.place_score}",
        *[f"NOT (contains(lower({p}.jobdescription), '{s}') AND "
          f"contains(lower({q}.jobdescription), '{t}'))"
          for s, t in DEFAULT_RULES.contradictions for p, q in (("x", "y"), ("y", "x"))],
    ]
    terms = [f"CAST(s_{c}.score AS DOUBLE)" for c in fuzzy] + [near[c] for c in numbers]
    total = " + ".join(f"coalesce({t}, 0)" for t in terms)
    count = " + ".join(f"CAST({t} IS NOT NULL AS INTEGER)" for t in terms)
    return f"""
    WITH RECURSIVE family AS ({_FAMILY}),
    ads AS ({_select(_FAMILY_COLUMNS, "family")}),
    ranked AS (SELECT *, row_number() OVER (ORDER BY {filled} DESC, jobid) AS place,
                      concat(coalesce(jobtype, ''), '|', coalesce(country, '')) AS grp,
                      {text} AS joined FROM ads),
    {_vectors_cte("SELECT place AS doc_id, grp AS lang, joined AS text FROM ranked")},
    near AS ({_nearest_sql(0.0)}),
    pairs AS (SELECT DISTINCT least(i, j) AS lo, greatest(i, j) AS hi FROM near),
    cand AS (SELECT row_number() OVER () AS id, lo, hi FROM pairs),
    checked AS (SELECT lo, hi, CAST(floor(({total}) / ({count})) AS INTEGER) AS score
                FROM cand JOIN ranked x ON x.place = lo JOIN ranked y ON y.place = hi {scores}
                WHERE {" AND ".join(checks)}),
    accepted AS (SELECT * FROM checked WHERE score >= {DEFAULT_RULES.min_probability}),
    nodes AS (SELECT row_number() OVER (ORDER BY place) AS step, place, coalesce(
                     (SELECT list(lo) FROM accepted WHERE hi = place), []) AS better
              FROM (SELECT lo AS place FROM accepted UNION SELECT hi FROM accepted)),
    walk AS (SELECT CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS led
             UNION ALL
             SELECT n.step, CASE WHEN len(list_intersect(w.led, n.better)) > 0 THEN w.led
                                 ELSE list_append(w.led, n.place) END
             FROM walk w JOIN nodes n ON n.step = w.step + 1),
    led AS (SELECT led FROM walk ORDER BY step DESC LIMIT 1),
    taken AS (SELECT place, list_min(list_intersect(led, better)) AS leader FROM nodes, led),
    dropped AS (SELECT n.jobid AS node, l.jobid AS leader, score FROM taken
                JOIN accepted ON lo = leader AND hi = taken.place
                JOIN ranked n ON n.place = taken.place JOIN ranked l ON l.place = leader
                WHERE leader IS NOT NULL)"""


_LISTED = """,
    kept AS (SELECT leader, max(score) AS probability,
                    row_number() OVER (ORDER BY leader) - 1 AS pair_id FROM dropped GROUP BY 1),
    roles AS (SELECT leader AS orig_index, true AS keep, pair_id, probability FROM kept
              UNION ALL SELECT node, false, pair_id, score FROM dropped JOIN kept USING (leader))"""


def _families(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = spread_table(spark, sf_dir, "part", "p_partkey").selectExpr(
        "p_partkey", "CAST(floor(p_partkey / 4) AS BIGINT) AS c",
        "CAST(p_partkey % 4 AS INTEGER) AS j")
    family = family.selectExpr("*", "md5(CAST(c AS STRING)) AS h")
    return family.select(*[F.expr(e).alias(n) for n, e in _FAMILY_COLUMNS.items()])


@query(
    "duplicate_ads",
    f"""{_found_sql()}{_LISTED}
    SELECT ads.*, keep, pair_id, orig_index, probability FROM ads JOIN roles ON jobid = orig_index""",
)
def duplicate_ads(spark, sf_dir):
    """All fuzzy fields and coordinates, every check, survivors and listing."""
    return dedupe.find_duplicates(_families(spark, sf_dir), "jobid").listing


@query(
    "duplicate_ads_after_a_load",
    f"""{_found_sql()}{_LISTED}
    SELECT ads.*, keep, orig_index, probability, jobid % 8 < 4 AND pair_id IS NOT NULL AS early
    FROM ads JOIN roles ON jobid = orig_index""",
)
def duplicate_ads_after_a_load(spark, sf_dir):
    """Half of the ads (whole families) were searched before the others came; all pair numbers
    of that search stay, which leaves the rows of a full search."""
    every = _families(spark, sf_dir)
    before = dedupe.find_duplicates(every.filter("jobid % 8 < 4"), "jobid").listing
    before = written(before.select("orig_index", "pair_id", "keep"), "earlier-listing")
    last = before.agg(F.max("pair_id")).first()[0]
    listing = dedupe.find_duplicates(every, "jobid").listing_after(before)
    return listing.withColumn("early", F.col("pair_id") <= F.lit(last)).drop("pair_id")


@query(
    "remaining_ads",
    f"{_found_sql()} SELECT * FROM ads WHERE jobid NOT IN (SELECT node FROM dropped)",
)
def remaining_ads(spark, sf_dir):
    return dedupe.find_duplicates(_families(spark, sf_dir), "jobid").cleaned


@query(
    "duplicate_ads_export",
    f"""{_found_sql()}{_LISTED}
    SELECT {", ".join(f"{c} AS _{c.upper()}_" for c in _FAMILY_COLUMNS)}, leader AS _DUPLICATE_OF_
    FROM ads JOIN dropped ON jobid = node WHERE score = 100""",
)
def duplicate_ads_export(spark, sf_dir):
    found = dedupe.find_duplicates(_families(spark, sf_dir), "jobid").listing
    certain = dedupe.certain_duplicates(found)
    return dedupe.duplicate_export(certain, dedupe.preselected(certain))


@query(
    "ad_pair_scores",
    f"""{_found_sql()}
    SELECT least(x.jobid, y.jobid) AS lo, greatest(x.jobid, y.jobid) AS hi, score FROM accepted
    JOIN ranked x ON x.place = lo JOIN ranked y ON y.place = hi""",
)
def ad_pair_scores(spark, sf_dir):
    ads_ = _families(spark, sf_dir)
    rules = DEFAULT_RULES
    rank = F.struct((-dedupe.filled_cells(ads_)).alias("minus_filled"), F.col("jobid").alias("key"))
    rows = candidates.search_rows(
        ads_, "jobid", candidates.group_key(["jobtype", "country"]),
        candidates.joined_text(ads_, list(rules.fuzzy_columns)), rank)
    pairs, _ = candidates.search(rows, rules)
    return dedupe.pair_scores(ads_, "jobid", pairs.select("lo", "hi"))


# ------------------------------------------------------------- files, written and scanned

def _folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _order_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """Orders as delimited files with a header each."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    header = "_JobID__§_*STATUS*_§_Priority_§__Date__§_geo_lat_§_extra"
    path = _folder(spark, "orders")
    orders.repartition(files).select(F.expr(_LINE).alias(header)).write.options(
        header=True, sep="\x01", quote="", encoding="UTF-8").csv(path)
    return path


@query("delimited_scan", ORACLES["delimited_parse"])
def delimited_scan(spark, sf_dir):
    return delimited.read_table(spark, _order_files(spark, sf_dir, 3))


@query("chunked_scan", ORACLES["delimited_parse"])
def chunked_scan(spark, sf_dir):
    found = ingest_chunks(
        spark, _order_files(spark, sf_dir, 4), _folder(spark, "ingested"),
        _folder(spark, "ingest-checkpoint"))
    return found.table


_CODE = "concat('N', chr(CAST(65 + n_nationkey AS INTEGER)))"


@query(
    "stored_codes",
    f"""SELECT c_custkey, n_name AS stored, concat(n_name, ' neu') AS fresh, n_name AS chosen
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def stored_codes(spark, sf_dir):
    """Customers' places from codes: of a stored file, of a query response, and the choice."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("place"), F.expr(_CODE).alias("code"))
    stored, response = _folder(spark, "codes"), _folder(spark, "response")
    # one object of a row for each nation
    nations.agg(F.map_from_entries(F.collect_list(F.struct("code", "place"))).alias("m")).select(
        F.to_json("m")).coalesce(1).write.text(stored)
    cell = F.struct(
        F.struct(F.col("code").alias("value")).alias("licencePlate"),
        F.struct(F.concat("place", F.lit(" neu")).alias("value")).alias("itemLabel"))
    nations.agg(F.struct(F.collect_list(cell).alias("bindings")).alias("results")).coalesce(
        1).write.json(response)
    read = codes.read_codes(spark, stored)
    fresh = codes.codes_from_bindings(spark, response)
    kept = _folder(spark, "kept-codes")
    codes.write_codes(codes.choose_codes(read, fresh), kept)
    places = table(spark, sf_dir, "customer").join(
        nations.select(F.col("n_nationkey").alias("c_nationkey"), "code"), "c_nationkey"
    ).select("c_custkey", *[F.col("code").alias(c) for c in ("stored", "fresh", "chosen")])
    places = lookup.resolve_codes(places, "stored", read)
    places = lookup.resolve_codes(places, "fresh", fresh)
    return lookup.resolve_codes(places, "chosen", spark.read.parquet(kept))


@query("cleaned_sink", ORACLES["clean_table"])
def cleaned_sink(spark, sf_dir):
    path = _folder(spark, "cleaned")
    sinks.write_cleaned(QUERIES["clean_table"](spark, sf_dir), path)
    return spark.read.parquet(path)


@query("report_sink", ORACLES["error_report"])
def report_sink(spark, sf_dir):
    report = QUERIES["error_report"](spark, sf_dir)
    path = _folder(spark, "report")
    sinks.write_report(report, path, "csv")
    return spark.read.csv(path, schema=report.schema, header=True, quote='"', escape='"')

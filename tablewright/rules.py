"""Column roles, thresholds and fixed values shared by all operators.

Operators never hard-code a column name: they read it from a ``Rules`` object,
so the same code runs on any table once its columns are mapped to roles.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --------------------------------------------------------------------------
# Fixed values.  Word lists, patterns and constants that decide the results;
# they have to stay exactly as they are.
# --------------------------------------------------------------------------

# Text forms read as "missing" by the delimited scan.
NA_STRINGS = (
    "", "NaN", "nan", "-NaN", "-nan", "NA", "N/A", "n/a", "#N/A", "#NA", "#N/A N/A",
    "<NA>", "NULL", "null", "None", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
)

# Missing markers counted by the profiler, in tie-break order (null comes last).
ERROR_MARKERS = ("", "??", "na", "n/a", "null")

# Error taxonomy labels.
NO_DATA = "Keine Daten"
NO_ERRORS = "Keine signifikanten Fehler"

MISPLACED_TERMS = ("gmbh", "ag", "bibliothek", "universität", "http", "www")
DUMMY_VALUES = ("test", "xxx", "123", "unknown")

# Towns removed from the end of an organisation name when they follow a comma.
TOWN_SUFFIXES = (
    "Hamburg|Berlin|München|Köln|Frankfurt|Dresden|Leipzig|Hannover|Düsseldorf|Stuttgart|"
    "Dortmund|Essen|Bremen|Duisburg|Nürnberg|Bochum|Wuppertal|Bielefeld|Bonn|Münster|"
    "Karlsruhe|Mannheim|Augsburg|Wiesbaden|Gelsenkirchen|Mönchengladbach|Braunschweig|"
    "Chemnitz|Kiel|Aachen|Halle|Magdeburg|Freiburg|Krefeld|Lübeck|Mainz|Erfurt|Oberhausen|"
    "Rostock|Kassel|Hagen|Potsdam|Saarbrücken|Hamm|Mülheim|Ludwigshafen|Leverkusen|"
    "Oldenburg|Osnabrück|Solingen|Heidelberg|Herne|Neuss|Darmstadt|Paderborn|Regensburg|"
    "Ingolstadt|Würzburg|Fürth|Wolfsburg|Offenbach|Ulm|Heilbronn|Pforzheim|Göttingen|"
    "Bottrop|Trier|Recklinghausen|Reutlingen|Bremerhaven|Koblenz|Bergisch|Gladbach|Jena|"
    "Remscheid|Erlangen|Moers|Siegen|Hildesheim|Salzgitter|Leimen|Marburg|Kleve|Wildau|"
    "Minden|Oberhaching|Böhl-Iggelheim|Groß-Umstadt|Mainburg|Stralsund|Zella-Mehlis"
)

# Whole-word spellings unified in organisation names, applied in this order.
NAME_SPELLINGS = (
    ("gGmbH", "gGmbH"),
    ("GmbH", "GmbH"),
    ("AG", "AG"),
    (r"e\.V\.", "e.V."),
    ("eV", "e.V."),
    ("LLP", "LLP"),
    ("Bibliothek", "Bibliothek"),
    ("Universität", "Universität"),
    ("Hochschule", "Hochschule"),
    ("Institut", "Institut"),
    ("Zentrum", "Zentrum"),
    ("Stadt", "Stadt"),
)

# Redundant tails of organisation names, applied in this order.  WORD stands for
# one word character (see functions/text.py).
NAME_TAILS = (
    r",\s*Softwarehersteller für Bibliotheken",
    r",\s*Bibliothek$",
    r",\s*Stadtbibliothek$",
    r",\s*Universitätsbibliothek$",
    r",\s*Referat Benutzung$",
    r",\s*Dienstort\s+WORD+$",
    r",\s*Standort\s+WORD+$",
    r",\s*Ärztliche Zentralbibliothek$",
    r",\s*Hochschulbibliothek$",
)

POSTAL_AFTER_COMMA = r",\s*(\d{5})(?:\s+[A-ZÄÖÜ][a-zäöüß\s-]+)?$"
POSTAL_AFTER_BLANK = r"\s+(\d{5})\s+[A-ZÄÖÜ][a-zäöüß\s-]+$"

# Contract term.
OPEN_ENDED = r"\bunbefristet\b"
FIXED_TERM_RAISE = r"\bbefristete\s+erhöhung\b"
FIXED_TERM = (
    r"\bbefristet\b"
    r"(?:"
    r"(?:\s+(?:bis|für|auf|als|zum|zur|in|mit|voraussichtlich|zunächst))?"
    r"(?:\s+(?:zum|den|die|der|das|ein|eine|einen|zwei|drei))?"
    r"(?:"
    r"(?:\s+\d{1,2}\.?\s*(?:januar|februar|märz|april|mai|juni|juli|august|september"
    r"|oktober|november|dezember|\d{1,2})\.?\s*\d{4})|"
    r"(?:\s+\d+\s+(?:jahr|jahre|monat|monate|woche|wochen))|"
    r"(?:\s+WORD*vertretung)|"
    r"(?:\s+elternzeit)|"
    r"(?:\s+mutterschutz)|"
    r"(?:\s+der\s+option\s+einer\s+unbefristeten\s+weiterbeschäftigung)"
    r")*"
    r")?"
)
FIXED_TERM_EXCLUSION = (
    r"(?![\sWORD]*(?:tv-?l|e\s?\d+|vollzeit|teilzeit|stunden|arbeitszeit"
    r"|wochenarbeitszeit|stellenausschreibung))"
)
FIXED_TERM_TAILS = (
    r"\s+(?:zu|in|mit|und|oder)\s*$",
    r"\s+bis\s*$",
    r"\s+tv-?l.*$",
    r"\s+e\s?\d+.*$",
    r"\s+(?:vollzeit|teilzeit|in\s+vollzeit|in\s+teilzeit).*$",
    r"\s+\d+\s*(?:%|prozent|stunden|std\.).*$",
)

# Working time.
FULL_TIME_WORD = r"\bvollzeit\b"
PART_TIME_WORD = r"\bteilzeit\b"
HOURS_PER_WEEK = (
    r"(\d+(?:[,\.]\d+)?)\s*(?:stunden|std\.?)\s*(?:/|pro|je|die)?\s*(?:woche|wo\.)"
)
HOURS_PER_MONTH = r"(\d+(?:[,\.]\d+)?)\s*(?:stunden|std\.?)\s*(?:/|pro|je|im)?\s*monat"
PERCENT = r"(\d+(?:[,\.]\d+)?)\s*%"
HOURS_BARE = (
    r"(?:mit|von|umfang|arbeitszeit|wochenarbeitszeit)\s*(?:von)?\s*"
    r"(\d+(?:[,\.]\d+)?)\s*(?:stunden|std\.?)"
)
FULL_TIME = "Vollzeit"
PART_TIME = "Teilzeit"
FULL_TIME_HOURS = 36
FULL_TIME_PERCENT = 90
MAX_WEEK_HOURS = 60
WEEKS_PER_MONTH = 4.33

# Pay.
TARIFF_GRADE = (
    r"(?:tv-?[löd]|tv[öo]d|tv-?h)\s*(?:e|eg)\s*((\d{1,2})[üÜ]?(?:\s*[ab])?)"
)
BARE_GRADE = r"\b(?:e|eg)\s*((\d{1,2})[üÜ]?(?:\s*[ab])?)\b"
CIVIL_GRADE = r"\ba\s*(\d{1,2})\b"
MINI_JOB = r"450\s*(?:€|eur|euro)(?:-job)?"
MINI_JOB_LABEL = "450 Euro-Job"
SPLIT_AMOUNT = (
    r"(\d{1,2})\s+(\d{2})\s*(?:€|eur|euro)\s*(?:/|pro|je)?\s*"
    r"(?:stunde|std\.?|monat|jahr|woche|tag)"
)
AMOUNTS = (
    r"(\d{1,5}(?:[.,]\d{1,3})?)\s*(?:€|eur|euro)\s*(?:/|pro|je)?\s*"
    r"(?:stunde|std\.?|monat|jahr|woche|tag)",
    r"(\d{1,5}(?:[.,]\d{1,3})?)\s*€\s*/\s*(?:h|std\.?)",
    r"(?:stunden|monats|jahres|wochen)lohn\s*(?:von)?\s*(\d{1,5}(?:[.,]\d{1,3})?)"
    r"\s*(?:€|eur|euro)",
    r"(\d{3,5})\s*(?:€|eur|euro)(?![/-]job)",
)

# Pair checks.
GRADE_IN_SALARY = r"E\s*G?\s*(\d+)\s*([A-Z]*)"
COMPANY_STOP_WORDS = (
    "gmbh", "ag", "ev", "e.v.", "bibliothek", "stadtbibliothek",
    "universitätsbibliothek", "landesbibliothek", "stadt", "universität",
)
CONTRADICTIONS = (
    ("vollzeit", "teilzeit"),
    ("befristet", "unbefristet"),
    ("ausbildung", "arbeitsstelle"),
    ("leitung", "mitarbeiter"),
    ("e13", "e9"),
    ("e12", "e8"),
    ("e11", "e7"),
    ("e10", "e6"),
    ("e9", "e5"),
)
# --------------------------------------------------------------------------
# End of fixed values.
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Roles of the columns and the tunable numbers of every operator."""

    # typed columns of the delimited scan
    integer_columns: tuple[str, ...] = ("jobid",)
    number_columns: tuple[str, ...] = ("geo_lat", "geo_lon")
    date_columns: tuple[str, ...] = ("date",)

    # roles used by cleaning
    name_column: str = "company"
    place_column: str = "location"
    postal_column: str = "plz"
    description_column: str = "jobdescription"

    # roles used by the error detectors
    unique_columns: tuple[str, ...] = ("jobid", "url")
    latitude_column: str = "geo_lat"
    longitude_column: str = "geo_lon"
    country_column: str = "country"
    category_column: str = "jobtype"
    first_year: int = 2000
    last_year: int = 2025
    conflict_top: int = 10

    # roles and thresholds used by duplicate search
    exact_columns: tuple[str, ...] = (
        "jobtype", "insttype", "country", "fixedterm", "workinghours",
    )
    fuzzy_columns: tuple[str, ...] = (
        "jobdescription", "company", "location", "plz", "salary",
    )
    numeric_columns: tuple[str, ...] = ("geo_lat", "geo_lon")
    salary_column: str = "salary"
    description_score: int = 95
    field_score: int = 90
    company_score: int = 85
    place_score: int = 90
    min_compare_length: int = 10
    numeric_tolerance: float = 0.01
    numeric_score: float = 95.0
    min_probability: int = 95
    contradictions: tuple[tuple[str, str], ...] = CONTRADICTIONS
    company_stop_words: tuple[str, ...] = COMPANY_STOP_WORDS

    # text dates whose year is checked: the first form that parses counts
    date_forms: tuple[str, ...] = (
        "d-M-yyyy", "d.M.yyyy", "d/M/yyyy", "M-d-yyyy", "M/d/yyyy", "yyyy-M-d", "yyyy/M/d",
        "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy",
    )

    # candidate search
    n_neighbors: int = 5
    max_df: float = 0.95
    min_cosine: float = 0.0  # least similarity of a neighbour, in every group

    # name consolidation
    name_score: int = 85

    # physical tuning: none of these changes a result
    block_head: int = 256
    block_classes: int = 32_768
    block_entries: int = 6_000_000
    rare_holders: int = 256

    def with_(self, **changes) -> "Rules":
        """A copy with some values replaced."""
        return replace(self, **changes)


DEFAULT_RULES = Rules()

"""Native text functions: trimming, markup removal, entity decoding."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# One word character: letters, digits of any kind, underscore.
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\x1c-\x1f]"


def pattern(text: str) -> str:
    """Case-insensitive Unicode pattern in which only ``\\n`` ends a line."""
    return "(?idU)" + text.replace("WORD", WORD)


def found(column: Column, text: str, group: int = 0) -> Column:
    """First match of ``text`` (null when there is none)."""
    return F.when(
        column.rlike(pattern(text)), F.regexp_extract(column, pattern(text), group)
    )


def removed(column: Column, text: str) -> Column:
    return F.regexp_replace(column, pattern(text), "")


def trimmed(column: Column) -> Column:
    """Strip every kind of blank at both ends (``F.trim`` strips spaces only)."""
    return F.regexp_replace(
        column, rf"(?U)^{BLANK}+|(?<!{BLANK}){BLANK}+\z", ""
    )


def squeezed(column: Column) -> Column:
    """Runs of blanks become one space, none stay at the ends."""
    return trimmed(F.regexp_replace(column, rf"(?U){BLANK}+", " "))


def strip_tags(column: Column) -> Column:
    """Delete every shortest ``<...>`` that does not cross a line end."""
    return F.regexp_replace(column, r"<[^>\n]*>", "")


# ---------------------------------------------------------------- entity decoding

def _references() -> tuple[str, str]:
    """Named references as ``{first character: {name: text}}`` JSON, and the pattern
    of the old names that also work without a semicolon (longest first)."""
    by_first: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        by_first.setdefault(name[0], {})[name] = text
    legacy = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return json.dumps(by_first), "|".join(legacy)


_NAMED_JSON, _LEGACY = _references()
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _windows_1252() -> dict[int, str]:
    """References 128-159 mean Windows-1252 characters; unassigned ones stay."""
    table = {}
    for code in range(0x80, 0xA0):
        try:
            table[code] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[code] = chr(code)
    return table


_WINDOWS_JSON = json.dumps({str(k): v for k, v in _windows_1252().items()})


def _character(code: Column) -> Column:
    """Text of a numeric reference, following the HTML5 error rules."""
    windows = F.from_json(F.lit(_WINDOWS_JSON), "map<string,string>")
    ignored = (
        code.between(0x1, 0x8)
        | code.between(0xB, 0xB)
        | code.between(0xE, 0x1F)
        | code.between(0x7F, 0x9F)
        | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when(code.isNull() | (code == 0) | (code > 0x10FFFF), F.lit("�"))
        .when(code == 13, F.lit("\r"))
        .when(code.between(0x80, 0x9F), F.element_at(windows, code.cast("string")))
        .when(code.between(0xD800, 0xDFFF), F.lit("�"))
        .when(ignored, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _decoded_piece(piece: Column) -> Column:
    """Decode one piece of text that followed an ampersand."""
    reference = F.regexp_extract(piece, _REFERENCE, 1)
    rest = F.substring(piece, F.length(reference) + 1, F.length(piece))
    named = F.element_at(
        F.from_json(F.lit(_NAMED_JSON), "map<string,map<string,string>>"),
        F.substring(reference, 1, 1),
    )
    exact = F.element_at(named, reference)
    old_name = F.regexp_extract(reference, rf"^({_LEGACY})", 1)
    digits = F.regexp_replace(reference, "[#xX;]", "")
    is_hex = reference.rlike("^#[xX]")
    bare_hex = F.ltrim(digits, F.lit("0"))
    code = F.when(
        is_hex,
        F.when(F.length(bare_hex) <= 8, F.conv(F.concat(F.lit("0"), bare_hex), 16, 10)),
    ).otherwise(digits)
    number = code.try_cast("bigint")
    return (
        F.when(reference == "", F.concat(F.lit("&"), piece))
        .when(reference.startswith("#"), F.concat(_character(number), rest))
        .when(exact.isNotNull(), F.concat(exact, rest))
        .when(
            F.length(old_name) >= 2,
            F.concat(
                F.element_at(named, old_name),
                F.substring(piece, F.length(old_name) + 1, F.length(piece)),
            ),
        )
        .otherwise(F.concat(F.lit("&"), piece))
    )


def decode_entities(column: Column) -> Column:
    """Decode named, decimal and hexadecimal character references.

    Each ampersand is decoded once and on its own, so ``&amp;lt;`` gives ``&lt;``.
    Text without an ampersand passes through untouched.
    """
    pieces = F.split(column, "&", -1)
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(
            F.transform(F.slice(pieces, 2, F.size(pieces)), _decoded_piece), ""
        ),
    )
    return F.when(F.instr(column, "&") == 0, column).otherwise(decoded)


def clean_markup(column: Column) -> Column:
    """Tags first, then entities (encoded tags therefore stay as text)."""
    return decode_entities(strip_tags(column))

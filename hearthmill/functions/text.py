"""Whitespace, redaction, personal data and HTML text."""

from __future__ import annotations

from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Account masks.
MASK_PREFIX = "XXXX-"
MASK_UNKNOWN = "XXXX-REDACTED"

# Entities resolved by the SQL twin of the HTML strip, with or without
# their semicolon; the native strip knows all. The ampersand comes last so that a doubly escaped entity is
# resolved once only.
HTML_ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "#39": "'",
    "nbsp": "\xa0",
    "copy": "\xa9",
    "reg": "\xae",
    "middot": "\xb7",
    "euro": "\u20ac",
    "pound": "\xa3",
    "cent": "\xa2",
    "ndash": "\u2013",
    "mdash": "\u2014",
    "hellip": "\u2026",
    "amp": "&",
}

# Stands where markup was; cannot occur in decoded text.
_NODE_BREAK = "\x01"

# One alternation, so that the construct that begins first wins.
_HTML_MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|template\b[^>]*>.*?(?:</template\s*>|\z)"
    r"|[!?][^>]*>"
    # Runs are taken whole, so that a long tag needs few regex steps.
    r"""|/?[a-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>)"""
)

# A name is taken whole: '&ampersand' is no ampersand.
_HTML_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+(?:;|\b))"
_NAMED = {name[:-1]: plain for name, plain in html5.items() if name.endswith(";")}
# Numbers that stand for another character or for none.
_NUMBERED = {n: unescape(f"&#{n};") for n in range(160) if unescape(f"&#{n};") != chr(n)}

# Tried only where a name begins and taken whole, so that a long token costs one step.
EMAIL_ADDRESS = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
LONG_DIGIT_RUN = r"\d{7,}"


def strip(value: Column) -> Column:
    """Remove surrounding whitespace, tabs and line ends included."""
    return F.btrim(value, F.lit(WHITESPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def snake_case(header: str) -> str:
    return header.strip().lower().replace(" ", "_")


def redact_account(value: Column) -> Column:
    """Keep the last four digits of an account number behind a mask."""
    digits = F.regexp_replace(value, r"[^\p{Nd}]", "")
    return F.when(
        F.coalesce(digits, F.lit("")) == "", F.lit(MASK_UNKNOWN)
    ).otherwise(F.concat(F.lit(MASK_PREFIX), F.right(digits, F.lit(4))))


def account_from_file_name(file_name: Column) -> Column:
    """Mask built from the first four-digit ``_`` token of a file's stem."""
    base = F.element_at(F.split(file_name, "/"), -1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]+$", "")
    tokens = F.filter(F.split(stem, "_"), lambda token: token.rlike(r"^\p{Nd}{4}$"))
    return F.coalesce(F.concat(F.lit(MASK_PREFIX), F.get(tokens, F.lit(0))), F.lit(MASK_UNKNOWN))


def mask_personal_data(value: Column) -> Column:
    """Copy of a text with e-mail addresses and long digit runs masked."""
    no_email = F.regexp_replace(value, EMAIL_ADDRESS, "[EMAIL]")
    return F.regexp_replace(no_email, LONG_DIGIT_RUN, "[NUMBER]")


def _numbered(code: Column) -> Column:
    """Character of a code point as HTML reads it; a null code is beyond all."""
    unpaired = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    none = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    fixed = F.create_map(*[F.lit(x) for n, plain in _NUMBERED.items() for x in (n, plain)])
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code.isNull() | unpaired, "\ufffd").when(none, "").when(code < 160, F.coalesce(F.try_element_at(fixed, code.cast("int")), plain)).otherwise(plain)


def _referenced(reference: Column) -> Column:
    """The text a character reference stands for; an unknown one is kept."""
    body = F.regexp_replace(reference, "^&|;$", "")
    digits = F.regexp_replace(body, "^#[xX]?0*(?=.)", "")
    # Longer numbers are beyond all code points.
    decimal = F.when(F.length(digits) <= 8, digits.try_cast("long"))
    hexadecimal = F.when(F.length(digits) <= 8, F.conv(digits, 16, 10).try_cast("long"))
    named = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    return (
        F.when(body.rlike("^#[xX]"), _numbered(hexadecimal))
        .when(body.startswith("#"), _numbered(decimal))
        .otherwise(F.coalesce(F.try_element_at(named, body), reference))
    )


def html_visible_text(html: Column) -> Column:
    """Visible text of an HTML column: one stripped line per text node."""
    text = F.regexp_replace(html, _HTML_MARKUP, _NODE_BREAK)
    plain = F.split(text, _HTML_REFERENCE)
    references = F.regexp_extract_all(text, F.lit(_HTML_REFERENCE), F.lit(0))
    text = F.array_join(F.zip_with(plain, references, lambda p, r: F.concat(p, F.coalesce(_referenced(r), F.lit("")))), "")
    nodes = F.transform(F.split(text, _NODE_BREAK), strip)
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")

"""Amounts in bank cells, receipts and bills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthmill.functions.text import WHITESPACE, strip

# Spark alone would also read "1.5d"; a bank cell must be a plain number. The
# pattern takes the blanks around it, so that a cell is read in one step.
_PLAIN_NUMBER = (
    rf"^[{WHITESPACE}]*+([+-]?(?:(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?\d++)?+|(?i:inf|infinity)))[{WHITESPACE}]*+$"
)

# Cell texts that mean "no amount".
_MISSING_TEXTS = ["", "nan", "None"]

# Decimal tokens on a receipt, and on a bill (optional commas).
RECEIPT_TOKEN = r"\d+\.\d{2}"
BILL_TOKEN = r"\d{1,3}(?:,\d{3})*\.\d{2}|\d+\.\d{2}"


def _without(cell: Column, characters: str) -> Column:
    return reduce(lambda text, c: F.replace(text, F.lit(c), F.lit("")), characters, cell)


def _unsigned_text(cell: Column) -> Column:
    return _without(cell, "$,()-")


def _signed_text(cell: Column) -> Column:
    return _without(cell, "$,")


def _number(text: Column) -> Column:
    return F.regexp_extract(text, _PLAIN_NUMBER, 1).try_cast("double")


def _is_missing(text: Column) -> Column:
    return text.isNull() | strip(text).isin(_MISSING_TEXTS)


def unsigned_amount(cell: Column) -> Column:
    """Magnitude of a debit or credit cell; missing or unreadable gives 0."""
    return F.coalesce(_number(_unsigned_text(cell)), F.lit(0.0))


def signed_amount(cell: Column) -> Column:
    """Signed amount cell; parentheses are not a sign here and give 0."""
    return F.coalesce(_number(_signed_text(cell)), F.lit(0.0))


def _unreadable(text: Column) -> Column:
    return _number(text).isNull() & ~_is_missing(text)


def unsigned_unreadable(cell: Column) -> Column:
    """True where a debit or credit cell holds text that is not a number."""
    return _unreadable(_unsigned_text(cell))


def signed_unreadable(cell: Column) -> Column:
    """True where a signed cell holds text that is not a number."""
    return _unreadable(_signed_text(cell))


def amount_missing(cell: Column) -> Column:
    """True where a debit or credit cell holds nothing to read."""
    return _is_missing(_unsigned_text(cell))


def net_amount(debit: Column, credit: Column) -> Column:
    """Credit minus debit: outflow negative, inflow positive."""
    return unsigned_amount(credit) - unsigned_amount(debit)


def receipt_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RECEIPT_TOKEN), F.lit(0))


def bill_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(BILL_TOKEN), F.lit(0))


def receipt_total(text: Column) -> Column:
    """Largest two-decimal figure on a receipt; commas end a figure."""
    return F.array_max(receipt_tokens(text).cast("array<double>"))


def bill_total(text: Column) -> Column:
    """Largest two-decimal figure in a bill, thousands commas allowed."""
    return F.array_max(
        F.transform(bill_tokens(text), lambda t: F.replace(t, F.lit(","), F.lit("")).cast("double"))
    )

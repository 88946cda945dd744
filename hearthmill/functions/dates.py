"""Ledger, receipt and message dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DATE = (
    r"^\d{4}(-\d{1,2}(-\d{1,2}([T ]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?$"
)
_COMPACT_DATE = r"^\d{8}$"

# Fixed value: year-first date on a receipt once "_" and "/" read as "-".
_RECEIPT_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_ONE_DIGIT_PART = r"-(\d)(?!\d)"
_POSSIBLE_DATE = r"-(0?[1-9]|1[0-2])-(0?[1-9]|[12]\d|3[01])$"

_MESSAGE_DATE = r"(\d{1,2} [A-Za-z]{3} \d{4})"


def ledger_date(cell: Column) -> Column:
    """ISO 8601 calendar date; anything else is null."""
    return F.when(
        cell.rlike(_COMPACT_DATE), F.try_to_date(cell, "yyyyMMdd")
    ).when(cell.rlike(_ISO_DATE), cell.try_cast("date"))


def receipt_date_text(text: Column) -> Column:
    """First year-first date with month 1-12 and day 1-31, zero-padded.

    The day is not checked against the month's length; ``receipt_date`` does.
    """
    dashed = F.translate(text, "_/", "--")
    candidates = F.regexp_extract_all(dashed, F.lit(_RECEIPT_DATE), F.lit(0))
    first = F.get(F.filter(candidates, lambda date: date.rlike(_POSSIBLE_DATE)), F.lit(0))
    return F.regexp_replace(first, _ONE_DIGIT_PART, "-0$1")


def receipt_date(date_text: Column) -> Column:
    """Typed date of ``receipt_date_text``; null where the day does not exist."""
    return F.try_to_date(date_text, "yyyy-MM-dd")


def message_date(header: Column) -> Column:
    """Calendar date of an RFC 2822 date header, in the header's own offset."""
    day = F.regexp_extract(header, _MESSAGE_DATE, 1)
    return F.try_to_date(day, "d MMM yyyy")


def utc_text(timestamp: Column) -> Column:
    """``2026-09-23T22:00:00Z`` form of a timestamp; the session zone is UTC."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def collected_at() -> Column:
    """Current UTC time to the second, in the text form of a sample."""
    return utc_text(F.current_timestamp())


def month_index(date: Column) -> Column:
    """Months since year 0, so that calendar gaps are plain differences."""
    return F.year(date) * 12 + F.month(date) - 1


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")

"""Canonical column lists and the records' Spark types."""

from __future__ import annotations

# Column names, their order, and the words that name a layout, a
# status, a probe or a metric.
LEDGER_COLUMNS = ["account_number", "post_date", "check", "description", "amount", "status"]

# Kept beside the canonical columns so that a defaulted value stays visible.
LEDGER_AUDIT_COLUMNS = ["post_date_raw", "amount_raw", "amount_ok"]

LEDGER_ROW = (
    "account_number string, post_date date, check string, description string, amount double, "
    "status string, post_date_raw string, amount_raw string, amount_ok boolean, "
    "source_file string, received_ts timestamp, record string, error string"
)

SPLIT_LEDGER_REQUIRED = [
    "account_number",
    "post_date",
    "check",
    "description",
    "debit",
    "credit",
    "status",
]

# Header that only the signed-amount layout carries, and its column mapping.
SIGNED_LEDGER_MARKER = "Sub-description"
SIGNED_LEDGER_HEADERS = {
    "Date": "post_date",
    "Sub-description": "description",
    "Amount": "amount",
}

BILL_COLUMNS = ["date", "subject", "total_amount", "raw_body_text"]

RECEIPT_COLUMNS = ["date", "total_amount", "raw_ocr_text"]

OBSERVATION_COLUMNS = [
    "timestamp",
    "source_component",
    "metric_name",
    "metric_value",
    "status",
    "raw_payload",
]

GOOD_STATUSES = ["ONLINE", "HEALTHY"]

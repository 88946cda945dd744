"""Receipt text to dated totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthmill.functions import dates, money


def extract_receipts(df: DataFrame, text: str = "raw_ocr_text") -> DataFrame:
    """Add ``date``, typed ``receipt_date`` and ``total_amount``; text stays."""
    raw = F.col(text)
    return df.withColumns(
        {"date": dates.receipt_date_text(raw), "total_amount": money.receipt_total(raw)}
    ).withColumn("receipt_date", dates.receipt_date(F.col("date")))

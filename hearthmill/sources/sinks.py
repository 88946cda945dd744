"""Staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.schemas import BILL_COLUMNS


def stage_bills_csv(bills: DataFrame, path: str) -> None:
    """Overwrite the staged bills: fixed columns, header even when empty."""
    (
        bills.select(*BILL_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def read_staged_bills(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("date string, subject string, total_amount double, raw_body_text string")
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("undated"))


def write_monthly(df: DataFrame, path: str, date: str, mode: str = "append") -> None:
    """Parquet table partitioned by month.

    The rebalance hint gathers a month's rows into few files and lets adaptive
    execution split a month too large for one task.
    """
    (
        df.withColumn("month", month_of(date))
        .hint("rebalance", "month")
        .write.mode(mode)
        .partitionBy("month")
        .parquet(path)
    )

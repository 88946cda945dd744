"""Discovery and scan of one-document-per-file folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discover_documents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Files of a folder that match a name pattern, in path order, unread."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", F.col("modificationTime").alias("received_ts"))
        .orderBy("path")
    )


def read_documents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Raw bytes of the same files; fails if no file matches."""
    documents = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", F.col("modificationTime").alias("received_ts"), "content")
    )
    if documents.select("path").isEmpty():
        raise FileNotFoundError(f"no file matching {pattern} in {folder}")
    return documents

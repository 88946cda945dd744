"""Bank statement CSV files of several layouts."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthmill.functions.text import strip
from hearthmill.sources import splits

FILE_COLUMN = "source_file"
BROKEN_COLUMN = "_broken_row"

# No cell can hold this, so no cell reads as null; empty cells stay "".
_NEVER = "\x00"


def header_columns(header: str) -> list[str]:
    """Column names of a header line; blank and repeated names get a number."""
    seen: dict[str, int] = defaultdict(int)
    names = []
    for place, cell in enumerate(next(csv.reader([header]))):
        name = cell.strip() or f"Unnamed: {place}"
        repeats = seen[name.lower()]
        seen[name.lower()] += 1
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


# A whole quoted cell; a quote elsewhere in a cell is a character like others.
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'


def cell_count(row: Column) -> Column:
    """Cells of a row's text: separators outside quoted cells, plus one."""
    return F.size(F.split(F.regexp_replace(row, _QUOTED, "$1"), ","))


def _leaves_open(line: Column) -> Column:
    """1 if a quoted cell goes on behind the line's end."""
    return F.regexp_replace(line, _QUOTED, "$1").rlike('(^|,)"').cast("long")


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV records as they stand in files: source_file, block, seq (their order), record.

    A quoted cell may hold line ends, which read as "\n". Files are read by as
    many tasks as they have splits.
    """
    lines = splits.read_pieces(spark, paths)
    quoted = F.contains("value", F.lit('"'))
    none = F.lit(0).cast("long")
    effects = {
        "when_closed": F.when(quoted, _leaves_open(F.col("value"))).otherwise(none),
        "when_open": F.when(quoted, _leaves_open(F.concat(F.lit('"'), "value"))).otherwise(F.lit(1).cast("long")),
        "depth_closed": none,
        "depth_open": none,
    }
    found = splits.records(lines.withColumns(effects), "\n")
    return found.select(F.col("file").alias(FILE_COLUMN), "block", "seq", F.col("text").alias("record"))


def file_headers(spark: SparkSession, paths: str | Sequence[str], records: DataFrame) -> DataFrame:
    """First record that is not blank of every file: source_file, received_ts, header, its block and seq."""
    place = F.struct("block", "seq")
    first = records.where("trim(record) <> ''").groupBy(FILE_COLUMN).agg(F.min(place).alias("at"), F.min_by("record", place).alias("header"))
    listed = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias(FILE_COLUMN), F.col("modificationTime").alias("received_ts")
    )
    header = strip(F.ltrim("header", F.lit("\ufeff")))
    return first.join(listed, FILE_COLUMN).select(FILE_COLUMN, "received_ts", header.alias("header"), "at")


def record_cells(record: Column, width: int) -> Column:
    """The first ``width`` cells of a record, null where it has fewer."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    options = {"escape": '"', "emptyValue": "", "nullValue": _NEVER, "multiLine": "true"}
    cells = F.from_csv(record, schema, options)
    return F.array(*[cells[f"c{i}"] for i in range(width)])


def read_layout(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    multi_line: bool = True,
) -> DataFrame:
    """Scan files that share one header; every cell is text, none is null.

    ``multi_line`` keeps cells with line ends whole at the price of one task
    per file; switch it off for large files without such cells.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = (
        spark.read.schema(schema.add(BROKEN_COLUMN, T.StringType()))
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", _NEVER)
        .option("columnNameOfCorruptRecord", BROKEN_COLUMN)
        # Unread columns would hide that a row has too many.
        .option("columnPruning", False)
        .csv(paths)
    )
    cells = [F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for name in columns]
    # A short row is padded; a row longer than the header cannot be placed. Of
    # the rows that do not fit, a short one has nothing in the last column.
    last_is_filled = F.coalesce(F.col(f"`{columns[-1]}`"), F.lit("")) != ""
    too_long = F.col(BROKEN_COLUMN).isNotNull() & (
        last_is_filled | (cell_count(F.col(BROKEN_COLUMN)) > len(columns))
    )
    return rows.select(
        *cells,
        F.when(too_long, F.col(BROKEN_COLUMN)).alias(BROKEN_COLUMN),
        F.col("_metadata.file_path").alias(FILE_COLUMN),
        F.col("_metadata.file_modification_time").alias("received_ts"),
    )

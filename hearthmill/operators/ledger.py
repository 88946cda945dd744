"""Bank statement layouts to one ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearthmill.functions import dates, money, text
from hearthmill.schemas import (
    LEDGER_AUDIT_COLUMNS,
    LEDGER_COLUMNS,
    LEDGER_ROW,
    SIGNED_LEDGER_HEADERS,
    SIGNED_LEDGER_MARKER,
    SPLIT_LEDGER_REQUIRED,
)
from hearthmill.sources.shared import fresh_path, settle
from hearthmill.sources.statements import (
    BROKEN_COLUMN,
    FILE_COLUMN,
    cell_count,
    file_headers,
    header_columns,
    read_records,
    record_cells,
)

PROVENANCE_COLUMNS = [FILE_COLUMN, "received_ts"]


class LayoutError(ValueError):
    """A statement lacks columns its layout must have."""


def snake_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.snake_case(name) for name in df.columns])


def _require(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [name for name in required if name not in columns]
    if missing:
        raise LayoutError(f"statement lacks columns: {missing}")
    repeated = [name for name in required if columns.count(name) > 1]
    if repeated:
        raise LayoutError(f"statement repeats columns: {repeated}")


def map_headers(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rename the mapped columns and drop the rest; ``keep`` passes through."""
    _require(df.columns, list(mapping))
    mapped = [F.col(f"`{header}`").alias(name) for header, name in mapping.items()]
    return df.select(*mapped, *[name for name in keep if name in df.columns])


def is_pending(status: Column) -> Column:
    return F.coalesce(F.lower(text.strip(status)) == "pending", F.lit(False))


def drop_pending(df: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Drop authorisations that have not settled; ``counts`` gets how many."""
    pending = is_pending(F.col("status"))
    if BROKEN_COLUMN in df.columns:  # the cells of a broken row are not where they seem
        pending &= F.col(BROKEN_COLUMN).isNull()
    if counts is not None:
        df = df.observe(counts, F.count_if(pending).alias("pending_rows"))
    return df.where(~pending)


def _finished(df: DataFrame) -> DataFrame:
    provenance = [name for name in (*PROVENANCE_COLUMNS, BROKEN_COLUMN) if name in df.columns]
    return df.withColumns(
        {
            "post_date_raw": F.col("post_date"),
            "post_date": dates.ledger_date(F.col("post_date")),
            "description": text.strip(F.col("description")),
        }
    ).select(*LEDGER_COLUMNS, *LEDGER_AUDIT_COLUMNS, *provenance)


def normalize_split(df: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Debit/credit layout to ledger rows, settled rows only."""
    rows = snake_headers(df)
    _require(rows.columns, SPLIT_LEDGER_REQUIRED)
    debit, credit = F.col("debit"), F.col("credit")
    amount = money.net_amount(debit, credit)
    readable = ~(money.unsigned_unreadable(debit) | money.unsigned_unreadable(credit))
    return _finished(
        drop_pending(rows, counts).withColumns(
            {
                "account_number": text.redact_account(F.col("account_number")),
                "amount": amount,
                "amount_raw": F.concat_ws("|", debit, credit),
                "amount_ok": readable & (F.abs(amount) < float("inf")),
            }
        )
    )


def normalize_signed(df: DataFrame, file_name: str = FILE_COLUMN) -> DataFrame:
    """Signed-amount layout to ledger rows; the file name holds the account."""
    rows = map_headers(df, SIGNED_LEDGER_HEADERS, keep=dict.fromkeys([file_name, *PROVENANCE_COLUMNS, BROKEN_COLUMN]))
    raw = F.col("amount")
    amount = money.signed_amount(raw)
    return _finished(
        rows.withColumns(
            {
                # The account is masked already, so masking again changes nothing.
                "account_number": text.account_from_file_name(F.col(file_name)),
                "status": F.lit("Cleared"),
                "check": F.lit(""),
                "amount": amount,
                "amount_raw": raw,
                "amount_ok": ~money.signed_unreadable(raw) & (F.abs(amount) < float("inf")),
            }
        )
    )


def is_signed(columns: Sequence[str]) -> bool:
    return SIGNED_LEDGER_MARKER in columns


def has_known_layout(columns: Sequence[str]) -> bool:
    try:
        if is_signed(columns):
            _require(list(columns), list(SIGNED_LEDGER_HEADERS))
        else:
            _require([text.snake_case(name) for name in columns], SPLIT_LEDGER_REQUIRED)
    except LayoutError:
        return False
    return True


def _rejected(rows: DataFrame, record: str, error: str) -> DataFrame:
    return rows.select(*PROVENANCE_COLUMNS, F.col(record).alias("record"), F.lit(error).alias("error"))


def _placed(rows: DataFrame) -> DataFrame:
    """Good and broken rows in one projection, so that a layout is scanned once."""
    broken = F.col(BROKEN_COLUMN).isNotNull()
    return rows.select(
        *[F.when(~broken, F.col(name)).alias(name) for name in (*LEDGER_COLUMNS, *LEDGER_AUDIT_COLUMNS)],
        *PROVENANCE_COLUMNS,
        F.col(BROKEN_COLUMN).alias("record"),
        F.when(broken, F.lit("more cells than the header")).alias("error"),
    )


SIGNED, SPLIT, UNKNOWN = "signed", "split", "unknown"


def _places(header: str) -> tuple[str, int, list[int]]:
    """Layout of a file's header, its number of columns, and where the layout's columns stand."""
    columns = header_columns(header)
    if not has_known_layout(columns):
        return UNKNOWN, len(columns), []
    if is_signed(columns):
        return SIGNED, len(columns), [columns.index(name) for name in SIGNED_LEDGER_HEADERS]
    names = [text.snake_case(name) for name in columns]
    return SPLIT, len(columns), [names.index(name) for name in SPLIT_LEDGER_REQUIRED]


def _layouts(header: str) -> Column:
    """_places of a column of headers, one per file."""

    @F.pandas_udf("layout string, width int, places array<int>")
    def places(headers: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_places(header) for header in headers], columns=["layout", "width", "places"])

    return places(header)


def _named(rows: DataFrame, names: Sequence[str], width: int) -> DataFrame:
    """Rows of one layout with its columns by name; a short row is padded."""
    cells = rows.withColumn("cells", record_cells(F.col("record"), width))
    own = [F.coalesce(F.get("cells", F.get("places", F.lit(i))), F.lit("")).alias(name) for i, name in enumerate(names)]
    # A row longer than the header cannot be placed.
    broken = F.when(cell_count(F.col("record")) > F.col("width"), F.col("record"))
    return cells.select(*own, broken.alias(BROKEN_COLUMN), *PROVENANCE_COLUMNS)


def read_ledger(spark: SparkSession, paths: str | Sequence[str], counts: Observation | None = None) -> DataFrame:
    """Statements of any known layout as ledger rows, or rows with an ``error``.

    Every record meets its file's header in a join, so neither the plan nor
    the driver grows with the number of files or headers. A row that does not
    fit its header, and every record of a file with an unknown layout, is kept
    in ``record``. ``counts`` gets the number of pending rows left out.
    """
    records = read_records(spark, paths)
    headers = file_headers(spark, paths, records).withColumn("found", _layouts("header"))
    headers = settle(headers.select(FILE_COLUMN, "received_ts", "at", "found.*"), "headers")
    if headers.isEmpty():
        raise FileNotFoundError(f"no statement with a header under {paths}")
    width = headers.where(F.col("layout") != UNKNOWN).agg(F.max("width")).first()[0] or 1
    rows = records.join(headers, FILE_COLUMN)
    is_row = (F.col("layout") == UNKNOWN) | ((F.struct("block", "seq") != F.col("at")) & (F.trim("record") != ""))
    folder = fresh_path(spark, "statement-rows")
    rows.where(is_row).select(*PROVENANCE_COLUMNS, "record", "width", "places", "layout").write.partitionBy("layout").parquet(folder)
    schema = f"{FILE_COLUMN} string, received_ts timestamp, record string, width int, places array<int>, layout string"
    placed = spark.read.schema(schema).parquet(folder)
    signed = _named(placed.where(F.col("layout") == SIGNED), list(SIGNED_LEDGER_HEADERS), width)
    split = _named(placed.where(F.col("layout") == SPLIT), SPLIT_LEDGER_REQUIRED, width)
    parts = [
        _placed(normalize_signed(signed)),
        _placed(normalize_split(split, counts)),
        _rejected(placed.where(F.col("layout") == UNKNOWN), "record", "unknown layout"),
    ]

    def combine(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.unionByName(right, allowMissingColumns=True)

    return reduce(combine, parts, spark.createDataFrame([], LEDGER_ROW))


def canonical(ledger: DataFrame) -> DataFrame:
    return ledger.select(*LEDGER_COLUMNS)

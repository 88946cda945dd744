"""Ledger queries: bank layouts rendered from customers and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.functions import money, text
from hearthmill.operators import ledger
from hearthmill.plans import ingest
from hearthmill.plans.baselines import MONEY
from hearthmill.queries.registry import query, table
from hearthmill.sources.shared import fresh_path


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.abs(amount), 2))


def split_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances as a debit/credit statement."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (key % 365).cast("int"))
    post_date = (
        F.when(key % 11 == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 13 == 0, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    debit = F.when(key % 2 == 0, F.concat(F.lit("("), _dollars(balance), F.lit(")"))).otherwise(
        F.format_string("-%.2f", F.abs(balance))
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("4000-"), F.lpad(key.cast("string"), 8, "0")).alias("Account Number"),
        post_date.alias("Post Date"),
        F.when(key % 5 == 0, key.cast("string")).otherwise("").alias("Check"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias(" Description "),
        F.when(balance < 0, debit).otherwise("").alias("Debit"),
        F.when(balance >= 0, _dollars(balance)).otherwise("").alias("Credit"),
        F.lit("Cleared").alias("Status"),
        F.col("c_mktsegment").alias("Branch"),
    )


_SPLIT_SQL = """
SELECT 'XXXX-' || right(lpad(c_custkey::VARCHAR, 8, '0'), 4) AS account_number,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            ELSE DATE '2026-01-01' + (c_custkey % 365)::INTEGER END AS post_date,
       CASE WHEN c_custkey % 5 = 0 THEN c_custkey::VARCHAR ELSE '' END AS "check",
       c_name AS description, c_acctbal AS amount, 'Cleared' AS status
FROM customer
"""


@query(_SPLIT_SQL)
def ledger_split_normalize(spark, sf_dir):
    """Round trip of a debit/credit statement."""
    return ledger.canonical(ledger.normalize_split(split_statement(spark, sf_dir)))


def signed_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a signed-amount statement, one file per account."""
    price, status, account = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_custkey")
    digits = F.lpad((account % 10000).cast("string"), 4, "0")
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("Sub-description"),
        F.when(status == "F", F.concat(F.lit("-"), _dollars(price)))
        .when(status == "P", F.format_string("(%.2f)", price))
        .otherwise(_dollars(price))
        .alias("Amount"),
        F.format_string("%.2f", price * 2).alias("Balance"),
        F.when(account % 10 == 0, "/in/Export_091926.csv")
        .otherwise(F.concat(F.lit("/in/Export_x12_"), digits, F.lit("_091926.csv")))
        .alias("source_file"),
    )


_SIGNED_SELECT = """
       o_orderdate::DATE AS post_date, '' AS "check", 'Order ' || o_orderkey AS description,
       CASE o_orderstatus WHEN 'F' THEN -o_totalprice WHEN 'P' THEN 0.0 ELSE o_totalprice END::DOUBLE AS amount,
       'Cleared' AS status
FROM orders
"""


@query(
    """
SELECT CASE WHEN o_custkey % 10 = 0 THEN 'XXXX-REDACTED'
            ELSE 'XXXX-' || lpad((o_custkey % 10000)::VARCHAR, 4, '0') END AS account_number,"""
    + _SIGNED_SELECT
)
def ledger_signed_normalize(spark, sf_dir):
    """Round trip of a signed-amount statement."""
    return ledger.canonical(ledger.normalize_signed(signed_statement(spark, sf_dir)))


@query(
    _SPLIT_SQL + " UNION ALL SELECT 'XXXX-REDACTED' AS account_number," + _SIGNED_SELECT
)
def ledger_union_vendors(spark, sf_dir):
    """Round trip through CSV files of both layouts and header detection."""
    folder = fresh_path(spark, "statements")
    split_statement(spark, sf_dir).write.option("header", True).csv(f"{folder}/split")
    signed_statement(spark, sf_dir).drop("source_file").write.option("header", True).csv(
        f"{folder}/signed"
    )
    rows = ledger.read_ledger(spark, [f"{folder}/split", f"{folder}/signed"])
    return ledger.canonical(rows)


@query(
    """
SELECT 'XXXX-' || right(lpad(o_custkey::VARCHAR, 6, '0'), 4) AS account_number,
       o_orderdate::DATE AS post_date, '' AS "check", o_orderkey::VARCHAR AS description,
       -o_totalprice AS amount, CASE o_orderstatus WHEN 'F' THEN 'Cleared' ELSE '' END AS status
FROM orders WHERE o_orderstatus <> 'P'
"""
)
def ledger_pending_filter(spark, sf_dir):
    """Rows not settled are dropped; any other status is kept as it is."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    pending = F.when(key % 3 == 0, " Pending ").when(key % 3 == 1, "PENDING").otherwise("\tpending\n")
    statement = table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("Account Number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Post Date"),
        F.lit("").alias("Check"),
        key.cast("string").alias("Description"),
        F.format_string("-%.2f", F.col("o_totalprice")).alias("Debit"),
        F.lit("").alias("Credit"),
        F.when(status == "P", pending).when(status == "F", "Cleared").otherwise("").alias("Status"),
    )
    return ledger.canonical(ledger.normalize_split(statement))


@query(
    """
WITH cells AS (
  SELECT c_nationkey, c_custkey % 9 AS kind, c_acctbal::DECIMAL(18,2) AS balance FROM customer)
SELECT c_nationkey, count(*) AS n_rows,
       count(*) FILTER (kind IN (1, 2)) AS n_missing,
       count(*) FILTER (kind IN (0, 3)) AS n_unreadable,
       sum(CASE WHEN kind = 4 THEN 100 WHEN kind > 4 THEN abs(balance) ELSE 0 END)::DOUBLE AS total_unsigned,
       sum(CASE WHEN kind = 4 THEN 100 WHEN kind > 4 THEN balance ELSE 0 END)::DOUBLE AS total_signed
FROM cells GROUP BY c_nationkey
"""
)
def currency_quality_counts(spark, sf_dir):
    """Missing and unreadable cells are counted, and read as zero."""
    kind, balance = F.col("c_custkey") % 9, F.col("c_acctbal")
    sign = F.when(balance < 0, "-").otherwise("")
    cell = (
        F.when(kind == 0, "N/A")
        .when(kind == 1, "  ")
        .when(kind == 2, "nan")
        .when(kind == 3, "12.5d")
        .when(kind == 4, " 1e2\t")
        .otherwise(F.concat(sign, _dollars(balance)))
    )
    cells = table(spark, sf_dir, "customer").select("c_nationkey", cell.alias("cell"))
    raw = F.col("cell")
    return cells.groupBy("c_nationkey").agg(
        F.count("*").alias("n_rows"),
        F.count_if(money.amount_missing(raw)).alias("n_missing"),
        F.count_if(money.signed_unreadable(raw)).alias("n_unreadable"),
        F.sum(money.unsigned_amount(raw).cast(MONEY)).cast("double").alias("total_unsigned"),
        F.sum(money.signed_amount(raw).cast(MONEY)).cast("double").alias("total_signed"),
    )


@query(
    """
SELECT s_suppkey,
       CASE s_suppkey % 4 WHEN 0 THEN 'XXXX-REDACTED' WHEN 1 THEN 'XXXX-' || (s_suppkey % 100)
            ELSE 'XXXX-' || right(lpad(s_suppkey::VARCHAR, 9, '0'), 4) END AS account_number,
       CASE WHEN s_suppkey % 3 = 0 THEN 'XXXX-REDACTED' ELSE 'XXXX-2026' END AS account_from_file
FROM supplier
"""
)
def account_redaction(spark, sf_dir):
    """Account masks from cells and from file names."""
    key = F.col("s_suppkey")
    padded = F.lpad(key.cast("string"), 9, "0")
    cell = (
        F.when(key % 4 == 0, "no digits")
        .when(key % 4 == 1, F.concat(F.lit("acct "), (key % 100).cast("string")))
        .otherwise(F.concat(F.substring(padded, 1, 3), F.lit("-"), F.substring(padded, 4, 6)))
    )
    name = F.when(key % 3 == 0, F.concat(F.lit("/in/a_"), padded, F.lit("_1.2.csv"))).otherwise(
        F.concat(F.lit("file:/in/a_2026_"), F.lpad((key % 10000).cast("string"), 4, "0"), F.lit(".csv"))
    )
    return table(spark, sf_dir, "supplier").select(
        key,
        text.redact_account(cell).alias("account_number"),
        text.account_from_file_name(name).alias("account_from_file"),
    )


@query(
    """
SELECT 'XXXX-' || right(lpad(c_custkey::VARCHAR, 8, '0'), 4) AS account_number,
       sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS net_flow, count(*) AS n_rows, 0::BIGINT AS n_unreadable
FROM customer GROUP BY 1
"""
)
def ledger_net_flow(spark, sf_dir):
    """Net flow per masked account of the rendered statement."""
    rows = ledger.normalize_split(split_statement(spark, sf_dir))
    return rows.groupBy("account_number").agg(
        F.sum(F.col("amount").cast(MONEY)).cast("double").alias("net_flow"),
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("amount_ok")).alias("n_unreadable"),
    )


@query(
    """
SELECT unnest(['pending', 'rows', 'unplaced', 'amount_unreadable', 'date_unreadable',
               'failed_date_ok', 'failed_amount_ok', 'failed_account_masked']) AS measure,
       unnest([count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (o_orderstatus <> 'P'), 0,
               count(*) FILTER (o_orderstatus <> 'P' AND o_orderkey % 50 = 7), count(*) FILTER (o_orderstatus <> 'P' AND o_orderkey % 70 = 9),
               count(*) FILTER (o_orderstatus <> 'P' AND o_orderkey % 70 = 9), count(*) FILTER (o_orderstatus <> 'P' AND o_orderkey % 50 = 7), 0]) AS n_rows
FROM orders
"""
)
def ledger_load_counts(spark, sf_dir):
    """What a load of statement files reports about itself."""
    key = F.col("o_orderkey")
    statement = table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("Account Number"),
        F.when(key % 70 == 9, "some day").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Post Date"),
        F.lit("").alias("Check"),
        F.concat_ws("\n", F.lit("order"), key.cast("string")).alias("Description"),
        F.when(key % 50 == 7, "abc").otherwise(F.format_string("$%.2f", F.col("o_totalprice").cast("double"))).alias("Debit"),
        F.lit("").alias("Credit"),
        F.when(F.col("o_orderstatus") == "P", " Pending").otherwise("ok").alias("Status"),
    )
    folder, tables = fresh_path(spark, "statements"), fresh_path(spark, "tables")
    statement.write.option("header", True).csv(folder)
    ingest.ingest_statements(spark, folder, tables, load="all")
    return spark.read.parquet(f"{tables}/load_log/job=statements/load=all")

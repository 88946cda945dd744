"""Receipt, bill and message queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.functions import dates, money, text
from hearthmill.operators.messages import extract_bills
from hearthmill.operators.quality import split_errors
from hearthmill.operators.receipts import extract_receipts
from hearthmill.queries.registry import query, table
from hearthmill.sources.documents import read_documents
from hearthmill.sources.shared import fresh_path
from hearthmill.sources.sinks import read_staged_bills, stage_bills_csv


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
       CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate::DATE END AS receipt_date
FROM orders
"""
)
def receipt_date_extract(spark, sf_dir):
    """Round trip of a date behind an impossible one."""
    day = F.when(
        F.col("o_orderkey") % 17 != 0, F.date_format("o_orderdate", "yyyy/M_d")
    ).otherwise("none")
    slip = F.concat(
        F.lit("STATION 0042\n2022-86-71 ref "), F.col("o_custkey"), F.lit("\nDATE "), day,
        F.lit(" 10:22\n2001-01-01\n"),
    )
    no_date = F.concat(F.lit("STATION 0042\n2022-86-71 ref "), F.col("o_custkey"))
    slips = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 17 != 0, slip).otherwise(no_date).alias("raw_ocr_text"),
    )
    return extract_receipts(slips).select("o_orderkey", "date", "receipt_date")


@query(
    """
WITH cents AS (
  SELECT *, round(l_extendedprice * 100)::BIGINT AS total FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey,
       greatest(l_quantity, l_discount,
                CASE WHEN l_linenumber % 3 = 0 THEN (total % 100000) / 100.0 ELSE total / 100.0 END
               )::DOUBLE AS total_amount
FROM cents
"""
)
def receipt_total_extract(spark, sf_dir):
    """Round trip of totals; a thousands comma cuts a receipt's figure."""
    price = F.col("l_extendedprice")
    shown = F.when(F.col("l_linenumber") % 3 == 0, F.format_number(price, 2)).otherwise(
        F.format_string("%.2f", price)
    )
    slip = F.concat(
        F.lit("PUMP 3\nLITRES "), F.format_string("%.2f", F.col("l_quantity")),
        F.lit("\nOFF "), F.format_string("%.2f", F.col("l_discount")),
        F.lit("\nT0TAL $"), shown, F.lit("\nTHANK YOU 7"),
    )
    slips = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", slip.alias("raw_ocr_text")
    )
    return extract_receipts(slips).select("l_orderkey", "l_linenumber", "l_suppkey", "total_amount")


_BILL_TOKENS = r"regexp_extract_all(text, '\d{1,3}(?:,\d{3})*\.\d{2}|\d+\.\d{2}')"


@query(
    f"""
SELECT doc_id, len({_BILL_TOKENS})::BIGINT AS n_figures,
       list_max(list_transform({_BILL_TOKENS}, lambda t: replace(t, ',', '')::DOUBLE)) AS total_amount
FROM documents
"""
)
def bill_total_extract(spark, sf_dir):
    """Largest figure of each document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(money.bill_tokens(F.col("text"))).cast("bigint").alias("n_figures"),
        money.bill_total(F.col("text")).alias("total_amount"),
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_totalprice < 500000 THEN round(o_totalprice, 2) ELSE round(o_totalprice * 3, 2) END AS total_amount
FROM orders
"""
)
def bill_total_commas(spark, sf_dir):
    """Round trip of bill totals with thousands commas."""
    price = F.col("o_totalprice")
    due = F.when(price < 500000, price).otherwise(price * 3)
    bill = F.concat(
        F.lit("Prior balance 0.01\nLine "), F.format_number(price / 10, 2),
        F.lit("\nPlease pay $"), F.format_number(due, 2), F.lit("."),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", money.bill_total(bill).alias("total_amount")
    )


def _sql_visible_text(html: str) -> str:
    patterns = [
        (r"<!--.*?(?:-->|\z)", "gs"),
        (r"<script\b[^>]*>.*?(?:</script\s*>|\z)", "gsi"),
        (r"<style\b[^>]*>.*?(?:</style\s*>|\z)", "gsi"),
        (r"<template\b[^>]*>.*?(?:</template\s*>|\z)", "gsi"),
        ("<[!?][^>]*>", "gs"),
        (r"""</?[A-Za-z](?:"[^"]*"|''[^'']*''|[^''">])*>""", "gs"),
    ]
    for pattern, flags in patterns:
        html = f"regexp_replace({html}, '{pattern}', chr(1), '{flags}')"
    for entity, plain in text.HTML_ENTITIES.items():
        html = rf"regexp_replace({html}, '&{entity}(?:;|\b)', chr({ord(plain)}), 'g')"
    blanks = " || ".join(f"chr({ord(c)})" for c in text.WHITESPACE)
    return (
        f"array_to_string(list_filter(list_transform(string_split({html}, chr(1)), "
        f"lambda n: trim(n, {blanks})), lambda n: n <> ''), chr(10))"
    )


@query(f"SELECT page_id, {_sql_visible_text('html')} AS visible_text FROM pages")
def html_visible_text(spark, sf_dir):
    """Visible text of every page, by column expressions."""
    return table(spark, sf_dir, "pages").select(
        "page_id", text.html_visible_text(F.col("html")).alias("visible_text")
    )


_TEXT_MAIL, _BROKEN_MAIL = 4, 9


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages wrapped as e-mail files: HTML bodies, plain twins, broken files."""
    key = F.col("page_id")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (key % 365).cast("int"))
    head = F.concat(
        F.lit("From: billing@example.com\r\nSubject: "),
        F.when(
            key % 5 == 0, F.concat(F.lit("=?utf-8?B?"), F.base64(F.encode(F.concat(F.lit("Reçu "), key), "utf-8")), F.lit("?="))
        ).otherwise(F.concat(F.lit("  Statement "), key, F.lit(" "))),
        F.when(
            key % 7 != 0,
            F.concat(F.lit("\r\nDate: "), F.date_format(day, "EEE, d MMM yyyy"), F.lit(" 23:59:00 -0600")),
        ).otherwise("\r\nDate: soon"),
        F.lit("\r\nMIME-Version: 1.0\r\n"),
    )
    html_part = F.concat(
        F.lit("Content-Type: text/html; charset=\"utf-8\"\r\nContent-Transfer-Encoding: 8bit\r\n\r\n"),
        F.col("html"),
    )
    total = F.format_number((key * 1234.5).cast("double"), 2)
    plain_part = F.concat(
        F.lit("Content-Type: text/plain; charset=no-such-charset\r\n\r\nTotal due $"), total
    )
    twin = F.concat(
        F.lit("Content-Type: multipart/alternative; boundary=\"edge\"\r\n\r\n--edge\r\n"), html_part,
        F.lit("\r\n--edge\r\n"), plain_part, F.lit("\r\n--edge--\r\n"),
    )
    mail = F.concat(head, F.when(key % _TEXT_MAIL == 0, twin).otherwise(html_part))
    broken = F.concat(F.lit("\x01 no headers here "), key)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.encode(F.when(key % _BROKEN_MAIL == 0, broken).otherwise(mail), "utf-8").alias("content"),
    )


_MESSAGE_SQL = f"""
WITH visible AS (SELECT page_id, {_sql_visible_text('html')} AS t FROM pages),
bodies AS (
  SELECT page_id, page_id % {_BROKEN_MAIL} = 0 AS broken, page_id % {_TEXT_MAIL} = 0 AS plain, t AS text FROM visible)
SELECT page_id,
       CASE WHEN NOT broken AND page_id % 7 <> 0
            THEN strftime(DATE '2026-01-01' + (page_id % 365)::INTEGER, '%Y-%m-%d') END AS date,
       CASE WHEN broken THEN NULL WHEN page_id % 5 = 0 THEN 'Reçu ' || page_id ELSE 'Statement ' || page_id END AS subject,
       CASE WHEN broken THEN NULL WHEN plain THEN round(page_id * 1234.5, 2)::DOUBLE
            ELSE list_max(list_transform({_BILL_TOKENS}, lambda t: replace(t, ',', '')::DOUBLE)) END AS total_amount,
       CASE WHEN broken OR plain THEN NULL ELSE text END AS html_text,
       broken AS rejected
FROM bodies
"""


@query(_MESSAGE_SQL)
def email_extract(spark, sf_dir):
    """One bill per message, unreadable messages marked."""
    plain = F.col("page_id") % _TEXT_MAIL == 0
    return extract_bills(page_messages(spark, sf_dir)).select(
        "page_id", "date", "subject", "total_amount",
        F.when(~plain, F.col("raw_body_text")).alias("html_text"),
        F.col("error").isNotNull().alias("rejected"),
    )


@query(
    f"""
WITH found AS ({_MESSAGE_SQL})
SELECT CASE WHEN NOT rejected THEN page_id END AS page_id, date, subject, total_amount, html_text, rejected
FROM found
"""
)
def email_corpus_scan(spark, sf_dir):
    """The same messages as one file each: discovery, scan and extraction."""
    folder = fresh_path(spark, "inbox")
    mails = page_messages(spark, sf_dir).select("page_id", F.decode("content", "utf-8").alias("value"))
    # One file per message: creating the files is the work, so it is spread.
    mails.repartition(64, "page_id").select("value").write.option("maxRecordsPerFile", 1).text(folder)
    page = F.regexp_extract("subject", r"(\d+)$", 1).try_cast("bigint")
    plain = page % _TEXT_MAIL == 0
    return extract_bills(read_documents(spark, folder, "*.txt")).select(
        page.alias("page_id"), "date", "subject", "total_amount",
        F.when(~plain, F.col("raw_body_text")).alias("html_text"),
        F.col("error").isNotNull().alias("rejected"),
    )


@query(
    f"""
WITH found AS ({_MESSAGE_SQL})
SELECT date, count(*) AS n_bills, count(total_amount) AS n_totals,
       sum(total_amount::DECIMAL(18,2))::DOUBLE AS total_amount
FROM found WHERE NOT rejected GROUP BY date
"""
)
def staged_bills(spark, sf_dir):
    """Bills through the staging CSV and back, summed per day."""
    path = fresh_path(spark, "staged-bills")
    bills, _ = split_errors(extract_bills(page_messages(spark, sf_dir)))
    stage_bills_csv(bills, path)
    return read_staged_bills(spark, path).groupBy("date").agg(
        F.count("*").alias("n_bills"),
        F.count("total_amount").alias("n_totals"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("total_amount"),
    )


@query("SELECT o_orderkey, o_orderdate::DATE AS message_date FROM orders")
def message_date_extract(spark, sf_dir):
    """Round trip of message dates; the header's own offset decides the day."""
    header = F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy"), F.lit(" 23:59:59 -0600"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.message_date(header).alias("message_date")
    )


@query(
    r"""
SELECT doc_id,
       regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g'),
                      '\d{7,}', '[NUMBER]', 'g') AS safe_text
FROM documents
"""
)
def pii_mask(spark, sf_dir):
    """Masked copy of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.mask_personal_data(F.col("text")).alias("safe_text")
    )

"""Keys, duplicates, timeliness and the validation gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.functions import dates, money
from hearthmill.operators import quality, vendors
from hearthmill.queries.registry import query, table

_UUID_SQL = (
    "concat_ws('-', substr(d, 1, 8), substr(d, 9, 4), substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12))"
)


@query(
    f"""
WITH numbered AS (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS occurrence
  FROM lineitem),
digests AS (
  SELECT *, sha256(concat_ws('|', l_orderkey, l_linenumber, occurrence)) AS d FROM numbered)
SELECT {_UUID_SQL} AS transaction_id, l_orderkey, l_linenumber, occurrence FROM digests
"""
)
def record_key(spark, sf_dir):
    """Keys that keep genuine repeats of a natural key apart."""
    keyed = quality.with_record_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return keyed.select("transaction_id", "l_orderkey", "l_linenumber", "occurrence")


@query(
    f"""
WITH digests AS (
  SELECT event_id, sha256(concat_ws('|', event_id, user_id, event_type)) AS d FROM events)
SELECT event_id, {_UUID_SQL} AS log_id FROM digests
"""
)
def record_key_events(spark, sf_dir):
    """Keys where the natural key is unique already."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        quality.key_uuid([F.col("event_id"), F.col("user_id"), F.col("event_type")]).alias("log_id"),
    )


_FIRST = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    f"""
SELECT l_orderkey, l_linenumber, {_FIRST} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_FIRST}) = 1
"""
)
def dedup_first(spark, sf_dir):
    """First row per key, as a repeated ingest would keep it."""
    order = _FIRST.split(", ")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    return quality.keep_first(rows, ["l_orderkey", "l_linenumber"], order)


@query(
    """
SELECT o_orderdate::DATE AS day, count(*) AS n_rows,
       count(*) FILTER (l_shipdate <= o_orderdate + INTERVAL 48 HOUR) AS n_timely,
       count(*) FILTER (l_shipdate <= o_orderdate + INTERVAL 48 HOUR)::DOUBLE / count(*) AS timely_share
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
"""
)
def timeliness_48h(spark, sf_dir):
    """Daily share of lines shipped within 48 hours of the order."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_shipdate")
        .agg(F.count("*").alias("weight"))
    )
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    judged = shipped.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("o_orderdate").alias("day"),
        "weight",
        quality.is_timely(F.col("o_orderdate"), F.col("l_shipdate")).alias("timely"),
    )
    return quality.timely_rate(judged, ["day"])


_RULES = ["date_ok", "amount_ok", "key_unique", "account_masked", "vendor_known", "on_time"]


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ledger rows, some of them faulty, with failed rules."""
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.when(part % 20 == 0, F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(day).alias("post_date"),
        F.when(supplier % 15 == 0, "n/a").otherwise(F.format_string("$%.2f", F.col("l_extendedprice"))).alias("amount"),
        F.when(part % 50 == 1, F.lpad(part.cast("string"), 8, "4"))
        .otherwise(F.concat(F.lit("XXXX-"), F.lpad((part % 10000).cast("string"), 4, "0")))
        .alias("account_number"),
        F.when(supplier % 7 == 0, "corner shop").otherwise("AMZN Mktp US*HT45").alias("description"),
    )
    counted = quality.with_key_count(lines, ["l_orderkey", "l_linenumber"])
    received = F.date_trunc("day", "l_shipdate") - F.make_dt_interval(days=F.col("l_linenumber") % 4)
    return quality.apply_rules(
        counted,
        {
            "date_ok": dates.ledger_date(F.col("post_date")).isNotNull(),
            "amount_ok": ~money.signed_unreadable(F.col("amount")),
            "key_unique": F.col("key_rows") == 1,
            "account_masked": F.col("account_number").rlike(r"^XXXX-\d{1,4}$"),
            "vendor_known": vendors.matched_vendor(F.col("description")).isNotNull(),
            "on_time": quality.is_timely(received, F.col("l_shipdate")),
        },
    )


_CHECKED_SQL = """
WITH counted AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_rows FROM lineitem),
checked AS (
  SELECT l_orderkey, l_linenumber,
         l_partkey % 20 = 0 AS date_ok, l_suppkey % 15 = 0 AS amount_ok, key_rows > 1 AS key_unique,
         l_partkey % 50 = 1 AS account_masked, l_suppkey % 7 = 0 AS vendor_known,
         l_shipdate > date_trunc('day', l_shipdate) - to_days((l_linenumber % 4)::INTEGER) + INTERVAL 48 HOUR AS on_time
  FROM counted)
"""
_FAILED_SQL = "concat_ws(','," + ",".join(f" CASE WHEN {rule} THEN '{rule}' END" for rule in _RULES) + ")"


@query(f"{_CHECKED_SQL} SELECT {_FAILED_SQL} AS failed_rules, count(*) AS n_rows FROM checked GROUP BY 1")
def validation_gate(spark, sf_dir):
    """Rows per set of failed rules; no failed rule means loaded."""
    reasons = F.concat_ws(",", "failed_rules").alias("failed_rules")
    return checked_lines(spark, sf_dir).groupBy(reasons).agg(F.count("*").alias("n_rows"))


@query(
    _CHECKED_SQL
    + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS n_rows, count(*) FILTER ({rule}) AS n_failed FROM checked"
        for rule in _RULES
    )
)
def validation_summary(spark, sf_dir):
    """Failures per rule."""
    return quality.gate_summary(checked_lines(spark, sf_dir), _RULES)


@query(
    """
SELECT p_partkey,
       CASE p_partkey % 7 WHEN 0 THEN 'Amazon' WHEN 1 THEN 'Amazon' WHEN 2 THEN 'Amazon' WHEN 3 THEN 'Shell'
            WHEN 4 THEN 'Utilities' ELSE upper(p_name) END AS vendor_normalized,
       CASE p_partkey % 7 WHEN 0 THEN 'Shopping' WHEN 1 THEN 'Shopping' WHEN 2 THEN 'Shopping' WHEN 3 THEN 'Fuel'
            WHEN 4 THEN 'Utilities' ELSE 'Uncategorized' END AS category
FROM part
"""
)
def vendor_normalize(spark, sf_dir):
    """Round trip of spellings; unknown vendors keep their cleaned name."""
    key, name = F.col("p_partkey"), F.col("p_name")
    number = key.cast("string")
    description = (
        F.when(key % 7 == 0, F.concat(F.lit("AMZN Mktp US*"), number))
        .when(key % 7 == 1, F.concat(F.lit("Amazon.com*"), number))
        .when(key % 7 == 2, F.concat(name, F.lit(" amzn shell")))
        .when(key % 7 == 3, F.concat(F.lit("SHELL OIL "), number))
        .when(key % 7 == 4, F.concat(F.lit("CITY UTIL "), number))
        .otherwise(F.concat(F.lit(" "), name, F.lit("  #"), number, F.lit("\t")))
    )
    named = table(spark, sf_dir, "part").select(
        key, vendors.normalized_vendor(description).alias("vendor_normalized")
    )
    return named.withColumn("category", vendors.vendor_category(F.col("vendor_normalized")))


@query(
    """
SELECT CASE WHEN l_partkey % 5 = 0 THEN 'CASH' ELSE s_name END AS vendor_normalized, count(*) AS n_rows
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1
"""
)
def vendor_rules_table(spark, sf_dir):
    """Rows per vendor, one rule per supplier and one that catches less."""
    supplier = table(spark, sf_dir, "supplier")
    own = supplier.select(
        F.col("s_suppkey").alias("priority"), F.lower("s_name").alias("needle"),
        F.concat(F.lit(r"(?i)\b"), F.col("s_name"), F.lit(r"\b")).alias("pattern"), F.col("s_name").alias("vendor"),
    )
    late = supplier.select(
        F.lit(10**9).cast(own.schema["priority"].dataType).alias("priority"), F.lit("purchase").alias("needle"), F.lit("(?i)purchase").alias("pattern"), F.lit("any").alias("vendor")
    )
    sold = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    bought = F.concat(F.lit("POS purchase "), F.upper("s_name"), F.lit(" #"), F.col("l_linenumber").cast("string"))
    rows = sold.select(F.when(F.col("l_partkey") % 5 == 0, F.lit("cash #12")).otherwise(bought).alias("description"))
    named = vendors.join_rules(rows, own.union(late.distinct()))
    name = F.coalesce("vendor_matched", vendors.cleaned_name(F.col("description")))
    return named.groupBy(name.alias("vendor_normalized")).agg(F.count("*").alias("n_rows"))


@query(
    """
WITH categories AS (
  SELECT p_brand AS vendor, max(p_type) AS category FROM part WHERE p_brand NOT LIKE '%5' GROUP BY 1)
SELECT coalesce(category, 'Uncategorized') AS category, count(*) AS n_rows,
       sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS spend
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN categories ON p_brand = vendor
GROUP BY 1
"""
)
def vendor_categorize(spark, sf_dir):
    """Spend per category, the category looked up by vendor."""
    parts = table(spark, sf_dir, "part")
    categories = (
        parts.where(~F.col("p_brand").endswith("5"))
        .groupBy(F.col("p_brand").alias("vendor"))
        .agg(F.max("p_type").alias("category"))
    )
    spend = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    )
    bought = spend.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    by_vendor = bought.groupBy(F.col("p_brand").alias("vendor_normalized")).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")
    )
    return (
        vendors.join_categories(by_vendor, categories)
        .groupBy("category")
        .agg(F.sum("n").alias("n_rows"), F.sum("s").cast("double").alias("spend"))
    )

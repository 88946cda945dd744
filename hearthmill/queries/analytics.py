"""Baselines, cash flow, upkeep and figures per department."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.plans import baselines, cash, kpis, upkeep
from hearthmill.plans.baselines import MONEY
from hearthmill.queries.registry import query, table


@query(
    """
SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS month,
       round(median(o_totalprice), 4) AS median_value,
       sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean_value, count(*) AS n_values
FROM orders GROUP BY 1, 2
"""
)
def baseline_median_mean(spark, sf_dir):
    """Median and mean per category and month."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.trunc("o_orderdate", "MM").alias("month"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )
    return baselines.baseline(rows, ["o_orderpriority", "month"], "price").withColumn(
        "median_value", F.round("median_value", 4)
    )


@query(
    """
WITH medians AS (SELECT event_type, median(value) AS m FROM events GROUP BY 1),
limits AS (
  SELECT e.event_type, any_value(m) AS m, median(abs(value - m)) AS mad
  FROM events e JOIN medians USING (event_type) GROUP BY 1)
SELECT event_id, event_type, value, round(m, 4) AS median_value, round(mad, 4) AS mad_value
FROM events JOIN limits USING (event_type) WHERE abs(value - m) > 3 * 1.4826 * mad
"""
)
def anomaly_mad(spark, sf_dir):
    """Events far from their type's median."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("value").cast(MONEY).alias("exact")
    )
    found = baselines.anomalies(rows, ["event_type"], "exact").drop("exact")
    return found.withColumns(
        {"median_value": F.round("median_value", 4), "mad_value": F.round("mad_value", 4)}
    )


def signed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cash movements: F is money out, the rest money in."""
    amount = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", amount.alias("amount")
    )


_SIGNED_SQL = """
signed AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority,
         (CASE o_orderstatus WHEN 'F' THEN -o_totalprice ELSE o_totalprice END)::DECIMAL(18,2) AS amount
  FROM orders)"""
_MONTHLY_SQL = f"""
WITH {_SIGNED_SQL},
monthly AS (
  SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS month, sum(amount) AS net_flow
  FROM signed GROUP BY 1, 2),
indexed AS (SELECT *, (year(month) * 12 + month(month))::BIGINT AS m FROM monthly)
"""


@query(
    f"""
WITH {_SIGNED_SQL}
SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, sum(amount)::DOUBLE AS net_flow,
       sum(CASE WHEN amount > 0 THEN amount ELSE 0 END)::DOUBLE AS inflow,
       sum(CASE WHEN amount < 0 THEN amount ELSE 0 END)::DOUBLE AS outflow, count(*) AS n_rows,
       count(*) - count(amount) AS n_left_out
FROM signed GROUP BY 1, 2
"""
)
def cash_monthly(spark, sf_dir):
    """Net flow per account and month."""
    return cash.monthly_flow(signed_orders(spark, sf_dir), ["o_custkey"], "o_orderdate", "amount")


@query(
    f"""
WITH {_SIGNED_SQL}
SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day, amount::DOUBLE AS amount,
       (sum(amount) OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey
                          ROWS UNBOUNDED PRECEDING))::DOUBLE AS balance
FROM signed
"""
)
def cash_running(spark, sf_dir):
    """Balance of each account after each movement."""
    moves = signed_orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "amount"
    )
    return cash.running_balance(moves, ["o_custkey"], "day", "o_orderkey", "amount").withColumn(
        "balance", F.col("balance").cast("double")
    )


def _monthly_priority(spark, sf_dir):
    moves = signed_orders(spark, sf_dir)
    return cash.monthly_flow(moves, ["o_orderpriority"], "o_orderdate", "amount").select(
        "o_orderpriority", "month", "net_flow"
    )


@query(
    f"""{_MONTHLY_SQL}
SELECT o_orderpriority, month, net_flow::DOUBLE AS net_flow, count(*) OVER w AS months_used,
       (sum(net_flow) OVER w)::DOUBLE / nullif(count(*) OVER w, 0) AS forecast_mean,
       round(median(net_flow::DOUBLE) OVER w, 3) AS forecast_median
FROM indexed
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY m RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)
"""
)
def cash_forecast(spark, sf_dir):
    """Forecast from the three months before."""
    return cash.forecast(_monthly_priority(spark, sf_dir), ["o_orderpriority"], "net_flow").withColumn(
        "forecast_median", F.round("forecast_median", 3)
    )


@query(
    f"""{_MONTHLY_SQL}
SELECT o_orderpriority, month, net_flow::DOUBLE AS net_flow,
       (net_flow - max(net_flow) OVER (PARTITION BY o_orderpriority ORDER BY m
                                       RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING))::DOUBLE AS change_mom,
       (net_flow - max(net_flow) OVER (PARTITION BY o_orderpriority ORDER BY m
                                       RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING))::DOUBLE AS change_yoy
FROM indexed
"""
)
def trend_mom(spark, sf_dir):
    """Change against last month and last year."""
    return cash.trend(_monthly_priority(spark, sf_dir), ["o_orderpriority"], "net_flow")


@query(
    """
WITH days AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders),
gaps AS (SELECT *, day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS gap FROM days),
assets AS (
  SELECT o_custkey, max(day) AS last_service, count(*) AS n_services, median(gap)::DOUBLE AS median_interval
  FROM gaps GROUP BY 1)
SELECT *, last_service + round(median_interval)::INTEGER AS next_service_due FROM assets
"""
)
def service_due(spark, sf_dir):
    """Next service of each customer as an asset."""
    return upkeep.service_due(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


_SCALE = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query(
    """
SELECT o_orderpriority, (6 - left(o_orderpriority, 1)::INTEGER) AS priority_rank,
       left(o_orderpriority, 1)::INTEGER <= 3 AS is_pressing, count(*) AS n_rows
FROM orders GROUP BY ALL ORDER BY priority_rank
"""
)
def priority_rank(spark, sf_dir):
    """Orders per priority, in the order of the scale."""
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            priority,
            upkeep.priority_rank(priority, _SCALE).alias("priority_rank"),
            upkeep.at_least(priority, "3-MEDIUM", _SCALE).alias("is_pressing"),
        )
        .agg(F.count("*").alias("n_rows"))
        .orderBy("priority_rank")
    )


@query(
    """
WITH monthly AS (
  SELECT 'procurement' AS department, date_trunc('month', o_orderdate)::DATE AS month, 'spend' AS kpi,
         sum(o_totalprice::DECIMAL(28,2)) AS value FROM orders GROUP BY 2
  UNION ALL SELECT 'procurement', date_trunc('month', o_orderdate)::DATE, 'records', count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'fleet', date_trunc('month', l_shipdate)::DATE, 'spend', sum(l_extendedprice::DECIMAL(28,2))
            FROM lineitem GROUP BY 2
  UNION ALL SELECT 'fleet', date_trunc('month', l_shipdate)::DATE, 'records', count(*) FROM lineitem GROUP BY 2
  UNION ALL SELECT 'infrastructure', date_trunc('month', ts)::DATE, 'records', count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'infrastructure', date_trunc('month', ts)::DATE, 'bad_samples',
            count(*) FILTER (event_type = 'error') FROM events GROUP BY 2
  UNION ALL SELECT 'facilities', NULL, 'records', count(*) FROM documents)
SELECT kpi, department, month, sum(value)::DOUBLE AS value,
       CASE WHEN grouping(department) = 1 THEN 'all' WHEN grouping(month) = 1 THEN 'department' ELSE 'month' END AS level
FROM monthly GROUP BY GROUPING SETS ((kpi, department, month), (kpi, department), (kpi))
"""
)
def kpi_rollup(spark, sf_dir):
    """Monthly figures of four departments with totals."""
    money = {"spend": F.sum(F.col("amount").cast(MONEY)), "records": F.count("*")}
    orders = table(spark, sf_dir, "orders").withColumn("amount", F.col("o_totalprice"))
    lines = table(spark, sf_dir, "lineitem").withColumn("amount", F.col("l_extendedprice"))
    probes = {"records": F.count("*"), "bad_samples": F.count_if(F.col("event_type") == "error")}
    return kpis.kpi_table(
        [
            kpis.department_kpis(orders, "procurement", F.col("o_orderdate"), money),
            kpis.department_kpis(lines, "fleet", F.col("l_shipdate"), money),
            kpis.department_kpis(table(spark, sf_dir, "events"), "infrastructure", F.col("ts"), probes),
            kpis.department_kpis(
                table(spark, sf_dir, "documents"), "facilities", F.lit(None).cast("date"),
                {"records": F.count("*")},
            ),
        ]
    )

"""One long table of departmental figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.functions.dates import month_start
from hearthmill.plans.baselines import exact


def department_kpis(df: DataFrame, department: str, date: Column, figures: dict[str, Column]) -> DataFrame:
    """Monthly figures of one department as (department, month, kpi, value).

    The figures must add up over months, because totals are built from them;
    they keep ten decimals.
    """
    monthly = df.groupBy(month_start(date).alias("month")).agg(
        *[exact(figure).alias(name) for name, figure in figures.items()]
    )
    return monthly.unpivot("month", list(figures), "kpi", "value").select(
        F.lit(department).alias("department"), "month", "kpi", "value"
    )


def kpi_table(departments: Sequence[DataFrame]) -> DataFrame:
    """All departments by month, with totals per department and per figure.

    ``level`` tells a row of a month from a total; totals have null marks.
    """
    monthly = reduce(DataFrame.unionByName, departments)
    sets = [["kpi", "department", "month"], ["kpi", "department"], ["kpi"]]
    level = F.when(F.grouping("department") == 1, "all").when(F.grouping("month") == 1, "department")
    return (
        monthly.groupingSets(sets, "kpi", "department", "month")
        .agg(F.sum("value").cast("double").alias("value"), level.alias("_total"))
        .withColumn("level", F.coalesce("_total", F.lit("month")))
        .drop("_total")
    )

"""Dashboard queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a chart shows, rows that any result is cut at.
CHART_ROWS, RESULT_ROWS = 50, 5000
CRITICAL_HOURS = 240.0


def at_facilities(df: DataFrame, facilities: list[str] | None = None) -> DataFrame:
    return df.where(F.col("facility").isin(facilities)) if facilities else df


def capped(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order).limit(RESULT_ROWS)


def inventory(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("facility", "dwell_bucket").agg(F.sum("container_count").alias("containers"))


def inventory_wide(metrics: DataFrame, buckets: list[str]) -> DataFrame:
    """One column per dwell class; the classes are given, so no job has to find them."""
    return metrics.groupBy("facility").pivot("dwell_bucket", buckets).agg(F.sum("container_count"))


def backlog(metrics: DataFrame) -> DataFrame:
    total = metrics.groupBy("backlog_type", "facility").agg(F.sum("backlog_count").alias("backlog"))
    return total.orderBy(F.desc("backlog"), "backlog_type", "facility").limit(CHART_ROWS)


def critical(open_cycles: DataFrame, hours: float = CRITICAL_HOURS) -> DataFrame:
    rows = open_cycles.where(F.col("current_dwell_hours") > hours).select("container_no_norm", "facility", "gate_in_time", "current_dwell_hours")
    return capped(rows, F.desc("current_dwell_hours"), "container_no_norm", "facility")


def ticker(status: DataFrame) -> DataFrame:
    rows = status.select("container_no_norm", "event_time_parsed", "event_type_norm", "facility", "last_location")
    return rows.orderBy(F.desc("event_time_parsed"), "container_no_norm").limit(CHART_ROWS)


def shift_productivity(kpis: DataFrame) -> DataFrame:
    rows = kpis.where(F.col("kpi_type").isin("SHIFT_GATE_IN", "SHIFT_YARD_MOVES"))
    return rows.groupBy("operational_date", "shift_id").agg(F.sum("value").alias("moves"))


def throughput_trend(kpis: DataFrame) -> DataFrame:
    return kpis.where("kpi_type = 'DAILY_THROUGHPUT'").groupBy("day_ts").agg(F.sum("value").alias("cycles"))


def dwell_trend(kpis: DataFrame) -> DataFrame:
    return kpis.where("kpi_type = 'DAILY_THROUGHPUT'").groupBy("day_ts").agg(F.avg("metric1").alias("avg_dwell"), F.avg("metric3").alias("p95_dwell"))


def heatmap(peaks: DataFrame) -> DataFrame:
    """The share is of the whole map, which has at most 168 cells."""
    cells = peaks.groupBy("day_name", "hour_of_day").agg(F.sum("avg_activity").alias("activity"))
    return cells.withColumn("share", F.col("activity") / F.sum("activity").over(Window.partitionBy()))


def facility_share(peaks: DataFrame) -> DataFrame:
    """One row per facility, so the total is over a handful of rows."""
    rows = peaks.groupBy("facility").agg(F.sum("total_activity").alias("activity"))
    return rows.withColumn("share", F.col("activity") / F.sum("activity").over(Window.partitionBy()))


def cards(inventory_metrics: DataFrame, backlog_metrics: DataFrame, kpis: DataFrame) -> DataFrame:
    """card, value: containers in the yard, work waiting, and the rolling throughput of the last day over facilities."""
    yard = inventory_metrics.agg(F.lit("total_in_yard").alias("card"), F.sum("container_count").cast("double").alias("value"))
    waiting = backlog_metrics.agg(F.lit("total_backlog").alias("card"), F.sum("backlog_count").cast("double").alias("value"))
    days = kpis.where("kpi_type = 'DAILY_THROUGHPUT'").groupBy("day_ts").agg(F.sum("rolling_7d_avg_throughput").alias("v"))
    trend = days.agg(F.lit("rolling_throughput").alias("card"), F.max_by("v", "day_ts").alias("value"))
    return yard.union(waiting).union(trend)

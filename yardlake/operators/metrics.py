"""Inventory by dwell class, work backlog and long stays, all as of a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardlake.operators.cycles import dwell_hours
from yardlake.schemas import IN_TYPES

#: Upper bounds in days and names of the dwell classes.
CLASSES = [(5, "SHORT_0_5D"), (12, "MEDIUM_6_12D"), (20, "LONG_13_20D")]
BEYOND = "CRITICAL_GT20D"
LONG_DAYS = 20


def dwell_class(hours: Column) -> Column:
    out = F.lit(BEYOND)
    for days, name in reversed(CLASSES):
        out = F.when(hours <= days * 24.0, name).otherwise(out)
    return F.when(hours.isNotNull(), out)


def open_dwell(cycles: DataFrame, as_of: Column) -> DataFrame:
    """Open cycles that have begun, with their dwell so far."""
    rows = cycles.where((F.col("cycle_status") == "OPEN") & (F.col("gate_in_time") <= as_of))
    return rows.withColumn("current_dwell_hours", dwell_hours(F.col("gate_in_time"), as_of))


def inventory_by_dwell(cycles: DataFrame, as_of: Column) -> DataFrame:
    hours = F.col("current_dwell_hours")
    by = open_dwell(cycles, as_of).withColumn("dwell_bucket", dwell_class(hours)).groupBy("facility", "dwell_bucket")
    totals = by.agg(F.count(F.lit(1)).alias("container_count"), F.max(hours).alias("max_dwell_hours"), F.min(hours).alias("min_dwell_hours"))
    return totals.withColumn("metric_type", F.lit("INVENTORY_BY_DWELL"))


def inventory_of_entries(entries: DataFrame, as_of: Column) -> DataFrame:
    """inventory_by_dwell() from the counts of open cycles: facility, gate_in_time, n."""
    hours = F.col("current_dwell_hours")
    rows = entries.where(F.col("gate_in_time") <= as_of).withColumn("current_dwell_hours", dwell_hours(F.col("gate_in_time"), as_of))
    by = rows.withColumn("dwell_bucket", dwell_class(hours)).groupBy("facility", "dwell_bucket")
    totals = by.agg(F.sum("n").alias("container_count"), F.max(hours).alias("max_dwell_hours"), F.min(hours).alias("min_dwell_hours"))
    return totals.withColumn("metric_type", F.lit("INVENTORY_BY_DWELL"))


def backlog_type(row: str | None = None) -> Column:
    """The first case that holds; null: no work is waiting. row: a struct that has the columns of a status."""
    of = lambda c: F.col(row)[c] if row else F.col(c)
    severity, stage, cleaning = (of(c) for c in ("last_inspection_severity", "last_repair_stage", "last_cleaning_type"))
    return (
        F.when(severity.isNotNull() & stage.isNull(), "WAITING_REPAIR")
        .when(stage.isNotNull() & cleaning.isNull(), "WAITING_CLEANING")
        .when(of("event_type_norm").isin(IN_TYPES) & severity.isNull(), "WAITING_INSPECTION")
    )


def backlog(status: DataFrame) -> DataFrame:
    rows = status.withColumn("backlog_type", backlog_type()).where("backlog_type is not null and facility is not null")
    return rows.groupBy("facility", "backlog_type").agg(F.count(F.lit(1)).alias("backlog_count"))


def long_dwell(cycles: DataFrame, as_of: Column, days: int = LONG_DAYS) -> DataFrame:
    rows = open_dwell(cycles, as_of).where(F.col("current_dwell_hours") > days * 24.0)
    return rows.select("container_no_norm", "facility", "gate_in_time", "gate_in_truck", F.round((F.unix_timestamp(as_of) - F.unix_timestamp("gate_in_time")) / F.lit(86400.0), 1).alias("current_dwell_days"))

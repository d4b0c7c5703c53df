"""Gate-in / gate-out cycles.

An OUT belongs to the latest IN at or before it of the same container and facility; the earliest OUT of an IN closes the
cycle. Both sides are sorted once by time and the last IN is carried forward, so the work is linear in the events, where
a join on `in <= out` would pair every IN with every later OUT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardlake.functions import clean
from yardlake.schemas import IN_TYPES, OUT_TYPES

KEY = ["container_no_norm", "facility"]


def opened(gate: DataFrame) -> DataFrame:
    """One OPEN cycle per (container, facility, time) of an IN; of repeated INs the least truck stays."""
    rows = gate.where(F.col("event_type_norm").isin(IN_TYPES) & F.col("facility").isNotNull())
    return rows.groupBy(*KEY, F.col("event_time_parsed").alias("gate_in_time")).agg(F.min("truck").alias("gate_in_truck")).withColumn("cycle_id", clean.cycle_id("container_no_norm", "gate_in_time", "facility"))


def dwell_hours(start: Column, end: Column) -> Column:
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0), 2)


def carried(gate: DataFrame) -> DataFrame:
    """INs and OUTs with the time of the latest IN at or before them; OUTs without any are left out. One shuffle and one
    sort; what is grouped by the key and that time afterwards moves no more."""
    rows = gate.where(F.col("event_type_norm").isin(IN_TYPES + OUT_TYPES) & F.col("facility").isNotNull())
    side = rows.select(*KEY, F.col("event_time_parsed").alias("t"), F.col("event_type_norm").isin(OUT_TYPES).cast("int").alias("out"), "truck")
    order = Window.partitionBy(*KEY).orderBy("t", "out").rowsBetween(Window.unboundedPreceding, 0)
    last_in = F.last(F.when(F.col("out") == 0, F.col("t")), ignorenulls=True).over(order)
    return side.withColumn("gate_in_time", last_in).where("gate_in_time is not null")


FIRST_OUT = "min(case when out = 1 then struct(t, truck) end)"


def matched(gate: DataFrame) -> DataFrame:
    """container_no_norm, facility, gate_in_time, gate_out_time, gate_out_truck of every closed cycle."""
    outs = carried(gate).where("out = 1").groupBy(*KEY, "gate_in_time").agg(F.expr(FIRST_OUT).alias("first"))
    return outs.select(*KEY, "gate_in_time", F.col("first.t").alias("gate_out_time"), F.col("first.truck").alias("gate_out_truck"))


def cycles(gate: DataFrame) -> DataFrame:
    """All cycles of cleaned gate events, without updated_at: opened() and matched() in one pass."""
    first_in = F.min(F.when(F.col("out") == 0, F.col("truck"))).alias("gate_in_truck")
    both = carried(gate).groupBy(*KEY, "gate_in_time").agg(first_in, F.expr(FIRST_OUT).alias("first"))
    out = F.col("first.t")
    return both.select(
        *KEY, "gate_in_time", out.alias("gate_out_time"), "gate_in_truck", F.col("first.truck").alias("gate_out_truck"),
        clean.cycle_id("container_no_norm", "gate_in_time", "facility").alias("cycle_id"),
        F.when(out.isNull(), "OPEN").otherwise("CLOSED").alias("cycle_status"), dwell_hours(F.col("gate_in_time"), out).alias("dwell_time_hours"),
    )


def pair_matches(gate: DataFrame) -> DataFrame:
    """The same matches by an equi-join with a time condition, for comparison: quadratic in a container's events."""
    ins = gate.where(F.col("event_type_norm").isin(IN_TYPES)).select(*KEY, F.col("event_time_parsed").alias("gate_in_time")).distinct()
    outs = gate.where(F.col("event_type_norm").isin(OUT_TYPES)).select(*KEY, F.col("event_time_parsed").alias("gate_out_time"))
    latest = outs.join(ins, KEY).where("gate_in_time <= gate_out_time").groupBy(*KEY, "gate_out_time").agg(F.max("gate_in_time").alias("gate_in_time"))
    return latest.groupBy(*KEY, "gate_in_time").agg(F.min("gate_out_time").alias("gate_out_time"))

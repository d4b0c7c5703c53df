"""Shift, daily and peak-hour figures, as of a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardlake.functions import clean, shifts

#: Spellings of the two families.
IN_FAMILY = ["GATE_IN", "GATEIN", "IN", "GATE-IN"]
OUT_FAMILY = ["GATE_OUT", "GATEOUT", "OUT", "GATE-OUT"]
TIME = "event_time_parsed"


def since(as_of: Column, days: int) -> Column:
    return F.col(TIME).between(F.date_sub(F.to_date(as_of), days).cast("timestamp"), as_of)


def direction() -> Column:
    """IN or OUT, by the cleaned type or else the raw one; null: neither."""
    norm = F.upper(F.trim(F.coalesce("event_type_norm", "event_type")))
    return F.when(norm.isin(IN_FAMILY), "IN").when(norm.isin(OUT_FAMILY), "OUT")


def shift_kpis(gate: DataFrame, yard: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """facility, operational_date, shift_id, kpi_type, value. Both directions come from one pass over the gate events.
    The oldest operational date is only partly within the lookback and is left out."""
    kind = F.when(direction() == "IN", "SHIFT_GATE_IN").when(direction() == "OUT", "SHIFT_GATE_OUT")
    rows = gate.where(since(as_of, days)).select(clean.facility_code("facility", "location").alias("facility"), TIME, kind.alias("kpi_type")).where("kpi_type is not null")
    moves = yard.where(since(as_of, days)).select(clean.facility_code("facility").alias("facility"), TIME, F.lit("SHIFT_YARD_MOVES").alias("kpi_type"))
    both = rows.unionByName(moves).where("facility is not null")
    counted = both.groupBy("facility", shifts.operational_date(F.col(TIME)).alias("operational_date"), shifts.shift(F.col(TIME)).alias("shift_id"), "kpi_type").agg(F.count(F.lit(1)).alias("value"))
    return counted.where(F.col("operational_date") >= F.date_sub(F.to_date(as_of), days))


def throughput(cycles: DataFrame) -> DataFrame:
    """Closed cycles by facility and day of gate-out, with dwell figures in hours."""
    return by_day_out(cycles.where("cycle_status = 'CLOSED' and gate_out_time is not null"))


def by_day_out(cycles: DataFrame) -> DataFrame:
    """The same; cycles that are not closed have no day."""
    hours = F.col("dwell_time_hours").cast("double")
    rows = cycles.withColumn("operational_date", F.when(F.col("cycle_status") == "CLOSED", F.to_date("gate_out_time")))
    return rows.groupBy("facility", "operational_date").agg(
        F.count(F.lit(1)).alias("cycles_completed"), F.sum(hours).alias("dwell_hours_sum"), F.avg(hours).alias("avg_dwell_hours"),
        F.min(hours).alias("min_dwell_hours"), F.max(hours).alias("max_dwell_hours"),
        F.percentile_approx(hours, 0.5).alias("median_dwell_hours"), F.percentile_approx(hours, 0.95).alias("p95_dwell_hours"),
    )


#: Size of a quantile sketch: its rank error is about SKETCH_ERROR (99 of 100 times), whatever it holds.
SKETCH_K, SKETCH_ERROR = 200, 0.0133


def dwell_sketches(cycles: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """facility, operational_date, cycles_completed and a mergeable quantile sketch (KLL) of the dwell hours of closed cycles, some kilobytes each:
    stored once, a closed day need not be scanned again."""
    rows = cycles.where("cycle_status = 'CLOSED' and gate_out_time is not null and dwell_time_hours is not null")
    own = rows.groupBy("facility", F.to_date("gate_out_time").alias("operational_date"))
    return own.agg(F.count(F.lit(1)).alias("cycles_completed"), F.kll_sketch_agg_double(F.col("dwell_time_hours").cast("double"), F.lit(k)).alias("dwell_sketch"))


def merged_dwell(sketches: DataFrame, period: Column, *by: str, quantiles: dict[str, float] | None = None, k: int = SKETCH_K) -> DataFrame:
    """Quantiles of longer periods from the sketches of their days alone. period: over operational_date; by: facility, or nothing for all. The
    rank error is that of one sketch, however many are merged."""
    told = quantiles or {"median_dwell_hours": 0.5, "p95_dwell_hours": 0.95}
    merged = sketches.groupBy(*by, period.alias("period")).agg(F.sum("cycles_completed").alias("cycles_completed"), F.kll_merge_agg_double("dwell_sketch", F.lit(k)).alias("s"))
    return merged.select(*by, "period", "cycles_completed", *[F.kll_sketch_get_quantile_double("s", F.lit(q)).alias(n) for n, q in told.items()])


def dense_days(cycles: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Every facility on every day. Facilities are a handful of codes and the calendar has days + 1 rows, so each facility
    generates its own days and nothing is joined."""
    today = F.to_date(as_of)
    facilities = cycles.where("facility is not null").select("facility").distinct()
    return facilities.select("facility", F.explode(F.sequence(F.date_sub(today, days), today)).alias("operational_date"))


def densely(daily: DataFrame, as_of: Column, days: int) -> DataFrame:
    """The dense days with the figures of daily, null where it has none. daily: facility, operational_date, figures, a row a day at most; days that are
    null or not in the calendar only tell that there is the facility. Its days are one map of days + 1 entries at most, in which the calendar
    looks them up: facilities and figures come from one pass over what daily is made of."""
    today = F.to_date(as_of)
    start, key = F.date_sub(today, days), ["facility", "operational_date"]
    figures = [c for c in daily.columns if c not in key]
    entry = F.when(F.col("operational_date").between(start, today), F.struct("operational_date", F.struct(*figures)))
    told = daily.where("facility is not null").groupBy("facility").agg(F.map_from_entries(F.collect_list(entry)).alias("told"))
    own = lambda day: F.struct(day.alias("operational_date"), F.try_element_at("told", day).alias("own"))
    return told.select("facility", F.inline(F.transform(F.sequence(start, today), own))).select(*key, "own.*")


def rolling(cycles: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """The dense days with throughput and its trailing figures: 7-day mean throughput, 30-day mean dwell in days."""
    dense = densely(by_day_out(cycles), as_of, days).na.fill({"cycles_completed": 0, "dwell_hours_sum": 0.0})
    by = Window.partitionBy("facility").orderBy("operational_date")
    week, month = by.rowsBetween(-6, 0), by.rowsBetween(-29, 0)
    done = F.sum("cycles_completed").over(month)
    return dense.withColumns({
        "rolling_7d_avg_throughput": F.avg(F.col("cycles_completed").cast("double")).over(week),
        "rolling_30d_avg_dwell": F.when(done > 0, F.sum("dwell_hours_sum").over(month) / done / 24.0),
    })


def daily_inventory(cycles: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """Containers in the yard per facility and day, the day of gate-out included; days without any are 0.

    A container's stays that overlap count as one. A stay adds 1 on its first day and takes 1 away on the day after its
    last, so a cycle makes two rows, however long it is; a running sum over the calendar gives the days between.
    """
    today = F.to_date(as_of)
    first, last = F.greatest(F.to_date("gate_in_time"), F.date_sub(today, days)), F.least(F.coalesce(F.to_date("gate_out_time"), today), today)
    stays = cycles.select("container_no_norm", "facility", first.alias("a"), F.when(first <= last, last).alias("b"))
    by = Window.partitionBy("container_no_norm", "facility").orderBy("a", "b")  # as cycles are dealt already
    before = F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1))
    # what a stay adds to those before it: the days past their last one
    added = stays.withColumn("a", F.greatest("a", F.date_add(before, 1)))
    step = lambda day, n: F.struct(day.alias("operational_date"), F.lit(n).alias("step"))
    both = F.when(F.col("a") <= F.col("b"), F.array(step(F.col("a"), 1), step(F.date_add("b", 1), -1)))
    # a stay that adds nothing still tells of its facility
    steps = added.select("facility", F.inline(F.coalesce(both, F.array(step(F.lit(None).cast("date"), 0)))))
    change = steps.groupBy("facility", "operational_date").agg(F.sum("step").alias("step"))
    running = F.sum(F.coalesce("step", F.lit(0))).over(Window.partitionBy("facility").orderBy("operational_date").rowsBetween(Window.unboundedPreceding, 0))
    dense = densely(change, as_of, days)
    return dense.select("facility", "operational_date", running.alias("inventory_eod"))


def daily_kpis(cycles: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """Both daily figures in long format."""
    shape = ["facility", F.col("operational_date").cast("timestamp").alias("day_ts")]
    none = F.lit(None).cast("double")
    rest = {"metric1": none, "metric2": none, "metric3": none, "category": F.lit(None).cast("string"), "rolling_7d_avg_throughput": none, "rolling_30d_avg_dwell": none}
    told = {"metric1": F.col("avg_dwell_hours"), "metric2": F.col("median_dwell_hours"), "metric3": F.col("p95_dwell_hours")}
    told |= {c: F.col(c) for c in ("rolling_7d_avg_throughput", "rolling_30d_avg_dwell")}
    make = lambda df, kind, value, told: df.select(*shape, F.lit(kind).alias("kpi_type"), F.col(value).cast("long").alias("value"), *[c.alias(n) for n, c in (rest | told).items()])
    return make(rolling(cycles, as_of, days), "DAILY_THROUGHPUT", "cycles_completed", told).unionByName(make(daily_inventory(cycles, as_of, days), "DAILY_INVENTORY_EOD", "inventory_eod", {}))


def peak_hours(gate: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    rows = gate.where(since(as_of, days)).select(clean.facility_code("facility", "location").alias("facility"), TIME).where("facility is not null")
    counted = rows.groupBy("facility", F.date_format(TIME, "EEEE").alias("day_name"), F.hour(TIME).alias("hour_of_day")).agg(F.count(F.lit(1)).alias("total_activity"))
    return counted.withColumns({"avg_activity": F.col("total_activity") / F.lit(days / 7), "kpi_type": F.lit("PEAK_HEATMAP")})

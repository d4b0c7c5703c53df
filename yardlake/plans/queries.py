"""Every operator as a query over the given tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.functions import clean
from yardlake.operators import bronze as bronze_ops
from yardlake.operators import cycles, health, kpi, metrics, serving, shape, silver, status, upsert
from yardlake.plans import given, sql
from yardlake.plans.given import as_of, at, edge
from yardlake.schemas import GATE_TYPES, TOPICS, TYPES_OF_KIND

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(text: str | None, dates: bool = False):
    """Registers a function under its name with the SQL of its rows. dates: they have an operational_date."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: edge(f(spark, sf_dir))
        if text:
            dated = f"SELECT * REPLACE (CAST(operational_date AS TIMESTAMP) AS operational_date) FROM ({text})"
            ORACLE_SQL[f.__name__] = sql.over(dated if dates else text)
        return f

    return add


def six(c: str) -> str:
    """Six places, as given.edge() rounds."""
    return f"round({c} + {given.TIE}, 6)"


def r6(*columns: str) -> str:
    return ", ".join(f"{six(c)} AS {c}" for c in columns)


# Single values


@query(f"SELECT event_id, {sql.CONTAINER} AS container_no_norm FROM raw")
def clean_container(spark, sf):
    return given.raw(spark, sf).select("event_id", clean.container_number("container_no_raw").alias("container_no_norm"))


@query(rf"""SELECT event_id, coalesce({sql.code("facility")}, {sql.code("location")}) AS facility,
  nullif(regexp_extract(upper(trim(coalesce(facility, location))), '^(CT\d{{2}})', 1), '') AS facility_prefix FROM raw""")
def clean_facility(spark, sf):
    return given.raw(spark, sf).select("event_id", clean.facility_code("facility", "location").alias("facility"), clean.facility_prefix("facility", "location").alias("facility_prefix"))


@query(f"SELECT event_id, {sql.time('event_time')} AS event_time_parsed FROM raw")
def parse_event_time(spark, sf):
    return given.raw(spark, sf).select("event_id", clean.event_time("event_time", "date_raw", "time_raw").alias("event_time_parsed"))


@query(f"SELECT event_id, {sql.GATED} AS event_type_norm FROM raw")
def validate_event_type(spark, sf):
    return given.raw(spark, sf).select("event_id", clean.event_type("event_type", GATE_TYPES).alias("event_type_norm"))


@query(f"SELECT event_id, {sql.joined_id('container_no_raw', 'event_time', 'booking', 'kafka_offset')} AS id FROM raw")
def event_id_md5(spark, sf):
    return given.raw(spark, sf).select("event_id", clean.text_id("container_no_raw", "event_time", "booking", "kafka_offset").alias("id"))


# Shaping and routing: rows of the given events stand for staging rows


def staging(spark, sf, kind: str) -> DataFrame:
    rows = given.raw(spark, sf, kind).where(F.col("topic") == TOPICS[kind]).withColumn("source_row", F.col("event_id").cast("string"))
    if kind in ("yard_move", "inspection"):
        rows = rows.drop("event_id")
    if kind == "yard_move":
        part = lambda i: F.split_part("location", F.lit("-"), F.lit(i))
        rows = rows.withColumns({"move_id": F.concat(F.lit("M"), "source_row"), "move_time": F.col("event_time"), "to_block": part(1), "to_row": part(2), "to_bay": part(3), "to_tier": part(4)})
        moved = F.col("source_row").cast("long") % 3 == 0
        rows = rows.withColumns({f"from_{c}": F.when(moved, part(i)) for c, i in (("block", 1), ("row", 2), ("bay", 4), ("tier", 3))})
    if kind == "inspection":
        rows = rows.withColumn("inspection_time", F.col("event_time"))
    if kind == "cleaning":
        rows = rows.withColumn("Date In", F.col("event_time")).withColumn("event_time", F.when(F.col("event_id") % 4 == 0, F.lit(" ")).otherwise(F.col("event_time")))
    if kind == "mnr":
        rows = rows.withColumn("location_raw", F.col("location"))
    return rows


SHOWN = ["event_id", "event_type", "event_time", "container_no_raw", "facility"]


@query(f"SELECT topic, count(*)::BIGINT AS n FROM (SELECT {sql.ROUTE} AS topic FROM (SELECT event_type AS t FROM raw)) GROUP BY topic")
def route_topics(spark, sf):
    return given.raw(spark, sf).select(shape.topic_of(F.col("event_type")).alias("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT 'GATE_' || event_id AS event_id, event_type, event_time, container_no_raw, {sql.RAW_FACILITY.format("location")} AS facility, booking, truck, 'stg_gate_events.csv' AS source_file, '0' AS is_synthetic
  FROM raw WHERE topic = 'raw.gate' AND event_type IN ('GATE_IN', 'GATEIN', 'GATE_OUT', 'GATEOUT')""")
def shape_gate(spark, sf):
    return shape.gate(staging(spark, sf, "gate")).select(*SHOWN, "booking", "truck", "source_file", "is_synthetic")


@query(f"""SELECT 'CLEAN_' || event_id AS event_id, CASE WHEN event_type = 'WASH' THEN 'CLEANING' ELSE event_type END AS event_type, event_time, container_no_raw,
  {sql.RAW_FACILITY.format("facility")} AS facility, event_time AS date_in, 'stg_cleaning_events.csv' AS source_file FROM raw WHERE topic = 'raw.cleaning'""")
def shape_cleaning(spark, sf):
    return shape.cleaning(staging(spark, sf, "cleaning")).select(*SHOWN, "date_in", "source_file")


@query(f"""SELECT 'MNR_' || event_id AS event_id, event_type, event_time, container_no_raw, {sql.RAW_FACILITY.format("location")} AS facility, stage FROM raw WHERE topic = 'raw.mnr'""")
def shape_mnr(spark, sf):
    return shape.mnr(staging(spark, sf, "mnr")).select(*SHOWN, "stage")


@query("""SELECT 'M' || event_id AS event_id, 'yard_move' AS event_type, event_time, container_no_raw, facility,
  CASE WHEN event_id % 3 = 0 AND location IS NOT NULL THEN split_part(location, '-', 1) || '-' || split_part(location, '-', 2) || '-' || split_part(location, '-', 4) || '-' || split_part(location, '-', 3) ELSE '---' END AS from_location, coalesce(location, '---') AS to_location
  FROM raw WHERE topic = 'raw.yard_move'""")
def shape_yard(spark, sf):
    return shape.yard_move(staging(spark, sf, "yard_move")).select(*SHOWN, "from_location", "to_location")


@query("""SELECT 'INSP_' || event_id AS event_id, 'inspection' AS event_type, event_time, container_no_raw, facility, severity FROM raw WHERE topic = 'raw.inspection'""")
def shape_inspection(spark, sf):
    return shape.inspection(staging(spark, sf, "inspection")).select(*SHOWN, "severity")


@query("SELECT event_id, topic FROM (SELECT event_id, topic, row_number() OVER (PARTITION BY topic ORDER BY event_id) AS n FROM raw) WHERE n <= 300")
def limit_per_type(spark, sf):
    return shape.first_rows(given.raw(spark, sf).select("event_id", "topic"), 300, "event_id", "topic")


@query("""SELECT topic, count(*)::BIGINT AS n, count(container_no_raw)::BIGINT AS keyed FROM raw
  WHERE topic <> 'raw.gate' OR event_type IN ('GATE_IN', 'GATEIN', 'GATE_OUT', 'GATEOUT') GROUP BY topic""")
def publish_counts(spark, sf):
    envelopes = shape.all_envelopes({k: staging(spark, sf, k) for k in TOPICS})
    return envelopes.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("keyed"))


# Bronze and silver


def envelopes(spark, sf) -> DataFrame:
    """Gate envelopes; every 89th value is broken JSON, every 83rd no record at all."""
    rows = given.raw(spark, sf, "gate").where("topic = 'raw.gate'")
    made = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", "event_time", "container_no_raw", "facility", "location", "truck", "booking"))
    value = F.when(F.col("event_id") % 89 == 0, F.lit("{bad")).when(F.col("event_id") % 83 == 0, F.lit(None)).otherwise(made)
    return rows.select(F.col("container_no_raw").alias("key"), value.alias("value"), "topic", F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), at("2024-02-01 00:00:00").alias("timestamp"))


BAD = "(event_id % 89 = 0 OR event_id % 83 = 0 OR container_no_raw IS NULL)"


@query(f"SELECT kafka_offset, kafka_partition, CAST(event_id AS VARCHAR) AS event_id, event_type, event_time, container_no_raw, facility, location FROM raw WHERE topic = 'raw.gate' AND NOT {BAD}")
def bronze_valid(spark, sf):
    rows = bronze_ops.valid(bronze_ops.parsed(envelopes(spark, sf), "raw.gate"), as_of())
    return rows.select("kafka_offset", "kafka_partition", *SHOWN, "location")


@query(f"SELECT kafka_offset, kafka_partition, container_no_raw AS kafka_key, 'INVALID_JSON_OR_MISSING_CONTAINER' AS dlq_reason FROM raw WHERE topic = 'raw.gate' AND {BAD}")
def bronze_dlq(spark, sf):
    rows = bronze_ops.dead_letters(bronze_ops.parsed(envelopes(spark, sf), "raw.gate"), as_of())
    return rows.select("kafka_offset", "kafka_partition", "kafka_key", "dlq_reason")


SILVER = ["event_id", "container_no_norm", "facility_raw", "facility", "event_time_parsed", "event_id_generated"]


def silver_sql(kind: str, *more: str) -> str:
    return f"SELECT {', '.join([*SILVER, *more])} FROM silver WHERE topic = '{TOPICS[kind]}'"


@query(silver_sql("gate", "event_type_norm", "booking"))
def silver_gate(spark, sf):
    return given.clean_events(spark, sf, "gate").select(*SILVER, "event_type_norm", "booking")


@query(silver_sql("yard_move", "location AS to_location"))
def silver_yard(spark, sf):
    return given.clean_events(spark, sf, "yard_move").select(*SILVER, "to_location")


@query(silver_sql("inspection", "severity_norm"))
def silver_inspection(spark, sf):
    return given.clean_events(spark, sf, "inspection").select(*SILVER, "severity_norm")


@query(silver_sql("cleaning", "event_type_norm"))
def silver_cleaning(spark, sf):
    return given.clean_events(spark, sf, "cleaning").select(*SILVER, "event_type_norm")


@query(silver_sql("mnr", "event_type_norm", "stage_norm"))
def silver_mnr(spark, sf):
    return given.clean_events(spark, sf, "mnr").select(*SILVER, "event_type_norm", "stage_norm")


@query(f"""SELECT id, count(*)::BIGINT AS n FROM (SELECT DISTINCT {sql.joined_id("container_no_norm", "event_type_norm", "event_time_parsed", "booking")} AS id FROM gate) GROUP BY id""")
def dedup_events(spark, sf):
    """Every record twice, as a feed that publishes its rows again: the business id keeps one."""
    once = given.bronze(spark, sf, "gate")
    rows = silver.deduplicated(silver.silver(once.unionByName(once), "gate", id_of="business"))
    return rows.groupBy(F.col("event_id_generated").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT CASE topic WHEN 'raw.gate' THEN 'gate' WHEN 'raw.yard_move' THEN 'yard_move' WHEN 'raw.inspection' THEN 'inspection' WHEN 'raw.cleaning' THEN 'cleaning' ELSE 'mnr' END AS kind,
  count(*)::BIGINT AS total, (count(*) FILTER ({sql.ACCEPTED}))::BIGINT AS accepted, (count(*) FILTER (container_no_norm IS NULL))::BIGINT AS null_container,
  (count(*) FILTER (event_time_parsed IS NULL))::BIGINT AS null_time, (count(*) FILTER (facility IS NULL))::BIGINT AS null_facility,
  (count(*) FILTER (event_type_norm IS NULL AND topic IN ('raw.gate', 'raw.cleaning', 'raw.mnr')))::BIGINT AS null_type FROM cleaned GROUP BY topic""")
def quality_report(spark, sf):
    out = None
    for kind in TOPICS:
        part = silver.quality_report(given.bronze(spark, sf, kind), kind)
        out = part if out is None else out.unionByName(part)
    return out


# Cycles and status


@query("SELECT * FROM opened")
def cycles_open(spark, sf):
    return cycles.opened(given.clean_events(spark, sf, "gate"))


@query("SELECT * FROM closed")
def cycles_closed(spark, sf):
    return cycles.matched(given.clean_events(spark, sf, "gate"))


@query("SELECT * FROM cycles")
def cycles_all(spark, sf):
    return given.gate_cycles(spark, sf)


@query("SELECT container_no_norm, facility, gate_in_time, gate_out_time FROM closed")
def cycles_pair_join(spark, sf):
    return cycles.pair_matches(given.clean_events(spark, sf, "gate"))


@query("SELECT * FROM harmonized")
def harmonized_events(spark, sf):
    return given.harmonized(spark, sf)


@query("SELECT * FROM status")
def current_status(spark, sf):
    return given.current(spark, sf)


@query("SELECT * FROM inventory")
def inventory_by_dwell(spark, sf):
    return metrics.inventory_by_dwell(given.gate_cycles(spark, sf), as_of())


@query("SELECT * FROM backlog")
def backlog(spark, sf):
    return metrics.backlog(given.current(spark, sf))


@query(f"""SELECT container_no_norm, facility, gate_in_time, gate_in_truck, (({sql.seconds(sql.LATER)} * 10 + 43200) // 86400) / 10::DOUBLE AS current_dwell_days
  FROM cycles WHERE cycle_status = 'OPEN' AND {sql.hours(sql.LATER)} > 480""")
def long_dwell(spark, sf):
    return metrics.long_dwell(given.gate_cycles(spark, sf), at("2024-03-01 00:00:00"))


# Figures


def shift_rows(spark, sf):
    return kpi.shift_kpis(given.clean_events(spark, sf, "gate"), given.clean_events(spark, sf, "yard_move").withColumn("location", F.lit(None).cast("string")), as_of())


@query("SELECT * FROM shift_kpi", dates=True)
def shift_kpi(spark, sf):
    return shift_rows(spark, sf)


@query("SELECT * FROM dense", dates=True)
def dense_calendar(spark, sf):
    return kpi.dense_days(given.gate_cycles(spark, sf), as_of(), 365)


HOURS = ["dwell_hours_sum", "avg_dwell_hours", "min_dwell_hours", "max_dwell_hours", "median_dwell_hours", "p95_dwell_hours"]


@query(f"SELECT facility, operational_date, cycles_completed, {r6(*HOURS)} FROM throughput", dates=True)
def daily_throughput(spark, sf):
    return kpi.throughput(given.gate_cycles(spark, sf))


@query("SELECT * FROM daily_inventory", dates=True)
def daily_inventory(spark, sf):
    return kpi.daily_inventory(given.gate_cycles(spark, sf), as_of())


@query(f"SELECT facility, operational_date, cycles_completed, {r6('rolling_7d_avg_throughput', 'rolling_30d_avg_dwell')} FROM rolling", dates=True)
def daily_rolling(spark, sf):
    return kpi.rolling(given.gate_cycles(spark, sf), as_of()).select("facility", "operational_date", "cycles_completed", "rolling_7d_avg_throughput", "rolling_30d_avg_dwell")


@query(f"SELECT facility, day_ts, kpi_type, value, {r6('metric1', 'metric2', 'metric3', 'rolling_7d_avg_throughput', 'rolling_30d_avg_dwell')}, category FROM daily")
def daily_kpi(spark, sf):
    return kpi.daily_kpis(given.gate_cycles(spark, sf), as_of())


def peak_rows(spark, sf):
    return kpi.peak_hours(given.clean_events(spark, sf, "gate"), as_of())


@query(f"SELECT facility, day_name, hour_of_day, total_activity, {r6('avg_activity')}, kpi_type FROM peaks")
def peak_hours(spark, sf):
    return peak_rows(spark, sf)


# Upserts: the events before and after the middle of the month are two batches



def is_early():
    return F.col("event_time_parsed") < at("2024-01-16 00:00:00")


def half(spark, sf, early: bool) -> DataFrame:
    rows = given.clean_events(spark, sf, "gate")
    return rows.where(is_early() if early else ~is_early())


@query("SELECT cycle_id, gate_in_time, gate_in_truck FROM opened")
def upsert_insert_only(spark, sf):
    pick = ["cycle_id", "gate_in_time", "gate_in_truck"]
    target = cycles.opened(half(spark, sf, True)).select(*pick)
    return upsert.insert_only(target, cycles.opened(given.clean_events(spark, sf, "gate")).select(*pick), ["cycle_id"])


@query("SELECT cycle_id, gate_in_time, gate_out_time, gate_out_truck, cycle_status, dwell_time_hours FROM cycles")
def upsert_conditional_close(spark, sf):
    rows = given.clean_events(spark, sf, "gate")
    empty = {"gate_out_time": F.lit(None).cast("timestamp"), "gate_out_truck": F.lit(None).cast("string"), "cycle_status": F.lit("OPEN"), "dwell_time_hours": F.lit(None).cast("double")}
    target = cycles.opened(rows).withColumns(empty)
    matched = cycles.matched(rows).withColumn("cycle_id", clean.cycle_id("container_no_norm", "gate_in_time", "facility"))
    return upsert.close_cycles(target, matched).select("cycle_id", "gate_in_time", "gate_out_time", "gate_out_truck", "cycle_status", "dwell_time_hours")


@query("SELECT * FROM status")
def upsert_newest_wins(spark, sf):
    """Three batches that interleave in time, as ids are dealt, and share times: their order does not count."""
    events = given.harmonized(spark, sf).withColumn("batch", F.pmod(F.xxhash64("event_id_generated"), F.lit(3)))
    state = lambda batch: status.state(events.where(F.col("batch") == batch))
    return status.visible(upsert.newest_status(upsert.newest_status(state(2), state(0)), state(1)))


@query("SELECT facility, operational_date, shift_id, kpi_type, value FROM shift_kpi", dates=True)
def upsert_replace(spark, sf):
    """All figures wrong at first, then replaced; keys that the source lacks would stay."""
    now = shift_rows(spark, sf)
    before = now.where("shift_id = 'NIGHT'").withColumn("value", F.lit(-1).cast("long"))
    return upsert.replace(before, now, ["facility", "operational_date", "shift_id", "kpi_type"])


# Dashboard


@query("SELECT facility, dwell_bucket, sum(container_count)::BIGINT AS containers FROM inventory GROUP BY 1, 2")
def q_inventory(spark, sf):
    return serving.inventory(metrics.inventory_by_dwell(given.gate_cycles(spark, sf), as_of()))


@query("""SELECT facility, sum(container_count) FILTER (dwell_bucket = 'SHORT_0_5D')::BIGINT AS SHORT_0_5D, sum(container_count) FILTER (dwell_bucket = 'MEDIUM_6_12D')::BIGINT AS MEDIUM_6_12D,
  sum(container_count) FILTER (dwell_bucket = 'LONG_13_20D')::BIGINT AS LONG_13_20D, sum(container_count) FILTER (dwell_bucket = 'CRITICAL_GT20D')::BIGINT AS CRITICAL_GT20D FROM inventory GROUP BY 1""")
def q_inventory_wide(spark, sf):
    return serving.inventory_wide(metrics.inventory_by_dwell(given.gate_cycles(spark, sf), as_of()), [n for _, n in metrics.CLASSES] + [metrics.BEYOND])


@query("SELECT backlog_type, facility, sum(backlog_count)::BIGINT AS backlog FROM backlog GROUP BY 1, 2 ORDER BY backlog DESC, 1, 2 LIMIT 50")
def q_backlog(spark, sf):
    return serving.backlog(metrics.backlog(given.current(spark, sf)))


@query("SELECT container_no_norm, facility, gate_in_time, current_dwell_hours FROM open_now WHERE current_dwell_hours > 240 ORDER BY current_dwell_hours DESC, container_no_norm, facility LIMIT 5000")
def q_critical(spark, sf):
    return serving.critical(metrics.open_dwell(given.gate_cycles(spark, sf), as_of()))


@query("SELECT container_no_norm, event_time_parsed, event_type_norm, facility, last_location FROM status ORDER BY event_time_parsed DESC, container_no_norm LIMIT 50")
def q_ticker(spark, sf):
    return serving.ticker(given.current(spark, sf))


@query("SELECT operational_date, shift_id, sum(value)::BIGINT AS moves FROM shift_kpi WHERE kpi_type IN ('SHIFT_GATE_IN', 'SHIFT_YARD_MOVES') GROUP BY 1, 2", dates=True)
def q_shift(spark, sf):
    return serving.shift_productivity(shift_rows(spark, sf))


def daily_rows(spark, sf):
    return kpi.daily_kpis(given.gate_cycles(spark, sf), as_of())


@query("SELECT day_ts, sum(value)::BIGINT AS cycles FROM daily WHERE kpi_type = 'DAILY_THROUGHPUT' GROUP BY 1")
def q_throughput_trend(spark, sf):
    return serving.throughput_trend(daily_rows(spark, sf))


@query(f"SELECT day_ts, {six('avg(metric1)')} AS avg_dwell, {six('avg(metric3)')} AS p95_dwell FROM daily WHERE kpi_type = 'DAILY_THROUGHPUT' GROUP BY 1")
def q_dwell_trend(spark, sf):
    return serving.dwell_trend(daily_rows(spark, sf))


@query(f"""SELECT day_name, hour_of_day, {six('activity')} AS activity, {six('activity / sum(activity) OVER ()')} AS share
  FROM (SELECT day_name, hour_of_day, sum(avg_activity) AS activity FROM peaks GROUP BY 1, 2)""")
def q_heatmap(spark, sf):
    return serving.heatmap(peak_rows(spark, sf))


@query(f"SELECT facility, activity, {six('activity / sum(activity) OVER ()')} AS share FROM (SELECT facility, sum(total_activity)::BIGINT AS activity FROM peaks GROUP BY 1)")
def q_facility_share(spark, sf):
    return serving.facility_share(peak_rows(spark, sf))


@query(f"""SELECT 'total_in_yard' AS card, sum(container_count)::DOUBLE AS value FROM inventory UNION ALL SELECT 'total_backlog', sum(backlog_count)::DOUBLE FROM backlog
  UNION ALL SELECT 'rolling_throughput', {six('arg_max(v, day_ts)')} FROM (SELECT day_ts, sum(rolling_7d_avg_throughput) AS v FROM daily WHERE kpi_type = 'DAILY_THROUGHPUT' GROUP BY 1)""")
def q_cards(spark, sf):
    gate_cycles = given.gate_cycles(spark, sf)
    return serving.cards(metrics.inventory_by_dwell(gate_cycles, as_of()), metrics.backlog(given.current(spark, sf)), kpi.daily_kpis(gate_cycles, as_of()))


@query("SELECT container_no_norm, facility, cycle_status FROM cycles WHERE facility IN ('CT01', 'CT03')")
def q_facility_filter(spark, sf):
    return serving.at_facilities(given.gate_cycles(spark, sf), ["CT01", "CT03"]).select("container_no_norm", "facility", "cycle_status")


# Health


def layers(spark, sf) -> DataFrame:
    gate, moves = given.clean_events(spark, sf, "gate"), given.clean_events(spark, sf, "yard_move")
    dated = given.raw(spark, sf).select(F.col("topic"), clean.event_time("event_time", "date_raw", "time_raw").alias("t"))
    tables = {("bronze", "bronze_gate"): (dated.where("topic = 'raw.gate'"), "t"), ("bronze", "bronze_yard"): (dated.where("topic = 'raw.yard_move'"), "t")}
    tables |= {("silver", "silver_gate"): (gate, "event_time_parsed"), ("silver", "silver_yard"): (moves, "event_time_parsed")}
    tables |= {("gold", "gold_cycles"): (cycles.cycles(gate), "gate_in_time")}
    return health.table_health(tables)


LAYERS = f"""SELECT 'bronze' AS layer, 'bronze_gate' AS table_name, count(*)::BIGINT AS n, max({sql.TIME}) AS latest FROM raw WHERE topic = 'raw.gate'
  UNION ALL SELECT 'bronze', 'bronze_yard', count(*)::BIGINT, max({sql.TIME}) FROM raw WHERE topic = 'raw.yard_move'
  UNION ALL SELECT 'silver', 'silver_gate', count(*)::BIGINT, max(event_time_parsed) FROM gate UNION ALL SELECT 'silver', 'silver_yard', count(*)::BIGINT, max(event_time_parsed) FROM yard
  UNION ALL SELECT 'gold', 'gold_cycles', count(*)::BIGINT, max(gate_in_time) FROM cycles"""


@query(LAYERS)
def layer_health(spark, sf):
    return layers(spark, sf)


@query(f"""SELECT *, CASE WHEN lag_minutes < 1 THEN 'UP_TO_DATE' WHEN lag_minutes < 2 THEN 'CAUGHT_UP' ELSE 'BEHIND' END AS verdict FROM (
  SELECT max(latest) FILTER (layer = 'silver') AS silver_latest, max(latest) FILTER (layer = 'gold') AS gold_latest,
    round((epoch(max(latest) FILTER (layer = 'silver')) - epoch(max(latest) FILTER (layer = 'gold'))) / 60.0::DOUBLE, 3) AS lag_minutes FROM ({LAYERS}))""")
def layer_lag(spark, sf):
    return health.lag(layers(spark, sf))


@query(f"""SELECT *, round(gold_rows::DOUBLE / silver_rows, 6) AS gold_per_silver FROM (SELECT (sum(n) FILTER (layer = 'bronze'))::BIGINT AS bronze_rows,
  (sum(n) FILTER (layer = 'silver'))::BIGINT AS silver_rows, (sum(n) FILTER (layer = 'gold'))::BIGINT AS gold_rows FROM ({LAYERS}))""")
def layer_ratio(spark, sf):
    return health.layer_ratio(layers(spark, sf))

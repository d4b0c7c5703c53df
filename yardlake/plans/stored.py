"""Scans, sinks, the catalog and the batch run as queries: what they wrote, read again, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardlake.functions import clean
from yardlake.operators import bronze, cycles, health, kpi, metrics, shape, silver, upsert
from yardlake.plans import batch, given, sql
from yardlake.plans.given import as_of, at
from yardlake.plans.queries import SHOWN, query, staging
from yardlake.plans.streamed import ALL_FILES, envelopes, ingested, scratch
from yardlake.schemas import GATE_TYPES, TOPICS, TYPES_OF_KIND
from yardlake.session import lone_checkpoints
from yardlake.sources import sinks
from yardlake.sources.envelopes import offset_stream
from yardlake.sources.tables import ROW, between, envelope_stream, on_days, staging_csv, table_stream
from yardlake.streaming import gold, ingest, progress, service

# Staging files: four of a kind, rows in the order of their ids


def csv_files(spark: SparkSession, sf: str, kind: str, columns: list[str]) -> DataFrame:
    rows = staging(spark, sf, kind).withColumn("source_row", F.col("source_row").cast("long")).withColumn("part", F.col("source_row") % 4)
    dealt = rows.select(*columns, "source_row", "part").repartition(4, "part").sortWithinPartitions("part", "source_row")
    folder = f"{scratch(spark)}/{kind}"
    dealt.drop("source_row").write.partitionBy("part").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return staging_csv(spark, folder, columns)


def file_rows(kind: str) -> str:
    """The rows of a kind with their numbers in their files."""
    return f"SELECT *, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS row_number FROM raw WHERE topic = '{TOPICS[kind]}'"


@query(f"SELECT event_id, event_type, event_time, container_no_raw, facility, (event_id % 4)::INTEGER AS part, row_number FROM ({file_rows('gate')})")
def csv_scan(spark, sf):
    rows = csv_files(spark, sf, "gate", SHOWN)
    return rows.withColumns({"event_id": F.col("event_id").cast("long"), "part": F.col("part").cast("int")}).select(*SHOWN, "part", ROW)


@query(f"""SELECT container_no_raw AS key, row_number::VARCHAR AS event_id, event_type, row_number::VARCHAR AS source_row FROM ({file_rows("gate")})
  WHERE row_number < 40 AND event_type IN ('GATE_IN', 'GATEIN', 'GATE_OUT', 'GATEOUT')""")
def limit_per_file(spark, sf):
    sent = shape.all_envelopes({"gate": csv_files(spark, sf, "gate", [c for c in SHOWN if c != "event_id"])}, limit=40)
    told = {c: F.get_json_object("value", f"$.{c}") for c in ("event_id", "event_type", "source_row")}
    return sent.select("key", F.regexp_extract(told["event_id"], r"^GATE_[0-9a-f]{8}_(\d+)$", 1).alias("event_id"), *[told[c].alias(c) for c in ("event_type", "source_row")])


@query(f"SELECT container_no_raw, event_time, row_number, 1::BIGINT AS rows_of_id FROM ({file_rows('yard_move')})")
def made_ids(spark, sf):
    """Every row of every file has an id of its own."""
    made = shape.yard_move(csv_files(spark, sf, "yard_move", ["container_no_raw", "move_time"]))
    rows = F.count(F.lit(1)).over(Window.partitionBy("event_id")).alias("rows_of_id")
    return made.select("container_no_raw", "event_time", F.substring_index("event_id", "_", -1).cast("long").alias("row_number"), rows)


@query("""SELECT container_no_raw AS key, 'raw.gate' AS topic, 'GATE_' || event_id AS event_id, '2024-02-01T00:00:00.000000' AS ingest_time
  FROM raw WHERE topic = 'raw.gate' AND event_type IN ('GATE_IN', 'GATEIN', 'GATE_OUT', 'GATEOUT')""")
def publish_envelopes(spark, sf):
    sent = shape.all_envelopes({"gate": staging(spark, sf, "gate")}, at=at("2024-02-01 00:00:00"))
    return sent.select("key", "topic", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("event_id", "ingest_time")])


NAME = "CASE event_id % 7 WHEN 0 THEN 'in/STG_GATE_EVENTS.csv' WHEN 1 THEN 'gate/stg_clean.csv' WHEN 2 THEN 'mnr.csv' WHEN 3 THEN 'a/Yard_Location.csv' WHEN 4 THEN 'movement.csv' WHEN 5 THEN 'damage_report.csv' ELSE 'yard/other.csv' END"


@query(f"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'gate' WHEN 1 THEN 'cleaning' WHEN 2 THEN 'mnr' WHEN 3 THEN 'yard_move' WHEN 4 THEN 'yard_move' WHEN 5 THEN 'inspection' END AS kind FROM raw""")
def kinds_of_files(spark, sf):
    return given.raw(spark, sf).select("event_id", shape.kind_of_file(F.expr(NAME)).alias("kind"))


# Rules that few rows of the other queries meet

SPELT = "CASE WHEN event_id % 5 = 0 THEN replace(upper(event_type), '_', '-') WHEN event_id % 5 = 1 THEN ' ' || split_part(replace(replace(event_type, '-', '_'), ' ', '_'), '_', 2) || ' ' ELSE event_type END"


@query(f"""SELECT event_id, CASE WHEN t IN ('GATE_IN', 'GATEIN', 'IN', 'GATE-IN') THEN 'IN' WHEN t IN ('GATE_OUT', 'GATEOUT', 'OUT', 'GATE-OUT') THEN 'OUT' END AS direction
  FROM (SELECT event_id, upper(trim(CASE WHEN event_id % 5 < 2 THEN {SPELT} ELSE {sql.GATED} END)) AS t FROM raw WHERE topic = 'raw.gate')""")
def robust_type(spark, sf):
    """Types that silver has not cleaned are told from their own spelling."""
    rows = given.raw(spark, sf, "gate").where("topic = 'raw.gate'").withColumn("as_given", F.expr(SPELT))
    norm = F.when(F.col("event_id") % 5 >= 2, clean.event_type("event_type", GATE_TYPES))
    return rows.select("event_id", norm.alias("event_type_norm"), F.col("as_given").alias("event_type")).select("event_id", kpi.direction().alias("direction"))


@query(f"""SELECT event_id, {sql.TYPE} AS event_type_norm FROM cleaned
  WHERE topic = 'raw.cleaning' AND {sql.TYPE} IN ('CLEANING', 'WASH', 'DRY') AND event_time_parsed IS NOT NULL AND facility IS NOT NULL""")
def own_types(spark, sf):
    """A list of types for a kind that has none by default."""
    return silver.silver(given.bronze(spark, sf, "cleaning"), "cleaning", types=TYPES_OF_KIND["cleaning"]).select("event_id", "event_type_norm")


# Tables


@query("SELECT 'empty' AS state, 0::BIGINT AS n UNION ALL SELECT 'filled', count(*)::BIGINT FROM opened")
def table_bootstrap(spark, sf):
    pick = ["cycle_id", "gate_in_time", "gate_in_truck"]
    table = sinks.ensure_table(spark, f"{scratch(spark)}/cycles", "cycle_id string, gate_in_time timestamp, gate_in_truck string")
    count = lambda state: table.read().agg(F.lit(state).alias("state"), F.count(F.lit(1)).alias("n"))
    empty = count("empty")
    opened = cycles.opened(given.clean_events(spark, sf, "gate")).select(*pick)
    for _ in range(2):  # the second time is a replay
        table.upsert(opened, 0, lambda t, s: upsert.insert_only(t, s, ["cycle_id"]))
    return empty.unionByName(count("filled"))


@query("SELECT facility, dwell_bucket, container_count FROM inventory")
def report_overwritten(spark, sf):
    """A report that is made again, with other columns than before."""
    at_ = f"{scratch(spark)}/inventory"
    rows = metrics.inventory_by_dwell(given.gate_cycles(spark, sf), as_of())
    sinks.Snapshots(spark, at_, "facility string, dwell_bucket string").write(rows, 0)
    table = sinks.Snapshots(spark, at_, "facility string, dwell_bucket string, container_count long")
    table.write(rows, 1)
    return table.read()


@query("SELECT facility, backlog_type, backlog_count FROM backlog")
def registered_table(spark, sf):
    """A table that is registered, replaced and registered again, read by its name."""
    table = sinks.Snapshots(spark, f"{scratch(spark)}/backlog", "facility string, backlog_type string, backlog_count long")
    rows = metrics.backlog(given.current(spark, sf))
    for run, part in enumerate((rows.limit(0), rows)):
        table.write(part, run, ("yardlake_queries", "gold_backlog"))
    return spark.table("yardlake_queries.gold_backlog")


@query(f"SELECT event_id, event_time_parsed FROM gate WHERE event_time_parsed BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND {sql.AS_OF} - INTERVAL 10 DAY")
def silver_between(spark, sf):
    return between(silver_by_day(spark, sf), "event_time_parsed", at("2024-01-10 00:00:00"), at("2024-01-21 00:00:00")).drop(sinks.DAY)


def silver_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Gate events in three batches, each of which has events of all days, laid out by day."""
    folder = f"{scratch(spark)}/silver"
    rows = given.clean_events(spark, sf, "gate").select("event_id", "event_time_parsed")
    for batch_id in range(3):
        sinks.append_batch(rows.where(F.col("event_id") % 3 == batch_id), folder, batch_id, day_of="event_time_parsed")
    return sinks.read_days(spark, folder)


@query("""SELECT event_id, event_time_parsed FROM gate JOIN (SELECT CAST(event_time_parsed AS DATE) AS day, count(*) AS n FROM yard GROUP BY 1 HAVING n % 4 = 1) d ON CAST(event_time_parsed AS DATE) = d.day""")
def silver_on_days(spark, sf):
    """Gate events of the days that another table picks: only their folders are opened."""
    moves = f"{scratch(spark)}/days"
    counted = given.clean_events(spark, sf, "yard_move").groupBy(F.to_date("event_time_parsed").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    sinks.append_batch(counted, moves, 0)
    return on_days(silver_by_day(spark, sf), sinks.read_appended(spark, moves).where("n % 4 = 1"), "day").drop(sinks.DAY)


@query("""SELECT 'silver' AS layer, 'silver_gate' AS table_name, count(*)::BIGINT AS n, max(event_time_parsed) AS latest FROM gate
  UNION ALL SELECT 'gold', 'gold_cycles', count(*)::BIGINT, max(gate_in_time) FROM cycles""")
def stored_layer_health(spark, sf):
    """Health of stored tables, told by their files' footers."""
    root = scratch(spark)
    gate = given.clean_events(spark, sf, "gate")
    made = {("silver", "silver_gate"): (gate, "event_time_parsed"), ("gold", "gold_cycles"): (cycles.cycles(gate), "gate_in_time")}
    stored = {}
    for (layer, name), (df, time) in made.items():
        folder = f"{root}/{name}"
        df.withColumn("micros", F.unix_micros(time)).write.parquet(folder)
        stored[layer, name] = (folder, "micros")
    return health.stored_health(spark, stored)


@query("""SELECT 'gold_kpi_shift' AS table_name, count(*)::BIGINT AS n, sum(value)::BIGINT AS total FROM shift_kpi UNION ALL SELECT 'gold_kpi_daily', count(*)::BIGINT, sum(value)::BIGINT FROM daily
  UNION ALL SELECT 'gold_kpi_peak_hours', count(*)::BIGINT, sum(total_activity)::BIGINT FROM peaks""")
def batch_run(spark, sf):
    """The periodic run, twice."""
    gate, moves, made = given.clean_events(spark, sf, "gate"), given.clean_events(spark, sf, "yard_move"), given.gate_cycles(spark, sf)
    root, out = scratch(spark), None
    for run in range(2):
        tables = batch.run_kpis(spark, gate, moves, made, root, run, as_of())
    for name, table in tables.items():
        total = F.sum("total_activity" if name.endswith("hours") else "value").alias("total")
        part = table.read().agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), total)
        out = part if out is None else out.unionByName(part)
    return out


# Streams


@query("SELECT event_id, CASE WHEN event_id % 2 = 1 THEN booking END AS booking FROM raw WHERE topic = 'raw.gate'")
def replayed_batch(spark, sf):
    """A batch that is written again is not delivered again; the next one brings a new column."""
    root = scratch(spark)
    rows = given.raw(spark, sf, "gate").where("topic = 'raw.gate'")
    even, odd = rows.where("event_id % 2 = 0").select("event_id"), rows.where("event_id % 2 = 1").select("event_id", "booking")

    def read() -> None:
        stream = table_stream(spark, f"{root}/in", "event_id long", ALL_FILES)
        write = lambda df, i: sinks.append_batch(df, f"{root}/out", i) and None
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for part, batch_id in ((even, 0), (even, 0), (odd, 1)):
        sinks.append_batch(part, f"{root}/in", batch_id)
        read()
    return sinks.read_appended(spark, f"{root}/out").select("event_id", "booking")


@query("""SELECT event_id FROM gate, (SELECT max(event_time_parsed) AS newest FROM gate WHERE event_id % 10 <> 0)
  WHERE event_id % 10 <> 0 OR event_time_parsed > newest - INTERVAL 7 DAY""")
def late_rows(spark, sf):
    """A tenth of the events comes in a second run: those from before the watermark of the first are dropped."""
    root = scratch(spark)
    rows = given.bronze(spark, sf, "gate")

    for batch_id, part in enumerate((rows.where("event_id % 10 <> 0"), rows.where("event_id % 10 = 0"))):
        sinks.append_batch(part, f"{root}/in", batch_id)
        stream = silver.deduplicated(silver.silver(table_stream(spark, f"{root}/in", rows.schema, ALL_FILES), "gate"))
        write = lambda df, i: sinks.append_batch(df.select("event_id"), f"{root}/out", i) and None
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sinks.read_appended(spark, f"{root}/out")


@query("""SELECT 'inventory' AS metric, facility, dwell_bucket AS kind, container_count AS n FROM inventory UNION ALL SELECT 'backlog', facility, backlog_type, backlog_count FROM backlog""")
def stream_metrics(spark, sf):
    """Inventory and backlog of the streams' tables, made anew at every refresh."""
    root = ingested(spark, sf, list(TOPICS))
    gold.start_cycles(service.silver_table(spark, root, "gate"), f"{root}/gold/cycles", f"{root}/checkpoints/cycles", ingest.ONCE).awaitTermination()
    gold.start_status(service.silver_events(spark, root), f"{root}/gold/status", f"{root}/checkpoints/status", ingest.ONCE).awaitTermination()
    for start in (gold.start_inventory, gold.start_backlog):
        start(spark, root, ingest.ONCE).awaitTermination()
    for when in (at("2024-01-20 00:00:00"), as_of()):
        gold.refresh_metrics(spark, root, gold.next_refresh(spark, root), when)
    inventory = sinks.Snapshots(spark, f"{root}/gold/inventory", gold.INVENTORY).read()
    backlog = sinks.Snapshots(spark, f"{root}/gold/backlog", gold.BACKLOG).read()
    long = lambda df, name, kind, n: df.select(F.lit(name).alias("metric"), "facility", F.col(kind).alias("kind"), F.col(n).alias("n"))
    return long(inventory, "inventory", "dwell_bucket", "container_count").unionByName(long(backlog, "backlog", "backlog_type", "backlog_count"))


MIDDLE = "2024-01-16 00:00:00"


def cycles_in_two_runs(spark: SparkSession, sf: str) -> str:
    """The root of a lake whose cycles come from the events before MIDDLE and, in a later run, from the others."""
    root = scratch(spark)
    rows = given.clean_events(spark, sf, "gate").select(*cycles.KEY, "event_time_parsed", "event_type_norm", "truck")
    for batch_id, part in enumerate((rows.where(F.col("event_time_parsed") < at(MIDDLE)), rows.where(F.col("event_time_parsed") >= at(MIDDLE)))):
        sinks.append_batch(part, f"{root}/in", batch_id)
        gold.start_cycles(table_stream(spark, f"{root}/in", rows.schema, ALL_FILES), f"{root}/gold/cycles", f"{root}/checkpoints/cycles", ingest.ONCE).awaitTermination()
    return root


#: What the first of the two runs knows of a cycle.
EARLY = f"gate_in_time < TIMESTAMP '{MIDDLE}'"
CLOSED_EARLY = f"coalesce(gate_out_time < TIMESTAMP '{MIDDLE}', false)"


@query(f"""SELECT cycle_id, CASE WHEN {EARLY} THEN 'update' ELSE 'insert' END AS change, CASE WHEN {EARLY} THEN 'OPEN' END AS was_status, cycle_status, gate_out_time, gate_out_truck, dwell_time_hours
  FROM cycles WHERE NOT {EARLY} OR (gate_out_time IS NOT NULL AND NOT {CLOSED_EARLY})""")
def changes_since(spark, sf):
    """What the second run changed, from the feed alone."""
    feed = gold.cycle_table(spark, f"{cycles_in_two_runs(spark, sf)}/gold/cycles").feed
    first = feed.read().where("now.gate_in_time < timestamp'" + MIDDLE + "' and change = 'insert'").agg(F.max("version")).first()[0]
    net = feed.since(-1 if first is None else first)
    return net.select("cycle_id", "change", F.col("was.cycle_status").alias("was_status"), *[F.col(f"now.{c}").alias(c) for c in ("cycle_status", "gate_out_time", "gate_out_truck", "dwell_time_hours")])


@query(f"""SELECT cycle_id, n_changes, CASE WHEN {EARLY} AND NOT {CLOSED_EARLY} THEN 'OPEN' WHEN {EARLY} THEN 'CLOSED' END AS status_before
  FROM (SELECT *, CASE WHEN {EARLY} AND NOT {CLOSED_EARLY} AND gate_out_time IS NOT NULL THEN 2 ELSE 1 END::BIGINT AS n_changes FROM cycles)""")
def changes_streamed(spark, sf):
    """A reader that starts late and stops between the runs sees each change once; the table as of the version between them."""
    root = scratch(spark)
    lake = cycles_in_two_runs(spark, sf)
    feed = gold.cycle_table(spark, f"{lake}/gold/cycles").feed
    for _ in range(2):  # the second time nothing is new
        write = lambda df, i: sinks.append_batch(df.select("cycle_id", "version"), f"{root}/seen", i) and None
        feed.stream(files_per_trigger=1).writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    seen = sinks.read_appended(spark, f"{root}/seen", "cycle_id string, version long").groupBy("cycle_id").agg(F.count(F.lit(1)).alias("n_changes"))
    first = feed.read().where("now.gate_in_time < timestamp'" + MIDDLE + "' and change = 'insert'").agg(F.max("version")).first()[0]
    before = feed.as_of(-1 if first is None else first).select("cycle_id", F.col("cycle_status").alias("status_before"))
    return seen.join(before, "cycle_id", "left")


LATER_INVENTORY = "SELECT facility, CASE WHEN h <= 120 THEN 'SHORT_0_5D' WHEN h <= 288 THEN 'MEDIUM_6_12D' WHEN h <= 480 THEN 'LONG_13_20D' ELSE 'CRITICAL_GT20D' END AS dwell_bucket, count(*)::BIGINT AS container_count, max(h) AS max_dwell_hours, min(h) AS min_dwell_hours FROM (SELECT facility, gate_in_time, {hours} AS h FROM cycles WHERE cycle_status = 'OPEN' AND gate_in_time <= {at}) GROUP BY 1, 2"


@query(" UNION ALL ".join(f"SELECT '{name}' AS at, * FROM ({LATER_INVENTORY.format(hours=sql.hours(when), at=when)})" for name, when in (("end", sql.AS_OF), ("later", sql.LATER), ("during", "TIMESTAMP '2024-01-25 12:00:00'"))))
def stream_inventory_incremental(spark, sf):
    """Inventory at three times from one count of open entries, which a streaming aggregation keeps by adding what opens and
    taking away what closes."""
    root, out = cycles_in_two_runs(spark, sf), None
    gold.start_inventory(spark, root, ingest.ONCE).awaitTermination()
    for name, when in (("end", as_of()), ("later", at("2024-03-01 00:00:00")), ("during", at("2024-01-25 12:00:00"))):
        part = gold.inventory_now(spark, root, when).drop("metric_type").withColumn("at", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT 'first' AS run, 0::BIGINT AS lost, count(*)::BIGINT AS n FROM gate UNION ALL SELECT 'second', 0, 2 * count(*)::BIGINT FROM gate")
def new_checkpoint(spark, sf):
    """A query that starts anew, without its checkpoint, appends what it reads; a replay of it does not. By id nothing is lost or made up."""
    root, out = scratch(spark), None
    rows = given.clean_events(spark, sf, "gate").select("event_id")
    sinks.append_batch(rows, f"{root}/in", 0)
    for name in ("first", "second"):
        checkpoint = f"{root}/checkpoint-{name}"
        write = lambda df, i, c=checkpoint: [sinks.append_batch(df, f"{root}/out", i, sinks.query_of(spark, c)) for _ in range(2)] and None
        table_stream(spark, f"{root}/in", rows.schema, ALL_FILES).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        now = sinks.read_appended(spark, f"{root}/out", rows.schema)
        lost = rows.join(now, "event_id", "left_anti").agg(F.lit(name).alias("run"), F.count(F.lit(1)).alias("lost"))
        part = lost.withColumn("n", F.lit(now.count()))
        out = part if out is None else out.unionByName(part)
    return out


LATE = "event_id % 10 = 0 AND event_time_parsed <= (SELECT max(event_time_parsed) FROM gate WHERE event_id % 10 <> 0) - INTERVAL 7 DAY"


@query(f"""SELECT 'deduplicated' AS name, 'rows_in' AS metric, count(*)::BIGINT AS n FROM raw WHERE topic = 'raw.gate' UNION ALL SELECT 'deduplicated', 'rows', count(*)::BIGINT FROM gate WHERE NOT coalesce({LATE}, false)
  UNION ALL SELECT 'deduplicated', 'dropped_late', count(*)::BIGINT FROM gate WHERE {LATE}
  UNION ALL SELECT 'bronze raw.gate', 'rows_in', count(*)::BIGINT FROM raw WHERE topic = 'raw.gate' UNION ALL SELECT 'bronze raw.gate', 'rows', count(*) FILTER (container_no_raw IS NOT NULL)::BIGINT FROM raw WHERE topic = 'raw.gate'
  UNION ALL SELECT 'bronze raw.gate', 'dead_letters', count(*) FILTER (container_no_raw IS NULL)::BIGINT FROM raw WHERE topic = 'raw.gate' UNION ALL SELECT 'bronze raw.gate', 'dropped_late', 0""")
def stream_tallies(spark, sf):
    """What the batches of two streams observed, read from the table that their listener wrote."""
    root, topic = scratch(spark), TOPICS["gate"]
    rows = given.bronze(spark, sf, "gate")
    with progress.progress_table(spark, f"{root}/progress"):
        for batch_id, part in enumerate((rows.where("event_id % 10 <> 0"), rows.where("event_id % 10 = 0"))):
            sinks.append_batch(part, f"{root}/in", batch_id)
            stream = silver.deduplicated(silver.silver(table_stream(spark, f"{root}/in", rows.schema, ALL_FILES), "gate")).observe("kept", F.count(F.lit(1)).alias("rows"))
            write = lambda df, i: sinks.append_batch(df.select("event_id"), f"{root}/out", i) and None
            stream.writeStream.queryName("deduplicated").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        sinks.publish(envelopes(spark, sf, "gate"), f"{root}/topics/{topic}")
        ingest.start_bronze(envelope_stream(spark, f"{root}/topics/{topic}", ALL_FILES), topic, root, ingest.ONCE).awaitTermination()
    return progress.tallies(progress.read_progress(spark, f"{root}/progress"))


PERIODS = {"week": "date_trunc('week', operational_date)", "month": "date_trunc('month', operational_date)"}


@query(" UNION ALL ".join(f"""SELECT '{p}' AS kind, facility, period, count(*)::BIGINT AS cycles_completed, true AS median_ok, true AS p95_ok
  FROM (SELECT facility, date_trunc('{p}', gate_out_time)::TIMESTAMP AS period FROM cycles WHERE cycle_status = 'CLOSED') GROUP BY 2, 3""" for p in PERIODS))
def dwell_by_sketch(spark, sf):
    """Weeks and months from the stored sketches of days; a quantile is right if its rank among all cycles of the period is within the error of
    a sketch, or that of one cycle."""
    folder, out = f"{scratch(spark)}/sketches", None
    made = given.gate_cycles(spark, sf)
    sinks.append_batch(kpi.dwell_sketches(made), folder, 0)
    closed = made.where("cycle_status = 'CLOSED'").select("facility", F.to_date("gate_out_time").alias("operational_date"), "dwell_time_hours")
    for kind, text in PERIODS.items():
        period = F.expr(text).cast("timestamp")
        merged = kpi.merged_dwell(sinks.read_appended(spark, folder), period, "facility")
        all_of = closed.withColumn("period", period).join(merged, ["facility", "period"])

        def right(c: str, q: float):
            # ranks that the value takes: from the share below it to the share up to it
            low, high = F.avg((F.col("dwell_time_hours") < F.col(c)).cast("double")), F.avg((F.col("dwell_time_hours") <= F.col(c)).cast("double"))
            slack = F.lit(kpi.SKETCH_ERROR) + 1 / F.count(F.lit(1))
            return (low <= F.lit(q) + slack) & (high >= F.lit(q) - slack)

        told = all_of.groupBy("facility", "period").agg(F.count(F.lit(1)).alias("n"), F.max("cycles_completed").alias("cycles_completed"), right("median_dwell_hours", 0.5).alias("median_ok"), right("p95_dwell_hours", 0.95).alias("p95_ok"))
        part = told.where("n = cycles_completed").select(F.lit(kind).alias("kind"), "facility", "period", "cycles_completed", "median_ok", "p95_ok")
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT operational_date, kpi_type, sum(value)::BIGINT AS value, operational_date = DATE '2024-01-20' AS rewritten FROM (
  SELECT operational_date, kpi_type, CASE WHEN operational_date = DATE '2024-01-20' THEN value + 1 ELSE value END AS value FROM shift_kpi) GROUP BY 1, 2""", dates=True)
def upsert_touched_days(spark, sf):
    """Shift figures, again with one day's values changed: that day's files are new, the others' are those of before."""
    key = ["facility", "operational_date", "shift_id", "kpi_type"]
    rows = kpi.shift_kpis(given.clean_events(spark, sf, "gate"), given.clean_events(spark, sf, "yard_move").withColumn("location", F.lit(None).cast("string")), as_of())
    table = sinks.Dated(spark, f"{scratch(spark)}/shift", rows.schema, "operational_date")
    files = lambda: table.days().select(table.own, F.col("_metadata.file_name").alias("file"))
    later = rows.withColumn("value", F.when(F.col("operational_date") == F.lit("2024-01-20").cast("date"), F.col("value") + 1).otherwise(F.col("value")))
    table.upsert(rows, lambda t, s: upsert.replace(t, s, key))
    noted = f"{scratch(spark)}/noted"
    sinks.append_batch(files().distinct().toDF(table.own, "before"), noted, 0)
    before = sinks.read_appended(spark, noted)
    table.upsert(later, lambda t, s: upsert.replace(t, s, key))
    told = files().distinct().join(before, table.own, "left").groupBy(table.own).agg(F.bool_or(~F.col("file").eqNullSafe(F.col("before"))).alias("rewritten"))
    figures = table.days().groupBy(table.own, "kpi_type").agg(F.sum("value").alias("value"))
    return figures.join(told, table.own).withColumnRenamed(table.own, "operational_date")


#: Of a file of a topic that is read by offsets.
FILE_RECORDS = 10_000


@query("""SELECT CASE WHEN n < 700 THEN n // 500 ELSE 2 + (n - 700) // 500 END AS run, count(*)::BIGINT AS n, min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset FROM (
  SELECT kafka_offset, row_number() OVER (ORDER BY kafka_offset) - 1 AS n FROM raw WHERE topic = 'raw.gate' AND kafka_partition = 0) GROUP BY 1""")
def stream_by_offsets(spark, sf):
    """Envelopes of one partition, 500 records a trigger: first those that are there, then, by a query that starts again, those that came since.
    A trigger begins where the one before ended."""
    root = scratch(spark)
    rows = given.raw(spark, sf, "gate").where("topic = 'raw.gate' and kafka_partition = 0")
    rows = rows.withColumn("block", F.shiftright("kafka_offset", 16))  # one partition of a topic is a sequence, numbered by blocks
    before = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).select("block", F.coalesce(before, F.lit(0)).alias("before")), "block")
    seen = {}
    place = F.col("before") + F.row_number().over(Window.partitionBy("block").orderBy("kafka_offset")) - 1
    sent = rows.select(F.col("container_no_raw").alias("key"), F.col("kafka_offset").cast("string").alias("value"), "topic", F.col("kafka_partition").alias("partition"), place.cast("long").alias("offset"), at("2024-06-01 00:00:00").alias("timestamp"))
    sinks.append_batch(sent, f"{root}/sent", 0)  # read twice for each of two parts
    sent = sinks.read_appended(spark, f"{root}/sent")
    for part in (sent.where("offset < 700"), sent.where("offset >= 700")):
        sinks.publish(part, f"{root}/topic", records=FILE_RECORDS)
        # the run is text, as Spark writes numbers into the code that it compiles, anew for each
        write = lambda df, i: sinks.append_batch(df.selectExpr("cast(value as long) as v", f"'{i}' as run"), f"{root}/out", i, small=True, seen=seen) and None
        stream = offset_stream(spark, f"{root}/topic", f"{root}/checkpoint", 500)
        with lone_checkpoints(spark):
            running = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(processingTime="0 seconds").start()
        running.processAllAvailable()
        running.stop()
    got = sinks.read_appended(spark, f"{root}/out", "v long, run string")
    return got.groupBy(F.col("run").cast("long").alias("run")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("first_offset"), F.max("v").alias("last_offset"))


@query(f"""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'S' || event_id END AS seal, CASE WHEN event_id % 4 = 1 THEN (event_id * 2)::VARCHAR END AS weight, event_id % 4 < 2 AS has_more
  FROM raw WHERE topic = 'raw.gate' AND container_no_raw IS NOT NULL""")
def unknown_fields(spark, sf):
    """Payload fields that no schema names, kept beside the others and read back from the bronze table: one as text, one from within a record."""
    root, topic = scratch(spark), TOPICS["gate"]
    rows = given.raw(spark, sf, "gate").where("topic = 'raw.gate'")
    more = F.when(F.col("event_id") % 4 == 1, F.struct((F.col("event_id") * 2).alias("gross")))
    value = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", "container_no_raw", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("S"), "event_id")).alias("seal"), more.alias("load")))
    sent = rows.select(F.col("container_no_raw").alias("key"), value.alias("value"), "topic", F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), at("2024-06-01 00:00:00").alias("timestamp"))
    sinks.publish(sent, f"{root}/topics/{topic}")
    ingest.start_bronze(envelope_stream(spark, f"{root}/topics/{topic}", ALL_FILES), topic, root, ingest.ONCE, keep_unknown=True).awaitTermination()
    table = bronze.promoted(sinks.read_appended(spark, f"{root}/bronze/{topic}"), {"seal": ("$.seal", "string"), "weight": ("$.load.gross", "long")})
    return table.select(F.col("event_id").cast("long").alias("event_id"), "seal", F.col("weight").cast("string").alias("weight"), F.col(bronze.UNKNOWN).isNotNull().alias("has_more"))

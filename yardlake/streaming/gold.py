"""Streams from silver to gold. What a batch costs depends on the batch and on what is still open, not on the history: cycles and
status are kept in state, their tables and change feeds only take what has changed, and the metrics are streaming aggregations over
the feeds, which take away what a change ends and add what it begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardlake.functions import clean
from yardlake.operators import cycles, metrics, status
from yardlake.operators.silver import WATERMARK
from yardlake.schemas import IN_TYPES, OUT_TYPES
from yardlake.session import rocksdb, sent_whole, ship
from yardlake.sources.changes import ChangeFeed, steps
from yardlake.sources.sinks import Merged, Snapshots, query_of
from yardlake.streaming import processors
from yardlake.streaming.processors import KeepStatus, MatchCycles

sent_whole(processors)

GOLD_TRIGGER, METRICS_TRIGGER = {"processingTime": "30 seconds"}, {"processingTime": "1 minute"}
CYCLE_ROW = "container_no_norm string, facility string, gate_in_time timestamp, gate_out_time timestamp, gate_in_truck string, gate_out_truck string, cycle_id string, cycle_status string, dwell_time_hours double"
STATUS_ROW = "container_no_norm string, event_time_parsed timestamp, event_type_norm string, facility string, " + ", ".join(f"{a} string" for a in status.ATTRIBUTES)


def without(row: str, key: str) -> str:
    return ", ".join(c for c in row.split(", ") if not c.startswith(f"{key} "))


class Changing:
    """A gold table that a stateful stream keeps: its rows as merged runs, and the feed of their changes beside it."""

    def __init__(self, spark: SparkSession, folder: str, row: str, key: str):
        rule = lambda rows: newest_change(rows, key)
        self.table = Merged(spark, folder, f"{row}, batch long", rule)
        self.feed = ChangeFeed(spark, f"{folder}_changes", f"{key} string", without(row, key))
        self.names = [*self.feed.keys, *self.feed.columns]

    def add(self, changes: DataFrame, batch_id: int, query: str) -> None:
        """changes: the key, was, now. A batch that is run again after a failure between the two goes on where it stopped."""
        changes = changes.persist()
        self.feed.append(changes, batch_id, query)
        self.table.add(changes.select(*self.feed.keys, "now.*", F.lit(self.table.runs()["made"]).cast("long").alias("batch")), batch_id, query)
        changes.unpersist()

    def read(self) -> DataFrame:
        return self.table.read().drop("batch")


def cycle_table(spark: SparkSession, gold: str) -> Changing:
    return Changing(spark, gold, CYCLE_ROW, "cycle_id")


def status_table(spark: SparkSession, gold: str) -> Changing:
    return Changing(spark, gold, STATUS_ROW, "container_no_norm")


def keep(changes: DataFrame, table, gold: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        table(batch.sparkSession, gold).add(batch, batch_id, query_of(batch.sparkSession, checkpoint))

    with rocksdb(changes.sparkSession):
        return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_cycles(gate: DataFrame, gold: str, checkpoint: str, trigger: dict = GOLD_TRIGGER, watermark: str = WATERMARK) -> StreamingQuery:
    """gate: the silver gate events as a stream. Events that come later than the watermark are dropped, as silver does."""
    return keep(cycle_changes(gate.withWatermark("event_time_parsed", watermark)), cycle_table, gold, checkpoint, trigger)


def newest_change(rows: DataFrame, key: str = "cycle_id") -> DataFrame:
    """Of each key the row of the last batch."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "batch").alias("n")).select(*[f"n.{c}" if c != key else c for c in rows.columns])


def read_cycles(spark: SparkSession, gold: str) -> DataFrame:
    return cycle_table(spark, gold).read()


def stateful_matches(gate: DataFrame) -> DataFrame:
    """Matches as a stateful stream: no table is read or rewritten, and only what a batch changes comes out.

    gate needs a watermark on event_time_parsed. Each (container, facility) keeps its events; what lies before the watermark
    is final and goes, but for the last IN and what follows it. Once that IN is closed for good, which a timer finds where
    no event comes any more, the key has no state: what is kept are recent events and open cycles. Rows are as MatchCycles gives them;
    a later row of an IN replaces the earlier.
    """
    ship(gate.sparkSession)
    known = gate.where("container_no_norm is not null and facility is not null").where(F.col("event_type_norm").isin(IN_TYPES + OUT_TYPES))
    rows = known.select(*cycles.KEY, "event_time_parsed", F.unix_micros("event_time_parsed").alias("t"), F.col("event_type_norm").isin(OUT_TYPES).alias("is_out"), "truck")
    return rows.groupBy(*cycles.KEY).transformWithStateInPandas(MatchCycles(), MatchCycles.OUTPUT, "update", "EventTime")


def cycle_changes(gate: DataFrame) -> DataFrame:
    """cycle_id, was, now: changes of cycles as cycles.cycles() has them."""
    rows = stateful_matches(gate).withColumn("gate_in_time", F.timestamp_micros("i"))

    def image(truck: str, o: str, out_truck: str) -> Column:
        out = F.timestamp_micros(o)
        made = {
            "container_no_norm": F.col("container_no_norm"), "facility": F.col("facility"), "gate_in_time": F.col("gate_in_time"), "gate_out_time": out, "gate_in_truck": F.col(truck), "gate_out_truck": F.col(out_truck),
            "cycle_status": F.when(out.isNull(), "OPEN").otherwise("CLOSED"), "dwell_time_hours": cycles.dwell_hours(F.col("gate_in_time"), out),
        }
        return F.struct(*[c.alias(n) for n, c in made.items()])

    was = F.when(F.col("was_known"), image("was_in_truck", "was_o", "was_out_truck"))
    return rows.select(clean.cycle_id("container_no_norm", "gate_in_time", "facility").alias("cycle_id"), was.alias("was"), image("in_truck", "o", "out_truck").alias("now"))


def status_changes(events: DataFrame) -> DataFrame:
    """container_no_norm, was, now: changes of status as status.current() has it. events: the harmonized events as a stream; any order."""
    ship(events.sparkSession)
    rows = events.select("container_no_norm", F.unix_micros("event_time_parsed").alias("t"), "event_type_norm", "event_id_generated", "facility", *status.ATTRIBUTES)
    found = rows.where("container_no_norm is not null and t is not null").groupBy("container_no_norm").transformWithStateInPandas(KeepStatus(), KeepStatus.OUTPUT, "update", "None")
    image = lambda side: F.struct(F.timestamp_micros(f"{side}_t").alias("event_time_parsed"), F.col(f"{side}_type").alias("event_type_norm"), *[F.col(f"{side}_{c}").alias(c) for c in ("facility", *status.ATTRIBUTES)])
    return found.select("container_no_norm", F.when(F.col("was_known"), image("was")).alias("was"), image("now").alias("now"))


def start_status(events: DataFrame, gold: str, checkpoint: str, trigger: dict = GOLD_TRIGGER) -> StreamingQuery:
    """events: the harmonized events of all kinds as a stream."""
    return keep(status_changes(events), status_table, gold, checkpoint, trigger)


def read_status(spark: SparkSession, gold: str) -> DataFrame:
    return status_table(spark, gold).read()


# Metrics


ENTRIES = "facility string, gate_in_time timestamp, n long"
WAITING = "facility string, backlog_type string, backlog_count long"


def open_entries(changes: DataFrame) -> DataFrame:
    """facility, gate_in_time, n: containers in the yard by time of entry, from the changes of cycles. An entry has no class, which grows with
    the clock, so one table serves every time that is asked for. In a stream this is an aggregation in the state store."""
    own = steps(changes, F.col("cycle_status") == "OPEN", "facility", "gate_in_time")
    return own.groupBy("facility", "gate_in_time").agg(F.sum("step").alias("n")).where("n > 0")


def waiting(changes: DataFrame) -> DataFrame:
    """facility, backlog_type, backlog_count, from the changes of status."""
    typed = lambda side: F.when(F.col(side).isNotNull(), F.struct(F.col(side)["facility"].alias("facility"), metrics.backlog_type(side).alias("backlog_type")))
    slim = changes.select(typed("was").alias("was"), typed("now").alias("now"))
    own = steps(slim, F.col("backlog_type").isNotNull() & F.col("facility").isNotNull(), "facility", "backlog_type")
    return own.groupBy("facility", "backlog_type").agg(F.sum("step").alias("backlog_count")).where("backlog_count > 0")


def start_metric(rows: DataFrame, folder: str, schema: str, checkpoint: str, trigger: dict = METRICS_TRIGGER) -> StreamingQuery:
    """A streaming aggregation, written whole: complete mode."""

    def write(batch: DataFrame, batch_id: int) -> None:
        Snapshots(batch.sparkSession, folder, schema).write(batch, batch_id)

    return rows.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_inventory(spark: SparkSession, root: str, trigger: dict = METRICS_TRIGGER) -> StreamingQuery:
    changes = cycle_table(spark, f"{root}/gold/cycles").feed.stream()
    return start_metric(open_entries(changes), f"{root}/gold/entries", ENTRIES, f"{root}/checkpoints/entries", trigger)


def start_backlog(spark: SparkSession, root: str, trigger: dict = METRICS_TRIGGER) -> StreamingQuery:
    changes = status_table(spark, f"{root}/gold/status").feed.stream()
    return start_metric(waiting(changes), f"{root}/gold/waiting", WAITING, f"{root}/checkpoints/waiting", trigger)


INVENTORY = "facility string, dwell_bucket string, container_count long, max_dwell_hours double, min_dwell_hours double, metric_type string, metric_time timestamp"
BACKLOG = "facility string, backlog_type string, backlog_count long, metric_time timestamp"


def next_refresh(spark: SparkSession, root: str) -> int:
    """The number of the next refresh, also after a restart."""
    done = [Snapshots(spark, f"{root}/gold/{t}", s).current() for t, s in (("inventory", INVENTORY), ("backlog", BACKLOG))]
    return max((n for n in done if n is not None), default=-1) + 1


def inventory_now(spark: SparkSession, root: str, as_of: Column) -> DataFrame:
    return metrics.inventory_of_entries(Snapshots(spark, f"{root}/gold/entries", ENTRIES).read(), as_of)


def backlog_now(spark: SparkSession, root: str) -> DataFrame:
    return Snapshots(spark, f"{root}/gold/waiting", WAITING).read()


def refresh_metrics(spark: SparkSession, root: str, run: int, as_of: Column) -> None:
    """Inventory and backlog as of a time: dwell grows with the clock, though no event comes. What is read are the entries that
    are open and the counts of what waits; no cycle and no status."""
    Snapshots(spark, f"{root}/gold/inventory", INVENTORY).write(inventory_now(spark, root, as_of).withColumn("metric_time", as_of), run)
    Snapshots(spark, f"{root}/gold/backlog", BACKLOG).write(backlog_now(spark, root).withColumn("metric_time", as_of), run)

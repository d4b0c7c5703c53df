"""Current status: one row per container."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.functions import clean

ATTRIBUTES = ["last_location", "last_inspection_severity", "last_repair_stage", "last_cleaning_type"]
KINDS = {
    "gate": ("event_type_norm", {}),
    "yard_move": ("YARD_MOVE", {"last_location": "to_location"}),
    "inspection": ("INSPECTION", {"last_inspection_severity": "severity_norm"}),
    "cleaning": ("event_type_norm", {"last_cleaning_type": "event_type_norm"}),
    "mnr": ("event_type_norm", {"last_repair_stage": "stage_norm"}),
}


def harmonized(silver: DataFrame, kind: str) -> DataFrame:
    """The common columns of one kind; what the kind does not tell is null."""
    event_type, told = KINDS[kind]
    kind_column = F.col(event_type) if event_type == "event_type_norm" else F.lit(event_type)
    rows = silver.where(F.col("container_no_norm").isNotNull())
    return rows.select(
        "container_no_norm", "event_time_parsed", kind_column.alias("event_type_norm"), "facility",
        *[(F.col(told[a]) if a in told else F.lit(None).cast("string")).alias(a) for a in ATTRIBUTES], "event_id_generated",
    )


def all_events(silver: dict[str, DataFrame]) -> DataFrame:
    """All kinds together; a facility that is missing is read from the location."""
    out = None
    for kind in KINDS:
        if kind in silver:
            part = harmonized(silver[kind], kind)
            out = part if out is None else out.unionByName(part)
    return out.withColumn("facility", clean.facility_code(F.coalesce("facility", "last_location")))


def current(events: DataFrame) -> DataFrame:
    """Type and facility of the newest event (ties: greater type, then id), and of each attribute the newest value.

    One aggregation, combined map-side; the order in which events arrive does not count.
    """
    order = F.struct("event_time_parsed", "event_type_norm", "event_id_generated")
    newest = F.max_by(F.struct("event_time_parsed", "event_type_norm", "facility"), order).alias("n")
    attributes = [F.max_by(a, F.when(F.col(a).isNotNull(), order)).alias(a) for a in ATTRIBUTES]
    return events.groupBy("container_no_norm").agg(newest, *attributes).select("container_no_norm", "n.*", *ATTRIBUTES)


def state(events: DataFrame) -> DataFrame:
    """As current, but with the order of the event that told each value beside it, so that states can be merged."""
    order = F.struct("event_time_parsed", "event_type_norm", "event_id_generated")
    told = [F.max(F.when(F.col(a).isNotNull(), F.struct(order.alias("at"), F.col(a).alias("value")))).alias(a) for a in ATTRIBUTES]
    return events.groupBy("container_no_norm").agg(F.max(F.struct(order.alias("at"), F.col("facility").alias("value"))).alias("newest"), *told)


def merged(target: DataFrame, source: DataFrame) -> DataFrame:
    """Two states as one: what the state of all their events would be, in whatever order they came."""
    return newest_state(target.unionByName(source))


def newest_state(states: DataFrame) -> DataFrame:
    """One state of each container."""
    return states.groupBy("container_no_norm").agg(*[F.max(c).alias(c) for c in ("newest", *ATTRIBUTES)])


def visible(states: DataFrame) -> DataFrame:
    """The columns of current()."""
    return states.select(
        "container_no_norm", F.col("newest.at.event_time_parsed").alias("event_time_parsed"), F.col("newest.at.event_type_norm").alias("event_type_norm"),
        F.col("newest.value").alias("facility"), *[F.col(f"{a}.value").alias(a) for a in ATTRIBUTES],
    )


_TOLD = "struct<at: struct<event_time_parsed: timestamp, event_type_norm: string, event_id_generated: string>, value: string>"
STATE = "container_no_norm string, " + ", ".join(f"{c} {_TOLD}" for c in ("newest", *ATTRIBUTES))

"""Bronze rows to silver events, the same for batches and streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardlake.functions import clean
from yardlake.schemas import GATE_TYPES

WATERMARK = "7 days"


@dataclass(frozen=True)
class Kind:
    """facility: candidate columns; time: columns of read_time(); types: how event_type_norm is made, if at all;
    more: further columns; needs: columns that must not be null; business: columns of the event's id."""

    facility: tuple[str, ...]
    time: Callable[[], Column]
    needs: tuple[str, ...]
    business: tuple[str, ...]
    types: Callable[[], Column] | None = None
    more: tuple[tuple[str, str], ...] = ()
    replay: tuple[str, ...] = ("kafka_partition", "kafka_offset")


ID, TIME = "container_no_norm", "event_time_parsed"
KINDS = {
    "gate": Kind(
        ("facility", "location"), lambda: clean.read_time("event_time", "date_raw", "time_raw"), (ID, TIME, "facility", "event_type_norm"),
        (ID, "event_type_norm", TIME, "booking"), lambda: clean.event_type("event_type", GATE_TYPES),
    ),
    "yard_move": Kind(("facility",), lambda: clean.read_time("event_time"), (TIME, "facility"), (ID, TIME, "to_location")),
    "inspection": Kind(
        ("facility",), lambda: clean.read_time("event_time"), (TIME, "facility"), (ID, TIME, "damage_code", "component"), more=(("severity_norm", "severity"),),
    ),
    "cleaning": Kind(
        ("facility",), lambda: clean.read_time(F.coalesce("event_time", "date_in")), (TIME, "facility"), (ID, TIME, "event_type_norm"),
        lambda: clean.label("event_type"), replay=("kafka_partition", "kafka_offset", "source_file", "source_row"),
    ),
    "mnr": Kind(
        ("facility", "location_raw"), lambda: clean.read_time("event_time"), (TIME, "facility"), (ID, TIME, "event_type_norm", "stage_norm"),
        lambda: clean.label("event_type"), (("stage_norm", "stage"),), ("kafka_partition", "kafka_offset", "source_file", "source_row"),
    ),
}


def cleaned(bronze: DataFrame, kind: str, id_of: str = "replay", types: list[str] | None = None) -> DataFrame:
    """Silver columns beside the bronze ones, before any row is rejected. id_of: `replay` also hashes where the record
    lay in the topic, so that only re-reads are equal; `business` hashes the event alone. types: event types of a list of
    one's own (see schemas.TYPES_OF_KIND), others being null.

    What is costly is made by a generator of one row: Spark moves no filter below it, so each value is parsed once,
    whatever is asked of it afterwards.
    """
    k = KINDS[kind]
    made = {"container_no_norm": clean.container_number("container_no_raw"), "facility": clean.facility_code(*k.facility), TIME: k.time()}
    if types or k.types:
        made["event_type_norm"] = clean.event_type("event_type", types) if types else k.types()
    made |= {new: clean.label(old) for new, old in k.more}
    own = "__{}".format
    rows = bronze.select("*", F.inline(F.array(F.struct(*[c.alias(own(n)) for n, c in made.items()]))))
    columns = {"facility_raw": F.col("facility")} | {n: F.col(own(n)) for n in made} | {TIME: clean.in_range(F.col(own(TIME)))}
    ids = k.business + (k.replay if id_of == "replay" else ())
    return rows.withColumns(columns).drop(*map(own, made)).withColumn("event_id_generated", clean.text_id(*ids))


def accepted(kind: str, types: list[str] | None = None) -> Column:
    out = F.lit(True)
    for c in (*KINDS[kind].needs, *(["event_type_norm"] if types else [])):
        out &= F.col(c).isNotNull()
    return out


def silver(bronze: DataFrame, kind: str, id_of: str = "replay", latest: Column | None = None, types: list[str] | None = None) -> DataFrame:
    """Accepted rows, not yet deduplicated. latest: event times after it are rejected, lest one wild date drives the
    watermark past all others. types: see cleaned(); rows of other types are rejected."""
    rows = cleaned(bronze, kind, id_of, types).where(accepted(kind, types))
    return rows if latest is None else rows.where(F.col(TIME) <= latest)


def deduplicated(rows: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per event id. In a stream, ids are kept until the watermark has passed them, and later rows are dropped."""
    if rows.isStreaming:
        return rows.withWatermark(TIME, watermark).dropDuplicatesWithinWatermark(["event_id_generated"])
    return rows.dropDuplicates(["event_id_generated"])


def quality_report(bronze: DataFrame, kind: str) -> DataFrame:
    """One row: kind, total, accepted, and how many rows each check rejects on its own."""
    rows = cleaned(bronze, kind)
    nulls = lambda c: F.count_if(F.col(c).isNull()) if c in rows.columns else F.lit(0).cast("long")
    return rows.agg(
        F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("total"), F.count_if(accepted(kind)).alias("accepted"),
        nulls(ID).alias("null_container"), nulls(TIME).alias("null_time"), nulls("facility").alias("null_facility"), nulls("event_type_norm").alias("null_type"),
    )

"""Staging rows to raw events, and events to topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardlake.functions import clean
from yardlake.schemas import TOPIC_FIELDS, TOPIC_OF_TYPE
from yardlake.sources.tables import FILE, ROW

#: Kinds of staging files: prefix of made ids, words in a file's name that tell the kind, in the order they are published.
KINDS = {
    "gate": ("GATE", ["gate"], "raw.gate"),
    "cleaning": ("CLEAN", ["clean"], "raw.cleaning"),
    "mnr": ("MNR", ["mnr"], "raw.mnr"),
    "yard_move": ("YM", ["yard", "movement"], "raw.yard_move"),
    "inspection": ("INSP", ["inspection", "damage"], "raw.inspection"),
}


def topic_of(event_type: Column) -> Column:
    """Null for spellings that have no topic. The map is a literal of 21 entries."""
    pairs = [F.lit(x) for kv in TOPIC_OF_TYPE.items() for x in kv]
    return F.element_at(F.create_map(*pairs), event_type)


def kind_of_file(path: Column) -> Column:
    name = F.lower(F.substring_index(path, "/", -1))
    out = F.lit(None).cast("string")
    for kind, (_, words, _) in reversed(KINDS.items()):
        out = F.when(F.greatest(*[F.contains(name, F.lit(w)) for w in words]) if len(words) > 1 else F.contains(name, F.lit(words[0])), F.lit(kind)).otherwise(out)
    return out


def _field(df: DataFrame, name: str, default: str | None = None) -> Column:
    value = F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")
    return F.coalesce(value, F.lit(default)) if default is not None else value


def _row(df: DataFrame) -> Column:
    """The row's number in its file, as tables.staging_csv() counts them, or else what the file itself says."""
    return _field(df, ROW if ROW in df.columns else "source_row")


def _made_id(df: DataFrame, prefix: str, own: str | None = None) -> Column:
    """Rows are numbered within their file, so the file is part of the id."""
    made = F.concat_ws("_", F.lit(prefix), *([F.col(FILE)] if FILE in df.columns else []), _row(df))
    return F.coalesce(_field(df, own), made) if own else made


def _type_or(df: DataFrame, topic: str, default: str) -> Column:
    """A type that has no topic at all becomes the default; one of another topic stays, and is routed there."""
    t = F.trim(_field(df, "event_type", default))
    return F.when(topic_of(t).isNotNull(), t).otherwise(F.lit(default))


def _spot(df: DataFrame, side: str) -> Column:
    return F.concat_ws("-", *[_field(df, f"{side}_{x}", "") for x in ("block", "row", "bay", "tier")])


def _finish(df: DataFrame, topic: str, made: dict[str, Column]) -> DataFrame:
    """All fields of the topic: those given, else the staging column of that name; a row without a number gets that of its file."""
    if ROW in df.columns:
        made = {"source_row": F.coalesce(_field(df, "source_row"), _row(df))} | made
    return df.select(*[made.get(f, _field(df, f)).alias(f) for f in TOPIC_FIELDS[topic].split()])


def gate(df: DataFrame, file: str = "stg_gate_events.csv") -> DataFrame:
    t = F.trim(_field(df, "event_type", ""))
    rows = df.where(topic_of(t).isNotNull())
    made = {"event_id": _made_id(df, "GATE"), "event_type": t, "facility": clean.raw_facility(_field(df, "location"))}
    return _finish(rows, "raw.gate", made | {"source_file": _field(df, "source_file", file), "is_synthetic": _field(df, "is_synthetic", "0")})


def cleaning(df: DataFrame, file: str = "stg_cleaning_events.csv") -> DataFrame:
    date_in = F.coalesce(_field(df, "Date In"), _field(df, "Date_In"))
    time = F.coalesce(F.when(F.trim(_field(df, "event_time")) != "", _field(df, "event_time")), F.trim(date_in))
    made = {"event_id": _made_id(df, "CLEAN"), "event_type": _type_or(df, "raw.cleaning", "CLEANING"), "event_time": time, "date_in": date_in}
    made |= {"facility": clean.raw_facility(_field(df, "facility")), "source_file": _field(df, "source_file", file), "is_synthetic": _field(df, "is_synthetic", "0")}
    return _finish(df, "raw.cleaning", made)


def mnr(df: DataFrame, file: str = "stg_mnr_events.csv") -> DataFrame:
    made = {"event_id": _made_id(df, "MNR"), "event_type": _type_or(df, "raw.mnr", "MNR_RECEIVED"), "facility": clean.raw_facility(_field(df, "location_raw"))}
    return _finish(df, "raw.mnr", made | {"source_file": _field(df, "source_file", file), "is_synthetic": _field(df, "is_synthetic", "0")})


def yard_move(df: DataFrame, file: str = "yard_location_movement.csv") -> DataFrame:
    made = {"event_id": _made_id(df, "YM", "move_id"), "event_type": F.lit("yard_move"), "event_time": _field(df, "move_time"), "facility": _field(df, "facility", "UNKNOWN")}
    return _finish(df, "raw.yard_move", made | {"from_location": _spot(df, "from"), "to_location": _spot(df, "to"), "source_file": F.lit(file)})


def inspection(df: DataFrame, file: str = "inspection_damage_report.csv") -> DataFrame:
    made = {"event_id": _made_id(df, "INSP", "inspection_id"), "event_type": F.lit("inspection"), "event_time": _field(df, "inspection_time")}
    return _finish(df, "raw.inspection", made | {"facility": _field(df, "facility", "UNKNOWN"), "source": _field(df, "source", file)})


SHAPES = {"gate": gate, "cleaning": cleaning, "mnr": mnr, "yard_move": yard_move, "inspection": inspection}


def first_rows(df: DataFrame, n: int, by: str | None = None, within: str | None = None) -> DataFrame:
    """The first n rows of each file, or else by a column (source_row, as a number, where none is named), of each value of
    `within` if given. Per value Spark drops rows past n map-side."""
    if by is None and ROW in df.columns:
        return df.where(F.col(ROW) < n)
    by = F.col(by) if by else F.col("source_row").cast("long")
    if within is None:
        return df.orderBy(by).limit(n)
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(within).orderBy(by))).where(F.col("__n") <= n).drop("__n")


#: As the publisher spells the time of publishing. A fixed value.
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def envelope(events: DataFrame, topic: str | None = None, at: Column | None = None) -> DataFrame:
    """key, value (JSON), topic; the topic of the type where none is given. Null fields are left out of the JSON. at: the
    time of publishing, which becomes ingest_time; the current time by default."""
    to = F.lit(topic) if topic else topic_of(F.col("event_type"))
    events = events.withColumn("ingest_time", F.date_format(F.current_timestamp() if at is None else at, STAMP))
    return events.select(F.col("container_no_raw").alias("key"), F.to_json(F.struct("*")).alias("value"), to.alias("topic"))


def all_envelopes(staged: dict[str, DataFrame], limit: int | None = None, at: Column | None = None) -> DataFrame:
    """Envelopes of all kinds, in the order of KINDS; limit: rows of each kind, the first ones."""
    out = None
    for kind in (k for k in KINDS if k in staged):
        rows = first_rows(staged[kind], limit) if limit else staged[kind]
        fixed = KINDS[kind][2] if kind in ("yard_move", "inspection") else None
        part = envelope(SHAPES[kind](rows), fixed, at)
        out = part if out is None else out.unionByName(part)
    return out

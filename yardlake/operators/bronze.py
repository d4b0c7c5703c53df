"""Envelopes to bronze rows and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardlake.schemas import DLQ_REASON, payload

# Names, casts and order of the envelope's columns are fixed values.
KAFKA = ["kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]


#: The column that keeps what a payload has beside the known fields.
UNKNOWN = "unknown_fields"


def unknown(value: Column, known: list[str]) -> Column:
    """The fields of a JSON record that are not known, as one VARIANT: whatever their types, and records within. Null if there are none, or no
    record."""
    fields = F.from_json(value, "map<string, string>")
    others = F.map_filter(fields, lambda k, _: ~k.isin(known))
    # values of the map are JSON texts or plain ones; the variant of the whole record keeps their types
    whole = F.try_parse_json(value)
    each = F.transform(F.map_keys(others), lambda k: F.struct(k, F.try_variant_get(whole, F.lit("$"), "map<string, variant>")[k]))
    return F.when(F.size(others) > 0, F.to_variant_object(F.map_from_entries(each)))


def promoted(bronze: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Bronze rows with columns made of unknown fields: name -> (path, type). Values of another type become null."""
    return bronze.withColumns({name: F.try_variant_get(UNKNOWN, path, kind) for name, (path, kind) in fields.items()})


def parsed(envelopes: DataFrame, topic: str, more: tuple[str, ...] = (), keep_unknown: bool = False) -> DataFrame:
    """The envelope renamed, and the payload as struct `p` (null or all null where the value is no record). more: further
    fields of the payload; keep_unknown: what no schema names becomes the column UNKNOWN."""
    rows = envelopes.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
    ).withColumn("p", F.from_json("kafka_value", payload(topic, more)))
    return rows.withColumn(UNKNOWN, unknown(F.col("kafka_value"), payload(topic, more).names)) if keep_unknown else rows


def is_valid() -> Column:
    return F.coalesce(F.col("p").isNotNull() & F.col("p.container_no_raw").isNotNull(), F.lit(False))


def valid(rows: DataFrame, at: Column) -> DataFrame:
    """Bronze rows; at: the ingest time."""
    return rows.where(is_valid()).select(*KAFKA, at.alias("bronze_ingest_time"), "p.*", *([UNKNOWN] if UNKNOWN in rows.columns else []))


def dead_letters(rows: DataFrame, at: Column) -> DataFrame:
    """Exactly the rows that valid() leaves out."""
    return rows.where(~is_valid()).select("kafka_key", "kafka_value", *KAFKA[1:], F.lit(DLQ_REASON).alias("dlq_reason"), at.alias("dlq_time"))

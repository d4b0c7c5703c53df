"""The streams as queries: the given events as envelope files, through all layers, with the SQL of their batch twins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.plans import given
from yardlake.plans.queries import SILVER, query, silver_sql
from yardlake.schemas import TOPICS, payload
from yardlake.sources.sinks import publish, read_appended
from yardlake.sources.tables import envelope_stream
from yardlake.streaming import gold, ingest, service

#: All files of a folder in one batch, so that no event is late.
ALL_FILES = 1_000_000


def scratch(spark: SparkSession) -> str:
    """A folder of our own in the cluster's shared folder; where there is none, on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.gettempdir()}"
    return f"{shared.rstrip('/')}/yardlake-{uuid.uuid4().hex}"


def envelopes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows, topic = given.bronze(spark, sf_dir, kind).withColumn("event_id", F.col("event_id").cast("string")), TOPICS[kind]
    value = F.to_json(F.struct(*[f.name for f in payload(topic) if f.name in rows.columns]))
    return rows.select(
        F.col("container_no_raw").alias("key"), value.alias("value"), F.lit(topic).alias("topic"), F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.lit("2024-06-01 00:00:00").cast("timestamp").alias("timestamp"),
    )


def ingested(spark: SparkSession, sf_dir: str, kinds, id_of: str = "replay") -> str:
    """The root of a lake that holds bronze and silver of these kinds, each made by its streams. Ids are those of the SQL: each record counts, and
    events of one time and type are told apart by where they lay in the topic."""
    root = scratch(spark)
    for kind in kinds:
        topic = TOPICS[kind]
        publish(envelopes(spark, sf_dir, kind), f"{root}/topics/{topic}")
        ingest.start_bronze(envelope_stream(spark, f"{root}/topics/{topic}", ALL_FILES), topic, root, ingest.ONCE).awaitTermination()
        ingest.start_silver(spark, kind, root, ingest.ONCE, id_of, ALL_FILES).awaitTermination()
    return root


def silver_of(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return read_appended(spark, f"{root}/silver/{kind}", service.silver_schema(kind))


# A bronze row needs a container, which the other kinds' batch twins don't ask for
KEYED = " AND container_no_raw IS NOT NULL"


@query(silver_sql("gate", "event_type_norm").replace("SELECT event_id,", "SELECT CAST(event_id AS VARCHAR) AS event_id,") + KEYED)
def stream_silver_gate(spark, sf):
    return silver_of(spark, ingested(spark, sf, ["gate"]), "gate").select(*SILVER, "event_type_norm")


@query("SELECT * FROM cycles")
def stream_cycles(spark, sf):
    root = ingested(spark, sf, ["gate"])
    at = f"{root}/gold/cycles"
    gold.start_cycles(service.silver_table(spark, root, "gate"), at, f"{root}/checkpoints/cycles", ingest.ONCE).awaitTermination()
    return gold.read_cycles(spark, at)


@query("SELECT * FROM status")
def stream_status(spark, sf):
    root = ingested(spark, sf, list(TOPICS))
    gold.start_status(service.silver_events(spark, root), f"{root}/gold/status", f"{root}/checkpoints/status", ingest.ONCE).awaitTermination()
    return gold.read_status(spark, f"{root}/gold/status")

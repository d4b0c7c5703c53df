"""Streams from envelopes to bronze, dead letters and silver.

Every batch is a folder of its own id that is there wholly or not at all, so a batch that is run again after a failure is
not delivered twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardlake.operators import bronze, silver
from yardlake.schemas import TOPICS, payload
from yardlake.sources.sinks import append_batch, columns_of, query_of
from yardlake.sources.tables import table_stream

#: Triggers of the service.
INGEST_TRIGGER = {"processingTime": "10 seconds"}
ONCE = {"availableNow": True}
#: How far past its ingestion an event's own time may lie.
AHEAD = "INTERVAL 1 DAY"


def bronze_schema(topic: str) -> str:
    fields = ", ".join(f"{f.name} string" for f in payload(topic))
    return f"kafka_key string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, bronze_ingest_time timestamp, {fields}"


def start_bronze(envelopes: DataFrame, topic: str, root: str, trigger: dict = INGEST_TRIGGER, more: tuple[str, ...] = (), keep_unknown: bool = False) -> StreamingQuery:
    """One query for both tables: the batch is parsed once and split. more: payload fields beside the known ones, which
    become columns of the table from then on, and of silver; keep_unknown: all others stay in one column (bronze.promoted() reads them)."""

    checkpoint = f"{root}/checkpoints/bronze/{topic}"

    def write(rows: DataFrame, batch_id: int) -> None:
        query, at = query_of(rows.sparkSession, checkpoint), F.current_timestamp()
        rows = rows.persist()
        append_batch(bronze.valid(rows, at), f"{root}/bronze/{topic}", batch_id, query)
        append_batch(bronze.dead_letters(rows, at), f"{root}/dlq/{topic}", batch_id, query)
        rows.unpersist()

    rows = bronze.parsed(envelopes.where(F.col("topic") == topic), topic, more, keep_unknown)
    rows = rows.observe(f"bronze_{topic}", F.count_if(bronze.is_valid()).alias("rows"), F.count_if(~bronze.is_valid()).alias("dead_letters"))
    return rows.writeStream.queryName(f"bronze {topic}").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def silver_stream(spark: SparkSession, kind: str, root: str, id_of: str = "business", files_per_trigger: int = 100) -> DataFrame:
    """Accepted, deduplicated events of the bronze table as a stream. By default an event that a feed publishes again counts
    once; id_of `replay` removes re-reads of a record only."""
    topic = TOPICS[kind]
    rows = table_stream(spark, f"{root}/bronze/{topic}", bronze_schema(topic), files_per_trigger)
    return silver.deduplicated(silver.silver(rows, kind, id_of, latest=F.col("bronze_ingest_time") + F.expr(AHEAD)))


class NewColumns(Exception):
    """Ends a silver query whose bronze table has columns that it does not read. Its batch is not done: the query that is started next from
    the checkpoint reads it again, with them."""


def start_silver(spark: SparkSession, kind: str, root: str, trigger: dict = INGEST_TRIGGER, id_of: str = "business", files_per_trigger: int = 100) -> StreamingQuery:
    """Rows are counted on the way by observe(), not by a job of their own. Ends with NewColumns when bronze gets some: a table's columns are
    known before the batch that brings them is there."""
    source = f"{root}/bronze/{TOPICS[kind]}"
    rows = silver_stream(spark, kind, root, id_of, files_per_trigger).observe(f"silver_{kind}", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("container_no_norm").isNull()).alias("null_container"))

    checkpoint = f"{root}/checkpoints/silver/{kind}"

    def write(batch: DataFrame, batch_id: int) -> None:
        now = columns_of(batch.sparkSession, source)
        if new := [c for c in (now.names if now else []) if c not in batch.columns]:
            raise NewColumns(f"{source}: {', '.join(new)}")
        append_batch(batch, f"{root}/silver/{kind}", batch_id, query_of(batch.sparkSession, checkpoint), day_of=silver.TIME)

    return rows.writeStream.queryName(f"silver {kind}").foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).start()

"""All streams in one session."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardlake.operators import silver, status
from yardlake.schemas import TOPICS
from yardlake.sources.tables import table_stream
from yardlake.streaming import gold, ingest
from yardlake.streaming.progress import progress_table


def silver_schema(kind: str):
    """As silver() makes it of the kind's bronze rows."""
    spark = SparkSession.active()
    return silver.silver(spark.createDataFrame([], ingest.bronze_schema(TOPICS[kind])), kind).schema


def silver_table(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return table_stream(spark, f"{root}/silver/{kind}", silver_schema(kind))


def silver_events(spark: SparkSession, root: str) -> DataFrame:
    """The harmonized events of all silver tables."""
    return status.all_events({k: silver_table(spark, root, k) for k in TOPICS})


def start_all(spark: SparkSession, envelopes, root: str, trigger: dict | None = None, more: dict[str, tuple[str, ...]] | None = None) -> list:
    """envelopes: function of a topic that gives its stream; more: payload fields of a kind that become columns (see start_bronze()). Each query runs in a
    scheduler pool of its own name."""
    queries = []

    def start(pool: str, f, *args) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        queries.append(f(*args))

    for kind, topic in TOPICS.items():
        start(f"bronze-{kind}", ingest.start_bronze, envelopes(topic), topic, root, trigger or ingest.INGEST_TRIGGER, (more or {}).get(kind, ()))
        start(f"silver-{kind}", ingest.start_silver, spark, kind, root, trigger or ingest.INGEST_TRIGGER)
    when = trigger or gold.GOLD_TRIGGER
    start("cycles", gold.start_cycles, silver_table(spark, root, "gate"), f"{root}/gold/cycles", f"{root}/checkpoints/cycles", when)
    start("status", gold.start_status, silver_events(spark, root), f"{root}/gold/status", f"{root}/checkpoints/status", when)
    start("inventory", gold.start_inventory, spark, root, trigger or gold.METRICS_TRIGGER)
    start("backlog", gold.start_backlog, spark, root, trigger or gold.METRICS_TRIGGER)
    return queries


def catch_up(spark: SparkSession, envelopes, root: str, id_of: str = "business") -> None:
    """Everything there is, layer after layer, then stop: for back-fills and tests. Silver's ids: see ingest.silver_stream."""
    for kind, topic in TOPICS.items():
        ingest.start_bronze(envelopes(topic), topic, root, ingest.ONCE).awaitTermination()
        ingest.start_silver(spark, kind, root, ingest.ONCE, id_of).awaitTermination()
    gold.start_cycles(silver_table(spark, root, "gate"), f"{root}/gold/cycles", f"{root}/checkpoints/cycles", ingest.ONCE).awaitTermination()
    gold.start_status(silver_events(spark, root), f"{root}/gold/status", f"{root}/checkpoints/status", ingest.ONCE).awaitTermination()
    gold.start_inventory(spark, root, ingest.ONCE).awaitTermination()
    gold.start_backlog(spark, root, ingest.ONCE).awaitTermination()


def with_new_columns(spark: SparkSession, query: StreamingQuery, root: str, trigger: dict | None = None) -> StreamingQuery:
    """The query; if it is one of silver and has ended as bronze has new columns, the one that goes on in its place and reads them."""
    error = query.exception()
    if error is None or ingest.NewColumns.__name__ not in str(error):
        return query
    kind = query.name.removeprefix("silver ")
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"silver-{kind}")
    return ingest.start_silver(spark, kind, root, trigger or ingest.INGEST_TRIGGER)


def run(spark: SparkSession, envelopes, root: str, refresh_seconds: int = 60, trigger: dict | None = None, more: dict[str, tuple[str, ...]] | None = None) -> None:
    """Until a query ends; trigger: of all queries, each has its own by default; more: see start_all(). The listener's table is under progress; metrics are
    refreshed on the clock, the only place where it is read. If one fails, its error is raised and the others are stopped; silver queries
    that end as there are new columns go on with them."""
    with progress_table(spark, f"{root}/progress"):
        queries = start_all(spark, envelopes, root, trigger, more)
        try:
            while True:
                queries = [with_new_columns(spark, q, root, trigger) for q in queries]
                if not all(q.isActive for q in queries):
                    break
                spark.streams.resetTerminated()  # queries that had ended before don't end the wait
                try:
                    ended = spark.streams.awaitAnyTermination(refresh_seconds)
                except StreamingQueryException:
                    ended = True  # whose it is, and whether it is one to go on after, the next round tells
                if not ended:
                    gold.refresh_metrics(spark, root, gold.next_refresh(spark, root), F.current_timestamp())
            for error in filter(None, (q.exception() for q in queries)):
                raise error
        finally:
            for q in queries:
                q.stop()

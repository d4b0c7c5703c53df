"""Counts of the streams that arrive: a listener that appends what every batch observed to a table.

Rows are kept in a JSON file a batch of progress events, written by the driver's listener through the file system that the table lies in; a row
is a few hundred bytes and comes once a trigger, whatever the data.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from yardlake.sources.sinks import Files

COLUMNS = "query_id string, run_id string, name string, batch_id long, at string, rows_in long, dropped_late long, state_rows long, observed map<string, map<string, long>>"


class ProgressTable(StreamingQueryListener):
    """Use: `with progress_table(spark, folder):` around the queries. EACH events make a file, and what is left is written when a query ends."""

    EACH = 50

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.rows: list[dict] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: {k: v for k, v in row.asDict().items() if isinstance(v, int)} for name, row in p.observedMetrics.items()}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        with self.lock:
            self.rows.append({
                "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "at": p.timestamp, "rows_in": p.numInputRows, "dropped_late": late,
                "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "observed": observed,
            })
            full = len(self.rows) >= self.EACH
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            Files(self.spark, self.folder).put(f"{self.folder}/progress-{uuid.uuid4().hex}.json", "\n".join(json.dumps(r) for r in rows) + "\n")


class progress_table:
    """The listener is there within the block. On the way out it waits for events that are still queued."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.listener = spark, ProgressTable(spark, folder)

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self.listener)
        return self.listener

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self.listener)
        self.listener.flush()


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row a batch of a query. A batch that ran again after a failure has a row for each run; of those the last counts."""
    if not any(n.endswith(".json") for n in Files(spark, folder).names(folder)):
        return spark.createDataFrame([], COLUMNS)
    rows = spark.read.schema(COLUMNS).json(f"{folder}/*.json")
    names = rows.columns
    last = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct("run_id", "name", "at", "rows_in", "dropped_late", "state_rows", "observed"), F.struct("at", F.col("rows_in") + F.col("dropped_late"))).alias("r"))
    return last.select("query_id", "batch_id", "r.*").select(*names)


def tallies(progress: DataFrame) -> DataFrame:
    """name, metric, n: rows read, rows dropped behind the watermark, and every observed metric, over all batches of a query's name."""
    known = F.map_from_arrays(F.array(F.lit("rows_in"), F.lit("dropped_late")), F.array("rows_in", "dropped_late"))
    observed = F.aggregate(F.map_values(F.coalesce("observed", F.create_map().cast("map<string, map<string, long>>"))), F.create_map().cast("map<string, long>"), lambda acc, m: F.map_zip_with(acc, m, lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))))
    each = progress.select("name", F.explode(F.map_concat(known, observed)).alias("metric", "n"))
    return each.groupBy("name", "metric").agg(F.sum("n").alias("n"))

"""How full and how fresh the layers are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAUGHT_UP_MIN, CURRENT_MIN = 2.0, 1.0


def table_health(tables: dict[tuple[str, str], tuple[DataFrame, str]]) -> DataFrame:
    """tables: (layer, name) -> (df, time column). One row each: layer, table_name, n, latest."""
    out = None
    for (layer, name), (df, time) in tables.items():
        row = df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.max(F.col(time).cast("timestamp")).alias("latest"))
        out = row if out is None else out.unionByName(row)
    return out


def stored_health(spark: SparkSession, tables: dict[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """As table_health(), over Parquet tables: (layer, name) -> (folder, a column of microseconds). Rows and latest times come from the
    files' footers; no column is read. Footers have no bounds of timestamps that Spark trusts, so the tables keep the microseconds beside.

    Spark pushes aggregates into its second Parquet reader only, which the query's own session is set to use."""
    own = spark.newSession()
    for name, value in FOOTERS.items():
        own.conf.set(name, value)
    # the columns as the files have them: Spark finds a footer's statistics by the place of the column
    found = {k: own.read.parquet(folder).agg(F.count(F.lit(1)).alias("n"), F.max(micros).alias("latest")) for k, (folder, micros) in tables.items()}
    out = None
    for (layer, name), row in found.items():
        part = row.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n", F.timestamp_micros("latest").alias("latest"))
        out = part if out is None else out.unionByName(part)
    return out


FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def lag(health: DataFrame) -> DataFrame:
    """One row: minutes that gold is behind silver, and the verdict on it."""
    at = lambda layer: F.max(F.when(F.col("layer") == layer, F.col("latest")))
    both = health.agg(at("silver").alias("silver_latest"), at("gold").alias("gold_latest"))
    minutes = (F.unix_timestamp("silver_latest") - F.unix_timestamp("gold_latest")) / F.lit(60.0)
    verdict = F.when(F.col("lag_minutes") < CURRENT_MIN, "UP_TO_DATE").when(F.col("lag_minutes") < CAUGHT_UP_MIN, "CAUGHT_UP").otherwise("BEHIND")
    return both.withColumn("lag_minutes", F.round(minutes, 3)).withColumn("verdict", verdict)


def layer_ratio(health: DataFrame) -> DataFrame:
    """One row: rows of each layer, and of gold per row of silver."""
    n = lambda layer: F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("n"))), F.lit(0))
    totals = health.agg(*[n(x).alias(f"{x}_rows") for x in ("bronze", "silver", "gold")])
    return totals.withColumn("gold_per_silver", F.round(F.try_divide(F.col("gold_rows"), F.col("silver_rows")), 6))

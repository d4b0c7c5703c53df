"""Reading tables, as batches and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardlake.schemas import ENVELOPE
from yardlake.sources.sinks import DAY, columns_of, make_folder, widened


#: The column of staging_csv() that numbers a file's rows.
ROW = "row_number"
#: The one that tells its files apart: eight hexadecimal digits of its path's MD5.
FILE = "file_id"


def staging_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV files with a header, all text, and the number of each row in its file (ROW, from 0; FILE tells the file). Without `columns` the header
    is read for them, never the types."""
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return numbered(reader.csv(path))


def numbered(files: DataFrame) -> DataFrame:
    """Rows of files as read, numbered in order. Spark's tasks number the rows of each byte range; how many rows lie in the
    ranges before it is a sum over one row a range."""
    place = ["__file", "__range"]
    at = [F.col("_metadata.file_path").alias(place[0]), F.col("_metadata.file_block_start").alias(place[1])]
    rows = files.select("*", *at, F.monotonically_increasing_id().alias("__id"))
    ranges = rows.groupBy(*place).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(place[0]).orderBy(place[1]).rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*place, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return rows.join(ranges, place).select(*files.columns, (F.col("__id") + F.col("__shift")).alias(ROW), F.substring(F.md5(place[0]), 1, 8).alias(FILE))


def topic_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 3000) -> DataFrame:
    """A Kafka topic from its earliest offset; lost offsets don't stop it. Needs the Kafka connector. Its columns are those of
    envelope_stream, so `service.run(spark, lambda topic: topic_stream(spark, servers, topic), root)` runs on Kafka."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": "false"}
    return spark.readStream.format("kafka").options(**options).load()


def envelope_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """The same columns from Parquet files of envelopes."""
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def table_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Rows appended to a table that sinks.append_batch writes: the columns of `schema`, and those that the table has besides."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = widened(schema, columns_of(spark, folder) or schema)
    make_folder(spark, folder)  # a stream may start before the table's first batch
    # what the folders are named by must be named too; of a table that is not laid out by date the day is null
    named = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType()), T.StructField(DAY, T.DateType())])
    return spark.readStream.schema(named).option("maxFilesPerTrigger", files_per_trigger).parquet(folder).select(*schema.names)


def between(df: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    """Rows in [start, end]; on a plain column Spark pushes it down to the files' row groups. Of a table that is laid out by date the other days'
    folders are not even listed."""
    rows = df.where(F.col(time).between(start, end))
    return rows.where(F.col(DAY).between(F.to_date(start), F.to_date(end))) if DAY in df.columns else rows


def on_days(df: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows of the days that `days` holds; its filter on the days is what Spark prunes df's folders by when it runs."""
    return df.join(days.select(F.col(day).alias(DAY)).distinct(), DAY, "left_semi")

"""Writing tables: exactly-once appends, versioned snapshots and the catalog.

A keyed table that is small, or made anew each time, is a folder of versions, one per batch, and a file that names the
current one (Snapshots). A batch that is run again starts from the version before its own, so a replay changes nothing. A
keyed table that grows with its streams is a list of runs, merged where they are read (Merged).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import partial, reduce
from operator import and_

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardlake.session import ship

KEEP = 3


class Files:
    """The Hadoop file system that a path lies in."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, p: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(p))] if self.exists(p) else []

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def put(self, p: str, text: str) -> None:
        """Written aside and renamed over the old one, so that a reader sees one or the other."""
        out = self.fs.create(self.path(f"{p}.new"), True)
        out.write(bytearray(text.encode()))
        out.close()
        overwrite = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(overwrite, 1)
        how[0] = overwrite.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf()).rename(self.path(f"{p}.new"), self.path(p), how)

    def move(self, p: str, to: str) -> None:
        if not self.fs.rename(self.path(p), self.path(to)):
            raise OSError(f"{p} could not be renamed to {to}")

    def get(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text


def make_folder(spark: SparkSession, folder: str) -> None:
    files = Files(spark, folder)
    files.fs.mkdirs(files.path(folder))


SCHEMA = "_columns.json"


def columns_of(spark: SparkSession, folder: str) -> T.StructType | None:
    """The columns of all batches appended to a folder so far; None before the first."""
    files, at = Files(spark, folder), f"{folder}/{SCHEMA}"
    return T.StructType.fromJson(json.loads(files.get(at))) if files.exists(at) else None


def widened(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """Known columns, then those that are new; a column that changes its type is refused."""
    plain = lambda fields: T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    if known is None:
        return plain(new)
    types = {f.name: f.dataType for f in known}
    for f in new:
        if types.get(f.name, f.dataType).simpleString() != f.dataType.simpleString():  # nulls may be in any column
            raise ValueError(f"column {f.name} was {types[f.name].simpleString()} and now is {f.dataType.simpleString()}")
    return plain([*known, *(f for f in new if f.name not in types)])


def query_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to. Its batches are numbered from 0, and so are those of the next checkpoint,
    whose query has another id."""
    return json.loads(Files(spark, checkpoint).get(f"{checkpoint}/metadata"))["id"]


#: The folder level by which a table that is laid out by date is pruned.
DAY = "event_day"


def write_part(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows as one file, of the same name in each attempt; its number of rows."""
    task = TaskContext.get()
    system, root = fs.FileSystem.from_uri(folder)
    aside, name, n, writer = f"{root}/_{task.partitionId()}-{task.taskAttemptId()}", f"part-{task.partitionId():05d}.parquet", 0, None
    for batch in batches:
        if batch.num_rows:
            if writer is None:
                system.create_dir(root, recursive=True)
                writer = pq.ParquetWriter(aside, batch.schema, filesystem=system)
            writer.write_batch(batch)
            n += batch.num_rows
    if writer is not None:
        writer.close()
        system.move(aside, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"n": [n]})


def write_small(df: DataFrame, folder: str) -> None:
    """A batch of few rows as Parquet, a file for each task that has some, in a folder that is not there. Spark's own writer sends the settings of the
    file system to every task and makes, moves and marks folders, which takes longer than the rows of such a batch. folder: a URI that Arrow's file
    systems know."""
    ship(df.sparkSession)
    if not df.mapInArrow(partial(write_part, folder), "n long").collect():
        make_folder(df.sparkSession, folder)


def append_batch(df: DataFrame, folder: str, batch_id: int, query: str = "", day_of: str | None = None, small: bool = False, seen: dict | None = None) -> bool:
    """Rows of one batch, once: the batch is written aside and renamed into the table, so a reader sees all of it or
    nothing, and a batch that is there already is not written again. New columns are added to the table's. False: it was
    there. query: see query_of(); a batch is known by it and its number. day_of: a column of times, by whose dates the batch is laid out
    in folders (read_days() reads them). small: the batch has few rows, see write_small(). seen: kept by a query from batch to batch, so that it reads the
    table's columns, which only grow, for batches with new ones alone. (On stores without an atomic rename of folders, a reader
    must wait for the batch's _SUCCESS file, which small ones don't have.)"""
    spark, name = df.sparkSession, f"{query}-{batch_id}" if query else f"{batch_id}"
    files, place, aside = Files(spark, folder), f"{folder}/batch_id={name}", f"{folder}/_new-{name}"
    if files.exists(place):
        return False
    seen, own = {} if seen is None else seen, df.schema
    if folder not in seen or widened(seen[folder], own) != seen[folder]:
        known = columns_of(spark, folder)
        if (now := widened(known, own)) != known:
            files.put(f"{folder}/{SCHEMA}", now.json())
        seen[folder] = now
    if day_of:
        # a day's rows of a batch meet in one task, so that a batch has a file a day and not one for each task and day
        dealt = df.withColumn(DAY, F.to_date(day_of)).repartition(DAY)
        dealt.sortWithinPartitions(day_of).write.mode("overwrite").partitionBy(DAY).parquet(aside)
    elif small:
        files.delete(aside)
        write_small(df, aside)
    else:
        df.write.mode("overwrite").parquet(aside)
    files.move(aside, place)
    return True


def read_appended(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    """All rows appended so far, with all columns that any batch had; rows of `schema`, but none, before the first."""
    known = columns_of(spark, folder)
    if known is None or not any(n.startswith("batch_id=") for n in Files(spark, folder).names(folder)):
        return spark.createDataFrame([], schema or known or T.StructType())
    return spark.read.schema(known).option("basePath", folder).parquet(folder).select(*known.names)


def read_days(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a table that is laid out by date, with DAY. A bound on DAY, or a join with a filtered set of days, opens those days' folders
    only."""
    fields = T.StructType([*columns_of(spark, folder).fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(fields).option("basePath", folder).parquet(folder).select(*fields.names)


class Merged:
    """A keyed table as runs of partial rows, which `rule` makes one row a key of: rows -> rows, whatever their order, and
    the same if some were merged before. A batch only adds its own run. FANOUT runs of a level are merged into one of the
    next, so that a row is rewritten as often as the table has levels, not with every batch."""

    FANOUT = 8

    def __init__(self, spark: SparkSession, folder: str, schema, rule: Callable[[DataFrame], DataFrame]):
        self.spark, self.folder, self.schema, self.rule = spark, folder, schema, rule
        self.files = Files(spark, folder)

    def runs(self) -> dict:
        """The last batch of each query, how many batches there were, the runs of each level, and runs that the last batch has
        replaced, which readers may still use."""
        at = f"{self.folder}/_runs.json"
        return json.loads(self.files.get(at)) if self.files.exists(at) else {"done": {}, "made": 0, "levels": [], "old": []}

    def _rows(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{n}" for n in names])

    def add(self, batch: DataFrame, batch_id: int, query: str = "") -> bool:
        """Adds a batch, once; query: see query_of(). What is not named in the list of runs is not part of the table, so a failure
        leaves it as it was."""
        now = self.runs()
        if batch_id <= now["done"].get(query, -1):
            return False
        number = now["made"]
        levels, replaced, name, level = now["levels"], [], f"run-{number}-0", 0
        self.rule(batch).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        while True:
            if len(levels) <= level:
                levels.append([])
            levels[level].append(name)
            if len(levels[level]) < self.FANOUT:
                break
            full, levels[level] = levels[level], []
            replaced += full
            level, name = level + 1, f"run-{number}-{level + 1}"
            self.rule(self._rows(full)).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        # first what the list names, so that a failure in between leaves nothing that no list names
        for n in now["old"]:
            self.files.delete(f"{self.folder}/{n}")
        done = now["done"] | {query: batch_id}
        self.files.put(f"{self.folder}/_runs.json", json.dumps({"done": done, "made": number + 1, "levels": levels, "old": replaced}))
        return True

    def read(self) -> DataFrame:
        names = [n for level in self.runs()["levels"] for n in level]
        return self.rule(self._rows(names)) if names else self.spark.createDataFrame([], self.schema)


class Snapshots:
    """A keyed table."""

    def __init__(self, spark: SparkSession, folder: str, schema):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.files = Files(spark, folder)

    def versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in self.files.names(self.folder) if n.startswith("v="))

    def current(self) -> int | None:
        at = f"{self.folder}/_current"
        return int(self.files.get(at)) if self.files.exists(at) else None

    def read(self, below: int | None = None) -> DataFrame:
        """The current version, or the last one below a batch; an empty table if there is none."""
        now = self.current()
        fit = [] if now is None else [v for v in self.versions() if v <= now and (below is None or v < below)]
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/v={fit[-1]}") if fit else self.spark.createDataFrame([], self.schema)

    @property
    def place(self) -> str:
        return f"{self.folder}/v={self.current()}"

    def write(self, df: DataFrame, batch_id: int, name: tuple[str, str] | None = None) -> None:
        """The table as of this batch; older versions but KEEP go. name: schema and table under which it is registered; it is pointed to the
        new version before old ones go."""
        df.select([f.name for f in self.read(-1).schema]).write.mode("overwrite").parquet(f"{self.folder}/v={batch_id}")
        self.files.put(f"{self.folder}/_current", str(batch_id))
        if name:
            register(self.spark, *name, self.place)
        for old in [v for v in self.versions() if v <= batch_id][:-KEEP]:
            self.files.delete(f"{self.folder}/v={old}")

    def upsert(self, source: DataFrame, batch_id: int, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """rule: one of operators.upsert, target and source to the next target."""
        self.write(rule(self.read(below=batch_id), source), batch_id)


class Dated:
    """A keyed table in one folder a day, of which an upsert rewrites only those that it changes: dynamic partition overwrite.

    date: a column of the rows that is part of the key. A day's folder is replaced when the job commits; readers of several days may see
    some of them before and some after."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, date: str):
        self.spark, self.folder, self.schema, self.date = spark, folder, schema, date
        self.files = Files(spark, folder)
        self.own = f"{date}_part"

    @property
    def place(self) -> str:
        return self.folder

    def read(self) -> DataFrame:
        return self.days().drop(self.own)

    def days(self) -> DataFrame:
        """With the day that a row lies under, which Spark prunes folders by."""
        fields = T.StructType([*self.schema.fields, T.StructField(self.own, T.DateType())])
        if not any(n.startswith(f"{self.own}=") for n in self.files.names(self.folder)):
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(self.folder)

    def upsert(self, source: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame], ignore: tuple[str, ...] = ()) -> None:
        """rule: one of operators.upsert, target and source of the days that change to their next rows. A day is changed if a row of source is not in it as it
        is, columns to `ignore` (as the time of computing) aside; a source that changes nothing writes nothing. Repeating it changes nothing."""
        values = [c for c in self.schema.names if c not in ignore]
        source = source.select(*self.schema.names).persist()
        day = F.to_date(self.date).alias(self.own)
        bounds = source.agg(F.min(F.to_date(self.date)), F.max(F.to_date(self.date))).first()
        if bounds[0] is not None:
            there = self.days().where(F.col(self.own).between(*map(F.lit, bounds)))
            same = [source[c].eqNullSafe(there[c]) for c in values]
            changed = source.join(there, reduce(and_, same), "left_anti").select(day).distinct().persist()
            target = there.join(changed, self.own, "left_semi").drop(self.own)
            now = rule(target, source.withColumn(self.own, F.to_date(self.date)).join(changed, self.own, "left_semi").drop(self.own))
            made = now.select(*self.schema.names, day).repartition(self.own)
            made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.own).parquet(self.folder)
            changed.unpersist()
        source.unpersist()


def ensure_table(spark: SparkSession, folder: str, schema) -> Snapshots:
    """The table, made empty if it isn't there."""
    table = Snapshots(spark, folder, schema)
    if table.current() is None:
        table.write(spark.createDataFrame([], schema), -1)
    return table


def register(spark: SparkSession, schema: str, name: str, path: str) -> None:
    """An external table over a Parquet folder. A known name is pointed to the new place in one step, so that readers find the one or the
    other; where the columns have changed, the table is made anew."""
    full = f"{schema}.{name}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    if spark.catalog.tableExists(full):
        if spark.table(full).schema.simpleString() == spark.read.parquet(path).schema.simpleString():
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        else:
            spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)  # the catalog keeps a list of them, and new ones may have come
    spark.catalog.refreshTable(full)


def publish(envelopes: DataFrame, folder: str, files: int | None = None, records: int | None = None) -> None:
    """Envelopes with partition, offset and timestamp, as envelope_stream reads them. records: in the order of their offsets, so many a file at
    most, so that a trigger of offset_stream reads what it takes and not all that there is."""
    if records:
        envelopes = envelopes.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
    rows = envelopes.coalesce(files) if files else envelopes
    rows.write.mode("append").option("maxRecordsPerFile", records or 0).parquet(folder)


def publish_kafka(envelopes: DataFrame, servers: str) -> None:
    """key, value, topic to Kafka. Needs the Kafka connector."""
    envelopes.select("key", "value", "topic").write.format("kafka").option("kafka.bootstrap.servers", servers).save()

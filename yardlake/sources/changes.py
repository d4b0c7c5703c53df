"""What has changed in a keyed table, by version: a table of changes that is only ever appended to.

Every batch of changes is a version. A change has the row's key, whether it was inserted or updated, its values before and
after. Readers may begin at any version, as a batch (`since`, the net change of each key) or as a stream (`stream`, every change
once), and stop and go on; they read the changes only, never the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardlake.sources.sinks import Files, append_batch, read_appended
from yardlake.sources.tables import table_stream

INSERT, UPDATE = "insert", "update"


class ChangeFeed:
    """key, columns: of the table; a change holds the latter in the structs `was` (null for an insert) and `now`."""

    def __init__(self, spark: SparkSession, folder: str, key: str, columns: str):
        self.spark, self.folder = spark, folder
        self.key = T.StructType.fromDDL(key)
        self.keys = self.key.names
        values = T.StructType.fromDDL(columns)
        self.columns = values.names
        self.schema = T.StructType([*self.key.fields, T.StructField("version", T.LongType()), T.StructField("change", T.StringType()), T.StructField("was", values), T.StructField("now", values)])

    def latest(self) -> int:
        """The last version; -1 before the first."""
        return sum(n.startswith("batch_id=") for n in Files(self.spark, self.folder).names(self.folder)) - 1

    def append(self, changes: DataFrame, batch_id: int, query: str = "") -> bool:
        """changes: the key, was, now. One writer at a time; a batch that is there is not appended again (False)."""
        kind = F.when(F.col("was").isNull(), INSERT).otherwise(UPDATE)
        rows = changes.withColumns({"version": F.lit(self.latest() + 1).cast("long"), "change": kind})
        return append_batch(rows.select(*self.schema.names), self.folder, batch_id, query)

    def read(self) -> DataFrame:
        return read_appended(self.spark, self.folder, self.schema)

    def stream(self, after: int = -1, files_per_trigger: int = 100) -> DataFrame:
        """Every change after a version, once; by default all that there have been."""
        return table_stream(self.spark, self.folder, self.schema, files_per_trigger).where(F.col("version") > after)

    def since(self, version: int, upto: int | None = None) -> DataFrame:
        """The net change of each key after a version, and not after another if given: key, change, was, now. A row that is
        again what it was is left out. Versions are bounds on a plain column, which Spark checks in the files' footers."""
        rows = self.read().where(F.col("version") > version)
        if upto is not None:
            rows = rows.where(F.col("version") <= upto)
        first = F.min_by(F.struct("change", "was"), "version").alias("first")
        net = rows.groupBy(*self.keys).agg(first, F.max_by("now", "version").alias("now")).select(*self.keys, "first.*", "now")
        return net.where((F.col("change") == INSERT) | ~F.col("was").eqNullSafe(F.col("now")))

    def as_of(self, version: int) -> DataFrame:
        """The table as it was at a version."""
        rows = self.read().where(F.col("version") <= version)
        return rows.groupBy(*self.keys).agg(F.max_by("now", "version").alias("now")).select(*self.keys, "now.*")


def steps(changes: DataFrame, counts: Column, *by: str) -> DataFrame:
    """Changes as retractions: step is -1 for a row that was counted and 1 for one that is now. counts: whether a row counts, over
    its columns; by: what it is counted by. One pass: each change gives two rows at most."""
    each = F.explode(F.array(F.struct(F.lit(-1).alias("step"), F.col("was").alias("row")), F.struct(F.lit(1).alias("step"), F.col("now").alias("row"))))
    return changes.select(each.alias("e")).select("e.step", "e.row.*").where(counts).select("step", *by)

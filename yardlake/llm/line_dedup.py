"""Line deduplication over levelled sorted runs of line hashes.

A run is a table (h1, h2, n_docs, last_doc), bucketed and sorted by hash: its keys, with the documents of a batch that
hold them and the largest of their ids. Every batch is anti-joined with the runs, bucket by bucket, so that nothing is
shuffled again: keys that no run holds become a run of level 0, counts of the others go to a run of repeats. Two runs of
a level are merged into one of the next. So each key is in one run only, and what is counted over all batches is the
repeats. Runs hold 128-bit hashes, never lines.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import RAW, own_names, remove, scratch, written

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS = 40, 5
BATCHES = 4
RUN = "h1 long, h2 long, n_docs long, last_doc long"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


class LineRuns:
    """The runs under one folder, as external tables of the session's catalog; close() takes them away.

    buckets: of every run; the default is the shuffle partitions, so that a bucket is about what a task handles.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        self.spark, self.folder = spark, folder or scratch(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.repeats: list[list[str]] = []
        self.made = 0
        self.there: set[str] = set()

    def _write(self, run: DataFrame) -> str:
        """run: dealt by key, so that a task writes one bucket."""
        name = f"{self.name}_{self.made}"
        self.made += 1
        self.there.add(name)
        run.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).options(**RAW).option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, f"{self.folder}/{name}")
        self.there.discard(name)

    @staticmethod
    def _names(levels: list[list[str]]) -> list[str]:
        return [name for level in levels for name in level]

    def _with(self, rows: DataFrame, run: str, how: str) -> DataFrame:
        """rows and a run joined by key, counts added up."""
        more = self.spark.table(run).toDF(*KEY, "n_more", "later").hint("merge")
        total = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_more", F.lit(0))
        return rows.join(more, KEY, how).select(*KEY, total.alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc"))

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows (h1, h2, ...) whose key no run holds: an anti-join with one run after another."""
        for name in self._names(self.levels):
            rows = rows.join(self.spark.table(name).hint("merge"), KEY, "left_anti")
        return rows

    def _put(self, levels: list[list[str]], name: str) -> None:
        """A new run in level 0; full levels are compacted, each bucket on its own."""
        level = 0
        while True:
            if len(levels) <= level:
                levels.append([])
            levels[level].append(name)
            if len(levels[level]) < 2:
                return
            old, levels[level] = levels[level], []
            name = self._write(self._with(self.spark.table(old[0]), old[1], "full"))
            for x in old:
                self._drop(x)
            level += 1

    def add(self, lines: DataFrame) -> None:
        """lines: h1, h2, doc_id of one batch; a document must not be spread over batches."""
        once = lines.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one"))
        counted = once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        own = self._write(counted.repartition(self.buckets, *KEY))
        if not any(self.levels):
            return self._put(self.levels, own)
        batch = self.spark.table(own)
        new = self._write(self.unseen(batch))
        again = self._write(batch.join(self.spark.table(new).hint("merge"), KEY, "left_anti"))
        self._drop(own)
        self._put(self.levels, new)
        self._put(self.repeats, again)

    def table(self) -> DataFrame:
        """Each key once, over all batches: every run with the repeats of its keys."""
        out = self.spark.createDataFrame([], RUN)
        for name in self._names(self.levels):
            rows = self.spark.table(name)
            for again in self._names(self.repeats):
                rows = self._with(rows, again, "left")
            out = out.union(rows)
        return out

    def close(self) -> None:
        """Takes away whatever there is, also after a failure."""
        for name in sorted(self.there):
            self._drop(name)
        self.levels, self.repeats = [], []


def lines_of(df: DataFrame) -> DataFrame:
    """df: doc, r1, r2, text. Gives doc, r1, r2, pos, h1, h2 of the lines whose key has MIN_CHARS code points or more."""
    lines = df.select("doc", "r1", "r2", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    key = lines.select("doc", "r1", "r2", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= MIN_CHARS)
    return key.select("doc", "r1", "r2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def repeated(lines: DataFrame, batches: int = BATCHES) -> DataFrame:
    """lines: doc, r1, r2, pos, h1, h2. Gives doc, r1, r2, pos of the lines to drop: keys in at least MIN_DOCS documents,
    but for those of the largest document that holds the key."""
    spark = lines.sparkSession
    runs = LineRuns(spark)
    kept = scratch(spark, "lines")
    lines.withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches))).write.partitionBy("batch").options(**RAW).parquet(kept)
    lines = spark.read.schema("doc long, r1 long, r2 long, pos int, h1 long, h2 long, batch int").parquet(kept)
    try:
        for batch in range(batches):
            runs.add(lines.where(F.col("batch") == batch).withColumnRenamed("doc", "doc_id"))
        # written first, so that both sides of the join are plain shuffles and Spark splits the partition of a hot line
        gone = written(runs.table().where(F.col("n_docs") >= MIN_DOCS).select(*KEY, "last_doc"), "lines-gone")
    finally:
        runs.close()
    return lines.join(gone, KEY).where("doc <> last_doc").select("doc", "r1", "r2", "pos")


def without(texts: pd.Series, positions: pd.Series) -> pd.Series:
    """The texts less the lines at these positions; null for a null text."""

    def cut(text: str, gone) -> str:
        gone = set(gone)
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)

    return pd.Series([None if t is None else cut(t, p) for t, p in zip(texts, positions, strict=True)], dtype=object)


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "line_dedup") -> DataFrame:
    """df with a struct column: n_lines (before), n_dropped, kept. A column of that name is replaced.

    A null or empty text is one empty line. Rows of one doc_id count as one document, whatever they hold, and each loses
    its own lines of the same keys; a null doc_id counts as a document below all others. Lines of fewer than MIN_CHARS
    code points stay. Ids are whole numbers, or text that Spark casts to them; an empty df gives no rows. Long texts are
    split whole. Other columns keep their values, whatever their names.
    """
    low = -(1 << 63)
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(low))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # positions are those of one text: rows of one id and text share them, other rows of the id have their own
    r1, r2 = F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)
    lines = lines_of(df.select(doc.alias("doc"), r1.alias("r1"), r2.alias("r2"), whole.alias("text")))
    gone = repeated(lines).groupBy("doc", "r1", "r2").agg(F.collect_set("pos").alias("gone"))
    names = own_names(df, "doc", "r1", "r2", "gone")
    side, (its_doc, its_r1, its_r2, its) = gone.toDF(*names), map(F.col, names)
    joined = df.join(side, (doc == its_doc) & (r1 == its_r1) & (r2 == its_r2), "left")
    ship(df.sparkSession)
    # only texts that lose lines go to Python
    cut = F.pandas_udf(without, "string")(F.when(its.isNotNull(), whole), its)
    made = F.struct(
        (F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size(its), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(cut, whole).alias("kept"),
    )
    return joined.withColumn(into, made).drop(*names)

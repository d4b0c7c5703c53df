"""What the training-data operators share: tables, the shared folder and Arrow slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.session import ship

#: Text bytes that a Python worker handles at once, unless one row alone has more.
SLICE_BYTES = 1 << 20
#: Tasks that write a table of ids and labels, for each core of the cluster, at most.
TASKS_PER_CORE = 4
#: Of writes to the shared folder, where it is a local one or mounted: no checksum file beside each file. Without Hadoop's native library a process
#: (chmod) is started for each file and folder that is made, and while it starts it counts as one more of the JVM's size. Other stores are not touched.
RAW = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(1)
def own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='yardlake-')}"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir; where it is unset (tests), one of our own on this machine."""
    return spark.conf.get("spark.checkpoint.dir", None) or own_folder()


class Scratch:
    """The scratch paths of one run, and of no other that the driver has."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def clean_up(self, spark: SparkSession, keep: DataFrame | None = None) -> None:
        """Removes the run's paths, but for those that `keep` reads. Only for when no DataFrame that reads them is still to be run."""
        used = [f.rpartition("/")[0] for f in keep.inputFiles()] if keep is not None else []
        plain = lambda p: p.removeprefix("file:").lstrip("/")
        kept = {plain(p) for p in used}
        for path in self.paths:
            if plain(path) not in kept:
                remove(spark, path)
        self.paths = [p for p in self.paths if plain(p) in kept]


_run: ContextVar[Scratch | None] = ContextVar("scratch of the run", default=None)


@contextmanager
def scratch_of_run() -> Iterator[Scratch]:
    """What scratch() makes within the block, in this thread, belongs to the run; what is left then belongs to the run around it."""
    outer, own = _run.get(), Scratch()
    token = _run.set(own)
    try:
        yield own
    finally:
        _run.reset(token)
        if outer is not None:
            outer.paths += own.paths


def scratch(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that no one else uses. It stays until the run that it belongs to, if any, cleans up."""
    path = f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if (run := _run.get()) is not None:
        run.paths.append(path)
    return path


def own_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them; case does not count."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, what: str, narrow: bool = False) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, outlives executors. narrow: rows of ids and labels, which go to
    TASKS_PER_CORE files a core at most, however many partitions the shuffle before has."""
    spark, path = df.sparkSession, scratch(df.sparkSession, what)
    if narrow:
        df = df.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    df.write.options(**RAW).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_most(marks: DataFrame, rows: int, doc_id: str = "doc_id") -> DataFrame:
    """marks, a row per document, to be broadcast: all of them if they are no more than `rows`, else about so many, whose ids have the lowest
    hashes, so that no text is shuffled for them. Labels keep their shares, and a run that is repeated takes the same."""
    n, scale = marks.count(), 1 << 40
    if n > rows:
        marks = marks.where(F.pmod(F.xxhash64(F.lit("labels"), doc_id), F.lit(scale)) < rows * scale // n)
    return F.broadcast(marks)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; of an empty text where the id is null."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def slices(texts: pa.Array, rows: int | None = None, size: int | None = None) -> Iterator[pa.Array]:
    """The texts cut so that each piece has about `size` bytes (SLICE_BYTES) at most, and so many rows if given."""
    each = max(1, min(int(len(texts) * (size or SLICE_BYTES) / max(texts.nbytes, 1)), rows or len(texts)))
    for at in range(0, len(texts), each):
        yield texts.slice(at, each)


def text_column(returns: str, make: Callable[[], Callable[[list], pa.Array]], rows: int | None = None, size: int | None = None) -> Callable[[Column], Column]:
    """A column function of texts. make() runs once a task and gives list of texts (None: null) -> results; rows: texts of a list, at most;
    size: their bytes, if fewer than SLICE_BYTES.

    Marked as not deterministic only so that a filter on its result doesn't make Spark run it twice.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for texts in batches:
            parts = [work(part.to_pylist()) for part in slices(texts, rows, size)]
            yield pa.concat_arrays(parts) if parts else pa.nulls(0)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    ship(SparkSession.active())
    made = F.arrow_udf(run, returns).asNondeterministic()
    return lambda text: made(text.cast("string"))


def struct_of(**columns) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in columns.values()], list(columns))

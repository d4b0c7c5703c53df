"""Stored envelopes as a stream that goes by offsets, as a topic does: so many records a trigger, from any partition and offset on.

A folder of envelopes (sinks.publish) has partition and offset beside each value. Progress is the next offset of every partition; a trigger
takes `records` of them at most, dealt over the partitions that have some; a reader that starts again goes on at its offsets, and files that
come later count if their offsets are new. Parquet footers tell which files hold an offset, so a trigger opens those alone.

Spark asks a Python source for its next end without saying where the query is, so a new reader looks up the last end in the query's checkpoint.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from yardlake.schemas import ENVELOPE
from yardlake.session import sent_whole, ship

NAME = "envelopes"
sent_whole(sys.modules[__name__])


@dataclass
class Offsets(InputPartition):
    """Records of one partition, from start on and before end."""

    partition: int
    start: int
    end: int
    files: list[str]


@dataclass(frozen=True)
class Held:
    """What a row group of a file has."""

    file: str
    partitions: tuple[int, int]
    offsets: tuple[int, int]


class EnvelopeReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.records = options["path"], int(options.get("records", "3000"))
        self.lost_is_an_error = options.get("failondataloss", "true").lower() == "true"
        self.first = {int(k): int(v) for k, v in json.loads(options.get("startingoffsets", "{}")).items()}
        self.known: dict[str, list[Held]] = {}
        self.reached = self.last_end(options["checkpoint"]) or self.initialOffset()

    @staticmethod
    def last_end(checkpoint: str) -> dict | None:
        """The end of the last batch that was planned: the last line of the newest file of the checkpoint's offset log."""
        system, root = fs.FileSystem.from_uri(checkpoint)
        found = [f for f in system.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
        if not found:
            return None
        with system.open_input_file(max(found, key=lambda f: int(f.base_name)).path) as f:
            return json.loads(f.read().decode().splitlines()[-1])

    def files(self) -> tuple[fs.FileSystem, list[str]]:
        system, root = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return system, sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")))

    def held(self) -> list[Held]:
        """From the footers, each of which is read once."""
        system, files = self.files()
        there = set(files)
        for file in files:
            if file not in self.known:
                with system.open_input_file(file) as f:
                    footer = pq.ParquetFile(f).metadata
                names = {footer.schema.column(i).path: i for i in range(len(footer.schema))}
                groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
                bounds = lambda g, c: (s.min, s.max) if (s := g.column(names[c]).statistics) is not None and s.has_min_max else (-(1 << 62), 1 << 62)
                self.known[file] = [Held(file, bounds(g, "partition"), bounds(g, "offset")) for g in groups if g.num_rows]
        self.known = {f: h for f, h in self.known.items() if f in there}
        return [h for f in files for h in self.known[f]]

    def holding(self, partition: int, begin: int, stop: int) -> list[str]:
        """The files that hold these offsets of a partition. latestOffset() has just looked for new ones; where it has not, as in a query that starts
        with a batch that was planned before, they are looked for here."""
        if not any(h.partitions[0] <= partition <= h.partitions[1] and h.offsets[1] >= stop - 1 for held in self.known.values() for h in held):
            self.held()
        return sorted({h.file for held in self.known.values() for h in held if h.partitions[0] <= partition <= h.partitions[1] and h.offsets[0] < stop and h.offsets[1] >= begin})

    def ends(self) -> dict[int, int]:
        """The offset behind the last one of each partition. Files that hold several partitions are asked which."""
        out: dict[int, int] = {}
        system, _ = fs.FileSystem.from_uri(self.folder)
        for h in self.held():
            low, high = h.partitions
            if low == high:
                out[low] = max(out.get(low, 0), h.offsets[1] + 1)
            else:
                columns = ds.dataset(h.file, filesystem=system, format="parquet").to_table(["partition", "offset"]).group_by("partition").aggregate([("offset", "max")])
                for p, last in zip(columns["partition"].to_pylist(), columns["offset_max"].to_pylist(), strict=True):
                    out[p] = max(out.get(p, 0), last + 1)
        return out

    def initialOffset(self) -> dict:
        return {"next": {str(p): o for p, o in sorted(self.first.items())}}

    def latestOffset(self) -> dict:
        """At most `records` more than the end before."""
        at = {int(p): o for p, o in self.reached["next"].items()}
        left, ends = self.records, self.ends()
        behind = {p: ends[p] - at.get(p, 0) for p in sorted(ends) if ends[p] > at.get(p, 0)}
        for i, p in enumerate(sorted(behind, key=lambda p: (behind[p], p))):  # those with least first, so that what they leave goes to others
            take = min(behind[p], -(-left // (len(behind) - i)))
            at[p] = at.get(p, 0) + take
            left -= take
        self.reached = {"next": {str(p): o for p, o in sorted(at.items())}}
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[Offsets]:
        self.reached = end
        out = []
        for p, stop in ((int(k), v) for k, v in end["next"].items()):
            begin = int(start["next"].get(str(p), self.first.get(p, 0)))
            if begin < stop:
                out.append(Offsets(p, begin, stop, self.holding(p, begin, stop)))
        return out

    def read(self, partition: Offsets) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.folder)
        names = [c.split()[0] for c in ENVELOPE.split(", ")]
        place, offset = ds.field("partition"), ds.field("offset")
        wanted = (place == partition.partition) & (offset >= partition.start) & (offset < partition.end)
        found = 0
        if partition.files:
            for batch in ds.dataset(partition.files, filesystem=system, format="parquet").to_batches(columns=names, filter=wanted):
                found += batch.num_rows
                stamp = batch.column("timestamp").cast(pa.timestamp("us", "UTC"))
                columns = [stamp if n == "timestamp" else batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if self.lost_is_an_error and found < partition.end - partition.start:
            raise ValueError(f"partition {partition.partition} has {found} of the offsets from {partition.start} to {partition.end}; failOnDataLoss=false goes on without the others")

    def commit(self, end: dict) -> None:
        pass


class EnvelopeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ENVELOPE

    def streamReader(self, schema) -> EnvelopeReader:
        return EnvelopeReader({k.lower(): v for k, v in self.options.items()})


def offset_stream(spark: SparkSession, folder: str, checkpoint: str, records: int = 3000, fail_on_data_loss: bool = True, starting_offsets: dict[int, int] | None = None) -> DataFrame:
    """Envelopes of a folder, `records` a trigger at most. checkpoint: that of the query that reads them, which has no other source. Both are
    URIs that Arrow's file systems know (file, hdfs, s3, gs). Spark runs one batch of such a source for availableNow."""
    ship(spark)
    spark.dataSource.register(EnvelopeSource)
    options = {"path": folder, "checkpoint": checkpoint, "records": str(records), "failOnDataLoss": str(fail_on_data_loss).lower(), "startingOffsets": json.dumps({str(k): v for k, v in (starting_offsets or {}).items()})}
    return spark.readStream.format(NAME).options(**options).load()

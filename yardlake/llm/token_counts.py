"""Token counts by a separator scan of flat, unindexed token files.

A token file is nothing but big-endian unsigned 16-bit ids, each document closed by END_OF_DOC. Spark splits files into
byte ranges, and a range is searched block by block, each in one vectorised search. A block does not know where in its
file it lies, so it is read from its first and from its second byte on. A prefix scan over the blocks' summaries (bytes,
first and last separator, the ids about them) then tells which reading is true and where the document began that a
block's first separator ends. A document may span any number of blocks, and a file any number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import scratch, slices, written
from .word_bpe import encoder

#: Not an id of the tokenizer. Its second byte is the line separator of Spark's text writer, which closes each document.
END_OF_DOC = 0xFF41
#: Ids before a document's own that spell its number in 15-bit digits, lowest first; never END_OF_DOC.
HEADER = 5
#: Bytes searched at once.
BLOCK = 1 << 19
#: Spark's text reader cuts its ranges behind this byte; any would do that is not rare.
CUT = b"A"


def header(doc_id: int | None) -> bytes:
    """A null id is spelt as 2 ** 74."""
    n = 1 << 74 if doc_id is None else doc_id + (1 << 63)
    return np.array([n >> 15 * i & 0x7FFF for i in range(HEADER)], ">u2").tobytes()


def read_headers(digits: np.ndarray) -> list[int | None]:
    """digits: HEADER of them a row."""
    d = digits.astype(np.uint64).reshape(-1, HEADER)
    with np.errstate(over="ignore"):
        n = sum(d[:, i] << np.uint64(15 * i) for i in range(HEADER)) - np.uint64(1 << 63)
    null = d[:, -1] >= 1 << 14
    return [None if none else x for x, none in zip(n.view(np.int64).tolist(), null.tolist(), strict=True)]


def documents_bytes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Header, ids and the first byte of END_OF_DOC of each (id, text)."""
    encode, close = encoder().encode, bytes([END_OF_DOC >> 8])
    for numbers, texts in batches:
        parts, at = [], 0
        for part in slices(texts):
            ids = encode(part.to_pylist())
            heads = map(header, numbers.slice(at, len(part)).to_pylist())
            parts.append(pa.array([b"".join((h, x.astype(">u2").tobytes(), close)) for h, x in zip(heads, ids, strict=True)], pa.binary()))
            at += len(part)
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def write_flat(df: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str | None = None) -> str:
    """Token files of all rows, written by Spark's text writer to a folder it reaches; null texts are empty, null ids stay null. Ids are
    whole numbers, or text that Spark casts to them. Repeated rows are documents of their own, long texts are written whole, and an empty df gives no
    documents."""
    ship(df.sparkSession)
    folder = folder or scratch(df.sparkSession, "tokens")
    made = F.arrow_udf(documents_bytes, "binary")(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    df.select(made.cast("string").alias("value")).write.option("lineSep", chr(END_OF_DOC & 0xFF)).text(folder)
    return folder


def byte_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[int, int, int, bytes, bool]]:
    """file, start of its range, number within the range, bytes, whether they end the range: the lines of a range put together again.

    Each line gets its end back, and so does one that a file breaks off in: a range's last block may have a byte too many."""
    now, number, held, size = None, 0, [], 0
    for batch in batches:
        files, starts, lines = batch.column("file").to_numpy(), batch.column("start").to_numpy(), batch.column("line")
        edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        cuts = [0, *edges.tolist(), len(files)] if len(files) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if now != (here := (int(files[a]), int(starts[a]))):
                if size:
                    yield *now, number, b"".join(held), True
                now, number, held, size = here, 0, [], 0
            held.append(CUT.join([*lines.slice(a, b - a).to_pylist(), b""]))
            size += len(held[-1])
            if size > block:  # something stays for the end of the range
                whole, cut = b"".join(held), (size - 1) // block * block
                for at in range(0, cut, block):
                    yield *now, number, whole[at : at + block], False
                    number += 1
                held, size = [whole[cut:]], size - cut
    if size:
        yield *now, number, b"".join(held), True


SUMMARY = ["file long", "start long", "number int", "odd int", "short int", "file_size long", "bytes long", "first_byte int", "last_byte int", "n_ids long", "n_ends long", "first long", "last long", "head array<int>", "tail array<int>"]
#: Documents between two separators of one block.
INNER = ["doc_ids array<long>", "tokens array<long>"]


def summary(raw: bytes, odd: int, head: int) -> dict:
    """The ids of a block from its first or second byte on: the first and last separator (-1: none), the ids that begin it
    and that follow the last separator, as far as a header goes, and the documents in between."""
    ids = np.frombuffer(raw, ">u2", (len(raw) - odd) // 2, odd) if len(raw) > odd else np.zeros(0, ">u2")
    ends = np.flatnonzero(ids == END_OF_DOC)
    first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (-1, -1)
    sizes = np.diff(ends) - 1 - head
    whole = np.flatnonzero(sizes >= 0)
    numbers: list[int | None] = [None] * len(sizes)
    if head:
        for i, x in zip(whole.tolist(), read_headers(ids[ends[whole, None] + 1 + np.arange(head)]), strict=True):
            numbers[i] = x
    return {
        "odd": odd, "bytes": len(raw), "first_byte": raw[0] if raw else 0, "last_byte": raw[-1] if raw else 0, "n_ids": len(ids), "n_ends": len(ends), "first": first, "last": last,
        "head": ids[: min(head, first) if len(ends) else head].tolist(), "tail": ids[last + 1 :][:head].tolist() if len(ends) else [],
        "doc_ids": numbers, "tokens": np.maximum(sizes, 0).tolist(),
    }


class Scan:
    """Goes over the summaries of a file's blocks, in order."""

    def __init__(self, head: int):
        self.head = head
        self.bytes = self.documents = 0  # so far
        self.size, self.begun = 0, []  # ids of the document that is open, and the first of them
        self.half = 0  # the first byte of an id that the next block ends
        self.closed: list[tuple[int | None, int]] = []

    def extend(self, n: int, first: list[int]) -> None:
        self.begun = [*self.begun, *first][: self.head]
        self.size += n

    def close(self) -> None:
        whole = self.head and len(self.begun) == self.head
        self.closed.append((read_headers(np.array(self.begun))[0] if whole else None, max(self.size - self.head, 0)))
        self.size, self.begun = 0, []

    def block(self, readings: list) -> tuple:
        """number of the true reading, documents before the block, documents that it ends and others began."""
        odd, self.closed = self.bytes % 2, []
        b = readings[odd]
        if not b.bytes:
            return odd, self.documents, [], []
        if odd and (cut := self.half << 8 | b.first_byte) == END_OF_DOC:
            self.close()
        elif odd:
            self.extend(1, [cut])
        if b.n_ends:
            self.extend(b.first, list(b.head))
            self.close()
            self.extend(b.n_ids - 1 - b.last, list(b.tail))
        else:
            self.extend(b.n_ids, list(b.head))
        before = self.documents
        self.documents += len(self.closed) + max(b.n_ends - 1, 0)
        self.bytes += b.bytes
        self.half = b.last_byte
        return odd, before, [i for i, _ in self.closed], [n for _, n in self.closed]


def scan(spark: SparkSession, folder: str, head: int = HEADER, block: int = BLOCK) -> DataFrame:
    """file (a hash of its path), ordinal, doc_id (null if head is 0), n_tokens of every document of the files, header not
    counted. head: 0 or HEADER.

    An empty file has no documents; ids after the last separator, and a byte after the last id of a file that breaks off, belong to
    none; a document shorter than a header has no id and no tokens. spark.sql.files.maxPartitionBytes bounds what a task reads.
    """
    ship(spark)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[t]) for n, t in (c.split() for c in SUMMARY + INNER)])
        sizes: dict[int, int] = {}

        def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes.update(zip(batch.column("file").to_pylist(), batch.column("file_size").to_pylist(), strict=True))
                yield batch

        for file, start, number, raw, last in byte_blocks(noted(batches), block):
            place = {"file": file, "start": start, "number": number, "file_size": sizes[file]}
            rows = [{**place, "short": short, **summary(raw[: len(raw) - short], odd, head)} for short in range(1 + last) for odd in (0, 1)]
            yield pa.RecordBatch.from_pylist(rows, kinds)

    def stitch(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        whole = blocks[blocks["short"] == 0]
        missing = int(whole.loc[whole["odd"] == 0, "bytes"].sum() - whole["file_size"].iloc[0])  # 1 where the file breaks off
        whole = whole.sort_values(["start", "number", "odd"])
        if missing:
            end = whole.iloc[-1]
            whole = pd.concat([whole.iloc[:-2], blocks[(blocks["start"] == end["start"]) & (blocks["number"] == end["number"]) & (blocks["short"] == 1)].sort_values("odd")])
        state, rows = Scan(head), list(whole.itertuples(index=False))
        return pd.DataFrame([(*key, a.start, a.number, a.short, *state.block([a, b])) for a, b in zip(rows[::2], rows[1::2], strict=True)], columns=["file", "start", "number", "short", "odd", "before", "ended", "ended_tokens"])

    bytes_of = spark.read.option("pathGlobFilter", "part-*").option("lineSep", CUT.decode()).text(folder)
    lines = bytes_of.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("line"))
    found = written(lines.mapInArrow(summaries, ", ".join(SUMMARY + INNER)), "token-blocks")
    told = found.drop("doc_ids", "tokens").groupBy("file").applyInPandas(stitch, "file long, start long, number int, short int, odd int, before long, ended array<long>, ended_tokens array<long>")
    both = found.select("file", "start", "number", "short", "odd", "doc_ids", "tokens").join(told, ["file", "start", "number", "short", "odd"])
    each = both.select("file", "before", F.posexplode(F.arrays_zip(F.concat("ended", "doc_ids").alias("doc_id"), F.concat("ended_tokens", "tokens").alias("n_tokens"))).alias("at", "d"))
    return each.select("file", (F.col("before") + F.col("at")).alias("ordinal"), "d.doc_id", "d.n_tokens")

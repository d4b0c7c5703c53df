"""Best-fit decreasing packing of token sequences into windows.

A document is cut into full windows first; what is left of it, at most one window less one token, is placed whole. Pieces
are dealt at random to shards of about SHARD pieces, and each shard is packed on its own: longest piece first, each
into the open window with the least room that still holds it.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import text_column, written
from .word_bpe import encoder

WINDOW = 2048
END_ID = 1
SHARD = 20_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Rooms:
    """Open windows by room left, under a segment tree over the rooms 0 to `window`: a node is true if any room below
    it has an open window, so the least room of at least `n` is found in log2(window) steps."""

    def __init__(self, window: int):
        self.size = 1 << (window + 1).bit_length()
        self.any = [False] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, window_id: int) -> None:
        self.open[room].append(window_id)
        node = room + self.size
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """(room, window) of the tightest open window for n, which is then no longer open; None: there is none."""
        node = n + self.size
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        window_id = self.open[room].pop()
        if not self.open[room]:
            self.any[node] = False
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = False
                node >>= 1
        return room, window_id


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each length; lengths must come longest first."""
    rooms, made = Rooms(window), 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        room, at = rooms.take(n) or (window, made)
        made += at == made
        where[i], offset[i] = at, window - room
        if room > n:
            rooms.put(room - n, at)
    return where, offset


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, tokenizer_file: str | None = None) -> DataFrame:
    """PIECE rows: every document's ids and END_ID cut at multiples of the window. A null text is empty, and an empty one is END_ID alone. Long texts
    are cut whole, repeated rows are documents of their own, and an empty df gives no rows. Ids are whole numbers, or text that Spark casts to them; other columns are left
    out, whatever their names."""

    def make():
        encode = encoder(tokenizer_file).encode

        def work(texts: list) -> pa.Array:
            rows, sizes = [], [0]
            for ids in encode(texts):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                rows += [(at, min(window, len(ids) - at), zlib.crc32(ids[at : at + window].tobytes()), len(ids)) for at in range(0, len(ids), window)]
                sizes.append(len(rows))
            flat = np.array(rows, np.int64).reshape(-1, 4)
            names = ("start", "length", "ids_crc32", "doc_tokens")
            return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(4)], list(names)))

        return work

    cut = text_column("array<struct<start long, length long, ids_crc32 long, doc_tokens long>>", make)(F.col(text))
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.explode(cut).alias("p")).select("doc_id", "p.*")


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """PIECE rows with sequence_id and offset. Ties in length go by doc_id, then start, so a task can be run again;
    sequence ids are unique, not dense. Pieces of one document and equal pieces are dealt over all shards. Without pieces
    there are no rows."""
    ship(cut.sparkSession)
    cut = written(cut, "pieces")
    shards = max(1, math.ceil(cut.count() / SHARD))
    # the number of a row in the written pieces deals equal pieces over all shards, and is the same in a task run again
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where, offset = best_fit(rows["length"].to_numpy(), window)
        return rows.drop(columns="shard").assign(sequence_id=(int(key[0]) << 32) + where, offset=offset)

    out = cut.withColumn("shard", shard).groupBy("shard").applyInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out

"""Byte-level BPE: encoding by ranked merges, decoding by concatenation.

A pattern splits the text; a piece's bytes are merged, lowest rank first, until no two neighbours make a known piece.
`fold` does this for one column of distinct words with Spark's higher-order functions over a literal rank map. It gives
the same ids, but takes about 0.1 ms a word, so whole corpora go through `with_ids`: the same fold over the distinct
words of each worker, in Python with a memo (see the README for the figures).
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import struct_of, text_column

NAME = "byte_bpe_50k.tiktoken"
#: Words kept per worker, some 80 MB.
MEMO = 400_000
#: Buckets of the literal rank map: Spark looks keys of a map up one by one, so each map is kept to a few keys.
MAPS = 1 << 15
NEVER = (1 << 31) - 1


def read_ranks(file: str | None = None) -> dict[bytes, int]:
    with open(file or public_tokenizers.path(NAME), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], NEVER) for i in range(len(word) - 1)]
    while pairs:
        best = min(pairs)
        if best == NEVER:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
    return [ranks[p] for p in parts]


class Coder:
    """encode and decode; a word longer than LONG bytes is merged with a heap, in n log n steps."""

    LONG = 256

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.memo: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "replace")
        ids = merge(raw, self.ranks) if len(raw) <= self.LONG else merge_long(raw, self.ranks)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.find(text)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        try:
            return b"".join(map(memo.__getitem__, words))
        except KeyError:
            for w in set(words):
                if w not in memo:
                    memo[w] = self.word(w)
            return b"".join(map(memo.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As merge, with a heap over a linked list of parts."""
    import heapq

    n = len(word)
    after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : j + size[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, size[i], size[j]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if size[i] != a or j >= n or size[j] != b:
            continue  # one of the two has been merged since
        size[i], size[j], after[i] = a + b, 0, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i : i + size[i]]] for i in range(n) if size[i]]


_coders: dict[tuple, Coder] = {}


def coder(file: str | None = None, pattern: str | None = None) -> Coder:
    """The worker's own, kept from task to task."""
    if (file, pattern) not in _coders:
        _coders[file, pattern] = Coder(read_ranks(file), pattern or public_tokenizers.PATTERN)
    return _coders[file, pattern]


def with_ids(df: DataFrame, text: str = "text", into: str = "bpe", file: str | None = None) -> DataFrame:
    """df with a struct column: n_tokens, ids (little-endian 32-bit), decoded (ids put back into bytes).

    A null text is empty and has no ids. A column of that name is replaced, others keep their values. Equal texts get equal ids; long texts are
    encoded whole, their long words with a heap; an empty df gives no rows.
    """

    def make():
        c = coder(file)

        def work(texts: list) -> pa.Array:
            ids = [c.encode(t) if t else b"" for t in texts]
            return struct_of(n_tokens=pa.array([len(x) // 4 for x in ids], pa.int64()), ids=pa.array(ids, pa.binary()), decoded=pa.array([c.decode(x) for x in ids], pa.binary()))

        return work

    return df.withColumn(into, text_column("n_tokens long, ids binary, decoded binary", make)(F.col(text)))


def digests(df: DataFrame, text: str = "text", into: str = "bpe", file: str | None = None) -> DataFrame:
    """As with_ids, but n_tokens, ids_sha256, decoded_sha256: nothing long leaves the worker."""

    def make():
        c = coder(file)
        sha = lambda x: hashlib.sha256(x).hexdigest()

        def work(texts: list) -> pa.Array:
            ids = [c.encode(t) if t else b"" for t in texts]
            return struct_of(n_tokens=pa.array([len(x) // 4 for x in ids], pa.int64()), ids_sha256=pa.array(map(sha, ids), pa.string()), decoded_sha256=pa.array([sha(c.decode(x)) for x in ids], pa.string()))

        return work

    return df.withColumn(into, text_column("n_tokens long, ids_sha256 string, decoded_sha256 string", make)(F.col(text)))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, by crc32 of the key, each byte written as one character."""
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        maps[zlib.crc32(key.encode()) % MAPS][key] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def fold(word: Column, ranks: Column) -> Column:
    """Ids of a word given as a string of one character per byte: an aggregate over the merges still possible, whose
    state holds the parts and the ranks of neighbours."""
    never, none = F.lit(NEVER), F.array().cast("array<int>")
    exact = lambda s: F.element_at(F.get(ranks, F.pmod(F.crc32(s.cast("binary")), F.lit(MAPS)).cast("int")), s)
    rank = lambda s: F.coalesce(exact(s), never)
    n = F.length(word)
    start = F.struct(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1))).alias("parts"),
        F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: rank(F.substring(word, i, F.lit(2))))).otherwise(none).alias("ranks"),
    )

    def step(state: Column, _: Column) -> Column:
        parts, near = state["parts"], state["ranks"]
        best = F.array_min(near)

        def at(i: Column) -> Column:
            new = F.concat(F.get(parts, i - 1), F.get(parts, i))
            left = F.when(i > 1, F.concat(F.slice(near, F.lit(1), i - 2), F.array(rank(F.concat(F.get(parts, i - 2), new))))).otherwise(none)
            right = F.when(i < F.size(near), F.concat(F.array(rank(F.concat(new, F.get(parts, i + 1)))), F.slice(near, i + 2, F.size(near)))).otherwise(none)
            whole = F.concat(F.slice(parts, F.lit(1), i - 1), F.array(new), F.slice(parts, i + 2, F.size(parts)))
            return F.struct(whole.alias("parts"), F.concat(left, right).alias("ranks"))

        merged = F.get(F.transform(F.array(F.array_position(near, best).cast("int")), at), F.lit(0))
        return F.when(best.isNull() | (best == never), state).otherwise(merged)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, step, lambda s: F.transform(s["parts"], exact))

"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often a corpus links them.

Both tokenizers end a token wherever a space follows something that is no white space, so a text is cut there into units,
and a worker encodes each unit once while it remembers it. Token ends are then compared for a whole slice of texts at once:
between two neighbouring ends lies one link, and where both sides end, a group ends. The counts over the corpus are external
spill counting:

1. `spill`: while texts are aligned, the (pair, document) records of a slice of texts are sorted and radix-partitioned
   by their first id, and each part is written as a zstd run to the shared folder.
2. `counted`: a k-way heap merge over the runs of a radix adds up the documents of each pair, within one input split; the
   sums, dealt by first id and sorted (side-major order), are merged once more, which yields the totals and, as the pairs of
   a first id are neighbours, its maximum. They are stored as sorted blocks, each of one radix.
3. `contributions`: the runs of a radix, in shares, stream past the blocks of that radix, and give every document its sums.

A record crosses the network once, compressed, in step 3, and the totals once a share, which has more bytes of runs than they have. What is held at a time is one slice, the pairs of one radix of one
split (a split has about spark.sql.files.maxPartitionBytes), and the totals of one radix. A first id, frequent as it may be, has
one record a pair and split after the first merge, so no key is hot.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import slices, written

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Parts that pairs are dealt over by their first id.
RADIX = 8
#: Units that a worker remembers, some 100 MB, and characters of a text that are aligned at once.
MEMO, PART = 400_000, 1 << 21
#: Pairs in a stored block of totals; bytes of runs that are worth a copy of the totals.
BLOCK, SHARE = 1 << 16, 1 << 26
#: A pair is a << ID_BITS | b, its record in a slice that << ROW_BITS | row.
ID_BITS, ROW_BITS = 20, 20
SPACE = "▁"
CUT = re.compile(r"(?<=\S) ")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: visible Latin-1 stands for itself, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Byte:
    """Tokenizer A: ids, and the bytes of each id."""

    def __init__(self, file: str):
        # a worker has the cores of one task, not all that the library sees
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(file)
        self.model.encode_special_tokens = True
        back = byte_alphabet()
        vocab = self.model.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in piece)

    def ids(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]


class Piece:
    """Tokenizer B, which puts a space before a text itself, but not before an empty one."""

    def __init__(self, file: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=file)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.alone = m.piece_to_id(SPACE)

    def ids(self, units: list[str]) -> list[list[int]]:
        return [i or [self.alone] for i in self.model.encode(units, num_threads=1)]


class Ragged:
    """Lists of ids by number, and what is known of each id: its size in bytes and its number as text with what may follow it."""

    def __init__(self, pieces: list[bytes], inner: str, last: str):
        self.pieces = pieces
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.text = [f"{i}{mark}" for i in range(len(pieces)) for mark in (inner, last)]
        self.clear()

    def clear(self) -> None:
        self.flat, self.start = array("i"), array("q", [0])

    def add(self, ids: list[int]) -> None:
        self.flat.extend(ids)
        self.start.append(len(self.flat))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers, one list after another, and how many each has."""
        flat, start = np.frombuffer(self.flat, np.int32), np.frombuffer(self.start, np.int64)
        n = start[numbers + 1] - start[numbers]
        at = np.arange(int(n.sum())) + np.repeat(start[numbers] - (np.cumsum(n) - n), n)
        return flat[at].astype(np.int64), n


class Aligner:
    """Encodes and aligns slices of texts."""

    def __init__(self, a: str, b: str):
        self.models = Byte(a), Piece(b)
        self.a, self.b = Ragged(self.models[0].bytes, ",", "|"), Ragged(self.models[1].bytes, ",", ";")
        if max(len(self.a.pieces), len(self.b.pieces)) > 1 << ID_BITS:
            raise ValueError(f"a vocabulary has more than {1 << ID_BITS} ids")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.good = array("b")
        self.a.clear()
        self.b.clear()

    def learn(self, units: list[str]) -> None:
        """Numbers for units that are not known yet. A unit is good if both token lists give its bytes back."""
        for unit, x, y in zip(units, self.models[0].ids(units), self.models[1].ids(units), strict=True):
            raw = b" " + unit.encode("utf-8", "replace")
            same = [b"".join(map(side.pieces.__getitem__, ids)) == raw for side, ids in ((self.a, x), (self.b, y))]
            self.number[unit] = len(self.good)
            self.good.append(all(same))
            self.a.add(x)
            self.b.add(y)

    def numbers(self, units: list[str]) -> np.ndarray:
        """Of known units."""
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))

    def slice(self, texts: list[str | None], whole: bool = False) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """whole: an empty text is one space too, as the last part of another may be. For each text its four counts (zeros without tokens) and its groups as text; records (distinct, sorted) and their links."""
        split = [CUT.split(t) if (t or whole) and SPACE not in t else [] for t in texts]
        if len(self.good) > MEMO:
            self.clear()
        self.learn([u for u in dict.fromkeys(itertools.chain.from_iterable(split)) if u not in self.number])
        good = np.frombuffer(self.good, np.int8)
        numbers = [self.numbers(u) for u in split]
        numbers = [n if good[n].all() else n[:0] for n in numbers]
        del good
        row = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        numbers = np.concatenate([*numbers, np.zeros(0, np.int64)])
        (x, n_x), (y, n_y) = self.a.of(numbers), self.b.of(numbers)
        row_x, row_y = np.repeat(row, n_x), np.repeat(row, n_y)
        # all token ends in order; x comes before y where both end
        ends = np.r_[np.cumsum(self.a.size[x]), np.cumsum(self.b.size[y])]
        order = np.argsort(ends, kind="stable")
        first = np.flatnonzero(np.diff(ends[order], prepend=-1))
        in_x = np.add.reduceat((order < len(x)).astype(np.int64), first) if len(first) else first
        in_y = np.diff(np.r_[first, len(order)]) - in_x
        at_x, at_y, cut = np.cumsum(in_x) - in_x, np.cumsum(in_y) - in_y, in_x & in_y
        records, links = np.unique((x[at_x] << ID_BITS | y[at_y]) << ROW_BITS | row_x[at_x], return_counts=True)
        per = lambda rows: np.bincount(rows, minlength=len(texts))
        counts = np.stack([per(row_x), per(row_y), per(row_x[at_x[cut > 0]]), per(row_x[at_x])], 1)
        group = np.cumsum(cut) - cut
        of_x, of_y = in_x > 0, in_y > 0
        # within a group first the ids of one side, then those of the other
        order = np.argsort(np.r_[2 * group[of_x], 2 * group[of_y] + 1], kind="stable")
        which = np.r_[2 * x + cut[of_x], 2 * y + cut[of_y] + len(self.a.text)][order]
        words = list(map((self.a.text + self.b.text).__getitem__, which.tolist()))
        upto = np.r_[0, np.cumsum(counts[:, 0] + counts[:, 1])].tolist()
        return counts, ["".join(words[i:j])[:-1].encode() for i, j in itertools.pairwise(upto)], records, links


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str | None = None, b: str | None = None) -> Aligner:
    """The worker's own, kept from task to task."""
    files = a or public_tokenizers.path(A_FILE), b or public_tokenizers.path(B_FILE)
    if files not in _aligners:
        _aligners[files] = Aligner(*files)
    return _aligners[files]


def parts_of(text: str) -> Iterator[str]:
    """The text in parts of about PART characters, cut as units are."""
    at = 0
    while at < len(text):
        found = CUT.search(text, at + PART)
        yield text[at : found.start() if found else len(text)]
        at = found.end() if found else len(text)
        if found and at == len(text):
            yield ""  # a last unit of one space


def aligned(texts: list[str | None], own: Aligner) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Of whole texts: counts, SHA-256 of the groups ('' without tokens), records (distinct, sorted), links."""
    if len(texts) != 1 or not texts[0] or len(texts[0]) <= PART:
        counts, groups, records, links = own.slice(texts)
        return counts, [hashlib.sha256(g).hexdigest() if g else "" for g in groups], records, links
    total, sha, found = np.zeros((1, 4), np.int64), hashlib.sha256(), []
    for i, part in enumerate(parts_of(texts[0])):
        counts, groups, *records = own.slice([part], whole=True)
        if not counts[0, 0]:
            return np.zeros((1, 4), np.int64), [""], np.zeros(0, np.int64), np.zeros(0, np.int64)
        sha.update(b";" * (i > 0) + groups[0])
        total += counts
        found.append(records)
    records, links = added(*(np.concatenate(c) for c in zip(*found, strict=True)))
    return total, [sha.hexdigest()], records, links


# runs


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns as one zstd frame; a sorted first column goes as steps."""
    out = [np.array([len(c) for c in columns], "<u4").tobytes()]
    for i, c in enumerate(columns):
        c = np.diff(c, prepend=0) if i == 0 else c
        top = int(c.max(initial=0))
        kind = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8"
        out += [kind[2].encode(), np.ascontiguousarray(c, kind).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpacked(frame: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    sizes, at, out = np.frombuffer(raw, "<u4", n), 4 * n, []
    for i, size in enumerate(sizes.tolist()):
        kind = f"<u{chr(raw[at])}"
        c = np.frombuffer(raw, kind, size, at + 1).astype(np.int64)
        at += 1 + size * int(kind[2])
        out.append(np.cumsum(c) if i == 0 else c)
    return out


def merged(runs: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A k-way heap merge of sorted runs (distinct keys, numbers): blocks of ascending distinct keys, numbers added up.

    The heap holds each run by its next key. A step takes from all runs that begin below it what lies below a bound, so that it
    handles about STEP keys at once instead of one.
    """
    held = [(k, n) for k, n in runs if len(k)]
    at = [0] * len(held)
    heap = [(int(k[0]), r) for r, (k, _) in enumerate(held)]
    heapq.heapify(heap)
    while heap:
        each = max(1, STEP // len(heap))
        first, r = heap[0]
        bound = int(held[r][0][min(at[r] + each, len(held[r][0])) - 1])
        keys, numbers = [], []
        while heap and heap[0][0] <= bound:
            _, r = heapq.heappop(heap)
            k, n = held[r]
            end = int(np.searchsorted(k, bound, "right"))
            keys.append(k[at[r] : end])
            numbers.append(n[at[r] : end])
            at[r] = end
            if end < len(k):
                heapq.heappush(heap, (int(k[end]), r))
        yield added(np.concatenate(keys), np.concatenate(numbers))


STEP = 1 << 15


def added(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(numbers, first) if len(first) else numbers


SPILLED = "task int, slice int, radix int, row int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, frame binary"
NAMES = ["task", "slice", "radix", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "frame"]


def batch_of(names: list[str], columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, columns, strict=True)], names=names)


ARROW = pa.schema([("task", pa.int32()), ("slice", pa.int32()), ("radix", pa.int32()), ("row", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("frame", pa.binary())])


def spill(texts: DataFrame, make: Callable[[], Aligner], key: str) -> DataFrame:
    """texts: the key, text. Gives, written to the shared folder, one row per text (radix null) with its key, numbers and place, and
    one row per slice and radix with its run: distinct pairs, the number of rows of each, then for each of these rows its place and links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, own = TaskContext.get().partitionId(), 0, make()
        for batch in batches:
            at = 0
            for part in slices(batch.column("text")):
                keys = batch.column(key).slice(at, len(part))
                at += len(part)
                counts, shas, records, links = aligned(part.to_pylist(), own)
                n = len(part)
                rows = batch_of(NAMES, [[task] * n, [number] * n, [None] * n, range(n), *counts.T, shas, [None] * n], ARROW)
                yield pa.RecordBatch.from_arrays([keys, *rows.columns], names=[key, *NAMES])
                runs = list(runs_of(records, links))
                k = len(runs)
                rows = batch_of(NAMES, [[task] * k, [number] * k, [r for r, _ in runs], *[[None] * k] * 6, [x for _, x in runs]], ARROW)
                yield pa.RecordBatch.from_arrays([pa.nulls(k, keys.type), *rows.columns], names=[key, *NAMES])
                number += 1

    ship(texts.sparkSession)
    kind = texts.schema[key].dataType.simpleString()
    return written(texts.mapInArrow(run, f"`{key}` {kind}, {SPILLED}"), "alignment-runs")


def runs_of(records: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, bytes]]:
    pairs, rows = records >> ROW_BITS, records & (1 << ROW_BITS) - 1
    radix = (pairs >> ID_BITS) % RADIX
    for r in range(RADIX):
        mine = radix == r
        if mine.any():
            distinct, n = np.unique(pairs[mine], return_counts=True)
            yield r, packed(distinct, n, rows[mine], links[mine])


def counted(runs: DataFrame) -> DataFrame:
    """runs: task, radix, frame. Gives blocks of totals, written: radix, frame (pairs, their documents, 1 where no pair of the same first
    id has more)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r, f) for b in batches for r, f in zip(b.column("radix").to_pylist(), b.column("frame").to_pylist(), strict=True))
        for _, group in itertools.groupby(rows, key=lambda x: x[0]):
            for keys, n in merged(tuple(unpacked(f, 4)[:2]) for _, f in group):
                yield pa.RecordBatch.from_pydict({"a": (keys >> ID_BITS).astype(np.int32), "b": (keys & (1 << ID_BITS) - 1).astype(np.int32), "n": n})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by a, b: what is held back is the last first id, whose pairs may go on."""
        rest, numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = Blocks()
        for batch in batches:
            a, b, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
            keys, sums = added(np.r_[rest, a << ID_BITS | b], np.r_[numbers, n])
            cut = int(np.searchsorted(keys, keys[-1] >> ID_BITS << ID_BITS)) if len(keys) else 0
            yield from blocks.add(keys[:cut], sums[:cut])
            rest, numbers = keys[cut:], sums[cut:]
        yield from blocks.add(rest, numbers)
        yield from blocks.flush()

    # the runs of a split lie in one file, or in a few
    by_radix = runs.select("radix", "frame").sortWithinPartitions("radix")
    pairs = by_radix.mapInArrow(partial, "a int, b int, n long").repartition("a").sortWithinPartitions("a", "b")
    return written(pairs.mapInArrow(total, "radix int, frame binary"), "alignment-totals")


class Blocks:
    """Totals of whole first ids, gathered until a radix has a block full."""

    def __init__(self):
        self.held: list[list] = [[] for _ in range(RADIX)]
        self.size = [0] * RADIX

    def add(self, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            a = keys >> ID_BITS
            first = np.flatnonzero(np.diff(a, prepend=-1))
            best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.r_[first, len(a)]))
            for r in np.unique(a % RADIX).tolist():
                mine = a % RADIX == r
                self.held[r].append((keys[mine], n[mine], best[mine].astype(np.int64)))
                self.size[r] += int(mine.sum())
                if self.size[r] >= BLOCK:
                    yield self.take(r)

    def take(self, r: int) -> pa.RecordBatch:
        frame = packed(*(np.concatenate(c) for c in zip(*self.held[r], strict=True)))
        self.held[r], self.size[r] = [], 0
        return pa.RecordBatch.from_pydict({"radix": pa.array([r], pa.int32()), "frame": pa.array([frame], pa.binary())})

    def flush(self) -> Iterator[pa.RecordBatch]:
        yield from (self.take(r) for r in range(RADIX) if self.held[r])


def shares(runs: DataFrame, totals: DataFrame) -> int:
    """Groups of splits, each of which gets a copy of all totals: as many as hold at least as many bytes of runs as the totals have, and SHARE; so the
    copies are never more than the runs, but for those that the cluster's cores ask for."""
    size = lambda df: df.agg(F.coalesce(F.sum(F.octet_length("frame").cast("long")), F.lit(0))).first()[0]  # noqa: E731  one value
    return max(1, -(-size(runs) // max(size(totals), SHARE)), -(-runs.sparkSession.sparkContext.defaultParallelism // RADIX))


def contributions(runs: DataFrame, totals: DataFrame, groups: int | None = None) -> DataFrame:
    """runs: task, slice, radix, frame; totals as counted() gives them; groups: see shares(). Gives task, slice, row, n_best, count_sum, a row per radix."""
    groups = groups or shares(runs, totals)
    none = F.lit(None).cast("int")
    copies = totals.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("share"), none.alias("task"), none.alias("slice"), "radix", "frame")
    share = F.pmod(F.xxhash64("task", "slice"), F.lit(groups)).cast("int").alias("share")
    both = copies.unionByName(runs.select(share, "task", "slice", "radix", "frame"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("share", "radix", "task", "slice", "frame")), strict=True))
        for _, group in itertools.groupby(rows, key=lambda x: x[:2]):
            blocks, table = [], None
            for _, _, task, number, frame in group:
                if task is None:
                    blocks.append(unpacked(frame, 3))
                    continue
                if table is None:
                    keys, n, best = (np.concatenate(c) for c in zip(*blocks, strict=True))
                    order = np.argsort(keys)
                    table, blocks = (keys[order], n[order], best[order]), []
                pairs, times, row, links = unpacked(frame, 4)
                where = np.repeat(np.searchsorted(table[0], pairs), times)
                size = int(row.max()) + 1
                n_best = np.bincount(row, links * table[2][where], size).astype(np.int64)
                # sums of whole numbers: bincount adds floating-point numbers, exact only up to 2^53
                total = np.zeros(size, np.int64)
                np.add.at(total, row, links * table[1][where])
                has = np.unique(row)
                yield pa.RecordBatch.from_pydict({"task": np.full(len(has), task, np.int32), "slice": np.full(len(has), number, np.int32), "row": has.astype(np.int32), "n_best": n_best[has], "count_sum": total[has]})

    # a partition for each share and radix; the totals come first in it
    dealt = both.repartitionById(groups * RADIX, F.col("share") * RADIX + F.col("radix"))
    dealt = dealt.sortWithinPartitions("share", "radix", F.col("task").asc_nulls_first(), "slice")
    return dealt.mapInArrow(run, "task int, slice int, row int, n_best long, count_sum long")


def align_documents(df: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """One row per row of df: its key and n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    a, b: files of a byte-level BPE vocabulary and of a sentencepiece BPE model. Texts that are null or empty or that one of the
    tokenizers does not give back byte by byte have no tokens: zeros and an empty groups_sha256. Every row is a document of its own,
    also where rows or keys repeat; a null key stays null. An empty df gives no rows. Long texts are worked through in
    parts. Other columns of df are left out, whatever their names.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    spilled = spill(rows, lambda: aligner(a, b), "key")
    runs = spilled.where("radix is not null")
    sums = contributions(runs, counted(runs)).groupBy("task", "slice", "row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = spilled.where("radix is null").drop("radix", "frame")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    joined = own.join(sums, ["task", "slice", "row"], "left")
    return joined.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")

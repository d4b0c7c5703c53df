"""SimHash near-duplicates by pigeonhole blocks.

Texts become 64-bit fingerprints; equal fingerprints are one class from there on. 64 bits are cut into blocks; two
fingerprints that differ in at most DISTANCE bits agree in all but DISTANCE blocks or more, so they share one of the keys
made of that many blocks (35 keys of 27 or 28 bits at 7 blocks). Classes are dealt by key, each bucket is verified by
Hamming distance, and the links' components are the groups. Buckets are counted first: one of over MAX_BUCKET classes
is not compared in a task but linked through common neighbours (far_links).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import text_column, written
from .components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE, SEED = 4, 42
BITS, DISTANCE, BLOCKS = 64, 4, 7
MAX_BUCKET = 20_000
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Bit i is set if it is in over half the shingles' hashes; no words (or null): 0."""
    words = WORD.findall((text or "").encode("utf-8", "replace").lower())
    if not words:
        return 0
    whole, hashed = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[-n:].tolist() if len(words) >= SHINGLE else [len(whole)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([hashed(whole[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """df with the fingerprint as a signed long."""

    def make():
        return lambda texts: pa.array(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))

    return df.withColumn(into, text_column("long", make)(F.col(text)))


def key_masks(blocks: int = BLOCKS) -> list[int]:
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - DISTANCE)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near(fp: np.ndarray, other: np.ndarray | int) -> np.ndarray:
    return np.bitwise_count((fp ^ other).view(np.uint64)) <= DISTANCE  # of signed numbers it counts the absolute value's bits


def forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly what all links of these distinct fingerprints join: each is compared with those not
    reached yet, so a tight group costs one comparison each and never all pairs."""
    a, b = [], []
    rest = np.arange(len(fp))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            hit = near(fp[rest], fp[x])
            found, rest = rest[hit], rest[~hit]
            a.append(np.full(len(found), fp[x]))
            b.append(fp[found])
            todo.extend(found)
    return np.concatenate([*a, fp[:0]]), np.concatenate([*b, fp[:0]])


def bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows k, v, fp sorted by (k, v), which are buckets. Gives links a, b."""
    k, v, fp = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def compare(k: np.ndarray, v: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]) if len(k) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, len(k)])
        bucket = np.repeat(np.arange(len(starts)), sizes)
        small = (sizes > 1) & (sizes <= 32)
        inside = np.flatnonzero(small[bucket]) if len(bucket) else np.zeros(0, np.int64)
        b, x = bucket[inside], fp[inside]
        for step in range(1, int(sizes[small].max(initial=1))):
            same = b[step:] == b[:-step]
            hit = same & near(x[step:], x[:-step])
            if hit.any():
                yield pa.RecordBatch.from_pydict({"a": x[:-step][hit], "b": x[step:][hit]})
        for i in np.flatnonzero(sizes > 32):
            a, b = forest(fp[starts[i] : starts[i] + sizes[i]])
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    for batch in batches:
        k = np.r_[k, batch.column("k").to_numpy()]
        v = np.r_[v, batch.column("v").to_numpy()]
        fp = np.r_[fp, batch.column("fp").to_numpy()]
        cut = int(np.flatnonzero((k != k[-1]) | (v != v[-1])).max(initial=-1)) + 1 if len(k) else 0
        yield from compare(k[:cut], v[:cut], fp[:cut])
        k, v, fp = k[cut:], v[cut:], fp[cut:]
    yield from compare(k, v, fp)


def far_links(classes: DataFrame) -> DataFrame:
    """Links among the classes of large buckets, linear in their number: each gives itself with 0, 1 and 2 bits turned
    (2,081 keys). Whatever meets at a key differs in 4 bits at most, and whatever differs in 4 bits or fewer meets."""
    turned = [0, *(1 << i for i in range(BITS)), *((1 << i) | (1 << j) for i, j in combinations(range(BITS), DISTANCE // 2))]
    at = classes.select("fp", F.explode(F.array(*[F.lit(signed(x)) for x in turned])).alias("turn")).select("fp", F.col("fp").bitwiseXOR(F.col("turn")).alias("key"))
    least = at.groupBy("key").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "a")
    return at.join(least, "key").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def links(classes: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """classes: fp (long), distinct. Links a, b whose components are those of all pairs within DISTANCE bits."""
    ship(classes.sparkSession)
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("v")) for i, m in enumerate(key_masks(blocks))])
    dealt, far = classes.select("fp", F.explode(keys).alias("key")).select("key.k", "key.v", "fp"), None
    if classes.count() > MAX_BUCKET:  # else no bucket can be large
        counted = dealt.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
        large = written(counted.where(F.col("n") > MAX_BUCKET).select("k", "v"), "simhash-large")
        if not large.isEmpty():
            far = written(dealt.join(large, ["k", "v"], "left_semi").select("fp").distinct(), "simhash-far")
            dealt = dealt.join(large, ["k", "v"], "left_anti")
    sorted_rows = dealt.repartition("k", "v").sortWithinPartitions("k", "v", "fp")
    found = written(sorted_rows.mapInArrow(bucket_links, "a long, b long").distinct(), "simhash-links")
    return found if far is None else found.union(far_links(far))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint (long), component_id, one row per row of df.

    component_id is the smallest doc_id of the group, by links of at most DISTANCE bits from text to text. Texts without
    words, null ones too, have fingerprint 0. A null doc_id is never a component's id unless all its ids are null. Ids are whole numbers, or text that Spark casts to them;
    long texts are read whole; repeated rows are of one component; an empty df gives no rows; other columns are left out. blocks:
    8 for more than some 10 million fingerprints (70 keys of 32 bits instead of 35 of 27).
    """
    prints = written(with_fingerprint(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fingerprint"), "simhash-prints")
    classes = written(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "simhash-classes")
    labels = components(links(classes.select("fp"), blocks))
    labelled = classes.join(labels, classes["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    groups = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(groups, "label").select(F.col("fp").alias("fingerprint"), "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")

"""Near-copies by word shingles: SimHash blocks (operator 5) and MinHash bands find candidates, exact overlap decides.

Two texts are near-copies if their sets of SHINGLE-word shingles have a Jaccard similarity of 4/5 or more. A text's set
gives BANDS keys of ROWS minima each; a pair at 0.8 shares none of them with probability (1 - 0.8^6)^32, 6 in 100,000.
Whatever shares a key is a candidate, and its similarity is counted on the full sets. Texts of equal words are one class
from the start. Operator 5 comes first: classes that its fingerprints link are compared, and those that are near get one label. The
bands then look for links between labels only: fingerprints of near-copies differ in up to some 17 of 64 bits, for which no key of
agreeing blocks is left that would tell texts apart (see the README).

A pair of sets of sizes a and b that is near shares 4/9 (a + b) shingles or more. So a text that shares too few of its
shingles with anything else is near to nothing, and is left out before any pair is made: of a group of loose copies, those
with many changes of their own. And it differs in (a + b) / 9 shingles or fewer: each set has a bitmap with the bits of
its shingles' hashes, and sets whose bitmaps differ in more bits than that make no pair either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import own_names, struct_of, text_column, written
from .components import components
from .simhash import WORD

SHINGLE, SEED = 5, 42
BANDS, ROWS = 32, 6
#: Shingles whose minima are taken at once.
CHUNK = 1 << 10
#: Keys of so many members are compared in full.
SMALL = 16
#: Heads of a key in the second round.
HEADS = 64
#: Columns of 64 bits that hold a set's bitmap, and what a member of a key carries besides.
BITMAP = [f"bits{i}" for i in range(16)]
CARRIED = ["n", "apart", *BITMAP]
#: The number of a row in the written input.

_turns = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
MULTIPLY, ADD = _turns[0] | np.uint64(1), _turns[1]


def shingles(text: str | None) -> tuple[int, np.ndarray]:
    """Hash of the words, and the distinct hashes of their shingles, sorted. Fewer than SHINGLE words are one shingle; no words (or null): 0, none."""
    words = WORD.findall((text or "").encode("utf-8", "replace").lower())
    if not words:
        return 0, np.zeros(0, np.uint64)
    whole, hashed = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[-n:].tolist() if len(words) >= SHINGLE else [len(whole)]
    return hashed(whole, SEED), np.unique(np.fromiter((hashed(whole[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, n))


def bands(found: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles; an empty set has none."""
    if not len(found):
        return found
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), CHUNK):
            least = np.minimum(least, (found[at : at + CHUNK, None] * MULTIPLY + ADD).min(axis=0))
        key = np.arange(BANDS, dtype=np.uint64)
        for row in least.reshape(ROWS, BANDS):
            key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key


def lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)))


def make_prints():
    def work(texts: list) -> pa.Array:
        found = [shingles(x) for x in texts]
        prints = np.array([simhash.fingerprint(x) for x in texts], np.uint64).view(np.int64)
        return struct_of(
            cls=np.array([c for c, _ in found], np.uint64).view(np.int64), n=np.array([len(s) for _, s in found], np.int32), fp=prints, bands=lists([bands(s) for _, s in found])
        )

    return work


SET = ", ".join(["set array<long>", *(f"{c} long" for c in BITMAP)])


def bitmap(found: np.ndarray) -> np.ndarray:
    """16 signed 64-bit numbers."""
    bits = np.zeros(64 * len(BITMAP), bool)
    bits[(found % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<i8")


def make_sets():
    def work(texts: list) -> pa.Array:
        found = [shingles(x)[1] for x in texts]
        bits = np.stack([bitmap(x) for x in found])
        return struct_of(set=lists(found), **{c: np.ascontiguousarray(bits[:, i]) for i, c in enumerate(BITMAP)})

    return work


def mixed(members: DataFrame) -> DataFrame:
    """members of the keys that hold more than one label, with the number of the key's members as m."""
    keys = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"))
    return written(members.join(keys.where("lo <> hi").select("key", "m"), "key"), "near-members")


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs a, b of classes those whose sets overlap enough."""
    side = lambda c: sets.select(F.col("cls").alias(c), F.col("set").alias(f"set_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # shared / (a + b - shared) >= 4 / 5
    found = both.where(9 * F.size(F.array_intersect("set_a", "set_b")) >= 4 * (F.size("set_a") + F.size("set_b")))
    return written(found.select("a", "b"), "near-links", narrow=True)


def simhash_pairs(classes: DataFrame) -> DataFrame:
    """Candidates a, b by operator 5. classes: cls, n, fp. Classes of one fingerprint make a pair with the least of them, and
    the least ones of two fingerprints that operator 5 links make one, so pairs are no more than classes and links."""
    known = classes.where("n > 0").select("cls", "n", "fp")
    least = written(known.groupBy("fp").agg(F.min(F.struct("cls", "n")).alias("head")).select("fp", "head.*"), "near-fingerprints", narrow=True)
    side = lambda c, fp: least.select(F.col("fp").alias(fp), F.col("cls").alias(c), F.col("n").alias(f"n_{c}"))
    equal = known.toDF("b", "n_b", "fp").join(side("a", "fp"), "fp").where("a <> b")
    linked = simhash.links(least.select("fp")).toDF("fp_a", "fp_b").join(side("a", "fp_a"), "fp_a").join(side("b", "fp_b"), "fp_b")
    both = equal.select("a", "n_a", "b", "n_b").union(linked.select("a", "n_a", "b", "n_b"))
    able = both.where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    return written(able.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-candidates", narrow=True)


def near_pairs(members: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b between heads and members of their key, by bitmaps first and then by the sets."""
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"head_{c}"))) for c in BITMAP), F.lit(0))
    able = members.join(heads, "key").where("label <> head_label and 5 * least(n, head_n) >= 4 * greatest(n, head_n)").where(9 * differ <= F.col("n") + F.col("head_n"))
    return near(able.select(F.least("cls", "head_cls").alias("a"), F.greatest("cls", "head_cls").alias("b")).distinct(), sets)


def named(df: DataFrame, labels: DataFrame, c: str, into: str) -> DataFrame:
    """df with the label of class c, which is c itself where it is linked to none."""
    return df.join(labels.toDF(c, "__label"), c, "left").withColumn(into, F.coalesce("__label", c)).drop("__label")


def chosen(members: DataFrame, slot: Column) -> DataFrame:
    """The head of each slot of a key: of its members the one that has the least part of its own. That order is the same in
    all keys, so that the same few classes head many of them."""
    carried = ["cls", "label", *[c for c in CARRIED if c != "apart"]]
    heads = members.groupBy("key", slot.alias("slot")).agg(F.min(F.struct("apart", F.xxhash64("cls").alias("h"), *carried)).alias("head"))
    return written(heads.select("key", *[F.col(f"head.{c}").alias(f"head_{c}") for c in carried]), "near-heads", narrow=True)


def links(members: DataFrame, sets: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """members: key, cls, label (of its component by known, else its cls), m, CARRIED (n: size of its set, apart: the part of it that no other
    has); sets: cls, set; known: links that are found already. Gives links a, b whose components, with the known ones, are those of all
    near-copies that share a key.

    Keys of SMALL members or fewer are compared in full, that is, each member is a head. Of others the member that shares
    most of its shingles is the head, and all others are compared with it. What is then of its component needs no pairs
    among itself; each member that is not becomes a head in its turn, HEADS, HEADS ** 2, ... of a key at once, and is
    compared with all. So a tight group costs one comparison a member, and only members that are not near to the first
    head are compared with all, by their bitmaps.
    """
    small = F.col("m") <= SMALL
    heads = chosen(members, F.when(small, F.col("cls")).otherwise(F.lit(0)))
    found = near_pairs(members, heads, sets)
    if members.where(~small).isEmpty():
        return found
    label = components(found if known is None else found.union(known))
    first = named(heads.select("key", "head_cls"), label, "head_cls", "first_label").drop("head_cls")
    rest = named(members.where(~small).drop("label", "m"), label, "cls", "label").join(first, "key")
    rest = written(rest.withColumn("free", F.col("label") != F.col("first_label")).drop("first_label"), "near-rest")
    k = 0
    while True:
        free = rest.where("free").select("key").distinct()
        members = written(rest.join(free, "key", "left_semi"), "near-members")
        if members.isEmpty():
            return found
        k += 1
        heads = chosen(members.where("free"), F.pmod(F.xxhash64(F.lit(k), "cls"), F.lit(HEADS**k)))
        found = found.union(near_pairs(members, heads, sets))
        rest = members.join(heads.select("key", F.col("head_cls").alias("cls")), ["key", "cls"], "left_anti")


def keyed(prints: DataFrame) -> DataFrame:
    """key, cls, n, label, m of the classes that share a key with another one."""
    return mixed(written(prints.select("cls", "n", F.explode("bands").alias("key")).distinct().withColumn("label", F.col("cls")), "near-keys"))


def able_members(members: DataFrame, sets: DataFrame) -> DataFrame:
    """members but for those that cannot be near to another one of their key, and apart of each.

    A shingle counts as shared if two sets or more hold it. Of the pairs of a member, the one with the smallest set of the
    key asks least.
    """
    holders = sets.select("cls", F.explode("set").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min("cls").alias("cls"))
    own = written(holders.where("held = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("own")), "near-own", narrow=True)
    counted = members.join(own, "cls", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    least = counted.groupBy("key").agg(F.min("n").alias("least"))
    able = counted.join(least, "key").where("9 * (n - own) >= 4 * (n + least)")
    told = able.select("key", "cls", "n", (F.col("own") / F.col("n")).alias("apart"), "label").join(sets.select("cls", *BITMAP), "cls")
    return mixed(written(told, "near-able"))


def one_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-copies: that of the smallest doc_id (null: only where all are null), of these that
    of the least text hash, and of equal rows one. Texts without a word, null ones too, are one group. Ids are whole numbers or text
    that Spark casts to them; long texts are compared whole; an empty df gives no rows. Columns keep their values, whatever their names.
    """
    (row,) = own_names(df, "row")
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    slim = rows.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prints = text_column("struct<cls long, n int, fp long, bands array<long>>", make_prints)(F.col("text"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", F.xxhash64("text").alias("h"), "row")
    prints = written(slim.select(first.alias("first"), prints.alias("p")).select("first", "p.*"), "near-prints")
    classes = written(prints.groupBy("cls").agg(F.min("first").alias("first"), F.min("n").alias("n"), F.min("fp").alias("fp")), "near-classes", narrow=True)
    members, pairs = keyed(prints), simhash_pairs(classes)
    compared = members.select("cls").union(pairs.select("a")).union(pairs.select("b")).distinct()
    holders = classes.join(compared, "cls", "left_semi").select("cls", "first.row")
    sets = written(slim.join(holders, "row").select("cls", text_column(SET, make_sets)(F.col("text")).alias("s")).select("cls", "s.*"), "near-sets")
    known = near(pairs, sets)
    members = named(members.drop("label"), components(known), "cls", "label")
    labels = components(known.union(links(able_members(members, sets), sets, known)))
    labelled = classes.join(labels, F.col("cls") == F.col("node"), "left").select("first", F.coalesce("label", "cls").alias("label"))
    keep = labelled.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(keep, row, "left_semi").drop(row)

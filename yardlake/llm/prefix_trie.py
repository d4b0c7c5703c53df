"""A trie of conversations: every distinct sequence of first turns is a node.

A turn is known by a digest. The digest of a prefix is the exclusive-or of digests of its (position, turn) pairs, so that it
is a running aggregate and no conversation is ever gathered. Nodes are found by fixed-length blocks of BLOCK turns:

1. Conversations are grouped by what they hold up to the end of each of their blocks. Equal blocks of equal conversations
   become one row that names a conversation for all, the smallest.
2. Blocks of the same beginning are siblings. Where a beginning has one block only, each of its turns is a node with the
   same members, so nothing is compared; only where siblings diverge their turns are grouped, those of one conversation for
   each distinct block.

A node is named by its smallest member and its depth; so the nodes that a conversation names are the end of its path (its own
turns beyond what a smaller conversation shares with it). Sums over subtrees need no iteration: a conversation hands the sums
of its own nodes to the last node of each smaller conversation on its path, which is one row per turn at most, and a running
sum from the deepest node up does the rest.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import written

BLOCK = 4
#: Ids of a chunk that is put together at once, at most.
CHUNK_BITS = 10
NO_IDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(df: DataFrame) -> DataFrame:
    """df: conv_id, turn, role, text. Gives conv_id, pos (from 0), digest, bytes (of the text).

    Order is by turn, null first; turns of one number are ordered by role and digest. A null role or text is empty, rows
    without a conv_id are left out. Repeated rows are turns of their own. Texts go no further than this.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length keeps role and text apart
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "digest", "bytes")


def word(hexadecimal: Column, at: int) -> Column:
    """8 bytes of a digest as a signed number."""
    high, low = (F.conv(F.substring(hexadecimal, at + i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def prefixes(turns: DataFrame) -> DataFrame:
    """turns: conv_id, pos, digest, bytes. Adds p (two longs, of the turns up to this one) and before (p of those before it), as structs."""
    placed = F.sha2(F.concat_ws(":", "pos", "digest"), 256)
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.select("conv_id", "pos", "bytes", word(placed, 0).alias("w1"), word(placed, 16).alias("w2"))
    run = rows.select("conv_id", "pos", "bytes", "w1", "w2", F.bit_xor("w1").over(upto).alias("p1"), F.bit_xor("w2").over(upto).alias("p2"))
    pair = lambda a, b: F.struct(a.alias("p1"), b.alias("p2"))
    p1, p2 = F.col("p1"), F.col("p2")
    return run.select("conv_id", "pos", "bytes", pair(p1, p2).alias("p"), pair(p1.bitwiseXOR(F.col("w1")), p2.bitwiseXOR(F.col("w2"))).alias("before"))


def nodes(turns: DataFrame) -> DataFrame:
    """turns: conv_id, pos, bytes, p, before, stored. Gives the nodes below the root: depth, p, before, bytes, conv_id, n_convs."""
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    own = turns.groupBy("conv_id", block).agg(F.min_by("before", "pos").alias("start"), F.max_by("p", "pos").alias("end"))
    # equal blocks after equal beginnings: one row, however many conversations have it
    distinct = own.groupBy("block", "start", "end").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    distinct = written(distinct, "trie-blocks")
    siblings = distinct.groupBy("block", "start").agg(F.count(F.lit(1)).alias("n_siblings"))
    told = distinct.join(siblings, ["block", "start"]).select("conv_id", "block", "n_convs", (F.col("n_siblings") > 1).alias("diverges"))
    depth = (F.col("pos") + 1).alias("depth")
    inside = turns.withColumn("block", block).join(told, ["conv_id", "block"]).select(depth, "p", "before", "bytes", "conv_id", "n_convs", "diverges")
    columns = ["depth", "p", "before", "bytes", "conv_id", "n_convs"]
    alone = inside.where("not diverges").select(*columns)
    apart = inside.where("diverges").groupBy("depth", "p").agg(F.first("before").alias("before"), F.first("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    return alone.unionByName(apart.select(*columns))


def hashed_ends(ends: DataFrame) -> DataFrame:
    """ends: conv_id, depth (a node's name), id. Gives conv_id, depth, ends_sha256 of the ids, ascending and joined by commas.

    Ids are put together by ranges of CHUNK_BITS bits and the chunks of a node are hashed one after another in one task, as
    SHA-256 takes its input in order; what a task holds is a batch of chunks.
    """
    chunk = F.shiftright("id", CHUNK_BITS).alias("chunk")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")), ",").alias("ids")
    chunks = ends.groupBy("conv_id", "depth", chunk).agg(joined)
    key = ["conv_id", "depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((c, d, i) for b in batches for c, d, i in zip(*(b.column(n).to_pylist() for n in (*key, "ids")), strict=True))
        digests = each_digest(rows)
        while some := list(itertools.islice(digests, 10_000)):
            c, d, h = zip(*some, strict=True)
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array(c, pa.int64()), "depth": pa.array(d, pa.int64()), "ends_sha256": pa.array(h, pa.string())})

    ship(ends.sparkSession)
    dealt = chunks.repartition(*key).sortWithinPartitions(*key, "chunk").select(*key, "ids")
    return dealt.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def each_digest(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (c, d), group in itertools.groupby(rows, key=lambda r: r[:2]):
        sha = hashlib.sha256()
        for i, (_, _, ids) in enumerate(group):
            sha.update(b"," * (i > 0) + ids.encode())
        yield c, d, sha.hexdigest()


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """turns: conv_id, pos (from 0, without gaps), digest (of role and text), bytes; conversations: conv_id, all of them once,
    those without turns too. Gives a row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that storing each turn once saves in its subtree), ends_sha256.

    Without conversations there is no node. Long conversations make deep nodes and nothing else; equal ones share their nodes.
    """
    turns = written(prefixes(turns), "trie-turns")
    found = written(nodes(turns), "trie-nodes")
    # the root's name: one value
    whole = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root_name = F.lit(whole.agg(F.first("conv_id")).first()[0]).cast("long")
    top = lambda c: F.lit(0).cast("long").alias(c)
    nothing = F.struct(top("p1"), top("p2"))
    root = whole.select(top("depth"), nothing.alias("p"), F.lit(None).cast("struct<p1:long,p2:long>").alias("before"), top("bytes"), "conv_id", "n_convs")
    every = root.unionByName(found)
    # children of each node, and its parent's name
    children = found.groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("p")).agg(F.count(F.lit(1)).alias("n_children"))
    every = written(every.join(children, ["depth", "p"], "left").fillna(0, ["n_children"]), "trie-tree")
    names = every.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("before"), F.col("conv_id").alias("parent_conv_id"))
    named = every.join(names, ["depth", "before"], "left")
    # sums: those of a conversation's own nodes go to the last node of each conversation on its path above them
    saved, leaf = (F.col("n_convs") - 1) * F.col("bytes"), (F.col("n_children") == 0).cast("long")
    own = every.groupBy("conv_id").agg(F.sum(saved).alias("saved"), F.sum(leaf).alias("leaves"), F.min("depth").alias("first"))
    names_of = every.select("depth", "p", F.col("conv_id").alias("name"))
    path = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "p").join(own.select("conv_id", "first"), "conv_id").where("depth < first")
    path = path.join(names_of, ["depth", "p"]).select("conv_id", "name", "depth")
    # the root is on every path but that of its own name
    from_root = own.where("first > 0").select("conv_id", root_name.alias("name"), top("depth"))
    leaves_at = path.unionByName(from_root).groupBy("conv_id", "name").agg(F.max("depth").alias("depth"))
    handed = leaves_at.join(own, "conv_id").groupBy(F.col("name").alias("conv_id"), "depth").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = named.join(handed, ["conv_id", "depth"], "left")
    total = lambda value, more: F.sum(value + F.coalesce(more, F.lit(0))).over(below).cast("long")
    summed = summed.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", total(leaf, F.col("more_leaves")).alias("n_leaves"), total(saved, F.col("more_saved")).alias("saved_tokens"))
    # where conversations end
    last = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("depth"), F.max_by("p", "pos").alias("p"))
    ended = conversations.join(last, "conv_id", "left").select(F.col("conv_id").alias("id"), F.coalesce("depth", top("depth")).alias("depth"), F.coalesce("p", nothing).alias("p"))
    ends = hashed_ends(ended.join(names_of, ["depth", "p"]).select(F.col("name").alias("conv_id"), "depth", "id"))
    return summed.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))


def build(df: DataFrame) -> DataFrame:
    """The trie of conversations as they are; df: conv_id, turn, role, text. Other columns are left out, whatever their names."""
    turns = ordered_turns(df)
    return trie(turns, df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct())

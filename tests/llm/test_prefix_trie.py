"""The trie of conversations against a plain one built from tuples."""

import hashlib
import zlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from yardlake.llm import prefix_trie, queries

KINDS = "conv_id long, turn int, role string, text string"


def slow(paths):
    """paths: conv_id -> list of (role, text). Gives the rows of all nodes."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def paths_of(rows):
    out = defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            role, text = r or "", t or ""
            out[c].append((n is not None, n or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    return {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in out.items()}


def rebuilt(paths):
    h = lambda c: zlib.crc32(str(c).encode()) % 9
    return {c: paths.get(c - c % 5, [])[: h(c)] + turns[h(c) :] for c, turns in paths.items()}


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


ODD = [
    (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "é漢"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, None, "user", "a"), (3, None, None, None), (4, 0, None, None),
    (5, 7, "user", "a"), (5, 7, "user", "a"), (5, 7, "assistant", "b"), (6, 0, "us", "era"), (7, 0, "user", "a"), (7, 1, "assistant", "b"), (7, 2, "user", "é漢"), (None, 0, "user", "a"), (8, 0, "user", "x" * 50_000),
    (-3, 0, "user", "a"), (9, 0, "", "user:a"),
]


def test_odd_conversations(spark, tmp_path):
    df = spark.createDataFrame([(*r, 5, "p", 7, "d", 1) for r in ODD], KINDS + ", pos int, p string, depth int, digest string, bytes int").repartition(3)
    assert got(prefix_trie.build(df)) == slow(paths_of(ODD))
    assert got(prefix_trie.build(df.limit(0))) == []
    assert got(prefix_trie.build(df.where("conv_id is null"))) == []
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    positive = [r for r in ODD if r[0] is None or r[0] >= 0]
    spark.createDataFrame(positive, KINDS).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    assert got(queries.op12_prefix_trie(spark, str(tmp_path))) == slow(rebuilt(paths_of(positive)))


def test_copies_and_long_conversations(spark):
    """One conversation of many turns, hundreds of copies of another, and branches at, before and after the ends of blocks."""
    rows = [(1000, i, "user", f"t{i}") for i in range(150)]
    rows += [(c, i, "user", f"t{i}") for c in range(300) for i in range(9)]
    for at in range(1, 14):
        rows += [(2000 + at, i, "user", f"t{i}" if i < at else f"own {at} {i}") for i in range(at + at % 3)]
        rows += [(3000 + at, i, "user", f"t{i}" if i < 12 else f"own {at}") for i in range(13)]
    df = spark.createDataFrame(rows, KINDS).repartition(5)
    assert got(prefix_trie.build(df)) == slow(paths_of(rows))


def test_ends_of_many_chunks(spark):
    ids = [i * 37 for i in range(3000)]
    ends = spark.createDataFrame([(0, 1, i) for i in ids] + [(5, 2, 5)], "conv_id long, depth long, id long").repartition(6)
    want = {(0, 1): ",".join(map(str, ids)), (5, 2): "5"}
    assert {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.hashed_ends(ends).collect()} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 99), st.lists(st.sampled_from("ab"), max_size=11), min_size=1, max_size=25))
def test_any_conversations(spark, given_paths):
    paths = {c: [("u", t) for t in turns] for c, turns in given_paths.items()}
    rows = [(c, i, "u", t) for c, turns in paths.items() for i, (_, t) in enumerate(turns)]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, KINDS))
    whole = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    assert got(prefix_trie.trie(turns, whole)) == slow(paths)

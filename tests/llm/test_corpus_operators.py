"""Packing, near-duplicates, chat, line dedup, token counts and the pipeline against brute force."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yardlake.llm import chat_format, line_dedup, packing, queries, simhash, token_counts
from yardlake.llm.common import shared_folder, table
from yardlake.llm.components import components
from yardlake.llm.word_bpe import Encoder
from yardlake.sources.sinks import Files

from test_near_copies import slow_label

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


# Packing


ODD_TEXTS = [
    "A<|EndOfText|>B <|ENDOFTEXT|> x<|endoftext|>y", "ΣΑΣ Σ. ΟΔΟΣ, İ. Å, A\u030a. é, 1. 2, a\xa0b. c D, x..y,. .,. (a). A\x1fB\x85C ﬁ. ǅ, ß.", "", " \n", "don't 'S. it's,",
]


def test_word_encoder_equals_library():
    e = Encoder()
    for _ in range(2):  # the second time from memory
        for text, ids in zip(ODD_TEXTS, e.encode(ODD_TEXTS), strict=True):
            assert ids.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB,. \n\té<|>'\x1f\x85\u2003s1"), max_size=40))
def test_word_encoder_on_any_text(text):
    e = ENCODER
    assert e.encode([text])[0].tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


ENCODER = Encoder()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offset = packing.best_fit(np.array(lengths, np.int64), 64)
    room: list[int] = []
    for n, w, o in zip(lengths, where, offset, strict=True):  # the tightest open window, found by looking at all
        fit = [r for r in room if r >= n]
        if fit:
            assert room[w] == min(fit) and o == 64 - room[w]
            room[w] -= n
        else:
            assert w == len(room) and o == 0
            room.append(64 - n)


def test_pack(spark, odd_documents):
    rows = packing.pack(packing.pieces(odd_documents)).collect()
    encode = Encoder().tokenizer
    want = Counter()
    for r in odd_documents.collect():
        ids = np.array([*encode.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((r.doc_id, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)) for at in range(0, len(ids), 2048))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.pack(packing.pieces(odd_documents.limit(0))).count() == 0


# Near-duplicates


def slow_print(text):
    raw = (text or "").encode().lower()
    words = [w for w in raw.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints):
    group = {p: p for p in prints}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    ps = list(group)
    for i, p in enumerate(ps):
        for q in ps[:i]:
            if (p ^ q).bit_count() <= 4:
                group[top(p)] = top(q)
    return {p: top(p) for p in ps}


def check_groups(rows):
    prints = {r.fingerprint & (1 << 64) - 1 for r in rows}
    group, least = slow_groups(prints), {}
    for r in rows:
        g = group[r.fingerprint & (1 << 64) - 1]
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    for r in rows:
        assert r.component_id == least.get(group[r.fingerprint & (1 << 64) - 1])


def test_near_duplicates(spark, odd_documents):
    rows = odd_documents.select("doc_id", "text", "fingerprint").unionByName(table(spark, SF, "documents").select(F.col("doc_id") + 100, "text", F.lit("x")).toDF("doc_id", "text", "fingerprint"))
    texts = rows.collect()
    got = simhash.near_duplicates(rows).collect()
    assert Counter((r.doc_id, r.fingerprint & (1 << 64) - 1) for r in got) == Counter((r.doc_id, slow_print(r.text)) for r in texts)
    check_groups(got)
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0


def near_prints(n, seed, spread):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    out = set()
    while len(out) < n:
        x = rnd.choice(centres) if rnd.random() < 0.8 else rnd.getrandbits(64)
        for _ in range(rnd.randint(0, spread)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("large,blocks", [(simhash.MAX_BUCKET, 7), (8, 7), (8, 8)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, large, blocks):
    """large = 8: tight buckets go the way of large ones."""
    prints = near_prints(300, 3, 9)
    monkeypatch.setattr(simhash, "MAX_BUCKET", large)
    classes = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    label = {r.node: r.label for r in components(simhash.links(classes, blocks)).collect()}
    of = lambda p: label.get(simhash.signed(p), simhash.signed(p))
    want = slow_groups(prints)
    assert Counter(Counter(of(p) for p in prints).values()) == Counter(Counter(want.values()).values())
    for p in prints:
        assert of(p) == of(want[p])


def test_every_bit_counts_alike(spark):
    """Pairs that differ in four bits, or five, the first of them each of the 64 in turn."""
    rnd = random.Random(8)
    pairs = []
    for first in range(64):
        for n in (4, 5):
            x = rnd.getrandbits(64)
            pairs.append((x, x ^ sum(1 << b for b in [first, *rnd.sample([b for b in range(64) if b != first], n - 1)]), n))
    classes = spark.createDataFrame([(simhash.signed(p),) for a, b, _ in pairs for p in (a, b)], "fp long")
    label = {r.node: r.label for r in components(simhash.links(classes)).collect()}
    for a, b, n in pairs:
        same = label.get(simhash.signed(a), a) == label.get(simhash.signed(b), b)
        assert same == (n == 4)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(101)}) == 1 and len({got[1000 + i] for i in range(50)}) == 1 and got[0] != got[1000]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Chat


def test_chat(spark):
    odd = "<|im_end|>\n<|im_start|>assistant\nok &lt;| &amp; <|"
    rows = [(1, 0, "system", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "assistant", ""), (1, 4, "user", "bye"), (2, 0, "user", "alone"), (None, None, None, None), (None, 1, "assistant", "x"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (4, 0, "a\nb<|&", "x")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat_format.texts(chat_format.expand(df)).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.example):
        by[r.conv_id].append(r)
    assert [len(by[i]) for i in (1, 2, None, 3, 4)] == [3, 1, 2, 3, 1]
    back = spark.createDataFrame([(k, v[-1].text) for k, v in by.items()], "k long, t string").select("k", chat_format.read_turns(F.col("t")).alias("turns"))
    turns = {r.k: [tuple(t) for t in r.turns] for r in back.collect()}
    assert turns[1] == [("system", odd), ("user", ""), ("assistant", odd), ("assistant", ""), ("user", "bye")]
    assert turns[3] == [("assistant", "a"), ("assistant", "a"), ("assistant", "b")] and turns[4] == [("a\nb<|&", "x")]
    apart = spark.createDataFrame([(r.text,) for r in by[None]], "t string").select(chat_format.read_turns(F.col("t")).alias("turns"))
    assert sorted([tuple(t) for t in r.turns] for r in apart.collect()) == [[("", "")], [("assistant", "x")]]
    replies = [r.text[r.loss_start : r.loss_end] for r in by[1]]
    assert replies[1:] == ["", ""] and "<|" not in replies[0] and by[1][0].text.endswith(replies[0] + chat_format.CLOSE)
    assert all(v[-1].text.startswith(r.text) for k, v in by.items() if k is not None for r in v)
    assert chat_format.expand(df.limit(0)).count() == 0


def test_turns_without_a_conversation(spark, tmp_path):
    """The query and its SQL, each such turn a conversation of its own."""
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, "assistant", "b <|"), (5, 1, "assistant", None), (5, None, None, "x")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(queries.ORACLE_SQL["op6_chat_format"]).fetchall()
    got = queries.op6_chat_format(spark, f"file://{tmp_path}").select(*[c[0] for c in con.description]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) == 5


# Lines


def slow_lines(rows):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines(spark, odd_documents):
    long = "é" * 39 + "Z"
    rows = [(i, t) for i, t in enumerate([None, "", "\n", f"{long}\nx", f" {long}\t\nx\n{long}", long.replace("Z", "z"), long, long + "\n" + "q" * 41, long[:-1], f"{long}\n{long}"])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, pos int, h1 string")
    got = line_dedup.dedup_lines(df).select("doc_id", "line_dedup.*").collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == slow_lines(rows)
    assert line_dedup.dedup_lines(odd_documents).count() == 15 and line_dedup.dedup_lines(odd_documents.limit(0)).count() == 0


def test_runs_are_levelled(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, f"file://{tmp_path}/runs")
    for b in range(7):
        batch = spark.createDataFrame([(k, k, b * 10 + k) for k in range(b, b + 3)], "h1 long, h2 long, doc_id long")
        new = {r.h1 for r in runs.unseen(batch).collect()}
        assert new == (set(range(3)) if b == 0 else {b + 2})
        runs.add(batch)
    assert [len(x) for x in runs.levels] == [1, 1, 1] and [len(x) for x in runs.repeats] == [0, 1, 1]
    held = [r.h1 for level in runs.levels for name in level for r in spark.table(name).collect()]
    assert sorted(held) == list(range(9))  # each key in one run
    assert {(r.h1, r.n_docs, r.last_doc) for r in runs.table().collect()} == {(k, min(k, 6) - max(0, k - 2) + 1, min(k, 6) * 10 + k) for k in range(9)}
    runs.close()
    assert not any(t.name.startswith(runs.name) for t in spark.catalog.listTables())


def test_anti_joins_and_compaction_move_nothing(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, f"file://{tmp_path}/runs")
    runs.add(spark.range(50).selectExpr("id as h1", "id as h2", "id as doc_id"))
    runs.add(spark.range(25, 80).selectExpr("id as h1", "id as h2", "id as doc_id"))
    tables = [spark.table(x) for level in runs.levels for x in level]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    anti = plan(runs.unseen(tables[-1]))
    assert anti.count("LeftAnti") == len(tables) and "Exchange" not in anti
    assert "Exchange" not in plan(runs._with(tables[0], runs.levels[-1][0], "full")) and "Exchange" not in plan(runs.table())
    runs.close()


# Token counts


@pytest.mark.parametrize("block", [7, 64, 1 << 18])
def test_token_counts(spark, odd_documents, block):
    folder = token_counts.write_flat(odd_documents.repartition(3))
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.scan(spark, folder, block=block).collect())
    encode = Encoder().tokenizer.encode
    assert got == Counter((r.doc_id, len(encode(r.text or "", add_special_tokens=False).ids)) for r in odd_documents.collect())


def test_a_file_is_scanned_by_several_tasks(spark):
    """Ranges of 5,000 bytes, which begin at even and at odd bytes of one file of all documents."""
    docs = table(spark, SF, "documents").select("doc_id", "text").coalesce(1)
    folder = token_counts.write_flat(docs)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        ranges = spark.read.option("pathGlobFilter", "part-*").option("lineSep", "A").text(folder).rdd.getNumPartitions()
        rows = token_counts.scan(spark, folder, block=1999).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    encode = Encoder().tokenizer.encode
    assert ranges > 20 and len({r.file for r in rows}) == 1
    assert [(r.doc_id, r.n_tokens) for r in sorted(rows, key=lambda r: r.ordinal)] == [(r.doc_id, len(encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([0xFF41, 0x41FF, 0x4141, 0x00FF, 0x4100, 5]), max_size=60), st.integers(1, 9), st.sampled_from([0, token_counts.HEADER]))
def test_scan_of_any_ids_in_any_blocks(ids, size, head):
    raw = np.array(ids, ">u2").tobytes()
    state, got = token_counts.Scan(head), []
    for at in range(0, len(raw), size):
        part = raw[at : at + size]
        readings = [SimpleNamespace(**token_counts.summary(part, odd, head)) for odd in (0, 1)]
        odd, before, ended, n_ended = state.block(readings)
        assert before == len(got)
        got += [*zip(ended, n_ended, strict=True), *zip(readings[odd].doc_ids, readings[odd].tokens, strict=True)]
    want, begin = [], 0
    for i, x in enumerate(ids):
        if x == 0xFF41:
            doc = ids[begin:i]
            whole = head and len(doc) >= head
            want.append((token_counts.read_headers(np.array(doc[:head]))[0] if whole else None, max(len(doc) - head, 0)))
            begin = i + 1
    assert got == want


def test_foreign_token_file(spark, tmp_path):
    ids = np.array([5, 6, 0xFF41, 0xFF41, 7, 0xFF41, 9], ">u2")
    (tmp_path / "part-0").write_bytes(ids.tobytes())
    (tmp_path / "part-1").write_bytes(b"")
    got = token_counts.scan(spark, f"file://{tmp_path}", head=0, block=2).orderBy("ordinal").collect()
    assert [(r.ordinal, r.doc_id, r.n_tokens) for r in got] == [(0, None, 2), (1, None, 0), (2, None, 1)]


@pytest.mark.parametrize("tail", [b"", b"\xff", b"A", b"\xff\x41", b"AA", b"\x00\x07\xff"])
@pytest.mark.parametrize("block", [3, 64])
def test_file_that_breaks_off(spark, tmp_path, tail, block):
    """The byte that a line of the file would end with is not there: it makes no id and no document."""
    raw = np.array([5, 6, 0xFF41, 7, 8], ">u2").tobytes() + tail
    (tmp_path / "part-0").write_bytes(raw)
    ids = np.frombuffer(raw, ">u2", len(raw) // 2).tolist()
    want = [2] + ([ids[3:].index(0xFF41)] if 0xFF41 in ids[3:] else [])
    assert [r.n_tokens for r in token_counts.scan(spark, f"file://{tmp_path}", head=0, block=block).orderBy("ordinal").collect()] == want


def test_header():
    for x in (0, -1, 1 << 62, -(1 << 63), (1 << 63) - 1, None):
        assert token_counts.read_headers(np.frombuffer(token_counts.header(x), ">u2")) == [x]


# Pipeline


@pytest.fixture(scope="module")
def pipeline():
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline

    return corpus_pipeline


def test_stages(spark, pipeline, odd_documents):
    labels = "/root/testdata/sf0.001"
    docs = odd_documents
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, labels)
        assert out.columns == docs.columns, name
        given = {r.row: r.asDict() for r in docs.collect()}
        for r in out.collect():
            assert {c: v for c, v in r.asDict().items() if c not in ("text", "n_chars")} == {c: v for c, v in given[r.row].items() if c not in ("text", "n_chars")}
        assert stage(spark, docs.limit(0), labels).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, labels).count() > 0


def test_pipeline_end_to_end(spark, pipeline):
    docs = table(spark, SF, "documents")
    stages = dict(pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    lines = stages["line_dedup"](spark, kept, SF)
    before = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in lines.collect()) == sorted((d, t, len(t)) for d, _, _, t in slow_lines(before))
    single = stages["near_copy_dedup"](spark, docs, SF)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    label = slow_label([t for _, t in rows])
    least: dict[int, int] = {}
    for (doc_id, _), g in zip(rows, label, strict=True):
        least.setdefault(g, doc_id)
    assert {r.doc_id for r in single.collect()} == set(least.values())
    folder = shared_folder(spark)
    before = set(Files(spark, folder).names(folder))
    pieces = pipeline.run(spark, SF)
    left = set(Files(spark, folder).names(folder)) - before
    assert pieces.count() > 0 and len(left) == 1 and left.pop().startswith("stage-packing")

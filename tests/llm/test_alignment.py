"""Cross-tokenizer alignment against whole-text encoding by the two libraries and plain counting."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from yardlake.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A = Tokenizer.from_file(public_tokenizers.path(alignment.A_FILE))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B_FILE))
BACK = alignment.byte_alphabet()


def tokens(text):
    """Ids and byte ranges of both sides; None where a side does not give the text back."""
    x = A.encode(" " + text, add_special_tokens=False).ids
    y = B.encode(text)
    of_a = [bytes(BACK[c] for c in A.id_to_token(i)) for i in x]
    of_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in y]
    raw = (" " + text).encode()
    if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
        return None
    spans = []
    for ids, parts in ((x, of_a), (y, of_b)):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        spans.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends, strict=True)])
    return spans


def slow_text(text):
    found = tokens(text or "")
    if not found:
        return 0, 0, 0, "", []
    x, y = found
    both = {e for *_, e in x} & {e for *_, e in y}
    spell, groups = lambda side, lo, hi: ",".join(str(i) for i, _, e in side if lo < e <= hi), []
    lo = 0
    for hi in sorted(both):
        groups.append(f"{spell(x, lo, hi)}|{spell(y, lo, hi)}")
        lo = hi
    links = [(a, b) for a, s, e in x for b, t, f in y if s < f and t < e]
    return len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def slow(texts):
    found = [slow_text(t) for t in texts]
    n = Counter(p for f in found for p in set(f[4]))
    best = {}
    for (a, _), k in n.items():
        best[a] = max(best.get(a, 0), k)
    return [(*f[:3], len(f[4]), sum(n[p] == best[p[0]] for p in f[4]), sum(n[p] for p in f[4]), f[3]) for f in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "\ta  \n b ", "x ▁y", "▁", "<s> </s> <0x41> <unk>", "<|endoftext|> it's", "\x00\x01 \x85 \xa0 q", "é漢字🙂 ß ﬁ ½",
    "a　b   c", "don't  we'll\r\n", "the the the the", "the the the the", "A" * 3000, "zq " * 5000, "\x1c \x1d x",
]


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if len(r["text"]) < 4000}
    docs = queries.table(spark, SF, "documents").where("length(text) < 4000")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(docs).collect()}
    assert got == dict(zip(texts, slow(texts.values()), strict=True))
    whole = {r.doc_id: r for r in queries.op13_alignment(spark, SF).collect()}
    assert len(whole) == docs.sparkSession.read.parquet(f"{SF}/documents.parquet").count()
    assert all(whole[i].groups_sha256 == w[-1] and whole[i].n_links == w[3] for i, w in got.items())


def test_odd_texts(spark):
    """Every row is a document, with repeated and null ids too; foreign columns of clashing names do no harm."""
    rows = [Row(doc_id=None if i % 7 == 3 else i // 2, text=t, task="t", slice=1, radix="r", row=2, frame="f", n_a=-1, key="k", KEY="K") for i, t in enumerate(ODD)]
    kinds = "doc_id long, text string, task string, slice int, radix string, row int, frame string, n_a int, key string"
    df = spark.createDataFrame([tuple(r)[:9] for r in rows], kinds).repartition(3)
    got = sorted(str((r.doc_id, *(r[c] for c in COLUMNS))) for r in alignment.align_documents(df).collect())
    assert got == sorted(str((r.doc_id, *s)) for r, s in zip(rows, slow(ODD), strict=True))
    assert alignment.align_documents(df.limit(0)).count() == 0
    assert alignment.align_documents(df.where("text is null")).select("n_a").distinct().collect() == [Row(n_a=0)]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB' \n\té1.▁\x85\xa0\x1c漢"), max_size=14), max_size=5))
def test_slices_of_any_texts(texts):
    own = alignment.aligner()
    counts, shas, records, links = alignment.aligned(texts, own)
    for i, (t, want) in enumerate(zip(texts, map(slow_text, texts), strict=True)):
        assert (*counts[i][:3], shas[i]) == want[:4], repr(t)
        mine = records & (1 << alignment.ROW_BITS) - 1 == i
        pairs = (records[mine] >> alignment.ROW_BITS).tolist()
        assert dict(zip(pairs, links[mine].tolist(), strict=True)) == Counter(a << alignment.ID_BITS | b for a, b in want[4])


@pytest.mark.parametrize("text", ["the cat, a dog " * 9, "a  b   c\n d ", "one two ▁ three four five six", "x" * 100 + " y z", "ab " * 20])
def test_long_texts_in_parts(monkeypatch, text):
    own = alignment.aligner()
    whole = alignment.aligned([text], own)
    monkeypatch.setattr(alignment, "PART", 4)
    monkeypatch.setattr(alignment, "MEMO", 2)
    parts = alignment.aligned([text], own)
    assert parts[1] == whole[1] and all((p == w).all() for p, w in zip(parts[::2], whole[::2], strict=True)) and (parts[3] == whole[3]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=12), max_size=7), st.integers(1, 9))
def test_heap_merge(runs, step):
    given_step, alignment.STEP = alignment.STEP, step
    try:
        of = [alignment.added(np.array([k for k, _ in r], np.int64), np.array([n for _, n in r], np.int64)) for r in runs]
        blocks = list(alignment.merged(of))
    finally:
        alignment.STEP = given_step
    keys = [k for b, _ in blocks for k in b.tolist()]
    want = Counter()
    for r in runs:
        for k, n in r:
            want[k] += n
    assert keys == sorted(want) and {k: n for b, m in blocks for k, n in zip(b.tolist(), m.tolist(), strict=True)} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 41), max_size=30).map(sorted), st.lists(st.integers(0, 70_000), max_size=30))
def test_frames(keys, numbers):
    back = alignment.unpacked(alignment.packed(np.array(keys, np.int64), np.array(numbers, np.int64)), 2)
    assert back[0].tolist() == keys and back[1].tolist() == numbers


def test_a_worker_that_forgets_gives_the_same(spark):
    """Totals do not depend on how rows are dealt to tasks."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["the cat", "the dog", "cat the", None, "a cat  "] * 8)], "doc_id long, text string")
    one, many = (sorted(map(tuple, alignment.align_documents(df.repartition(n)).collect())) for n in (1, 7))
    assert one == many


def test_shares_of_splits(spark, monkeypatch):
    """However many shares the runs are dealt over, sums are the same; a share is worth its copy of the totals, or there are as many as cores ask for."""
    texts = [(i, f"the cat {i % 7} and a dog {i % 5}") for i in range(60)]
    df = spark.createDataFrame(texts, "key long, text string").repartition(5)
    runs = alignment.spill(df, alignment.aligner, "key").where("radix is not null")
    totals = alignment.counted(runs)
    one, many = (sorted(map(tuple, alignment.contributions(runs, totals, n).collect())) for n in (1, 9))
    assert one == many and one
    sizes = {df: sum(len(r.frame) for r in df.select("frame").collect()) for df in (runs, totals)}
    monkeypatch.setattr(alignment, "RADIX", 1 << 10)
    assert alignment.shares(runs, totals) == 1
    monkeypatch.setattr(alignment, "SHARE", 1)
    assert alignment.shares(runs, totals) == -(-sizes[runs] // sizes[totals])

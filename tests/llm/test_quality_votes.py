"""Neighbour votes: held-out labels, and a plain computation of the query."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row

from yardlake.llm import quality_votes, queries

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    found = {r.doc_id: r for r in queries.op11_quality_votes(spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert set(found) == {d["doc_id"] for d in docs} and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out for i in held) and not any(found[i].held_out for i in labels if i not in set(held))
    assert sum(found[i].predicted == labels[i] for i in held) >= 0.95 * len(held)
    same = {}
    for d in docs:  # equal texts, equal scores
        assert same.setdefault(d["text"], found[d["doc_id"]].score) == pytest.approx(found[d["doc_id"]].score, abs=1e-9)


def slow_terms(text):
    """The counted terms of a text, by what they stand for."""
    out = Counter()
    words = re.findall(r"[^\x00-\x20]+", text.lower())
    out.update(("w", w) for w in words)
    out["twice"] = sum(a == b for a, b in zip(words, words[1:]))
    out["thrice"] = sum(a == b == c for a, b, c in zip(words, words[1:], words[2:]))
    kinds = [int(quality_votes.CLASSES[min(ord(c), 0x250)]) for c in f" {text} "]
    short = [k for i, k in enumerate(kinds) if i < 2 or not k == kinds[i - 1] == kinds[i - 2]]
    for n in quality_votes.ORDERS:
        out.update(("g", *short[i : i + n]) for i in range(len(short) - n + 1))
    return Counter({k: n for k, n in out.items() if n})


@pytest.mark.parametrize("text", ["a", "The cat the CAT!! cat  cat cat\n\n| x | 12&&& é漢", "a a a b\tb\x0b c", "AAAA bbb ,,,,, !"])
def test_terms(text):
    """Each hashed term counts what one plain term counts, if no two meet."""
    owner, term, times = quality_votes.terms(["zz top", text, None])
    want, mine = slow_terms(text), owner == 1
    assert sorted(times[mine]) == sorted(want.values()) or len(term[mine]) < len(want)
    alone = quality_votes.terms([text])
    assert (alone[1] == term[mine]).all() and (alone[2] == times[mine]).all()
    assert times[mine].sum() == sum(want.values())


def test_query_equals_brute_force(spark, tmp_path):
    """All documents compared with all labelled ones, one by one; every label row is within the bounds, so all count."""
    rng = np.random.default_rng(3)
    words = ["river", "stone", "walk", "Blue", "seven", "tree", "cloud", "lamp"]
    texts = [" ".join(rng.choice(words, 30)) + "." if i % 3 else " ".join(f"{w.upper()}!!" for w in rng.choice(words, 30)) for i in range(120)]
    docs = [Row(doc_id=i, text=t) for i, t in enumerate(texts)]
    labels = [Row(doc_id=i, quality=int(i % 3 > 0), toxic=0) for i in range(0, 120, 2)] + [Row(doc_id=4, quality=0, toxic=1), Row(doc_id=None, quality=1, toxic=0), Row(doc_id=6, quality=None, toxic=0)]
    spark.createDataFrame(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.score for r in queries.op11_quality_votes(spark, str(tmp_path)).collect()}
    mark = {i: min(r.quality for r in labels if r.doc_id == i and r.quality is not None) for i in range(0, 120, 2) if zlib.crc32(str(i).encode()) % 5}
    dense = np.zeros((120, quality_votes.TERMS))
    owner, term, times = quality_votes.terms(texts)
    dense[owner, term] = np.log2(1 + times)
    dense *= np.log(121 / (1 + (dense > 0).sum(0)))
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    train = list(mark)
    # where the rank reaches that of the labelled rows, latent vectors are projections on their row space
    basis = np.linalg.svd(dense[train], full_matrices=False)[2]
    assert len(train) <= quality_votes.RANK
    latent = dense @ basis.T
    latent /= np.linalg.norm(latent, axis=1, keepdims=True)
    rate = np.mean(list(mark.values()))
    for i in range(120):
        near = latent[train] @ latent[i]
        least = np.sort(near)[-quality_votes.NEIGHBOURS]
        votes = [(s**quality_votes.POWER, mark[j]) for s, j in zip(near, train) if s >= max(least, 0)]
        want = (sum(w * y for w, y in votes) + quality_votes.PRIOR * rate) / (sum(w for w, _ in votes) + quality_votes.PRIOR)
        assert got[i] == pytest.approx(want, abs=0.02)


def test_odd_documents(spark, odd_documents):
    """Nulls, empty and long texts, repeated ids, foreign columns: all rows come back with their own values."""
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, 1, None), (None, 1, 1), (4, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality_votes.fit(quality_votes.training_rows(odd_documents, labels), odd_documents)
    out = quality_votes.score(odd_documents, model, into="own").collect()
    key = lambda r: str((r.doc_id, r.text, r.label, r.score, r.language))
    assert sorted(map(key, out)) == sorted(map(key, odd_documents.collect())) and all(0 <= r.own.score <= 1 for r in out)
    assert all(r.own.score == pytest.approx(model.rate) for r in out if not r.text)
    assert quality_votes.score(odd_documents.limit(0), model).count() == 0
    none = quality_votes.fit(quality_votes.training_rows(odd_documents, labels.limit(0)), odd_documents)
    assert {r.quality.score for r in quality_votes.score(odd_documents.limit(3), none).collect()} == {0.5}
    one = quality_votes.fit(quality_votes.training_rows(odd_documents, labels.where("quality = 1")), odd_documents)
    assert all(r.quality.score == pytest.approx(1) for r in quality_votes.score(odd_documents, one).collect())


def test_bounds_keep_the_rate_of_labels(spark, monkeypatch):
    monkeypatch.setattr(quality_votes, "MAX_ROWS", 3)
    train = spark.createDataFrame([(i, f"text {i} of many", int(i > 4)) for i in range(30)] + [(9, "another text of nine", 1)], "doc_id long, text string, label int")
    model = quality_votes.fit(train, train)
    assert len(model.labels) == 6 and model.rate == pytest.approx(25 / 30)
    assert sorted(set(model.stands_for.round(6))) == [round(5 / 3, 6), round(25 / 3, 6)]

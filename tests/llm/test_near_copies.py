"""The pipeline's near-copy stage against brute force."""

import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

from yardlake.llm import near_copies, simhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

KINDS = "doc_id long, text string, source string"


def grams(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_label(texts):
    """Group of each text, by all pairs."""
    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def copies(seed, groups, each, edits, n_words=120):
    """Texts: copies of a few base texts with some words changed, and texts of their own."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    out = []
    for _ in range(groups):
        base = [word() for _ in range(n_words)]
        for _ in range(each):
            text = list(base)
            for _ in range(rnd.randint(0, edits)):
                text[rnd.randrange(n_words)] = word()
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("groups,each,edits", [(12, 3, 3), (1, 60, 3)])
def test_near_copies_at_four_fifths(spark, groups, each, edits):
    texts = [*copies(7, groups, each, edits), "one two", "ONE  two", "one two three", None, "", " \n"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, KINDS), "")
    label = slow_label(texts)
    least = {g: label.index(g) for g in label}
    assert Counter(r.doc_id for r in got.collect()) == Counter(least.values())
    assert got.columns == ["doc_id", "text", "source"]


def test_loose_members_of_one_key(spark):
    """All share a key but few are near: those that are get linked, whatever head comes first."""
    sets = {c: list(range(100 * c, 100 * c + 50)) for c in range(40)}
    sets[40], sets[41] = [*range(50, 98), 1, 2], [*range(50, 97), 1, 2, 3]  # near to each other alone
    bits = {c: near_copies.bitmap(np.array(s, np.uint64)).tolist() for c, s in sets.items()}
    members = spark.createDataFrame([(1, c, 50, 0.0, c, len(sets), *bits[c]) for c in sets], "key long, cls long, n int, apart double, label long, m long" + "".join(f", {b} long" for b in near_copies.BITMAP))
    found = near_copies.links(members, spark.createDataFrame(list(sets.items()), "cls long, `set` array<long>"))
    assert [(r.a, r.b) for r in found.collect()] == [(40, 41)]


def test_one_row_of_each_group(spark):
    x, y, near_y, z = copies(11, 3, 1, 0) + copies(12, 1, 1, 0)
    near_y = y + " more"
    rows = [(5, x), (5, x), (5, x), (5, y), (3, near_y), (None, z), (None, z), (None, x), (None, "own words"), (None, "other words")]
    df = spark.createDataFrame([(*r, "s") for r in rows], KINDS).repartition(3)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect())
    assert got == Counter([(5, x), (3, near_y), (None, z), (None, "own words"), (None, "other words")])


def test_loose_group(spark):
    """Copies of one text with few to many changes: what is near is found as by all pairs, but hardly any pair is made."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base, texts = [word() for _ in range(150)], []
    for _ in range(250):
        text = list(base)
        for _ in range(rnd.randrange(24)):
            text[rnd.randrange(150)] = word()
        texts.append(" ".join(text))
    rows = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], KINDS)
    label = slow_label(texts)
    least = {g: label.index(g) for g in label}
    assert 30 < len(least) < 220
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, rows, "").collect()) == sorted(least.values())
    sets = [grams(t) for t in texts]
    numbered = {g: i for i, g in enumerate(sorted(set().union(*sets)))}
    members = spark.createDataFrame([(1, c, len(s), c) for c, s in enumerate(sets)], "key long, cls long, n int, label long")
    bitmaps = [near_copies.bitmap(np.array([numbered[g] for g in s], np.uint64)).tolist() for s in sets]
    held = spark.createDataFrame([(c, [numbered[g] for g in s], *b) for c, (s, b) in enumerate(zip(sets, bitmaps, strict=True))], "cls long, `set` array<long>" + "".join(f", {b} long" for b in near_copies.BITMAP))
    able = {r.cls for r in near_copies.able_members(members, held).collect()}
    linked = {c for c in range(250) if label.count(label[c]) > 1}
    assert linked <= able and len(able) < len(linked) + 20


def test_bitmaps_never_rule_out_a_near_pair():
    rnd = np.random.default_rng(2)
    for n in (5, 40, 150, 900):
        for _ in range(40):
            a = rnd.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[: n - rnd.integers(0, n // 5 + 1)], rnd.integers(0, 1 << 63, rnd.integers(0, n // 5 + 1)).astype(np.uint64)])
            apart = len(set(a.tolist()) ^ set(b.tolist()))
            assert np.bitwise_count((near_copies.bitmap(a) ^ near_copies.bitmap(b)).view(np.uint64)).sum() <= apart


def test_operator_5_is_a_step(spark, monkeypatch):
    """Without any MinHash band its fingerprints still find what they link; the exact overlap decides on it, also on equal fingerprints."""
    monkeypatch.setattr(near_copies, "keyed", lambda prints, keyed=near_copies.keyed: keyed(prints.where("false")))
    own = lambda seed: copies(seed, 1, 1, 0, 40)[0]
    base = copies(21, 1, 1, 0, 400)[0]
    loop = "round and round and on it goes " * 80
    texts = [base, f"{base} more", own(22), loop + own(23), loop + own(24), None, " "]
    prints = [simhash.fingerprint(t) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.DISTANCE and (prints[3] ^ prints[4]).bit_count() <= simhash.DISTANCE
    rows = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], KINDS)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, rows, "").collect()) == [0, 2, 3, 4, 5]

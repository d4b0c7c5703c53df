"""Quality rules, language, toxicity, byte BPE and media against brute force and held-out rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yardlake.llm import byte_bpe, language_id, media_sniff, quality_rules, queries, toxicity
from yardlake.llm.common import table

SF = "/root/testdata/sf0.001"


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in text.split("\n"):
        if x.strip(" \t\n\x0b\x0c\r"):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "#x", "é", "\n", "\n\n", "\t", " "]), max_size=80))
def test_measures(parts):
    text = " ".join(parts)
    assert quality_rules.measure(text)[:5] == slow_measures(text)


def test_ledger(spark, odd_documents):
    got = quality_rules.verdicts(odd_documents).select("text", "ledger.*").collect()
    assert len(got) == 15
    for r in got:
        n = slow_measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (r.base_failed and r.kept)
    assert quality_rules.verdicts(odd_documents.limit(0)).count() == 0


def test_policies_and_ablations(spark):
    rows = quality_rules.verdicts(table(spark, SF, "documents")).persist()
    policy = quality_rules.POLICIES["v2"]
    bits = [r[0] for r in rows.select("ledger.fail_bits").collect()]
    got = {r.rule: (r.failed, r.sole, r.kept_without) for r in quality_rules.ablations(rows, policy).collect()}
    for rule in quality_rules.rules():
        flag = 1 << rule.bit
        want = (sum(bool(b & flag) for b in bits), sum(b & policy.any_of == flag for b in bits), sum(b & policy.any_of & ~flag == 0 for b in bits))
        assert got[rule.name] == want
    several = quality_rules.Policy("t", any_of=0, several_of=policy.any_of, at_least=2)
    kept = rows.where(quality_rules.allows(several, F.col("ledger.fail_bits"))).count()
    assert kept == sum(bin(b & policy.any_of).count("1") < 2 for b in bits)


def test_language_held_out(spark):
    docs = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_odd(spark, odd_documents):
    protos = language_id.train(table(spark, SF, "documents").where("lang is not null"))
    got = {(r.doc_id, r.text): r.language for r in language_id.predict(odd_documents, protos).collect()}
    assert got[1, None].lang_pred == got[2, ""].lang_pred == got[3, " \t\n"].lang_pred == "und"
    assert {r.language.lang_pred for r in language_id.predict(odd_documents, {}).collect()} == {"und"}
    assert language_id.train(odd_documents) == {}


def slow_bundle(text):
    """By the definition: bound letter vectors, added up."""
    low = [ord(c.lower()[0]) if c.isalpha() else 0 for c in f" {text or ''} "]
    v = lambda cp: language_id.letter_vectors(np.array([cp]))[0].astype(int)
    return sum((np.roll(v(a), 2) * np.roll(v(b), 1) * v(c) for a, b, c in zip(low, low[1:], low[2:], strict=False) if b), np.zeros(language_id.DIMENSIONS))


def slow_language(texts, taught):
    """(lang, score) of each text; taught: (lang, text)."""
    protos = {}
    for lang, t in taught:
        if lang is not None and t is not None:
            protos[lang] = protos.get(lang, 0) + slow_bundle(t)
    out = []
    for t in texts:
        b = slow_bundle(t)
        cos = {k: b @ p / max(np.linalg.norm(b) * np.linalg.norm(p), 1e-9) for k, p in sorted(protos.items())}
        best = max(cos, key=cos.get) if cos and np.linalg.norm(b) else None
        out.append((best, min(max(cos[best], 0), 1)) if best else ("und", 0.0))
    return out


def test_bundles_are_sums_of_bound_vectors():
    texts = ["abc", "", "ab cd", "Ärger Öl", "漢字かな", chr(0x30001) * 3]
    owner, codes = language_id.trigrams(texts)
    got = language_id.bundles(owner, codes, len(texts))
    for i, t in enumerate(texts):
        assert (got[i] == slow_bundle(t)).all()


def test_every_letter_has_a_vector_of_its_own():
    letters = [cp for cp in range(0x110000) if chr(cp).isalpha()]
    number = language_id.letter_numbers()
    assert all(number[letters]) and np.count_nonzero(number) == len(letters)
    first = [language_id.letter_vectors(np.unique(number[letters[i::8]])) for i in range(8)]
    packed = np.concatenate([np.packbits(v > 0, axis=1)[:, :32] for v in first])
    assert len(np.unique(packed.view("V32"))) == len(np.unique(number[letters]))
    v = language_id.letter_vectors(np.arange(1000))
    assert abs(v.mean()) < 0.01 and np.abs(v[1:].astype(int) @ v[0]).max() < 0.15 * language_id.DIMENSIONS


def test_letters_anywhere_in_unicode_are_not_und(spark):
    text = chr(0x30001) * 5
    protos = language_id.train(spark.createDataFrame([(1, text, "han"), (2, "abc abc", "en")], "doc_id long, text string, lang string"))
    got = language_id.predict(spark.createDataFrame([(text,), ("abc",), ("12 -",)], "text string"), protos).collect()
    assert [r.language.lang_pred for r in got] == ["han", "en", "und"]


def test_language_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, (r.text or "")[:400], r.lang) for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()] + [(900, None, "en"), (901, "no language", None), (902, "5 6", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted(queries.op2_language_id(spark, f"file://{tmp_path}").collect())
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    want = slow_language([t for _, t, _ in rows], [(g, t) for i, t, g in rows if not held(i)])
    assert [(r.doc_id, r.held_out, r.lang_pred) for r in got] == [(i, held(i), g) for (i, _, _), (g, _) in zip(rows, want, strict=True)]
    assert np.allclose([r.score for r in got], [s for _, s in want], atol=1e-4)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    got = queries.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    right = sum(p and y for p, y in held)
    assert right >= 0.98 * sum(p for p, _ in held) and right >= 0.9 * sum(y for _, y in held)
    assert all(r.predicted == (r.score >= 0.7) for r in got)


def test_toxicity_odd(spark, odd_documents):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, None), (None, 1), (8, 0), (9, 7)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_rows(odd_documents, labels))
    assert toxicity.score(odd_documents, model).count() == 15
    none = toxicity.fit(toxicity.training_rows(odd_documents, labels.where("toxic = 0")))
    assert {r.toxicity.predicted for r in toxicity.score(odd_documents, none).collect()} == {0}
    assert toxicity.score(odd_documents.limit(0), model).count() == 0


def test_byte_bpe_equals_library(spark, odd_documents):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(), special_tokens={})
    rows = odd_documents.select("doc_id", "text").unionByName(table(spark, SF, "documents").select("doc_id", "text"))
    for r in byte_bpe.with_ids(rows).collect():
        ids = library.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r.bpe.ids), "<u4").tolist() == ids and r.bpe.n_tokens == len(ids)
        assert bytes(r.bpe.decoded) == (r.text or "").encode()
    d = byte_bpe.digests(rows.where("doc_id = 12")).first()
    assert d.bpe.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_fold_equals_merge(spark):
    words = sorted({w for r in table(spark, SF, "documents").select("text").limit(20).collect() for w in r.text.split()})[:400] + ["é漢", "a", "xx" * 20]
    ranks = byte_bpe.read_ranks()
    rows = spark.createDataFrame([(w.encode().decode("latin-1"),) for w in words], "w string")
    for r in rows.select("w", byte_bpe.fold(F.col("w"), byte_bpe.rank_map(ranks)).alias("ids")).collect():
        assert r.ids == byte_bpe.merge(r.w.encode("latin-1"), ranks)


@pytest.mark.parametrize("word", [b"a" * 700, b"ab" * 400, bytes(range(256)) * 2, "é漢🙂".encode() * 60])
def test_long_words(word):
    ranks = byte_bpe.read_ranks()
    assert byte_bpe.merge_long(word, ranks) == byte_bpe.merge(word, ranks)


@pytest.mark.parametrize("kind", media_sniff.FORMATS)
def test_media_round_trip(kind):
    magic, _, make = media_sniff.FORMATS[kind]
    for payload in (b"\0" * 64, bytes(range(256)), b"RIFFBM" * 32):
        stored = make(payload)
        found = list(media_sniff.Sniffer().media(stored))
        assert [(m.kind, m.start, m.length, m.samples()) for m in found[:1]] == [(kind, 0, len(stored), payload)]
        inside = b"junk" + magic + stored + magic + b"tail"
        carved = media_sniff.describe(inside, "wav", media_sniff.Sniffer())
        assert carved["true_type"] is None and (kind, 4 + len(magic), len(stored)) in [(c["kind"], c["start"], c["length"]) for c in carved["carved"]]
        assert not any(m.start == 0 for m in media_sniff.Sniffer().media(stored[:-1]))


def chunked(header, raw, *cuts):
    """A PNG of these filtered rows, its IDAT cut."""
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    packed = zlib.compress(raw)
    parts = [packed[a:b] for a, b in zip((0, *cuts), (*cuts, None), strict=True)]
    return media_sniff.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", *header)) + chunk(b"tEXt", b"k\0v") + b"".join(chunk(b"IDAT", p) for p in parts) + chunk(b"IEND", b"")


def wav(code, channels, bits, body, extra=b""):
    frame = channels * bits // 8
    inside = b"WAVE" + struct.pack("<4sIHHIIHH", b"fmt ", 16, code, channels, 8000, 8000 * frame, frame, bits) + extra + struct.pack("<4sI", b"data", len(body)) + body + b"\0" * (len(body) & 1)
    return struct.pack("<4sI", b"RIFF", len(inside)) + inside


def bmp(bits, width, height, palette, packed=0, body=None):
    body = body if body is not None else bytes((width * bits + 31) // 32 * 4 * abs(height))
    at = 54 + 4 * palette
    return struct.pack("<2sIHHI", b"BM", at + len(body), 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, bits, packed, len(body), 0, 0, palette, 0) + bytes(4 * palette) + body


VARIANTS = {
    "rgb png, filtered, cut": ("png", chunked((5, 3, 8, 2, 0, 0, 0), (b"\4" + bytes(15)) * 3, 3, 7)), "grey 16 png": ("png", chunked((5, 3, 16, 0, 0, 0, 0), (b"\1" + bytes(10)) * 3)),
    "1-bit png": ("png", chunked((9, 2, 1, 0, 0, 0, 0), bytes(3) * 2)), "interlaced rgba png": ("png", chunked((3, 3, 8, 6, 0, 0, 1), bytes(media_sniff.png_bytes(3, 3, 32, True)))),
    "16-bit stereo wav": ("wav", wav(1, 2, 16, bytes(64), struct.pack("<4sI", b"LIST", 4) + b"abcd")), "float wav": ("wav", wav(3, 1, 32, bytes(12))), "odd 8-bit wav": ("wav", wav(1, 1, 8, b"abc")),
    "24-bit bmp": ("bmp", bmp(24, 5, 3, 0)), "1-bit bmp": ("bmp", bmp(1, 33, -2, 2)), "run-length bmp": ("bmp", bmp(8, 4, 4, 256, 1, b"\4\1\0\1")),
}


@pytest.mark.parametrize("name", VARIANTS)
def test_media_of_other_variants(name):
    kind, data = VARIANTS[name]
    found = media_sniff.describe(b"--" + data + b"tail", None, media_sniff.Sniffer())["carved"]
    assert found == [{"kind": kind, "start": 2, "length": len(data)}]
    assert media_sniff.describe(data, "txt", media_sniff.Sniffer())["true_type"] == kind
    assert not list(media_sniff.Sniffer().media(data[:-1]))


def test_hostile_png_is_refused_without_memory():
    import tracemalloc

    data = chunked((64, 1, 8, 0, 0, 0, 0), bytes(200_000_000))
    wide = chunked((64, 1 << 30, 8, 0, 0, 0, 0), bytes(65))
    tracemalloc.start()
    assert not list(media_sniff.Sniffer().media(data)) and not list(media_sniff.Sniffer().media(wide))
    assert tracemalloc.get_traced_memory()[1] < 10_000_000
    tracemalloc.stop()


def test_media_columns(spark, odd_documents):
    got = media_sniff.store_and_read(odd_documents).select("doc_id", "text", "media.*").collect()
    for r in got:
        raw = (r.text or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        kind = ("wav", "bmp", "png")[zlib.crc32(payload) % 3]
        stored = media_sniff.FORMATS[kind][2](payload)
        x = np.frombuffer(payload, np.uint8).astype(float)
        own, mean, spread = r.feature.rsplit("|", 2)
        inside = sum(1 for _ in media_sniff.Sniffer().media(payload))
        assert (r.media_bytes, r.media_sha256, own) == (len(stored), hashlib.sha256(stored).hexdigest(), f"{kind}|{'as declared' if kind == 'wav' else 'corrected'}|{inside}")
        assert abs(float(mean) - x.mean()) < 1e-3 and abs(float(spread) - x.std()) < 1e-3
    assert len({(r.media_sha256, r.feature) for r in got if (r.text or "") == ""}) == 1
    rows = spark.createDataFrame([(media_sniff.make_png(b"\1" * 64), "wav"), (None, None), (b"", "png")], "data binary, declared string")
    first, null, empty = media_sniff.sniff(rows, "data", "declared").collect()
    assert (first.media.true_type, first.media.corrected, null.media.true_type, empty.media.true_type) == ("png", True, None, None)

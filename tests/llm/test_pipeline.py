"""All stages of the pipeline, one after another, against brute force on a small corpus."""

import os
import random
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from yardlake.llm import queries
from yardlake.llm.word_bpe import Encoder

from test_corpus_operators import slow_lines
from test_near_copies import slow_label
from test_toxicity_sample import slow_scores

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402


def corpus():
    rnd = random.Random(12)
    words = [f"{a}{b}" for a in ("stone", "river", "garden", "window", "lamp", "table", "green", "early") for b in ("", "s", "er", "ly", "ing", "ness")]
    shared = "this line stands in many of the documents and is long enough to count"
    docs, base = [], None
    for i in range(160):
        text = " ".join(rnd.choices(words, k=rnd.randint(30, 90)))
        toxic = int(i % 4 == 0)
        if toxic:
            text += " vile rotten vile scoundrel rotten"
        if i % 10 == 1:
            text = f"{shared}\n{text}\n  {shared.upper()} "
        if i % 40 == 2:
            base = text
        if i % 40 in (3, 5, 7):
            text = base + f" {rnd.choice(words)}"
        if i % 16 == 9:
            text = rnd.choice([text[:20], "go " * 60, "# $ % & " * 20 + text[:60]])
        docs.append((i, text, "en", "s", len(text), toxic))
    docs += [(500, None, None, None, None, None), (501, "", None, "s", 0, 0), (502, " ".join(rnd.choices(words, k=5000)), "en", "s", 9, None)]
    return docs


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = corpus()
    spark.createDataFrame([d[:5] for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], 1, d[5]) for d in docs], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()

    train = [(t, y, i) for i, t, *_, y in docs if zlib.crc32(str(i).encode()) % 3 != 1 and t is not None and y is not None]
    scores, _, _ = slow_scores(train, [d[1] for d in docs])
    assert np.abs(scores - 0.7).min() > 0.02  # none is so near that the last digits would tell
    kept = [(d[0], d[1]) for d, s in zip(docs, scores, strict=True) if s < 0.7]
    assert 0 < len(kept) < len(docs)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(kept, columns=["doc_id", "text"]))
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.OP1_SQL}) WHERE kept").fetchall()}
    kept = [(i, t) for i, t in kept if i in good]
    before = len(kept)
    lines = [(i, t) for i, _, _, t in slow_lines(kept)]
    assert sum(n for _, _, n, _ in slow_lines(kept)) > 0
    label = slow_label([t for _, t in lines])
    single = [row for k, row in enumerate(lines) if label.index(label[k]) == k]
    assert 0 < len(single) < before
    encode = Encoder().tokenizer.encode
    want = Counter()
    for i, t in single:
        ids = np.array([*encode(t, add_special_tokens=False).ids, 1], "<u4")
        want.update((i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)) for at in range(0, len(ids), 2048))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want

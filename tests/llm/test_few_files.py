"""What a run writes on the way makes few files, and a worker holds the n-grams of few texts at once."""

import os
import random
import tracemalloc
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

from yardlake.llm import common, components, line_dedup, toxicity


@contextmanager
def many_partitions(spark, n):
    """n shuffle partitions, none of which is joined with others."""
    mine = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def files(path):
    return [f for _, _, names in os.walk(path.removeprefix("file:").replace("//", "/")) for f in names]


def test_labels_go_to_few_files(spark):
    rnd = random.Random(3)
    pairs = [(i, i + rnd.randint(1, 7)) for i in range(3000) if i % 50]
    want = {n: n for p in pairs for n in p}

    def top(x):
        while want[x] != x:
            x = want[x]
        return x

    for a, b in pairs:
        want[top(b)] = top(a)
    with common.scratch_of_run() as own, many_partitions(spark, 64):
        got = dict(components.components(spark.createDataFrame(pairs, "a long, b long")).collect())
        made = {p: files(p) for p in own.paths}
    groups = lambda of: sorted(sorted(x for x in want if of(x) == k) for k in {of(x) for x in want})
    assert groups(got.__getitem__) == groups(top)
    assert max(sum(f.endswith(".parquet") for f in x) for x in made.values()) <= common.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 64
    assert made and not any(f.endswith(".crc") for x in made.values() for f in x)


def test_runs_of_lines_have_no_checksum_files(spark):
    keys = spark.createDataFrame([(i % 30, i % 30 + 1, i) for i in range(300)], "h1 long, h2 long, doc_id long")
    with common.scratch_of_run() as own:
        runs = line_dedup.LineRuns(spark)
        runs.add(keys.where("doc_id < 200"))
        runs.add(keys.where("doc_id >= 200"))
        assert sorted(map(tuple, runs.table().collect())) == [(k, k + 1, 10, 270 + k) for k in range(30)]
        made = [f for p in own.paths for f in files(p)]
        runs.close()
    assert any(f.endswith(".parquet") for f in made) and not any(f.endswith(".crc") for f in made)


def test_ngrams_of_a_slice_are_small_and_change_nothing(spark, monkeypatch):
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choices("abcdefghijklmnop", k=6)) for _ in range(300)) for _ in range(500)]
    tracemalloc.start()
    for part in common.slices(pa.array(texts), size=toxicity.FEATURE_BYTES):
        toxicity.features(part.to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # 1 MB of text at once takes over 100 MB

    train = spark.createDataFrame([(i, t + " vile" * (i % 2), i % 2) for i, t in enumerate(texts[:60])], "doc_id long, text string, label int")
    found = []
    for size in (1 << 20, 3000):
        monkeypatch.setattr(toxicity, "FEATURE_BYTES", size)
        model = toxicity.fit(train)
        found.append([r.toxicity.score for r in toxicity.score(train, model).orderBy("doc_id").collect()])
    assert np.array_equal(*found) and max(found[0]) > 0.5

"""What a run writes is its own, and goes with it."""

import resource

import numpy as np
import pytest

from yardlake.llm import common, language_id, line_dedup


def exists(spark, path):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def test_a_run_cleans_up_its_own_paths_only(spark):
    other = common.written(spark.range(3), "other")
    with common.scratch_of_run() as outer:
        first = common.written(spark.range(4), "first")
        with common.scratch_of_run() as inner:
            second, third = common.written(spark.range(5), "second"), common.written(spark.range(6), "third")
            inner.clean_up(spark, keep=third)
            assert len(inner.paths) == 1 and third.count() == 6 and first.count() == 4
            with pytest.raises(Exception, match="NOT_EXIST|does not exist"):
                second.count()
        gone = list(outer.paths)
        assert len(gone) == 2
        outer.clean_up(spark)
    assert not any(exists(spark, p) for p in gone) and other.count() == 3


def test_other_threads_keep_theirs(spark):
    """A query that runs beside a run writes between its stages; the run's end leaves its table alone."""
    from concurrent.futures import ThreadPoolExecutor

    with common.scratch_of_run() as own, ThreadPoolExecutor(1) as pool:
        common.written(spark.range(2), "own")
        beside = pool.submit(lambda: common.written(spark.range(9), "beside")).result()
        own.clean_up(spark)
        assert beside.count() == 9


def test_runs_are_closed_on_failure(spark, monkeypatch):
    lines = line_dedup.lines_of(spark.createDataFrame([(i, 0, 0, "a line of more than forty characters, to be counted here") for i in range(9)], "doc long, r1 long, r2 long, text string"))
    before = {t.name for t in spark.catalog.listTables()}
    real, calls = line_dedup.LineRuns.unseen, []

    def fails(self, rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("an executor is lost")
        return real(self, rows)

    monkeypatch.setattr(line_dedup.LineRuns, "unseen", fails)
    with pytest.raises(RuntimeError, match="lost"):
        line_dedup.repeated(lines)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_many_short_texts_take_little_memory():
    """10,000 texts of letters that hardly repeat, in slices as a worker takes them."""
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 6))) for _ in range(10_000)]
    language_id.letter_numbers()
    language_id.bundles(*language_id.trigrams(texts[:50]), 50)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    import pyarrow as pa

    for part in common.slices(pa.array(texts), language_id.ROWS):
        found = language_id.bundles(*language_id.trigrams(part.to_pylist()), len(part))
    assert found.shape[0] <= language_id.ROWS
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100 << 10


def test_too_many_languages_are_refused(spark):
    df = spark.range(language_id.MAX_LANGUAGES + 1).selectExpr("id AS doc_id", "'a b c' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="more than"):
        language_id.train(df)
    assert len(language_id.train(df.where("doc_id < 3"))) == 3

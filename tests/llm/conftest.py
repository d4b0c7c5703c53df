import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, long and repeated texts and ids, ties, columns with clashing names."""
    line = "A line that is long enough to count as a passage of its own."
    texts = [None, "", " \t\n", "short", "x" * 50_000, "word " * 30_000, line, line, f"{line}\n{line}", f" {line.upper()} \r\nmore", line + "\n", "é漢字🙂 ß", line, "RIFF BM \x89PNG", "a\x00b"]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 12, None, None]
    rows = [Row(doc_id=i, text=t, lang=None, source=None, n_chars=None, ledger=1, fingerprint="f", bpe=None, media="m", label=2, score=3.0, language="q", toxicity=0, doc=9, pos=1, row=k, ROW_=3, CLS=4, gone="g", R1=7, __row=8, __gone=9, __doc=10, task=11) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, ledger int, fingerprint string, bpe string, media string, label int, score double, language string, toxicity int, doc int, pos int, row long, ROW_ int, CLS int, gone string, R1 int, __row int, __gone int, __doc int, task int"
    return spark.createDataFrame(rows, kinds)

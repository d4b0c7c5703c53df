"""Line dedup where ids repeat or are missing."""

from yardlake.llm import line_dedup

from test_corpus_operators import slow_lines


def test_rows_of_one_id_lose_their_own_lines(spark):
    long = "A line that is long enough to count as a passage of its own."
    rows = [*((i, f"{long}\nown {i}") for i in range(10, 16)), (5, f"{long}\nx"), (5, f"unique clean line\n{long}"), (5, f"unique clean line\n{long}"), (5, "short")]
    rows += [(None, f"first\n{long}"), (None, f"{long}\nlast"), (None, "neither\nof them\nat all")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "line_dedup.*").collect()
    low = -(1 << 63)
    assert sorted((low if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == slow_lines([(low if d is None else d, t) for d, t in rows])


def test_odd_documents(spark, odd_documents):
    """Five more rows make the long line one of five documents and more."""
    low = -(1 << 63)
    line = "A line that is long enough to count as a passage of its own."
    more = spark.createDataFrame([(i, f"{line}\nown {i}") for i in range(20, 25)], "doc_id long, text string")
    df = odd_documents.unionByName(more, allowMissingColumns=True)
    rows = [(low if r.doc_id is None else r.doc_id, r.text) for r in df.collect()]
    got = line_dedup.dedup_lines(df).select("doc_id", "line_dedup.*").collect()
    want = slow_lines(rows)
    assert sorted((low if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == want and sum(n for _, _, n, _ in want) > 5

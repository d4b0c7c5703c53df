"""Labels that are more than a broadcast may hold."""

from pyspark.sql import functions as F

from yardlake.llm import common, quality_votes, toxicity

SF = "/root/testdata/sf0.001"


def test_many_labels_shuffle_no_text(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    marks = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("label"))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(common.at_most(marks, 4000)) == list(range(4000))
    some = common.at_most(marks.repartition(7), 1000)
    assert 850 < len(ids(some)) < 1150 and ids(some) == ids(common.at_most(marks, 1000))
    assert 0.2 < some.agg(F.avg("label")).first()[0] < 0.3
    plan = docs.join(some, "doc_id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bounded_labels_teach(spark, monkeypatch):
    """Fewer labels give fewer training rows, of both kinds, and a model."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    for module in (toxicity, quality_votes):
        whole = module.training_rows(docs, labels).count()
        monkeypatch.setattr(module, "MAX_LABELS", whole // 2)
        some = module.training_rows(docs, labels)
        assert 0 < some.count() < whole and some.select("label").distinct().count() == 2
    model = quality_votes.fit(some, docs)
    assert len(model.labels) == some.select("doc_id").distinct().count()

"""A corpus through the training-data operators, stage after stage.

Each stage takes the documents that its predecessor kept and returns documents; the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.llm import line_dedup, near_copies, packing, quality_rules, toxicity
from yardlake.llm.common import crc_of_id, own_names, scratch_of_run, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from labelled documents of docs, as op9 does."""
    model = toxicity.fit(toxicity.training_rows(docs.where(crc_of_id() % 3 != 1), table(spark, sf_dir, "labels")))
    (own,) = own_names(docs, "toxicity")
    return toxicity.score(docs, model, into=own).where(F.col(own)["predicted"] == 0).drop(own)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    (own,) = own_names(docs, "ledger")
    return quality_rules.verdicts(docs, into=own).where(F.col(own)["kept"]).drop(own)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go but for their last document; n_chars follows. Documents stay, and a null text stays null."""
    (own,) = own_names(docs, "lines")
    found = line_dedup.dedup_lines(docs, into=own)
    found = found.withColumn("text", F.when(F.col("text").isNotNull(), F.col(own)["kept"]))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.drop(own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies (five-word shingles, similarity 0.8 or more) one row stays: that of the smallest id."""
    return near_copies.one_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("line_dedup", drop_lines), ("near_copy_dedup", drop_near_copies), ("packing", pack)]

#: No SQL: the first stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder; what a stage worked with goes once it is written."""
    docs = table(spark, sf_dir, "documents")
    with scratch_of_run() as own:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            own.clean_up(spark, keep=docs)
    return docs

"""Every operator with Python workers works where the package is not installed on them."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's own; workers don't see it
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
from yardlake.llm import byte_bpe, language_id, line_dedup, media_sniff, near_copies, packing, quality_rules, simhash, token_counts, toxicity
from yardlake import session

line = "A line that is long enough to count as a passage of its own."
rows = spark.createDataFrame([(i, f"word {{i % 3}} and more\\n{{line}}", "en", i % 2, bytearray(b"RIFF"), "wav") for i in range(12)], "doc_id long, text string, lang string, label int, data binary, declared string")
own = lambda df: df.select("doc_id", "text")
calls = dict(
    train=lambda: language_id.train(rows), counts=lambda: toxicity.counts(rows).count(), fit=lambda: toxicity.fit(rows), links=lambda: simhash.links(spark.range(40).toDF("fp")).count(),
    pack=lambda: packing.pack(spark.createDataFrame([(1, 0, 5, 6, 5)], packing.PIECE)).count(), sniff=lambda: media_sniff.sniff(rows, "data", "declared").collect(),
    lines=lambda: line_dedup.dedup_lines(rows).collect(), near=lambda: near_copies.one_each(own(rows)).count(), scan=lambda: token_counts.scan(spark, token_counts.write_flat(rows)).count(),
    quality=lambda: quality_rules.ledger(rows).collect(), bpe=lambda: byte_bpe.with_ids(rows).collect(), prints=lambda: simhash.near_duplicates(rows).collect(),
)
call = calls[sys.argv[1]]
call()
print("went well")
"""


def test_first_call_of_a_session(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for name in ("train", "counts", "links", "sniff", "scan"):
        done = subprocess.run([sys.executable, "-c", CODE.format(root=root), name], cwd=tmp_path, env=env, capture_output=True, text=True)
        assert "went well" in done.stdout, f"{name}: {done.stderr[-1500:]}"

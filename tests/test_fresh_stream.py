"""Stateful streams and a source in Python in a session that the library did not make, where the package is not installed on Spark's Python processes."""

import os
import subprocess
import sys

import pandas as pd

from test_queries import SF, connect, rows_of

CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's own; workers don't see it
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
import __spark_entry__
for name in sys.argv[1:]:
    __spark_entry__.queries()[name](spark, {sf!r}).toPandas().to_pickle(name)
assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
print("went well")
"""


def test_stateful_streams_in_a_plain_session(tmp_path):
    import __spark_entry__

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = ["stream_metrics", "stream_cycles", "stream_status", "changes_since", "changes_streamed", "stream_inventory_incremental", "stream_by_offsets"]
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root, sf=SF), *names], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "went well" in done.stdout, done.stderr[-1500:]
    for name in names:
        got, want = pd.read_pickle(tmp_path / name), connect().execute(__spark_entry__.oracle_sql()[name]).df()
        assert len(want) and sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)

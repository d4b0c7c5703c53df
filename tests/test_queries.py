"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from yardlake.plans import queries, stored, streamed  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def rows_of(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NaT or v != v:
            return ""
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_equals_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), connect().execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_without_training_operators(tmp_path):
    """The rest works where the subpackage is missing."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in os.listdir(root):
        if name.endswith(".py") and name != "corpus_pipeline.py":
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.makedirs(tmp_path / "yardlake")
    for name in os.listdir(f"{root}/yardlake"):
        if name != "llm":
            os.symlink(f"{root}/yardlake/{name}", tmp_path / "yardlake" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cycles_all' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})

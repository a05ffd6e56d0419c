import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from terrasync import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    def plain(v):
        return None if pd.isna(v) else repr(round(v, 6)) if isinstance(v, float) else str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(str, map(plain, r))) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        assert rows(got) == rows(con.execute(catalog.ORACLES[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(catalog.QUERIES)

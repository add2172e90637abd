import duckdb
import pandas as pd
import pytest

import __spark_entry__
from driftline.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(frame):
    columns = sorted(frame.columns)
    number = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return columns, sorted(map(str, (tuple(map(number, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_matches_sql(spark, db, name):
    assert plain(catalogue.QUERIES[name](spark, SF).toPandas()) == plain(db.sql(catalogue.SQL[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

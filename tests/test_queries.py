"""Every register query that has SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from regiscope import queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 5) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    out = con.execute(queries.SQL[name])
    at = [[d[0] for d in out.description].index(c) for c in names]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in out.fetchall()), key=str)


def test_entry_imports_without_the_corpus_part(spark):
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and __spark_entry__.entry(spark).count() > 0

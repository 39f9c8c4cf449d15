"""Every query against its SQL, on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as entry
from tsforge import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    return None if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, db, name):
    found = queries.QUERIES[name](spark, SF)
    want = db.sql(queries.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    a = [tuple(plain(r[c]) for c in columns) for r in found.collect()]
    b = [tuple(plain(dict(zip(want.columns, r))[c]) for c in columns) for r in want.fetchall()]
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_entry_and_registration(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_days_of_order_keys_beyond_64_bit_nanoseconds(spark, tmp_path):
    """Keys from 366,504 on lie past 2262; the first and last years have fewer or more than four digits."""
    keys = [None, 0, 499, 500, 366_503, 366_504, 367_000, 8_999_999, 10_055_643, 10_056_000, 100_000_000, 7_000_000_000, -366_000, -2_460_000, -2_467_500, -2_475_000, -2_600_000, -3_000_000, -100_000_000]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    c = duckdb.connect()
    c.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    want = c.sql(queries.ORACLE_SQL["ns_day_partition"]).fetchall()
    found = [tuple(r) for r in queries.QUERIES["ns_day_partition"](spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and len(found) == len(keys)

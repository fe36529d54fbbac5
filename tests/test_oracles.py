"""Every query that has SQL, against DuckDB on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def same(rows):
    def value(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else f"{x:.6g}"
        return "null" if x is None else str(x)

    return sorted(tuple(map(value, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(got.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {order} FROM ({entry.oracle_sql()[name]}) AS q").fetchall()
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert len(rows) == len(want)
    assert same(rows) == same(want)

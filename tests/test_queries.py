"""Every query against its SQL on DuckDB, as sets of rows."""

import datetime
import decimal
import math
from collections import Counter

import duckdb
import pytest

from concordat.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(plain(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    got = rows(df.columns, df.collect())
    assert sum(got.values()) > 0
    assert got == want, ((got - want).most_common(2), (want - got).most_common(2))

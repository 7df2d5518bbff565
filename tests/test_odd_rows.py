"""Queries against their SQL on tables made for the case."""

from collections import Counter

import duckdb
from pyspark.sql import functions as F

from concordat.operators import contexts
from concordat.plans.catalog import QUERIES, SQL


def both(spark, folder, name, **tables):
    """The query's rows and its SQL's, over tables given as SELECT statements."""
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, str(folder))
    return Counter(map(tuple, df.collect())), Counter(con.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall())


def test_chains_of_large_order_keys(spark, tmp_path):
    # order keys from a million on: ordinals of the lists overlap
    lines = """SELECT k::BIGINT AS l_orderkey, p::BIGINT AS l_partkey, s::BIGINT AS l_suppkey, 1::INTEGER AS l_linenumber, f AS l_returnflag FROM (VALUES
        (5000000, 1, 11, 'R'), (3, 1, 12, 'N'), (5000000, 2, 21, 'R'), (2000000, 2, 22, 'A'), (7, 3, 31, 'A'), (6, 3, 32, 'N'), (4, 4, NULL, 'R'), (5, 4, 41, 'N'), (9, 5, 51, NULL), (9, 6, NULL, 'A')) t(k, p, s, f)"""
    got, want = both(spark, tmp_path, "chained_targets", lineitem=lines, part="SELECT range AS p_partkey FROM range(8)")
    assert got == want
    assert got[(1, 12, "R")] == got[(2, 22, "R")] == 1


def test_nearest_compares_paths_not_rows(spark, monkeypatch):
    """40 questions of 4 paths over 2,000 rows of 8 paths: 80,000 pairs of rows, of paths 32 with 8 targets each at most."""
    compared = spark.sparkContext.accumulator(0)

    def distance(a, b):
        compared.add(1)
        return 2 * (a[2] != b[2])

    monkeypatch.setattr(contexts, "word_distance", F.udf(distance, "int"))
    rows = [(k, "s", ["en", "s", str(k % 8)]) for k in range(2000)]
    asked = spark.createDataFrame([(k, s, w) for k, s, w in rows if k % 50 == 0], "id long, source string, words array<string>")
    got = contexts.nearest(asked, spark.createDataFrame(rows, "target long, source string, words array<string>"), "id", "source").collect()
    assert Counter(map(tuple, got)) == Counter((k, k % 8 + 8 * n, 0, n + 1) for k, _, _ in rows if k % 50 == 0 for n in range(8))
    assert compared.value <= 32 * 8


def test_nearest_of_few_and_repeated_rows(spark, tmp_path):
    docs = """SELECT range AS doc_id, 'text' AS text, ['en', 'de'][(range % 3 = 0)::INT + 1] AS lang, 's' || range // 60 AS source, range * range AS n_chars FROM range(200)
        UNION ALL SELECT 80, 'again', 'en', 's0', 5 UNION ALL SELECT 80, 'again', 'en', 's0', 5 UNION ALL SELECT 81, 'alone', 'fr', 's9', 1 UNION ALL SELECT 120, 'alone', 'fr', 's9', 1"""
    got, want = both(spark, tmp_path, "context_nearest", documents=docs)
    assert got == want and got

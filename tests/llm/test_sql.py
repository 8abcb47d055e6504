"""Queries that SQL can express, against DuckDB on the given tables."""
import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_warc", "op7_substring_dedup", "op11_merkle", "op12_mixing", "op13_hard_negatives"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    got = E.queries()[name](spark, SF).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(found.fetchall(), key=str)

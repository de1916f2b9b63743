"""Queries beside their SQL on tables made for one case."""

import duckdb
from test_oracles import _norm
from tabwright import catalog


def against_sql(spark, folder, name, **tables):
    """The query's rows, once they are those of its SQL over the given SQL of tables."""
    with duckdb.connect() as c:
        for t, sql in tables.items():
            c.sql(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        want = c.sql(catalog.oracle_sql()[name])
        cols = sorted(want.columns)
        at = [want.columns.index(x) for x in cols]
        df = catalog.queries()[name](spark, str(folder))
        assert sorted(df.columns) == cols
        got = sorted(tuple(_norm(r[x]) for x in cols) for r in df.collect())
        assert got == sorted(tuple(_norm(r[i]) for i in at) for r in want.fetchall())
    return got


def test_summary_of_a_mean_just_below_the_whole(spark, tmp_path):
    customer = "SELECT i AS c_custkey, 'c' AS c_name, (i % 25)::INTEGER AS c_nationkey, 1000.0::DOUBLE + i % 2 AS c_acctbal, CASE WHEN i % 2 = 0 THEN 'LOW' ELSE 'HIGH' END AS c_mktsegment FROM range(50) r(i)"
    assert any("mean of -0.0%" in r[1] for r in against_sql(spark, tmp_path, "text_summary", customer=customer))

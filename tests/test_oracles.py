"""Every query that has SQL gives the SQL's rows on the smallest tables; the others give rows of a stable schema."""

from pathlib import Path

import duckdb
import pytest

from tabwright import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the small tables")


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return "[" + ",".join(map(_norm, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.fixture(scope="module")
def duck():
    with duckdb.connect() as c:
        for t in TABLES:
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        yield c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_against_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    at = [want.columns.index(c) for c in cols]
    assert got == sorted(tuple(_norm(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", ["kmeans_elbow", "pca_embedding", "forest_importances", "lasso_votes", "permutation_importances", "shapley_importances", "feature_selection"])
def test_fitted_queries_give_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0

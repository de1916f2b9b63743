import math
from collections import Counter, defaultdict

import duckdb
import pytest

from tabwright.llm import mixing

ROWS = [(i, "w " * (1 + i % 9), f"s{min(i % 7, 3)}") for i in range(900)] + [(1000 + i, t, s) for i, (t, s) in enumerate([(None, "s0"), ("", "s1"), (" \n", None), ("a b c", None)])] + [(5, "w " * 6, "s3")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, 1.0) for i, t, s in ROWS], "doc_id bigint, text string, source string, weight double")


def test_exponent_and_budget(docs):
    sizes = mixing.source_sizes(docs)
    tokens = {r.key: r.tokens for r in sizes.collect()}
    total = sum(tokens.values())
    t = mixing.solve_exponent(sizes, repetition_limit=1.5)
    passes = [(n / total) ** (t - 1) for n in tokens.values()]
    assert max(passes) / min(passes) == pytest.approx(1.5, rel=1e-6)
    t = mixing.solve_exponent(sizes, target_entropy=0.9)
    raw = [(n / total) ** t for n in tokens.values()]
    w = [x / sum(raw) for x in raw]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.9 * math.log(len(w)), rel=1e-6)


def test_copies_spend_the_budget_of_each_block(docs):
    got = mixing.with_copies(docs, repetition_limit=3.0, block_docs=50).collect()
    assert len(got) == len(ROWS) and min(r.copies for r in got) >= 1 and max(r.copies for r in got) <= 3
    found, _ = mixing.plan(docs, repetition_limit=3.0, block_docs=50)
    repeats = {r.key: r.repeats for r in found.collect()}
    spent, total = Counter(), defaultdict(int)
    for r in got:
        n, key = len((r.row.text or "").split()), ("" if r.row.source is None else f"={r.row.source}", r.block)
        spent[key] += n * r.copies
        total[key] += n
    assert all(abs(spent[k] - repeats[k[0]] * total[k]) <= 9 for k in total)


def test_mix_keeps_columns_and_empty_table(spark, docs):
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns and set(r.doc_id for r in rows.collect()) == {i for i, _, _ in ROWS}
    assert mixing.mix(spark.createDataFrame([], docs.schema)).count() == 0
    lost = spark.createDataFrame([(None, "a b", None), (None, "c", None), (None, None, None)], "doc_id bigint, text string, source string")
    assert mixing.mix(lost).count() == 3


def test_query_against_sql(spark, docs, tmp_path):
    from tabwright.llm import queries

    docs.drop("weight").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op7_temperature_mixing(spark, str(tmp_path)).select("doc_id", "source", "weight", "block", "place", "copies").collect()), key=str)
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted(c.sql(queries.oracle_sql()["op7_temperature_mixing"]).fetchall(), key=str) == got

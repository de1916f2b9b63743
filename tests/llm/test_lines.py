import hashlib
from collections import Counter

import pytest

from tabwright.llm.lines import dedup_lines

SCHEMA = "doc_id bigint, text string, n_lines string, hs string"


def brute(rows, min_docs):
    white = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(white).translate(low)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, k in {(i, key(x)) for i, ls in split for x in ls} if k)
    return sorted((i, len(ls), "\n".join(kept), len(ls) - len(kept)) for i, ls in split for kept in [[x for x in ls if seen[key(x)] < min_docs]])


@pytest.mark.parametrize("limit", [1000, 1, 0])
def test_lines_against_brute_force(spark, limit):
    rows = [(i, f"Common  line\r\nown {i}\n\n\t COMMON  LINE\nÉcole {i % 4}\nécole {i % 3}") for i in range(20)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "common  line"), (104, "x " * 200_000 + "\ncommon  line"), (105, " common  line")]
    rows += [(200, "said by one alone\nÉcole 1\n\n")] * 10 + [(200, "said by one alone"), (200, None)] + [(7, "own 7\nown 7\nown 8")]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], SCHEMA).repartition(3)
    got = sorted((r.doc_id, r.n_lines, r.kept, r.n_dropped) for r in dedup_lines(df, 5, broadcast_lines=limit).collect())
    assert got == brute(rows, 5)


def test_lines_of_nothing_and_of_rows_without_id(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA), 2).count() == 0
    df = spark.createDataFrame([(None, "a", "", ""), (1, "a", "", "")], SCHEMA)
    assert [(r.doc_id, r.kept) for r in dedup_lines(df, 2).collect()] == [(1, "a")]


def test_query_returns_the_hash_of_the_kept_text(spark, tmp_path):
    from tabwright.llm.queries import op9_line_dedup

    spark.createDataFrame([(1, "é\nb", "", "")], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert op9_line_dedup(spark, str(tmp_path)).first().kept_sha256 == hashlib.sha256("é\nb".encode()).hexdigest()

import json
from pathlib import Path

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the small tables")
def test_stages_and_run(spark):
    from tokenizers import Tokenizer

    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        assert docs.columns == first.columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] <= counts[4] <= 2 * counts[3]
    got = corpus_pipeline.run(spark, SF).collect()
    tok = Tokenizer.from_str(json.dumps(json.loads(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())))
    want = sorted((r.doc_id, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in docs.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want
    assert max(r.start + r.n_tokens for r in got) == sum(n for _, n in want)


def test_near_copies_keep_the_first(spark):
    from tabwright.llm.simhash import keep_first

    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text, "a"), (3, text, "b"), (9, text + " ", "c"), (4, "other words of its own", "d"), (None, text, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    assert sorted((r.doc_id or 0) for r in keep_first(docs).collect()) == [0, 3, 4]
    assert keep_first(docs).columns == docs.columns


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, keep string, _bad_id string, row string, component_id string, block string"


def tables(spark, where, rows):
    spark.createDataFrame([(i, t, "en", s, 1, *"abcdef") for i, t, s in rows], DOCS).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(10_000, "It was once said that every long road has one more turn than the traveller who walks it would like.")], "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, t, _ in rows if i is not None and t], "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(where)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Null and empty texts, ids and sources, a very long text, repeated rows and clashing columns: each stage keeps what it has no reason to drop."""
    own = lambda i: " ".join(f"the road{i}x{k} and the turn{i}y{k} was of it." for k in range(12))
    rows = [(i, own(i), "a" if i % 3 else None) for i in range(30)]
    odd = [(100, None, "a"), (101, "", "b"), (102, " \n", None), (103, " ".join(own(i) for i in range(1000, 1600)), "a"), (5, own(5), "a"), (None, own(7000), "a")]
    copies = [(200 + i, own(50), "b") for i in range(5)]
    leak = [(300, "Before it. It was once said that every long road has one more turn than the traveller who walks it would like. After it.", "a")]
    sf = tables(spark, tmp_path, rows + odd + copies + leak)
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, sf))
        assert docs.columns == DOCS.replace(" string", "").replace(" bigint", "").split(", "), name
        seen.append(sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()))
    good, single, clean, mixed = seen
    ids = lambda xs: [i for none, i in xs if not none]
    assert ids(good) == sorted(i for i, _, _ in rows + odd + copies + leak if i is not None) and (True, 0) in good
    assert set(ids(single)) == set(ids(good)) - {201, 202, 203, 204} - {101, 102} and (True, 0) in single  # blank texts are copies of one another
    assert set(ids(clean)) == set(ids(single)) - {300}
    assert set(mixed) == set(clean) and max(mixed.count(x) for x in mixed) <= 2 * max(clean.count(x) for x in clean)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == ids(mixed)
    assert {r.n_tokens for r in got if r.doc_id == 100} == {1}


def test_an_empty_table_passes_every_stage(spark, tmp_path):
    sf = tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, sf).count() == 0

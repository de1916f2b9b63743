"""What a Python worker is given and keeps is bounded, whatever ran in it before and however large a batch is."""

import pickle
import weakref

import numpy as np
import pyarrow as pa

from tabwright.llm import common, decontam, quality, simhash, simple8b


def test_a_task_drops_what_another_operator_left():
    common.worker_cache("another operator", lambda: [0])
    list(common._Released(lambda it: it, True, True, 0)(iter([])))
    assert common._cached
    list(common._Released(lambda it: it, True, False, 0)(iter([])))
    assert not common._cached


def test_a_scorer_travels_without_empty_buckets():
    weights = np.zeros((3, quality.BUCKETS + quality._SHAPES + 1))
    weights[:, [5, 70_000, 900_000, -1]] = [[1.0, 2.0, -1.0, 0.5], [0.0, 1.0, 3.0, 0.1], [2.0, 0.0, 0.0, -0.4]]
    scorer = quality.Scorer(weights, quality.BUCKETS)
    assert len(pickle.dumps(scorer)) < 10_000
    words = quality.Words(pa.array([f"w{i} of the W{i}!" for i in range(3000)]))
    of, bucket, value = words.features(quality.BUCKETS)
    shapes = quality._scaled(words.shapes())
    z = np.stack([np.bincount(of, w[bucket] * value, words.rows) + shapes @ w[quality.BUCKETS : -1] + w[-1] for w in weights], 1)
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(scorer(words, words.shapes()), want, rtol=1e-12)


def test_batches_come_in_pieces_that_lose_nothing():
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(["word " * (i % 50) for i in range(900)])], ["id", "text"])
    got = list(common.pieces(iter([batch, batch.slice(0, 0), batch.slice(7, 1)]), 10_000))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch, batch.slice(7, 1)]))
    assert len(got) > 5 and max(x.nbytes for x in got) < 20_000
    long = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["x" * 50_000, "y" * 50_000])], ["id", "text"])
    assert [x.num_rows for x in common.pieces(iter([long]), 10_000)] == [1, 1]


def test_pieces_give_the_results_of_whole_batches(spark, monkeypatch):
    texts = [f"Row {i} has the number {i * 7} and is of the kind k{i % 5}." if i % 9 else None for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = lambda: sorted((r.row.doc_id, r.row.text, r.p_good, r.keep) for r in quality.classify(docs, None, buckets=1 << 12).collect())
    whole = found()
    monkeypatch.setattr(quality, "_PIECE", 2_000)
    small = found()
    assert [x[:2] + x[3:] for x in small] == [x[:2] + x[3:] for x in whole] and [t for _, t, _, _ in small] == texts
    assert np.allclose([x[2] for x in small], [x[2] for x in whole], atol=1e-6)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["doc_id", "text"])]
    monkeypatch.setattr(simple8b, "_TOGETHER_BYTES", 2_000)
    merged = list(simple8b._merged(iter(batches)))
    assert len(merged) > 5 and max(x.nbytes for _, x in merged) < 4_000
    assert [t for _, x in merged for t in x.to_pylist()] == texts and np.concatenate([i for i, _ in merged]).tolist() == list(range(400))
    rows = decontam.windows(docs, "doc_id").select("id", "pos", "h").distinct().count()
    assert rows == decontam.windows(docs.repartition(7), "doc_id").select("id", "pos", "h").distinct().count() > 0


def test_batches_of_long_texts_are_small(spark):
    docs = spark.range(0, 1500, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 900) AS text")

    def run(batches):
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.num_rows]), pa.array([x.nbytes])], ["rows", "size"])

    found = common.map_arrow(docs, run, "rows bigint, size bigint").collect()
    assert sum(r.rows for r in found) == 1500 and max(r.size for r in found) < 2 << 20
    gathered = common.map_arrow(docs, run, "rows bigint, size bigint", together=6 << 20).collect()
    assert sum(r.rows for r in gathered) == 1500 and len(gathered) < len(found) / 3 and max(r.size for r in gathered) <= 6 << 20


def test_gathered_batches_lose_nothing():
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(["word " * (i % 50) for i in range(900)])], ["id", "text"])
    small = [batch.slice(i, 30) for i in range(0, 900, 30)]
    got = list(common.gathered(iter([batch.slice(0, 0), *small]), 20_000, 200))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert 3 < len(got) < len(small) and max(x.num_rows for x in got) <= 200 and max(x.nbytes for x in got) <= 20_000
    assert [x.num_rows for x in common.gathered(iter([batch, batch]), 10)] == [900, 900] and not list(common.gathered(iter([]), 10))


def test_small_tables_start_no_python_workers(spark):
    table = common.small_table(spark, {"code": pa.array([3, 1], pa.int64()), "share": pa.array([0.5, 1.0])})
    assert table.schema.simpleString() == "struct<code:bigint,share:double>" and sorted(map(tuple, table.collect())) == [(1, 1.0), (3, 0.5)]
    assert not common.small_table(spark, {"code": pa.array([], pa.int64())}).collect()
    assert "Python" not in table._jdf.queryExecution().toRdd().toDebugString()


def test_the_exact_join_keeps_no_batches():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 60, 400, np.uint64)) for _ in range(40)]
    sets += [np.unique(np.r_[x[:380], rng.integers(0, 1 << 60, 5, np.uint64)]) for x in sets]
    columns = [pa.array(range(80)), pa.array([i % 40 % 4 for i in range(80)]), pa.array([simhash.sketch(x) for x in sets]), pa.array([x.tobytes() for x in sets])]
    batch, given, live = pa.RecordBatch.from_arrays(columns, ["node", "tree", "sketch", "shingles"]), [], []

    def batches():
        for i in range(0, 80, 8):
            given.append(weakref.ref(x := pa.concat_batches([batch.slice(i, 8)])))
            yield x
            del x
            live.append(sum(r() is not None for r in given))

    out = list(simhash._exact(0.8)(batches()))
    assert sorted(p for x in out for p in zip(*(c.to_pylist() for c in x.columns))) == [(i + 40, i) for i in range(40)] and max(live) <= 1
    assert not list(simhash._exact(0.8)(iter([])))

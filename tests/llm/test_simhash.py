import random

import numpy as np
import pytest
import xxhash

from tabwright.llm.common import _with_least, components, cut
from tabwright.llm.simhash import keep_first, near_duplicates, similarity, simhash, sketch, trie_links, trie_self_join


def brute_fp(text):
    w = text.encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    ids, root = sorted(fps), {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= 2 and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


@pytest.mark.parametrize("chunk", [20_000, 7])
def test_near_duplicates_against_brute_force(spark, chunk):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)] + ["É", "é"]
    base = [" ".join(rng.choices(words, k=40)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(80):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((1000 + k, " \t".join(w) + rng.choice(["", "\n", " end"])))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "One"), (504, "one"), (505, "a b"), (506, "x y z " * 50_000), (7, base[7]), (None, base[0])]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, fp string")
    got = near_duplicates(df, chunk_rows=chunk).collect()
    fps = {i: brute_fp(t or "") for i, t in rows if i is not None}
    assert len(got) == len(rows) - 1
    assert {r.doc_id: r.fp % 2**64 for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == brute_components(fps)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_finds_every_pair(budget):
    rng = np.random.default_rng(budget)
    centre = rng.integers(0, 2**63, 5, np.uint64)
    v = np.concatenate([rng.integers(0, 2**63, 300, np.uint64)] + [c ^ (np.uint64(1) << rng.integers(0, 64, 400, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400, np.uint64)) for c in centre])
    v = np.unique(v)
    got = {(int(i), int(j)) for a, b in trie_links(v, np.array([0]), np.array([len(v)]), budget, 63) for i, j in zip(a, b)}
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= budget
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def test_simhash_of_words():
    assert simhash(b"") == simhash(b" \t") == 0
    assert simhash(b"A b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(1, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {i: 7 for i in range(8, 60)}


def jaccard(a, b, k=5):
    x, y = ({" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(7)
    for share in (0.0, 0.5, 0.8, 1.0):
        a = rng.integers(0, 2**63, 5000, np.uint64)
        b = np.concatenate([a[: int(5000 * share)], rng.integers(0, 2**63, 5000 - int(5000 * share), np.uint64)])
        true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        got = similarity(*(np.frombuffer(sketch(x), np.uint8)[None] for x in (a, b)))[0]
        assert abs(got - true) < 0.13
    none = np.frombuffer(sketch(np.zeros(0, np.uint64)), np.uint8)[None]
    assert similarity(none, none)[0] == 1.0


def test_similar_texts_link_and_others_do_not(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choices(words, k=400) for _ in range(6)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for k in range(60):  # one or two of 400 words differ: a similarity of at least 0.95
        w = list(base[k % 6])
        for _ in range(1 + k % 2):
            w[rng.randrange(400)] = "changed"
        rows.append((100 + k, " ".join(w)))
    for k in range(12):  # half of the words are shared
        rows.append((300 + k, " ".join(base[k % 6][:200] + rng.choices(words, k=200))))
    df = spark.createDataFrame(rows + [(900, None), (901, " ")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, words=5, budget=8, least=0.8).collect()}
    assert all(got[i] == i for i in range(6)) and all(got[300 + k] == 300 + k for k in range(12))
    assert sum(got[100 + k] == k % 6 for k in range(60)) >= 57 and got[901] == 900
    assert {i for i, r in got.items() if r == 0} <= {0, *(100 + k for k in range(0, 60, 6))}
    assert all(jaccard(rows[6 + k][1], rows[k % 6][1]) > 0.9 for k in range(60))
    assert keep_first(df, words=5, budget=8, least=0.8).count() <= 6 + 3 + 12 + 1


@pytest.mark.parametrize("chunk", [20_000, 9])
def test_all_pairs_at_the_threshold_link_exactly(spark, chunk):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(60):  # pairs of 60 to 400 words with one to nine changes: similarities on both sides of 0.8
        base = rng.choices(words, k=rng.choice([60, 150, 400]))
        other = list(base)
        for k in rng.sample(range(len(base)), rng.randrange(1, 10)):
            other[k] = f"new{rng.random()}"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    near = {2 * g for g in range(60) if jaccard(rows[2 * g][1], rows[2 * g + 1][1]) >= 0.8}
    shared = rng.choices(words, k=300)
    rows += [(1000 + k, " ".join([*shared, f"tail{k}"])) for k in range(20)]  # more than a chunk of them
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=5, budget=6, least=0.8, chunk_rows=chunk).collect()}
    assert 15 < len(near) < 55 and {2 * g for g in range(60) if got[2 * g + 1] == 2 * g} == near
    assert {got[1000 + k] for k in range(20)} == {1000}


def test_nothing_that_grows_is_broadcast(spark, tmp_path):
    """Written tables are compressed many times over: by their files' size Spark broadcast them."""
    df = spark.createDataFrame([(i, f"some words of text number {i % 40} and {i % 3}") for i in range(200)], "doc_id long, text string")
    planned = lambda x: x._jdf.queryExecution().executedPlan().toString()
    edges = cut(spark.range(1, 5000).selectExpr("id AS u", "0L AS v"))
    classes = cut(spark.range(1, 5000).selectExpr("id AS node", "CAST(NULL AS BINARY) AS sketch", "xxhash64(id) AS fp"))
    for found in (near_duplicates(df), _with_least(edges), trie_self_join(classes)):
        found.collect()
        assert "SortMergeJoin" in planned(found) and "Broadcast" not in planned(found)
    assert {(r.u, r.m) for r in _with_least(edges).collect()} == {(i, 0) for i in range(1, 5000)}

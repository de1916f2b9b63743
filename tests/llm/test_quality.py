import itertools
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabwright.llm import quality
from tabwright.llm.quality import COMMON, INSULTS, KINDS, LABELLERS, Words, classify, fit_labellers, heuristic_votes, keep_good, label, unpacked

SCHEMA = "doc_id bigint, text string, keep string"
VOCAB = [f"{a}{b}" for a in "lom tar vig sel pon rud kem".split() for b in "ar ine ost ule ask em".split()] + COMMON[:30]


def good(rng):
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(rng.sample(VOCAB, 60)))


def table(n=600, seed=0):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        kind, text = rng.choices(["good", "low", "toxic"], [8, 1, 1])[0], good(rng)
        if kind == "low":
            text = rng.choice([text.upper().replace(" ", "!! "), " ".join(w + "%%%" for w in text.split()), " ".join([text.split()[0]] * 50), text.replace(" ", " | ")])
        if kind == "toxic":
            bad = ["idiot", "moron"] if i % 2 else ["grunkel", "vorpik", "snazzo"]
            text = " ".join(rng.choice(bad) if rng.random() < 0.06 else w for w in text.split()) + f" {bad[0]} {bad[1]}"
        rows.append((i, text, kind))
        if i % 2 or rng.random() < 0.5:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return rows, labels


def test_shapes_against_brute_force():
    texts = ["AA bb!! %%% | |", None, "", " \t", "a a a b", "Idiot, you. End?", "é" * 5 + " ÉÉ", "The cat, of course (and a dog) l'été x-y 3.5%", 'The THE!! of### "Of" end."']
    words = Words(pa.array(texts))
    got = words.shapes()
    common = {*COMMON, *(x.capitalize() for x in COMMON)}
    for t, row, n in zip(texts, got, words.n):
        w = (t or "").split()
        assert n == len(w)
        runs = [len(list(g)) for _, g in itertools.groupby(w)]
        letters = [x for x in "".join(w) if x.isalpha()]
        plain = [x for x in w if not re.search(r"[#%&*$|]{2}|!!", x) and x != "|"]
        want = [sum(bool(re.search(r"[%$#&*^~<>{}=\\]{2}", x)) for x in w), sum(x.isupper() and len(x) > 1 for x in w), sum("!!" in x for x in w), sum(a == b for a, b in zip(w, w[1:])), w.count("|"), sum(map(len, w)), sum(bool(re.search(r"[.!?][\"')]?$", x)) for x in w), sum(x.strip(",.?").lower() == "idiot" for x in w)]
        want += [sum(re.sub("[.,;:!?]$", "", x) in common for x in w), len(w) - len(plain)]
        assert row[:10] == pytest.approx([x / max(len(w), 1) for x in want])
        assert row[10:] == pytest.approx([sum(x.isupper() for x in letters) / max(len(letters), 1), max(Counter(w).values(), default=0) / max(len(w), 1), max(runs, default=0)])
    assert words.different(INSULTS).tolist() == [0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert (heuristic_votes(got, words.n, words.different(INSULTS))[1:4] == 0).all()
    assert Words(pa.array([], pa.string())).shapes().shape == (0, 13)


ODD_WORDS = [None, "", "a", "été", "x" * 63, "y" * 64, "z" * 65, "é" * 900, "A\x00b", "中文字", "𝔘ni🎉", "ǅⅧªº", "THE,", "%$#"]


def test_hashes_and_characters_of_whole_columns():
    """Side by side, sliced and of any length, words have the CRC-32 and the letters that they have one by one."""
    rng = random.Random(4)
    words = pa.array([x or "" for x in ODD_WORDS] + ["".join(rng.choices("aZéß.中𝔘", k=rng.randrange(80))) for _ in range(500)])
    for w in (words, words.slice(5, 300), words[:0], pa.array(["", ""])):
        for start in (0, 1):
            assert quality.crc32s(w, start).tolist() == [zlib.crc32(x.encode(), start) for x in w.to_pylist()]
        letters, uppers = quality.characters(w, r"\pL", r"\p{Lu}")
        assert letters.tolist() == [sum(unicodedata.category(c)[0] == "L" for c in x) for x in w.to_pylist()]
        assert uppers.tolist() == [sum(unicodedata.category(c) == "Lu" for c in x) for x in w.to_pylist()]
    not_utf8 = pa.array([b"A\xc0\x80b", b"C"], pa.binary()).view(pa.string())
    assert [x.tolist() for x in quality.characters(not_utf8, r"\pL", r"\p{Lu}")] == [[2, 1], [1, 1]]


def test_words_are_hashed_once_and_not_one_by_one(monkeypatch):
    """Both scorers of given labels take the same hashes of a batch, and only words too long to lie beside others are hashed alone."""
    calls, columns = [], []
    one, many = zlib.crc32, quality.crc32s
    monkeypatch.setattr(quality.zlib, "crc32", lambda *x: calls.append(x) or one(*x))
    monkeypatch.setattr(quality, "crc32s", lambda *x: columns.append(x) or many(*x), raising=False)
    words = Words(pa.array([" ".join([*VOCAB, "é" * 900]), "Para, para. PARA"]))
    scorer = quality.Scorer(np.ones((3, (1 << 10) + quality._SHAPES + 1)), 1 << 10)
    assert (scorer(words, words.shapes()) == scorer(words, words.shapes())).all()
    assert len(calls) == 1 and len(columns) == 2
    of, bucket, value = words.features(1 << 10)
    want = Counter()
    for i, text in enumerate((" ".join([*VOCAB, "é" * 900]), "para para para")):
        want.update((i, one(x.encode(), s) & 1023) for w in text.split() for s, x in ((0, w), (1, w[: quality.PREFIX])))
    assert dict(zip(zip(of.tolist(), bucket.tolist()), value.tolist())) == {k: 1 - 0.5**n for k, n in want.items()}


def test_em_finds_accuracies():
    """Votes drawn with known accuracies, on kinds that each labeller can or can't tell apart."""
    rng = np.random.default_rng(1)
    kind = rng.choice(4, 40_000, p=[0.75, 0.1, 0.1, 0.05])
    right, cast, columns = {}, rng.random((len(LABELLERS), len(kind))), []
    for j, name in enumerate(LABELLERS):
        right[name] = acc = rng.uniform(0.8, 0.95)
        ok = rng.random(len(kind)) < acc
        if name in quality.TOXIC_LABELLERS:
            columns.append(np.where((kind == 2) & (cast[j] < 0.6), 3, 0))
        elif name in quality.FAULT_LABELLERS:
            columns.append(np.where((kind == 1) & (cast[j] < 0.3), 2, 0))
        elif name in quality.QUALITY_LABELLERS:
            columns.append(np.where(cast[j] < 0.8, np.where(np.isin(kind, quality._SEES[name]) == ok, 2, 1), 0))
        else:
            columns.append(np.where(cast[j] < 0.7, np.where(ok, quality.CLASS_OF_KIND[kind] + 1, rng.integers(1, 4, len(kind))), 0))
    patterns, at, n = np.unique(np.stack(columns, 1), axis=0, return_inverse=True, return_counts=True)
    share, p, posterior = fit_labellers(patterns, n.astype(float), belief=0.0)
    assert share.sum() == pytest.approx(1) and share[[1, 3]] == pytest.approx([0.1, 0.05], abs=0.03)
    for j, name in enumerate(LABELLERS):
        if name in quality._SEES:
            assert p[j, 0, 1] / p[j, 0, 1:3].sum() == pytest.approx(right[name], abs=0.05)
    assert (posterior[at.ravel()].argmax(1) == quality.CLASS_OF_KIND[kind]).mean() > 0.9
    assert len(KINDS) == 4


def test_a_labeller_that_is_often_wrong_weighs_less():
    rng = np.random.default_rng(3)
    kind = rng.choice(4, 20_000, p=[0.8, 0.1, 0.05, 0.05])
    columns = [np.zeros(len(kind), int)] * len(LABELLERS)
    for name, acc in (("sentences", 0.55), ("common_words", 0.95), ("plain_words", 0.95), ("longest_run", 0.95), ("repetition", 0.95)):
        columns[LABELLERS.index(name)] = np.where(np.isin(kind, quality._SEES[name]) == (rng.random(len(kind)) < acc), 2, 1)
    patterns, n = np.unique(np.stack(columns, 1), axis=0, return_counts=True)
    _, p, _ = fit_labellers(patterns, n.astype(float))
    gap = lambda name: np.log(p[LABELLERS.index(name), 0, 1] / p[LABELLERS.index(name), quality._SEES[name][0], 1])
    assert gap("common_words") > 5 * abs(gap("sentences"))


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = table()
    odd = [(10_000, None, "x"), (10_001, "", "x"), (10_002, " \n", "x"), (None, rows[0][1], "x"), (rows[3][0], rows[3][1], rows[3][2]), (10_003, " ".join([good(random.Random(9))] * 2000), "good")]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    told = spark.createDataFrame([x for x in labels if x[0] < 400] + [(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = classify(docs, told, buckets=1 << 16).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.row.doc_id: r for r in got}
    late = [(i, kind) for i, _, kind in rows if i >= 400]
    assert sum(by[i].keep == (kind == "good") for i, kind in late) >= 0.97 * len(late)
    assert all(by[i].keep for i in (10_000, 10_001, 10_002, 10_003))
    kept = keep_good(docs, told, buckets=1 << 16)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)


def test_labels_of_em_alone(spark):
    """Without any given label the heuristics find low texts and insults; the posterior of no document comes from its own label."""
    rows, labels = table()
    docs = spark.createDataFrame(rows, SCHEMA)
    for told, least in ((None, 0.8), (spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), 0.9)):
        every, codes, _, posterior, _ = label(docs, told, buckets=1 << 14)
        of = dict(zip(codes.tolist(), posterior.argmax(1)))
        got = {r.doc_id: of[r.code] for r in every.collect()}
        for k, name in enumerate(("good", "low", "toxic")):
            mine = [i for i, text, x in rows if x == name and (told or x != "toxic" or "idiot" in text)]  # the other insults are no heuristic's
            assert sum(got[i] == k for i in mine) >= least * len(mine)
        assert (unpacked(codes)[:, -1] == 0).all() == (told is None)
    flipped = spark.createDataFrame([(i, 1 - q if i == 7 else q, x) for i, q, x in labels], "doc_id bigint, quality int, toxic int")
    code = [next(r.code for r in label(docs, t, buckets=1 << 14)[0].filter("doc_id = 7").collect()) for t in (told, flipped)]
    assert code[0] == code[1]


def test_query_on_tables(spark, tmp_path):
    from tabwright.llm.queries import op1_weak_labels

    rows, labels = table(900, 5)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([x for x in labels if x[0] < 700], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op1_weak_labels(spark, str(tmp_path)).collect()}
    assert got.keys() == {i for i, _, _ in rows}
    assert all(r.p_good + r.p_low + r.p_toxic == pytest.approx(1, abs=1e-5) and r.keep == (r.p_good >= 0.5) for r in got.values())
    assert sum(got[i].keep == (k == "good") for i, _, k in rows if i >= 700) >= 0.95 * 200


def test_without_labels_and_empty_tables(spark):
    rows, _ = table(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for labels in (None, none):
        by = {r.row.doc_id: r.keep for r in classify(docs, labels, buckets=1 << 14).collect()}
        assert all(by[i] for i, _, k in rows if k == "good") and sum(not by[i] for i, _, k in rows if k == "low") > 0
    assert classify(docs.limit(0), none).count() == 0

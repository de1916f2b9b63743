import re
from collections import Counter, defaultdict

import pytest

from tabwright.llm.divergence import _terms, audit

SCHEMA = "lang string, source string, text string, term string, rank string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))) for lang, source, text in rows]
    out = []
    for lang in {x[0] for x in docs}:
        in_docs, of_lang, of_source = Counter(), Counter(), defaultdict(Counter)
        for _, source, words in (x for x in docs if x[0] == lang):
            in_docs.update(set(words))
            of_source[source].update(words)
        kept = [t for t in in_docs if in_docs[t] >= min_docs]
        for c in of_source.values():
            of_lang.update(c)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q, shares = share(of_lang), {s: share(c) for s, c in of_source.items()}
        for s, p in shares.items():
            pairs = sorted((-sum(f(p[t], r[t]) for t in kept), o) for o, r in shares.items() if o != s)
            terms = sorted((-f(p[t], q[t]), t.encode()) for t in kept if of_source[s][t] and p[t] > q[t])[:top]
            out += [(lang, s, "pair", o, -v, i) for i, (v, o) in enumerate(pairs, 1)] + [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms, 1)]
    return sorted(out)


def rows():
    out = [("en", f"s{i % 7}", f"The the {'Été ' * (i % 5)} cat{i % 3} x-ray_{i % 4} 1one2 ΑΒ") for i in range(60)]
    out += [("en", "hot", "the hot hot hot cat1")] * 40 + [("en", "s1", None), ("en", "blank", ""), ("en", None, "the cat0"), ("en", "", "The CAT0")]
    out += [(None, "s1", "the cat"), (None, "s2", "the dog"), ("", "s2", "the"), ("de", "s1", "einmal"), ("de", "s2", None), ("fr", "alone", "le le")]
    return out + [("en", "long", "the cat2 " * 200_000 + "zz" * 700_000), ("es", "a", "el"), ("es", "b", "el el"), ("es", "c", "EL EL EL"), ("es", "d", "no")]


@pytest.mark.parametrize("block,min_docs", [(64, 3), (1, 3), (2, 1)])
def test_audit_against_brute_force(spark, block, min_docs):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows()], SCHEMA).repartition(5)
    got = sorted(map(tuple, audit(df, min_docs, block=block).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == brute(rows(), min_docs)


def test_nothing_to_compare(spark):
    assert audit(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([("en", "a", "few words", "", "")], SCHEMA)
    assert audit(one).count() == 0
    assert [tuple(x)[:5] for x in audit(one.unionByName(one.selectExpr("lang", "'b' AS source", "text", "term", "rank"))).orderBy("source").collect()] == [("en", "a", "pair", "b", 0), ("en", "b", "pair", "a", 0)]


def test_counts_beyond_a_long_stay_exact(spark):
    from pyspark.sql import functions as F

    from tabwright.llm.divergence import _share

    n, total, terms = 10**15, 3 * 10**15 + 1, 10**9
    df = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint").select(_share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    assert df.dtypes == [("p", "bigint")] and df.first().p == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_long_texts_are_split_between_terms(monkeypatch):
    from tabwright.llm import divergence

    monkeypatch.setattr(divergence, "PIECE", 3)
    text = "ab, Ébène1cdefgh  i".encode()
    assert [x for piece in _terms(text) for x in piece] == [x.encode() for x in ("ab", "Ébène", "cdefgh", "i")]

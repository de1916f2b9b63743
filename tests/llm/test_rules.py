import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from tabwright.llm import rules

SCHEMA = "doc_id bigint, text string, lang string, scores string, half string"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] >= 2:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def odd_texts():
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a", "a a a a", "x\ny\nx\n x\n\n\nx", "été # | <b>&amp; $ $\x0b\x1cz", "x " * 100_000 + "\n" + "y" * 300_000]
    rng = random.Random(3)
    out += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(3, 120))) for _ in range(60)]
    return out + ["\n".join(rng.choice(["one line", "one line ", "é ü", ""]) for _ in range(30)) for _ in range(10)]


@pytest.mark.parametrize("parts", [1, 4])
def test_base_counts_against_brute_force(spark, parts):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "en" if i % 3 else None, "a", "b") for i, t in enumerate(texts)] + [(3, "a", "en", "", "")], SCHEMA).repartition(parts)
    out, strata = rules.judge(df, spark.createDataFrame([], LABELS))
    got = sorted((r.doc_id, *(r[c] for c in rules.BASE), r.base_failed, r.kept) for r in out.collect())
    assert strata == []
    assert got == sorted([(i, *brute(t), not brute(t)[-1]) for i, t in enumerate(texts)] + [(3, *brute("a"), False)])


def test_nothing_to_judge(spark):
    assert rules.judge(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 1, 0)], LABELS))[0].count() == 0


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 50, 0.05), (10, 10, 0.5), (17, 900, 0.02), (0, 1, 0.02)])
def test_binomial_probabilities_are_exact(k, n, p):
    exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
    assert rules.at_most(k, n, p) == pytest.approx(float(exact), rel=1e-9)
    if k < n:
        assert rules.at_most(k, n, rules.upper_bound(k, n, 0.05)) == pytest.approx(0.05, rel=1e-6)


def test_certified_levels_hold_their_bound():
    """Fresh holdouts of a stratum whose levels reject 1, 3 and 6 % of good texts: a level beyond 4 % is certified in under 5 % of the trials."""
    rng, wrong, some = random.Random(5), 0, 0
    for _ in range(400):
        counts = [0, 0, 0, 0]
        for _ in range(600):
            u = rng.random()
            counts[0 if u < 0.01 else 1 if u < 0.03 else 2 if u < 0.06 else 3] += 1
        level, n, gone, bound = rules.certify({"a": counts}, {"a": 2}, 0.04, 0.05)["a"]
        wrong, some = wrong + (level == 2), some + (level >= 0)
        assert n == 600 and (level < 0 or (gone == sum(counts[: level + 1]) and bound <= 0.04))
    assert wrong <= 32 and some > 360


def test_error_probability_is_divided_among_the_strata_that_can_pass():
    none = [0] * rules.LEVELS
    found = rules.certify({"a": [*none, 200], "b": [*none, 180], "tiny": [*none, 20]}, dict.fromkeys(("a", "b", "tiny"), 0), 0.02, 0.05)
    assert found["a"][0] == 0 and found["tiny"][0] == -1
    assert found["b"][0] == (0 if 0.98**180 <= 0.025 else -1)


def docs(n, seed, langs=("en", "de")):
    """Good, broken (symbols) and toxic (a word of each language) documents with their labels."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        lang, kind = langs[i % len(langs)], rng.choices(("good", "low", "toxic"), (8, 1, 1))[0]
        words = [f"w{int(rng.paretovariate(0.3)) % 5000}" for _ in range(rng.randrange(60, 200))]
        if kind == "low":
            words = [w + "%%$" for w in words]
        elif kind == "toxic":
            words[:: len(words) // 3] = [f"bad{lang}"] * len(words[:: len(words) // 3])
        rows.append((i, " ".join(words), lang, "", ""))
        labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return rows, labels


def test_rules_catch_planted_faults_and_keep_good_documents(spark):
    rows, labels = docs(3000, 1)
    out, strata = rules.judge(spark.createDataFrame(rows, SCHEMA).repartition(6), spark.createDataFrame(labels[:2400] + [(5, None, None), (None, 1, 0)], LABELS))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert {s.stratum for s in strata} == {"=en", "=de"} and all(s.level >= 0 and s.bound <= 0.02 for s in strata)
    good = [kept[i] for i, q, t in labels[2400:] if q and not t]
    bad = [kept[i] for i, q, t in labels[2400:] if not (q and not t)]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_copies_count_once_in_the_holdout(spark):
    rows, labels = docs(1500, 2, ("en",))
    copies = [(10_000 + i, rows[0][1], "en", "", "") for i in range(3000)]
    both = spark.createDataFrame(rows + copies, SCHEMA), spark.createDataFrame(labels + [(10_000 + i, 1, 0) for i in range(3000)], LABELS)
    assert rules.judge(*both)[1][0].holdout < 1000

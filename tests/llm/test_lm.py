import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabwright.llm.lm import Trie, grams, scores

SCHEMA = "doc_id bigint, text string, score string"
TEXTS = ["The cat sat on the mat", "the cat\tsat  on\nthe hat", None, "", " ", "École à la carte", "a rose is a rose is a rose", "zzz qqq \x0b x", "The dog sat on the log", "word " * 3000]
ROWS = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(3, "the same id again"), (41, "Ünseen ¿ bytes % here")]


def is_held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


class Plain:
    """Partial matching by method C with exclusion, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            s = [0] * order + list(t.encode()) + [256]
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.seen[tuple(s[i - k : i])][s[i]] += 1

    def score(self, text):
        s, total = [0] * self.order + list(text.encode()) + [256], 0.0
        for i in range(self.order, len(s)):
            out, done = set(), False
            for k in range(self.order, -1, -1):
                have = self.seen.get(tuple(s[i - k : i]))
                if not have:
                    continue
                left = {x: n for x, n in have.items() if x not in out}
                if left:
                    whole = sum(left.values()) + len(left)
                    if s[i] in left:
                        total, done = total + math.log10(left[s[i]] / whole), True
                        break
                    total += math.log10(len(left) / whole)
                out |= have.keys()
            if not done:
                total -= math.log10(257 - len(out))
        return total


@pytest.mark.parametrize(("order", "hot", "contexts", "few"), [(3, 0, 0, 0), (3, 3, 7, 10), (4, 1000, 100_000, 1_000_000), (4, 1000, 40, 1_000_000), (1, 2, 3, 0)])
def test_scores_against_brute_force(spark, order, hot, contexts, few):
    """However many words and contexts are broadcast, the scores are those of the model of all contexts."""
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS] + [(None, "lost", "x")], SCHEMA)
    got = scores(df, order=order, hot_words=hot, hot_contexts=contexts, broadcast_counts=few).collect()
    train = [t for i, t in ROWS if not is_held(i)]
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()) + len(train), len(c) + 1
    plain = Plain([t or "" for t in train], order)
    want = sorted((i, is_held(i), len(words(t)) + 1, sum(w in c for w in words(t)) + 1, n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)) + math.log10((len(train) + 1) / (n + v + 1)), 6), t or "") for i, t in ROWS)
    have = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert have == sorted(w[:6] for w in want)
    assert [x for _, x in sorted((r.doc_id, r.score) for r in got)] == pytest.approx([x for _, x in sorted((i, plain.score(t or "")) for i, t in ROWS)], rel=1e-9, abs=1e-9)


def levels(texts, order):
    keys, n = grams([t.encode() for t in texts], order)
    out = []
    for k in range(order + 1):
        c = Counter()
        for key, m in zip(keys.tolist(), n.tolist()):
            c[(key >> 9) & ((1 << 8 * k) - 1), key & 511] += m
        out.append(tuple(np.array(x, np.int64) for x in zip(*[(a, b, m) for (a, b), m in c.items()])))
    return out


def test_trie_is_a_distribution():
    trie = Trie(levels(["abracadabra", "abba", "cab \x00"], 3))
    p = 10.0 ** trie.table.reshape(-1, trie.n_classes)
    weight = np.ones(trie.n_classes)
    weight[-1] = 257 - (trie.n_classes - 1)
    assert np.allclose(p @ weight, 1, atol=1e-12)


def test_trie_of_some_contexts_leaves_the_others():
    counts = levels(["abracadabra " * 5], 2)
    few = Trie([counts[0], counts[1], tuple(x[(counts[2][0] & 255) == ord("a")] for x in counts[2])])
    score, text, gram, times = few.score([b"abra", b""])
    plain = Plain(["abracadabra " * 5], 2)
    left = Counter()
    for t, g, n in zip(text.tolist(), gram.tolist(), times.tolist()):
        assert (g >> 9) & 255 != ord("a")
        left[t] += n
    assert left == {0: 3, 1: 1} and score[1] == 0
    assert score[0] == pytest.approx(plain.score("abra") - rest_of(plain, "abra", "a"), abs=1e-9)


def rest_of(plain, text, last):
    """What the symbols of a text give that do not follow ``last``."""
    s, total = list(text.encode()) + [256], 0.0
    for i, x in enumerate(s):
        if i == 0 or chr(s[i - 1]) != last:
            total += symbol(plain, [0, 0, *s[:i]], x)
    return total


def symbol(plain, before, x):
    out = set()
    total = 0.0
    for k in range(plain.order, -1, -1):
        if have := plain.seen.get(tuple(before[len(before) - k :])):
            left = {a: n for a, n in have.items() if a not in out}
            if left:
                whole = sum(left.values()) + len(left)
                if x in left:
                    return total + math.log10(left[x] / whole)
                total += math.log10(len(left) / whole)
            out |= have.keys()
    return total - math.log10(257 - len(out))


def test_nothing_to_train_on(spark):
    held = next(i for i in range(100) if is_held(i))
    r = scores(spark.createDataFrame([(held, "ab", "x")], SCHEMA)).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 2, 0, 0, 0.0)
    assert r.score == pytest.approx(-3 * math.log10(257), abs=1e-9)
    assert scores(spark.createDataFrame([], SCHEMA)).count() == 0

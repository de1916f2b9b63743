import itertools
import re

import pytest

from tabwright.llm.decontam import NAMES, NUMBERS, UNITS, contaminated, decontaminate

ITEM = "A farmer in the valley has 12 apples and gives 5 apples to Anna, then Anna walks 3 km to sell the remaining 12 apples at the market."
PLAIN = "thblewh outhan therble haorble enesou bleha he with he the toanshedha eseser that thinon."
#: Sentences that begin with names.
STORY = "Alice has 3 pears in the old green basket. Bob takes 7 of the pears down to the street. Alice then counts what is left over in the morning."
ROWS = [
    (1, f"noise words before it all. {ITEM} And noise after it."),
    (2, ITEM.replace("12", "40").replace("5", "7").replace("Anna", "Tom").replace("km", "miles")),
    (3, ITEM.replace("12", "40", 1).replace("remaining 12", "remaining 99").replace("Anna,", "Tom,")),
    (4, " ".join(ITEM.split()[:14])),
    (5, f"x y z {PLAIN.upper()}"), (6, f"x y {PLAIN} z"), (7, f"x y {PLAIN.replace(' he ', ' he really ', 1)} z"),
    (8, None), (9, ""), (10, "the the the"), (11, "word " * 50_000 + PLAIN), (6, f"x y {PLAIN} z"),
    (13, "Then comes noise. " + STORY.replace("Alice", "Zyrtan").replace("Bob", "Quorl")), (14, STORY.replace("3", "9").replace("7", "9")), (15, STORY.replace("pears", "figs").replace("street", "road").replace("morning", "night").replace("counts", "eats")),
    (16, "before Too  short, in all. after"), (17, "too in short all"), (18, "so 1 2 3 4 5 6 7 it is"), (19, "so 1 2 3 4 5 6 8 it is"),
    (12, " ".join(PLAIN.split()[:8]) + " gap " * 40 + " ".join(PLAIN.split()[8:])),
]
BENCH = [(100, ITEM), (200, PLAIN), (300, None), (400, "too short"), (450, "Too short in all"), (500, "1 2 3 4 5 6 7"), (600, STORY)]


def windows(text):
    """(position, canonical words, slots) in every form: a capitalised word at a sentence's beginning stands for itself or for a name."""
    out, w = [], (text or "").split()
    low = [x.strip(".,;:!?") for x in w]
    canon, maybe = [], []
    for i, x in enumerate(low):
        capital, first = len(x) > 1 and x[0].isupper() and x[1:].islower(), not i or w[i - 1][-1] in ".!?"
        kind = "<num>" if re.fullmatch(r"\d+", x) or x.lower() in NUMBERS else "<unit>" if x.lower() in UNITS else "<name>" if x.lower() in NAMES or (capital and not first) else x.lower()
        canon.append(kind)
        maybe.append(capital and first and kind[0] != "<")
    for i in range(len(w) - 4):
        could = [k for k in range(5) if maybe[i + k]]
        for names in [(), *itertools.combinations(could, 1), *itertools.combinations(could, 2)]:
            form = [("<name>" if k in names else canon[i + k]) for k in range(5)]
            if sum(c[0] == "<" for c in form) <= 2:
                out.append((i, tuple(form), [a.lower() for a, c in zip(low[i : i + 5], form) if c[0] == "<"]))
    return out


def brute():
    found = set()
    for item, b in BENCH:
        ws = windows(b)
        n = len({q for q, _, _ in ws})
        plain = [x.strip(".,;:!?").lower() for x in (b or "").split()]
        for doc, text in ROWS:
            ds = windows(text)
            words = [x.strip(".,;:!?").lower() for x in (text or "").split()]
            if not n and len(plain) >= 3 and any(words[i : i + len(plain)] == plain for i in range(len(words))):
                found.add((doc, item))
            for diag in {p - q for p, x, _ in ds for q, y, _ in ws if x == y}:
                near = [(q, a, s) for p, x, a in ds for q, y, s in ws if x == y and abs(p - q - diag) <= 4]
                pairs = {}
                for _, a, s in near:
                    for u, v in zip(s, a):
                        pairs.setdefault(u, []).append(v)
                to = {u: max(sorted(set(v)), key=v.count) for u, v in pairs.items()}
                good = {q for q, a, s in near if all(to[u] == v for u, v in zip(s, a))}
                if n and len(good) >= 0.8 * n:
                    found.add((doc, item))
    return found


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in ROWS] + [(None, ITEM, "c")], "doc_id bigint, text string, slots string")
    return docs, spark.createDataFrame(BENCH, "item_id bigint, text string")


def test_against_brute_force(tables):
    got = contaminated(*tables).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute() == {(1, 100), (2, 100), (5, 200), (6, 200), (11, 200), (13, 600), (14, 600), (16, 450), (18, 500)} | ({(7, 200)} & brute())
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {r.doc_id: r.changed for r in got if r.item_id == 100} == {1: False, 2: True}


def test_join_without_broadcast_and_stage(tables, monkeypatch):
    from tabwright.llm import decontam

    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    kept = decontaminate(*tables)
    assert kept.columns == tables[0].columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([i for i, _ in ROWS if i not in {d for d, _ in brute()}] + [0])


def test_empty_tables(spark, tables):
    docs, bench = tables
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0

import itertools
import random
import re

import duckdb
import pytest

from tabwright.llm import turns
from tabwright.llm.queries import oracle_sql

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, chunk string"


def cheapest(kinds):
    """(cost, audit) over all edits, with up to two insertions in each gap."""
    best = None
    for edits in itertools.product(*[("D",) if k == "x" else "DKR" for k in kinds]):
        for gaps in itertools.product(range(3), repeat=len(kinds) + 1):
            cost, roles, audit = 0, "", ""
            for k, e, g in zip(kinds, edits, gaps):
                cost += 3 * g + {"D": 4, "K": 0, "R": 3}[e] + (3 if k.isupper() and e != "D" else 0)
                audit += "I" * g + e
                roles += "?" * g + {"D": "", "K": k.lower(), "R": "?"}[e]
            cost, audit, roles = cost + 3 * gaps[-1], audit + "I" * gaps[-1], roles + "?" * gaps[-1]
            # a made turn may have either role
            if re.fullmatch(r"(s?([u?][a?])+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_matrices_against_all_edits(n):
    rng = random.Random(n)
    every = list(itertools.product("suaoSUAOx", repeat=n))
    for kinds in every if n < 3 else rng.sample(every, 120 if n == 3 else 25):
        row = turns.closed(list(turns.chunk_matrix(tuple((k, 0) for k in kinds))[:4]))
        assert min(row[q] for q in turns.COMPLETE if row[q]) == cheapest(kinds), kinds


def test_products_are_associative_and_know_their_states():
    rng = random.Random(9)
    for _ in range(40):
        kinds = [(rng.choice("suaoSUAOx"), rng.choice((0, 0, 0, 2))) for _ in range(rng.randrange(2, 12))]
        cut_at = sorted(rng.sample(range(1, len(kinds)), min(2, len(kinds) - 1)))
        parts = [kinds[a:b] for a, b in zip([0, *cut_at], [*cut_at, len(kinds)])]
        total, paths = turns.product([list(turns.chunk_matrix(tuple(x))) for x in parts])
        assert tuple(total) == turns.chunk_matrix(tuple(kinds))
        for i, way in enumerate(total):
            if way is not None:
                states = list(map(int, paths[i]))
                assert "".join(turns.chunk_matrix(tuple(x))[a * 4 + b][1] for x, a, b in zip(parts, states, states[1:])) == way[1]


def odd_rows():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "User"]
    texts = ["Yes.", "No!", "what", "", " \t\n", None, "é?", "done.\n ", "a b", "x." * 50_000]
    out = [(c, t, rng.choice(roles[:3] if c % 2 else roles), rng.choice(texts), "p", "c") for c in range(40) for t in sorted(rng.sample(range(12), rng.randrange(1, 9)))]
    out += [(500, t, ("user", "assistant")[t % 2], f"turn {t % 37}.", "", "") for t in range(700)]  # long, with many repeats
    out += [(501, 7, "user", "Same.", "", "")] * 300 + [(501, 8, "assistant", "Other.", "", "")]  # one row again and again
    out += [(None, 1, "user", "hi.", "", ""), (None, None, "system", "s.", "", ""), (502, None, "user", "a.", "", ""), (502, None, "assistant", "b.", "", ""), (502, 3, "user", "c", "", "")]
    out += [(503, 5, "user", "u.", "", ""), (503, 5, "assistant", "a.", "", ""), (503, 5, "user", "t.", "", ""), (503, -4, "system", "s.", "", "")]
    dropped = next(c for c in range(600, 700) if turns_crc(c, 0) == 0)
    return out + [(dropped, 0, "user", "gone.", "", "")]


def turns_crc(conv, turn):
    import zlib

    return zlib.crc32(f"{conv}:{turn}".encode()) % 20


@pytest.mark.parametrize("chunk,fan,parts", [(256, 16, 4), (3, 2, 7), (2, 16, 1)])
def test_reports_and_repaired_turns_against_sql(spark, tmp_path, chunk, fan, parts):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(parts)
    df.coalesce(1).write.parquet(f"{tmp_path}/c")
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
        want = con.sql(oracle_sql()["op11_turn_matrices"]).fetchall()
    got = turns.repair_report(turns.damage(df), df, chunk=chunk, fan=fan)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_repaired_conversations_alternate(spark):
    report, repaired = turns.repair(spark.createDataFrame(odd_rows(), SCHEMA), chunk=4, fan=3)
    roles: dict = {}
    for r in repaired.orderBy("conv_id", "pos", "sub").collect():
        roles.setdefault(r.conv_id, []).append(r.role[:1])
        assert r.edit != "I" or (r.text == "" and r.role in ("user", "assistant"))
    assert all(re.fullmatch("s?(ua)+", "".join(x)) for x in roles.values())
    assert {r.conv_id for r in report.collect() if set(r.audit) - {"D"}} == set(roles)


def test_nothing_to_repair(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert turns.repair_report(turns.damage(df), df).count() == 0

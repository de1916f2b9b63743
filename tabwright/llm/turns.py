"""Conversation structure repair: a min-plus matrix scan over turns finds the cheapest edits, conversations of any length included."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import WHITE, cut, map_arrow

#: Costs of the edits, and of keeping a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Different turns of a chunk, whose matrices one task multiplies, and matrices multiplied at once above the chunks.
CHUNK, FAN = 256, 16
#: States of a repaired conversation's beginning: nothing, its system turn, ending with a user's turn, ending with an assistant's (complete).
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES, COMPLETE = 4, (NONE, ASSISTANT)
#: The state after a turn that a rerole or an insertion makes.
_MADE = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_KEEPS = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}

#: Cost and audit of the cheapest way from one state to another, or None where there is none. They are compared by cost, then by audit: among edits
#: of the same turns no audit is the beginning of another at equal cost, since it would lack paid insertions; so appending keeps the order.
Way = tuple[int, str] | None


def _least(*ways: Way) -> Way:
    return min((w for w in ways if w is not None), default=None)


def _and(way: Way, cost: int, letters: str) -> Way:
    return None if way is None else (way[0] + cost, way[1] + letters)


def closed(row: list[Way]) -> list[Way]:
    """Insertions may follow: a row times the closure of the insertion matrix."""
    user = _least(row[USER], *(_and(row[p], INSERT, "I") for p in (NONE, SYSTEM, ASSISTANT)))
    return [row[NONE], row[SYSTEM], user, _least(row[ASSISTANT], _and(user, INSERT, "I"))]


def turn_step(row: list[Way], kind: str) -> list[Way]:
    """A row times a turn's 4 x 4 matrix. ``kind``: x for a turn that must go, else the role's initial (o for another), a capital if truncated."""
    out = [_and(w, DELETE, "D") for w in row]
    if kind != "x":
        extra = TRUNCATED if kind.isupper() else 0
        for p, q in enumerate(_MADE):
            out[q] = _least(out[q], _and(row[p], REROLE + extra, "R"))
        for p, q in _KEEPS.get(kind.lower(), {}).items():
            out[q] = _least(out[q], _and(row[p], extra, "K"))
    return out


@lru_cache(maxsize=4096)
def chunk_matrix(kinds: tuple[tuple[str, int], ...]) -> tuple[Way, ...]:
    """The product of a chunk's matrices, each with the insertion closure before it, from (kind, how many further copies) of its turns."""
    out: list[Way] = []
    for start in range(STATES):
        row: list[Way] = [(0, "") if p == start else None for p in range(STATES)]
        for kind, copies in kinds:
            row = turn_step(closed(row), kind)
            if copies:  # insertions between deletions can as well stand before the next turn, with a smaller audit
                row = [_and(w, copies * DELETE, "D" * copies) for w in row]
        out += row
    return tuple(out)


def product(ways: list[list[Way]]) -> tuple[list[Way], list[str]]:
    """The product of matrices, and for each entry the states between them, as digits from its start to its end."""
    total = [(0, "") if p == q else None for p in range(STATES) for q in range(STATES)]
    paths = [str(p) if p == q else "" for p in range(STATES) for q in range(STATES)]
    for m in ways:
        found, on = [], []
        for p in range(STATES):
            for q in range(STATES):
                options = [(a[0] + b[0], a[1] + b[1], r) for r in range(STATES) if (a := total[p * STATES + r]) is not None and (b := m[r * STATES + q]) is not None]
                best = min(options, default=None)
                found.append(best and best[:2])
                on.append(paths[p * STATES + best[2]] + str(q) if best else "")
        total, paths = found, on
    return total, paths


class Facts(NamedTuple):
    """What else adds up along neighbouring turns: counts, and the ends that the next turns are compared with."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    turns: int  # distinct turn numbers
    first_turn: int | None
    last_turn: int | None
    first_role: str
    last_role: str

    def then(self, b: Facts) -> Facts:
        same = self.last_turn is not None and self.last_turn == b.first_turn
        return Facts(
            self.blank + b.blank, self.duplicate + b.duplicate, self.truncated + b.truncated, self.illegal + b.illegal + illegal(self.last_role, b.first_role), self.turns + b.turns - same,
            b.first_turn if self.first_turn is None else self.first_turn, self.last_turn if b.last_turn is None else b.last_turn, self.first_role, b.last_role,
        )


def illegal(a: str, b: str) -> int:
    return int(a + b not in ("su", "ua", "au"))


def _facts(turn: int | None, initial: str, blank: bool, first: bool, truncated: bool, n: int) -> Facts:
    new = first and not blank
    return Facts(n if blank else 0, 0 if blank else n - new, int(new and truncated), (n - 1) * illegal(initial, initial), int(turn is not None), turn, turn, initial, initial)


_FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, first_role string, last_role string"
_MATRIX = "costs array<bigint>, audits array<string>"
_CHUNK = f"conv_id bigint, chunk bigint, {_FACTS}, {_MATRIX}"
_NODE = f"conv_id bigint, idx bigint, {_FACTS}, {_MATRIX}, paths array<string>"
_SUMMARY = f"conv_id bigint, {_FACTS}, cost bigint, audit string, state int, tail string"


def _batch(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from pa.Table.from_pylist(rows, schema).to_batches()


def _arrow(ddl: str) -> pa.Schema:
    of = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(x.split()[0], of[x.split()[1]]) for x in ddl.split(", ")])


def _split(ways) -> dict:
    return {"costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}


def _ways(row: dict) -> list[Way]:
    return [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])]


def _kind(r: dict) -> str:
    if r["blank"] or not r["is_first"]:
        return "x"
    kind = r["role"][:1] if r["role"][:1] in ("s", "u", "a") else "o"
    return kind.upper() if r["truncated"] else kind


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's matrix and facts, from its turns in order."""
    schema = _arrow(_CHUNK)
    for batch in batches:
        out = []
        for c in batch.to_pylist():
            facts = None
            for r in c["turns"]:
                new = _facts(r["turn"], r["role"][:1], r["blank"], r["is_first"], r["truncated"], r["n"])
                facts = new if facts is None else facts.then(new)
            out.append({"conv_id": c["conv_id"], "chunk": c["chunk"], **facts._asdict(), **_split(chunk_matrix(tuple((_kind(r), r["n"] - 1) for r in c["turns"])))})
        yield from _batch(out, schema)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node of the reduction from its children in order."""
    schema = _arrow(_NODE)
    for batch in batches:
        out = []
        for c in batch.to_pylist():
            facts = Facts(*(c["has"][0][x] for x in Facts._fields))
            for r in c["has"][1:]:
                facts = facts.then(Facts(*(r[x] for x in Facts._fields)))
            total, paths = product([_ways(r) for r in c["has"]])
            out.append({"conv_id": c["conv_id"], "idx": c["idx"], **facts._asdict(), **_split(total), "paths": paths})
        yield from _batch(out, schema)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's cheapest edits: from nothing to a complete one, insertions at its end included."""
    schema = _arrow(_SUMMARY)
    for batch in batches:
        out = []
        for c in batch.to_pylist():
            options = []
            for state, way in enumerate(_ways(c)[:STATES]):
                if way is not None:
                    after = closed([way if q == state else None for q in range(STATES)])
                    options += [(*after[q], state, after[q][1][len(way[1]) :]) for q in COMPLETE if after[q] is not None]
            cost, audit, state, tail = min(options)
            out.append({"conv_id": c["conv_id"], **{x: c[x] for x in Facts._fields}, "cost": cost, "audit": audit, "state": state, "tail": tail})
        yield from _batch(out, schema)


_EDITED = "conv_id bigint, pos bigint, sub int, edit string, role string, turn bigint, from_role string, h binary"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that a chunk's part of the audit leaves and inserts."""
    schema = _arrow(_EDITED)
    for batch in batches:
        out = []
        for c in batch.to_pylist():
            state, letters = c["start"], iter(c["piece"])
            for r in c["turns"]:
                sub = 0
                for edit in letters:
                    row = {"conv_id": c["conv_id"], "pos": r["pos"], "sub": sub, "edit": edit, "turn": r["turn"]}
                    sub += 1
                    if edit in "IR":
                        state = _MADE[state]
                        out.append(row | {"role": _ROLES[state]} | ({"from_role": r["role"], "h": r["h"]} if edit == "R" else {}))
                    elif edit == "K":
                        state = _KEEPS[r["role"][:1]][state]
                        out.append(row | {"role": r["role"], "from_role": r["role"], "h": r["h"]})
                    if edit != "I":
                        break
                for _ in range(r["n"] - 1):  # deleted copies
                    next(letters)
        yield from _batch(out, schema)


def normal(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text), a null role or text being one space."""
    return rows.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])


def damage(rows: DataFrame, **columns: str) -> DataFrame:
    """Damage to test repairs with, by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the turn, 1 empties it, 2 takes its stops away, 3 repeats it, 4 makes it a user's."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    how = normal(rows, **columns).withColumn("how", F.crc32(key.cast("binary")) % 20).filter("how <> 0")
    text = F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role"))
    return how.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("how") == 3, 2).otherwise(1))).alias("_")).drop("_")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the text's hash, by which equal texts are told, and what its end says."""
    bare = F.rtrim("text", F.lit(WHITE.decode()))
    return rows.withColumn("h", F.unhex(F.md5(F.col("text").cast("binary")))).withColumn("blank", bare == "").withColumn("truncated", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))


def _same(*names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    return out


def repair(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(report, repaired): each conversation's faults and cheapest edits, and the turns that they leave.

    A conversation's turns are taken by turn number, nulls first; turns of one number by role, then by their text's MD5. A turn's first fault
    counts: blank, duplicate (an earlier one has its role and text), truncated (it doesn't end with a stop). Blank and duplicate turns are
    deleted; deleting costs 4, a new role or an inserted empty turn of a user or an assistant 3, a truncated turn that stays 3. The report
    has (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): the letters of the cheapest Keep, Rerole, Delete and Insert that
    leave at most one system turn and then pairs of user and assistant, or nothing; of equal costs the audit that sorts first.
    ``repaired`` has (conv_id, pos, sub, edit, role, turn, text), in order by pos and sub; inserted turns have the number of the next one.

    Every turn is a 4 x 4 matrix over (cost, audit): turns are sorted over all partitions, products are taken of chunks of ``chunk`` turns, and
    a conversation of several chunks is reduced by a tree with ``fan`` children a node; then the states between neighbours go down the tree. So
    no task holds a conversation, only a chunk's turns and audits no longer than its own; the audit of a whole conversation is one string
    of the result. Equal turns (repeated rows) are one record with a number. Texts are moved once, to be joined to the turns that stay.

    A null role or text is one space; a null conversation is one; repeated rows are duplicates; an empty table gives no rows; further columns
    are ignored.
    """
    keyed = _keyed(normal(rows, **columns))
    # --- equal turns are one record; which of them come first with their role and text
    runs = keyed.groupBy("conv_id", "turn", "role", "h", "blank", "truncated").agg(F.count("*").alias("n"))
    first = runs.filter("NOT blank").groupBy("conv_id", "role", "h").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    first = first.select("conv_id", "role", "h", F.col("first.turn").alias("turn"), F.lit(True).alias("is_first"))
    marked = runs.alias("a").join(first.alias("b"), _same("conv_id", "role", "h", "turn"), "left").select("a.*", F.coalesce("is_first", F.lit(False)).alias("is_first"))
    # --- order over all partitions, then chunks
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("h")]
    ordered = cut(marked.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("pos", F.monotonically_increasing_id()))
    turns = F.sort_array(F.collect_list(F.struct("pos", "turn", "role", "h", "blank", "truncated", "is_first", "n"))).alias("turns")
    held = ordered.groupBy("conv_id", F.expr(f"pos div {chunk}").alias("chunk")).agg(turns)
    leaves = cut(map_arrow(held, _chunks, _CHUNK, trims=False))
    # --- reduction of the conversations that have several chunks
    numbered = leaves.select("conv_id", "chunk").withColumn("idx", (F.row_number().over(Window.partitionBy("conv_id").orderBy("chunk")) - 1).cast("bigint"))
    several = leaves.groupBy("conv_id").count().filter("count > 1").select("conv_id")
    numbered = cut(numbered.alias("a").join(several.alias("b"), _same("conv_id"), "left_semi"))
    facts = [*Facts._fields, "costs", "audits"]
    levels = [leaves.alias("a").join(numbered.alias("b"), _same("conv_id", "chunk")).select("a.conv_id", "b.idx", *facts)]
    paths: list[DataFrame] = []
    while (levels[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        has = F.sort_array(F.collect_list(F.struct("idx", *facts))).alias("has")
        nodes = cut(map_arrow(levels[-1].groupBy("conv_id", F.expr(f"idx div {fan}").alias("parent")).agg(has).withColumnRenamed("parent", "idx"), _nodes, _NODE, trims=False))
        paths.append(nodes.select("conv_id", "idx", "paths"))
        levels.append(nodes.select("conv_id", "idx", *facts))
    alone = leaves.alias("a").join(several.alias("b"), _same("conv_id"), "left_anti").select("conv_id", *facts)
    tops = alone if not paths else alone.unionByName(levels[-1].select("conv_id", *facts))
    summary = cut(map_arrow(tops, _summaries, _SUMMARY, trims=False))
    # --- states go down: a node's start and end, then its children's
    ends = summary.select("conv_id", F.lit(0).cast("bigint").alias("idx"), F.lit(NONE).alias("start"), F.col("state").alias("end"))
    down = ends
    for depth in range(len(paths) - 1, -1, -1):
        parents = down.alias("a").join(paths[depth].alias("b"), _same("conv_id", "idx")).select("a.conv_id", "a.idx", F.expr(f"paths[start * {STATES} + end]").alias("path"))
        # a path has one digit more than the node has children
        children = F.transform(F.sequence(F.lit(1), F.length("path") - 1), lambda k: F.struct((F.col("idx") * fan + k - 1).alias("idx"), F.substring("path", k, F.lit(1)).cast("int").alias("start"), F.substring("path", k + 1, F.lit(1)).cast("int").alias("end")))
        down = cut(parents.select("conv_id", F.explode(children).alias("c")).select("conv_id", "c.*"))
    of_leaves = leaves.select("conv_id", "chunk", "audits")
    of_one = of_leaves.alias("a").join(several.alias("b"), _same("conv_id"), "left_anti").alias("a").join(ends.alias("b"), _same("conv_id")).select("a.*", "b.start", "b.end")
    if paths:
        placed = numbered.alias("a").join(down.alias("b"), _same("conv_id", "idx")).select("a.conv_id", "a.chunk", "b.start", "b.end")
        of_one = of_one.unionByName(of_leaves.alias("a").join(placed.alias("b"), _same("conv_id", "chunk")).select("a.*", "b.start", "b.end"))
    pieces = of_one.select("conv_id", "chunk", "start", F.expr(f"audits[start * {STATES} + end]").alias("piece"))
    # --- the turns that stay, with their texts
    edited = map_arrow(held.alias("a").join(pieces.alias("b"), _same("conv_id", "chunk")).select("a.*", "b.start", "b.piece"), _edited, _EDITED, trims=False)
    edited = cut(edited)
    texts = keyed.select("conv_id", "turn", "role", "h", "text").dropDuplicates(["conv_id", "turn", "role", "h"]).withColumnRenamed("role", "from_role")
    out = ["a.conv_id", "a.pos", "a.sub", "a.edit", "a.role", "a.turn"]
    stay = edited.filter("h IS NOT NULL").alias("a").join(texts.alias("b"), _same("conv_id", "turn", "from_role", "h")).select(*out, "b.text")
    made = edited.filter("h IS NULL").alias("a").select(*out, F.lit("").alias("text"))
    tail = summary.filter("tail <> ''").select("conv_id", F.lit((1 << 63) - 1).alias("pos"), F.posexplode(F.split("tail", "")).alias("sub", "edit"), "state").filter("edit <> ''")
    follows = F.when((F.col("state") == USER) == (F.col("sub") % 2 == 0), "assistant").otherwise("user")
    tail = tail.select("conv_id", "pos", "sub", "edit", follows.alias("role"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("text"))
    report = summary.select("conv_id", F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, stay.unionByName(made).unionByName(tail)


def digests(repaired: DataFrame) -> DataFrame:
    r"""(conv_id, repaired_sha256): SHA-256 of each conversation's ``role:text``, joined by \n.

    A hash of a sequence can only be taken in its order: one task takes a conversation's turns as they come, and holds no more than a batch of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        done: list[tuple] = []
        for batch in batches:
            for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], ["conv_id", "repaired_sha256"])
            done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    lines = repaired.select("conv_id", "pos", "sub", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    return map_arrow(lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "sub").select("conv_id", "line"), run, "conv_id bigint, repaired_sha256 string")


def repair_report(rows: DataFrame, every: DataFrame, **how) -> DataFrame:
    """The report of ``repair`` with the digests, one row for each conversation of ``every`` (conv_id); those without rows have zeros and empty texts."""
    report, repaired = repair(rows, **how)
    out = every.select("conv_id").distinct().alias("a").join(report.alias("b"), _same("conv_id"), "left").select("a.conv_id", *[F.coalesce(f"b.{c}", F.lit(0)).alias(c) for c in report.columns[1:-1]], F.coalesce("b.audit", F.lit("")).alias("audit"))
    return out.alias("a").join(digests(repaired).alias("b"), _same("conv_id"), "left").select("a.*", F.coalesce("b.repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

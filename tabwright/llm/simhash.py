"""SimHash near-duplicates, linked by a self-join of the binary trie of fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import bytes_of, components, cut, map_arrow, merged, texts

#: Fingerprints of one trie partition, and of one chunk of a top node that holds very many.
PARTITION_ROWS, CHUNK_ROWS = 1_000_000, 20_000
_LEAF_PAIRS, _STEP, _TESTED = 64, 2_000_000, 100_000


def _shingle_hashes(text: bytes, words: int) -> list[int]:
    w = text.lower().split()
    if not w:
        return []
    digest = xxhash.xxh64_intdigest
    if len(w) < words:
        return [digest(b" ".join(w), 42)]
    whole = b" ".join(w)
    stops = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = [0, *stops[: len(w) - words].tolist()]
    return [digest(whole[a:b], 42) for a, b in zip(starts, (stops[words - 1 :] - 1).tolist())]


def _majority(hashes: np.ndarray) -> int:
    """The fingerprint of uint64 hashes: a bit is 1 if it is set in over half of them."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for i in range(0, len(bits), 255):
        total += bits[i : i + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(total * 2 > len(bits)).tobytes(), "big")


#: Bins of a document's sketch: the least hash of each bin of its distinct shingles, as one byte; 0 for none.
SKETCH = 128


def sketch(hashes: np.ndarray) -> bytes:
    """One-permutation min-hash: the hashes fall into bins by their top bits."""
    h = np.unique(hashes * np.uint64(0x9E3779B97F4A7C15))
    first = np.searchsorted(h, np.arange(SKETCH, dtype=np.uint64) << np.uint64(57))
    stop = np.append(first[1:], len(h))
    out = np.zeros(SKETCH, np.uint8)
    full = first < stop
    out[full] = (h[first[full]] >> np.uint64(20)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches, row by row: equal bins over bins that either has; without any, 1."""
    equal, any_ = (a == b) & (a > 0), (a > 0) | (b > 0)
    n = any_.sum(1)
    share = equal.sum(1) / np.maximum(n, 1)
    return np.where(n > 0, (share - 1 / 255) / (1 - 1 / 255), 1.0)


#: Bins of one band key: two sets of similarity 0.8 share one of the 32 keys but once in 20 million, at 0.7 once in 6,000 (bins taken as independent).
BAND = 4
_PROBES = np.array([np.r_[i, np.random.default_rng(i).permutation(SKETCH)] for i in range(SKETCH)])


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of BAND bins each, from whole least hashes; an empty bin borrows from the first full one of its fixed random order."""
    h = np.unique(hashes * np.uint64(0x9E3779B97F4A7C15))
    first = np.searchsorted(h, np.arange(SKETCH, dtype=np.uint64) << np.uint64(57))
    full = first < np.append(first[1:], len(h))
    value = h[np.minimum(first, len(h) - 1)]
    if not full.all():
        value = value[_PROBES[np.arange(SKETCH), full[_PROBES].argmax(1)]]
    value = value.reshape(-1, BAND)
    key = np.arange(1, len(value) + 1, dtype=np.uint64)
    for k in range(BAND):
        key = (key ^ value[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def simhash(text: bytes, words: int = 3) -> int:
    hashes = _shingle_hashes(text, words)
    return _majority(np.array(hashes, np.uint64)) if hashes else 0


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text", sketches: bool = False) -> DataFrame:
    """(doc_id, fp bigint, sketch): 64-bit SimHash over the XXH64 (seed 42) of all word shingles, repeats included; null or blank text: 0. The sketch is null unless asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = [np.array(_shingle_hashes(x, words), np.uint64) for x in bytes_of(batch, "text")]
            fps = np.array([_majority(h) if len(h) else 0 for h in all_], np.uint64).view(np.int64)
            own = pa.array([sketch(h) for h in all_] if sketches else [None] * len(all_), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps), own], ["doc_id", "fp", "sketch"])

    return map_arrow(texts(docs, id_col, text_col), run, "doc_id bigint, fp bigint, sketch binary")


def _ones_from(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """For each range of sorted v whose members agree above ``bit``: where the members with that bit set begin."""
    lo, hi, b = lo.copy(), hi.copy(), np.uint64(bit)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        is_one = ((v[np.minimum(mid, len(v) - 1)] >> b) & np.uint64(1)).astype(bool)
        lo, hi = np.where(open_ & ~is_one, mid + 1, lo), np.where(open_ & is_one, mid, hi)
    return lo


def trie_links(v: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int, bit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) within each range [start, end) of v that differ in at most ``budget`` bits.

    The members of a range are sorted, distinct and agree above ``bit``: a range is a node of the binary trie. Pairs of nodes go down
    together; each level adds one where the two children differ, and a pair over the budget is dropped with all that lies below
    it. Pairs of small nodes are compared member by member.
    """
    big = ends - starts > 1
    stack = [(bit, starts[big], ends[big], starts[big], ends[big], np.zeros(int(big.sum()), np.int64))]
    while stack:
        bit, a0, a1, b0, b1, err = stack.pop()
        if len(a0) > _STEP:
            for i in range(0, len(a0), _STEP):
                stack.append((bit, *(x[i : i + _STEP] for x in (a0, a1, b0, b1, err))))
            continue
        pairs = (a1 - a0) * (b1 - b0)
        small = (pairs <= _LEAF_PAIRS) | (bit < 0)
        yield from _leaves(v, a0[small], a1[small], b0[small], b1[small], budget)
        a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        am, bm, own = _ones_from(v, a0, a1, bit), _ones_from(v, b0, b1, bit), a0 == b0
        parts = [(a0, am, b0, bm, err, True), (am, a1, bm, b1, err, True), (a0, am, bm, b1, err + 1, True), (am, a1, b0, bm, err + 1, ~own)]
        down = []
        for x0, x1, y0, y1, e, which in parts:
            live = (x0 < x1) & (y0 < y1) & (e <= budget) & which
            down.append([x[live] for x in (x0, x1, y0, y1, e)])
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*down))))


def _leaves(v: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = (a1 - a0) * (b1 - b0)
    bounds = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + _STEP, _STEP))
    for s, t in zip(bounds, [*bounds[1:], len(sizes)]):
        if s == t:
            continue
        n, of = sizes[s:t], np.repeat(np.arange(s, t), sizes[s:t])
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = (b1 - b0)[of]
        i, j = a0[of] + k // wide, b0[of] + k % wide
        near = (i < j) & (np.bitwise_count(v[i] ^ v[j]) <= budget)
        yield i[near], j[near]


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]], near: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """For each of n items the smallest item that it is linked to, directly or not. ``near`` tests pairs that aren't connected yet, some at a time."""
    root = np.arange(n)
    for i, j in ((a[k : k + _TESTED], b[k : k + _TESTED]) for a, b in links for k in range(0, len(a), _TESTED)):
        if near is not None:
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            good = near(i, j)
            i, j = i[good], j[good]
        while len(i):
            a, b = root[i], root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while not np.array_equal(up := root[root], root):
                root = up
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
    return root


def _links(budget: int, top: int, least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for x in batches if x.num_rows]
        if not got:
            return
        node, rot, tree = (np.concatenate([x.column(k).to_numpy() for x in got]) for k in ("node", "rot", "tree"))
        rot = rot.view(np.uint64)
        order = np.lexsort((node, rot, rot >> np.uint64(64 - top), tree))
        node, rot, tree = node[order], rot[order], tree[order]
        test = None
        if least is not None:
            held = np.concatenate([np.frombuffer(b"".join(x.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH) for x in got])[order]
            test = lambda i, j: similarity(held[i], held[j]) >= least
        head = rot >> np.uint64(64 - top)
        new = np.flatnonzero(np.r_[True, (head[1:] != head[:-1]) | (tree[1:] != tree[:-1])])
        root = _forest(len(rot), trie_links(rot, new, np.r_[new[1:], len(rot)], budget, 63 - top), test)
        linked = np.flatnonzero(root != np.arange(len(rot)))
        for i in range(0, len(linked), 100_000):
            part = linked[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(node[part]), pa.array(node[root[part]])], ["u", "v"])

    return run


def trie_self_join(classes: DataFrame, budget: int = 2, chunk_rows: int = CHUNK_ROWS, least: float | None = None) -> DataFrame:
    """(u, v) links that connect all classes (node bigint, fp bigint, sketch binary; fp distinct) within ``budget`` differing bits, and, with ``least``, of sketches that are at least so similar.

    Two fingerprints within the budget agree on one of budget + 1 blocks of bits. So the trie is built once for each block, with that
    block rotated to the top, and only pairs under one top node are traversed: top nodes are what Spark deals out. A top node with
    more than ``chunk_rows`` members is split into chunks by hash, one sub-trie for each pair of chunks. A task holds the
    fingerprints of its top nodes as arrays, and returns a spanning forest of its links: no link is lost to connectivity, and the
    rows stay at most (budget + 1) for each fingerprint however dense the links are.
    """
    top = 64 // (budget + 1)
    rots = [F.struct(F.lit(r).alias("r"), (F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s)) if s else F.col("fp")).alias("rot")) for r, s in enumerate(top * k for k in range(budget + 1))]
    keyed = classes.select("node", "sketch", F.explode(F.array(*rots)).alias("x")).select("node", "sketch", "x.r", "x.rot").withColumn("head", F.shiftrightunsigned("rot", 64 - top))
    counts = keyed.groupBy("r", "head").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = keyed.join(merged(counts), ["r", "head"]).withColumn("k", F.ceil(F.col("n") / chunk_rows).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    pairs = F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.least(j, own) * F.col("k") + F.greatest(j, own)))
    dealt = keyed.select("node", "sketch", "rot", "r", "head", F.explode(pairs).alias("c")).withColumn("tree", F.xxhash64("r", "head", "c"))
    copies = int(counts.agg(F.sum(F.col("n") * F.ceil(F.col("n") / chunk_rows))).first()[0] or 0)  # a task holds its rows, copies for pairs of chunks too
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-copies // (PARTITION_ROWS if least is None else PARTITION_ROWS // 5)))
    wanted = ["node", "rot", "tree"] + (["sketch"] if least is not None else [])
    return map_arrow(dealt.select(*wanted).repartition(parts, "tree"), _links(budget, top, least), "u bigint, v bigint")


def signatures(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, same, n, sketch, keys): the fingerprint, a hash and the size of the set of shingles, its sketch and band keys; a blank text has no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = [np.array(_shingle_hashes(x, words), np.uint64) for x in bytes_of(batch, "text")]
            fps = np.array([_majority(h) if len(h) else 0 for h in all_], np.uint64).view(np.int64)
            sets = [np.unique(h) for h in all_]
            columns = [pa.array(fps), pa.array([_same(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()), pa.array([sketch(h) for h in sets], pa.binary())]
            keys = pa.array([band_keys(h) if len(h) else [] for h in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, keys], ["doc_id", "fp", "same", "n", "sketch", "keys"])

    return map_arrow(texts(docs, id_col, text_col), run, "doc_id bigint, fp bigint, same bigint, n bigint, sketch binary, keys array<bigint>")


def _same(distinct: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(distinct.tobytes()) - 2**63


def shingle_sets(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, same, sketch, shingles): the distinct XXH64 of each text's shingles, in order, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.array(_shingle_hashes(x, words), np.uint64)) for x in bytes_of(batch, "text")]
            columns = [pa.array([_same(h) for h in sets], pa.int64()), pa.array([sketch(h) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["node", "same", "sketch", "shingles"])

    return map_arrow(texts(docs, id_col, text_col), run, "node bigint, same bigint, sketch binary, shingles binary")


def similar_links(sets: list[np.ndarray], sketches: np.ndarray, least: float) -> np.ndarray:
    """For each set the smallest that it is linked to, directly or not, by an exact Jaccard similarity of ``least`` or more.

    A pair that isn't connected yet is compared unless its sizes rule it out or its sketches lie five standard deviations below."""
    root, sizes = np.arange(len(sets)), np.array([len(x) for x in sets])
    for i in range(len(sets) - 1):
        j = i + 1 + np.flatnonzero(root[i + 1 :] != root[i])
        j = j[np.minimum(sizes[j], sizes[i]) >= least * np.maximum(sizes[j], sizes[i])]
        if len(j):
            bins = ((sketches[j] > 0) | (sketches[i] > 0)).sum(1)
            j = j[similarity(sketches[i][None], sketches[j]) >= least - 5 * np.sqrt(least * (1 - least) / np.maximum(bins, 1))]
        for k in range(0, len(j), 1000):
            part = j[k : k + 1000]
            part = part[root[part] != root[i]]
            if not len(part) or not sizes[i]:
                continue
            flat = np.concatenate([sets[x] for x in part])
            equal = sets[i][np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)] == flat
            shared = np.add.reduceat(equal, np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
            near = part[shared >= least * (sizes[part] + sizes[i] - shared)]
            if len(near):
                joined = np.unique(np.r_[root[i], root[near]])
                root[np.isin(root, joined)] = joined[0]
    return root


def _exact(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, near, sets = [], [], []
        for x in batches:  # what is kept are copies: any part of a batch would keep all of it
            keys.append(np.stack([x.column(k).to_numpy() for k in ("node", "tree")]))
            near += x.column("sketch").to_pylist()
            sets += [np.frombuffer(y, np.uint64) for y in x.column("shingles").to_pylist()]
        if not sets:
            return
        node, tree = np.concatenate(keys, axis=1)
        sketches = np.frombuffer(b"".join(near), np.uint8).reshape(-1, SKETCH)
        order = np.lexsort((node, tree))
        for at in np.split(order, np.flatnonzero(np.diff(tree[order])) + 1):
            root = similar_links([sets[i] for i in at], sketches[at], least)
            linked = np.flatnonzero(root != np.arange(len(at)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(node[at[linked]]), pa.array(node[at[root[linked]]])], ["u", "v"])

    return run


#: Ids of candidates that are broadcast to read their texts; bytes of shingles that a task of the exact test holds.
BROADCAST_IDS, TASK_BYTES = 500_000, 32 << 20


def exact_links(docs: DataFrame, members: DataFrame, least: float, words: int, chunk_rows: int, id_col: str, text_col: str) -> DataFrame:
    """(u, v) links that connect the members (key, node, same, n) of each key whose sets of shingles are similar enough, by the sets themselves.

    A key of more than ``chunk_rows`` members is split into chunks by hash, with one task group for each pair of chunks."""
    members = cut(members)
    counts = members.groupBy("key").agg(F.count("*").alias("m"))
    keyed = members.join(counts, "key").withColumn("k", F.ceil(F.col("m") / chunk_rows).cast("int"))
    own = F.pmod(F.xxhash64("node", "same"), F.col("k")).cast("int")
    chunks = F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.least(j, own) * F.col("k") + F.greatest(j, own)))
    dealt = keyed.select("node", "same", "n", "key", F.explode(chunks).alias("c")).select("node", "same", "n", F.xxhash64("key", "c").alias("tree"))
    total = int(dealt.agg(F.sum(F.col("n") * 8 + 200)).first()[0] or 0)
    ids = cut(members.select(F.col("node").alias("_wanted_id")).distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    wanted = docs.join(ids, docs[id_col].cast("bigint") == ids["_wanted_id"], "left_semi")
    sets = cut(shingle_sets(wanted, words, id_col, text_col).join(members.select("node", "same").distinct(), ["node", "same"], "left_semi").dropDuplicates(["node", "same"]))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    return map_arrow(dealt.join(sets, ["node", "same"]).select("node", "tree", "sketch", "shingles").repartition(parts, "tree"), _exact(least), "u bigint, v bigint")


def similar_documents(docs: DataFrame, words: int, budget: int, least: float, id_col: str, text_col: str, chunk_rows: int) -> DataFrame:
    """(doc_id, fp, component_id) by links of an exact Jaccard similarity of ``least`` or more.

    Candidates of the trie join are tested first. Min-hash bands then give the pairs that a fingerprint can't: every set of shingles
    has its own keys, and a key whose members are one component already, or the same as another key's, is left out. Equal sets are one class.
    """
    found = cut(signatures(docs, words, id_col, text_col))
    classes = found.groupBy("fp", "same").agg(F.min(F.struct("doc_id", "sketch", "n", "keys")).alias("x"))
    classes = cut(classes.select("fp", "same", F.col("x.doc_id").alias("node"), "x.sketch", "x.n", "x.keys"))
    heads = cut(classes.groupBy("fp").agg(F.min(F.struct("node", "same", "sketch", "n")).alias("x")).select("fp", "x.node", "x.same", "x.sketch", "x.n"))
    links = trie_self_join(heads.select("node", "fp", "sketch"), budget, chunk_rows, least=least).distinct()
    pairs = links.select(F.xxhash64("u", "v").alias("key"), F.explode(F.array("u", "v")).alias("node")).join(heads.select("node", "same", "n"), "node")
    how = {"least": least, "words": words, "chunk_rows": chunk_rows, "id_col": id_col, "text_col": text_col}
    near = cut(exact_links(docs, pairs.select("key", "node", "same", "n"), **how))
    named = classes.join(components(near), "node", "left").withColumn("root", F.coalesce("root", "node"))
    keyed = named.select("node", "same", "n", "root", F.explode("keys").alias("key"))
    own = [F.xxhash64("node", "same"), F.xxhash64("same", "node")]
    open_ = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi"), *(F.bit_xor(x).alias(f"x{i}") for i, x in enumerate(own))).filter("lo < hi")
    open_ = open_.groupBy("m", "x0", "x1").agg(F.min("key").alias("key")).select("key")
    rest = exact_links(docs, keyed.join(open_, "key").select("key", "node", "same", "n"), **how)
    roots = components(near.unionByName(rest))
    named = classes.select("fp", "same", "node").join(roots, "node", "left").select("fp", "same", F.coalesce("root", "node").alias("component_id"))
    return found.select("doc_id", "fp", "same").join(named, ["fp", "same"]).select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text", chunk_rows: int = CHUNK_ROWS, least: float | None = None) -> DataFrame:
    """(doc_id, fp bigint, component_id): documents joined by chains of fingerprints that differ in at most ``budget`` bits.

    With ``least`` documents are joined by chains of texts whose sets of shingles have that Jaccard similarity or more, whether their
    fingerprints are near or not: see ``similar_documents``.

    component_id is the smallest doc_id of the component. Documents with equal fingerprints (with ``least``: equal sets of shingles)
    form one class, and only classes are linked, so thousands of copies cost one. Null or blank texts have fingerprint 0 and link like
    any other; repeated rows share their component; rows without an id are left out; an empty table gives no rows; further columns are ignored.
    """
    if least is not None:
        return similar_documents(docs, words, budget, least, id_col, text_col, chunk_rows)
    fps = cut(fingerprints(docs, words, id_col, text_col))
    classes = cut(fps.groupBy("fp").agg(F.min(F.struct("doc_id", "sketch")).alias("x")).select(F.col("x.doc_id").alias("node"), "x.sketch", "fp"))
    roots = components(trie_self_join(classes, budget, chunk_rows))
    named = classes.join(merged(roots), "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return fps.join(merged(named), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and those without an id. Only ids are joined to the texts."""
    found = near_duplicates(docs, id_col=id_col, **how)
    later = cut(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_later_id")).distinct())
    return docs.join(later, docs[id_col].cast("bigint") == later["_later_id"], "left_anti")

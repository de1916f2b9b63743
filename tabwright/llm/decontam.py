"""Benchmark decontamination by template windows: numbers, units and names become typed placeholders, and their values must map consistently."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut, map_arrow, worker_cache

# Number words, units and given names that are placeholders wherever they stand.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = "mm cm m km inch inches foot feet yard yards mile miles g kg gram grams pound pounds ounce ounces ton tons ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres kilogram kilograms".split()
NAMES = "alice anna anne ben bob carl carlos charles clara daniel david emily emma eva george hannah henry jack jacob james jane jim joe john josh julia kate laura leo lily linda lisa lucas lucy maria mark mary max maya mia michael mike natalia nick nora olivia oscar paul peter rachel robert ruth sam sara sarah sophia susan thomas tim tom weng william".split()
_FIXED = dict.fromkeys(NUMBERS, "<num>") | dict.fromkeys(UNITS, "<unit>") | dict.fromkeys(NAMES, "<name>")
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*%?")
_EDGES = ".,;:!?\"'()[]{}«»„“”…"
CAPITAL, END, SLOT = 1, 2, 4
#: Bits of a window's hash that the filter before the join looks at; benchmark windows that are broadcast at most.
FILTER_BITS, BROADCAST_WINDOWS = 22, 200_000
#: A benchmark item may lose or gain up to half as many words inside a document.
DRIFT = 8
#: Words of the shortest item that is looked for.
LEAST_WORDS = 3
_MOST_WORDS, _BASE = 150_000, np.uint64(0x9E3779B97F4A7C15)


def _hash(canonical: str) -> int:
    return xxhash.xxh64_intdigest(canonical.encode())


_NAME = _hash("<name>")


def core(word: str) -> str:
    return word.strip(_EDGES) or word


def canonical(word: str) -> tuple[int, int]:
    """(hash of the word or its placeholder, flags). A capitalised word is a name; where it begins a text or a sentence, it may be one."""
    bare = core(word)
    low = bare.lower()
    flags = END if word.rstrip("\"')]}»“”")[-1:] in (".", "!", "?") else 0
    if kind := "<num>" if _NUMBER.fullmatch(bare) else _FIXED.get(low):
        return _hash(kind), flags | SLOT
    if len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
        flags |= CAPITAL
    return _hash(low), flags


class _Words(dict):
    def __missing__(self, word: str) -> tuple[int, int]:
        self[word] = found = canonical(word)
        return found


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _runs(tokens: np.ndarray, size: int) -> np.ndarray:
    """A polynomial of each run of ``size`` tokens: linear, so that a token can be exchanged afterwards."""
    n = max(len(tokens) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + tokens[k : k + n]
    return out


class _Texts:
    """The words of a batch of texts in turn: hash of each word, or of its placeholder; whether it is one; whether it may be a name.

    The first word of a sentence is capitalised anyhow. It stands for itself and, in a second form of its windows, for a name."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        self.offsets = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        self.words, self.codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        cache = worker_cache("template words", _Words)
        if len(cache) > _MOST_WORDS:
            cache.clear()
        known = [cache[w] for w in self.words]
        self.own, flags = np.array([h for h, _ in known], np.uint64)[self.codes], np.array([f for _, f in known], np.uint8)[self.codes]
        starts = np.zeros(len(self.codes) + 1, bool)
        starts[self.offsets] = True
        starts[1:] |= (flags & END) > 0
        capital = (flags & CAPITAL) > 0
        self.maybe = capital & starts[:-1]
        named = capital & ~starts[:-1]
        self.own[named] = np.uint64(_NAME)
        self.slot = named | ((flags & SLOT) > 0)

    def inside(self, size: int) -> np.ndarray:
        """Whether the run of ``size`` words from each word on lies in one text."""
        n = max(len(self.codes) - size + 1, 0)
        out = np.ones(n, bool)
        for k in range(1, size):
            at = self.offsets - k
            out[at[(at >= 0) & (at < n)]] = False
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first token, hash, bits of the words taken for names in this form, of the plain forms) of all eligible windows.

        A window is eligible if over half of its words are no placeholders. It has a form for each choice of at most two of its words that
        may be names."""
        n = max(len(self.codes) - size + 1, 0)
        plain, slots = _runs(self.own, size), np.zeros(n, np.int8)
        for k in range(size):
            slots += self.slot[k : k + n]
        inside = self.inside(size)
        forms = [(np.flatnonzero(inside & (2 * slots < size)), 0)]
        single = {}
        for k in range(size):
            single[k] = inside & self.maybe[k : k + n] & (2 * (slots + 1) < size)
            forms.append((np.flatnonzero(single[k]), 1 << k))
        for k in range(size):
            for m in range(k + 1, size):
                forms.append((np.flatnonzero(single[k] & single[m] & (2 * (slots + 2) < size)), 1 << k | 1 << m))
        at, hashes = [], []
        for where, bits in forms:
            h = plain[where]
            for k in range(size):
                if bits >> k & 1:
                    h = h + (np.uint64(_NAME) - self.own[where + k]) * np.uint64(pow(int(_BASE), size - 1 - k, 1 << 64))
            at.append(where)
            hashes.append(_mix(h))
        return np.concatenate(at), np.concatenate(hashes), np.repeat([b for _, b in forms], [len(x) for x in at]), forms[0][0]

    def verbatim(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of all runs of ``size`` words as they stand."""
        low = np.array([_hash(core(w).lower()) for w in self.words], np.uint64)[self.codes]
        at = np.flatnonzero(self.inside(size))
        return at, _mix(_runs(low, size)[at] + np.uint64(size))


def windows(table: DataFrame, id_col: str, text_col: str = "text", size: int = 5, among: np.ndarray | None = None, runs: list[int] | None = None) -> DataFrame:
    """(id, text_key, pos, h, slots, n, run): the eligible windows of each text in all their forms, or those whose leading bits are ``among``.

    n counts all of a text's windows. Texts without any that have LEAST_WORDS words or more give themselves as one run, as they stand;
    with ``runs`` all runs of so many words come in their stead. ``run`` is a run's length, 0 for a window."""
    held = None if among is None else table.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("text")
            t = _Texts(texts)
            at, h, bits, plain = t.windows(size)
            counts = np.bincount(np.searchsorted(t.offsets, plain, side="right") - 1, minlength=batch.num_rows)
            length = np.zeros(len(at), np.int64)
            lengths = np.diff(t.offsets)
            sizes = runs if runs is not None else sorted({int(x) for x in lengths[(counts == 0) & (lengths >= LEAST_WORDS)]})
            for words in sizes:
                first, hashes = t.verbatim(words)
                if runs is None:
                    row = np.searchsorted(t.offsets, first, side="right") - 1
                    whole = (counts[row] == 0) & (lengths[row] == words)
                    first, hashes = first[whole], hashes[whole]
                at, h, bits, length = np.r_[at, first], np.r_[h, hashes], np.r_[bits, np.zeros(len(first), bits.dtype)], np.r_[length, np.full(len(first), words)]
            if held is not None:
                near = held.value[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                at, h, bits, length = at[near], h[near], bits[near], length[near]
            row = np.searchsorted(t.offsets, at, side="right") - 1
            keys = {i: xxhash.xxh3_64_intdigest((texts[i].as_py() or "").encode()) - 2**63 for i in np.unique(row).tolist()}
            slots = [[core(t.words[t.codes[a + k]]).lower() for k in range(size) if t.slot[a + k] or b >> k & 1] if not r else [] for a, b, r in zip(at.tolist(), bits.tolist(), length.tolist())]
            ids = batch.column("id").take(pa.array(row))
            columns = [ids, pa.array([keys[i] for i in row.tolist()], pa.int64()), pa.array(at - t.offsets[row]), pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.string())), pa.array(np.maximum(counts[row], 1)), pa.array(length.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "pos", "h", "slots", "n", "run"])

    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id IS NOT NULL")
    return map_arrow(rows, run, "id bigint, text_key bigint, pos bigint, h bigint, slots array<string>, n bigint, run int", keeps=True, piece=2 << 20)


def consistent(matches: list[tuple[int, int, list[str], list[str]]]) -> tuple[set[int], bool, int]:
    """Item windows whose slots agree with one mapping of the item's values to the document's, whether a value changed, and the first position.

    A value maps to what it most often stands for; two values may map to one: a question can be asked again with less variety.
    """
    pairs = Counter(p for _, _, a, b in matches for p in set(zip(a, b)))
    to: dict[str, str] = {}
    for (a, b), _ in sorted(pairs.items(), key=lambda x: (-x[1], x[0][0] != x[0][1], x[0])):
        to.setdefault(a, b)
    good = [(i, p) for i, p, a, b in matches if len(a) == len(b) and all(to.get(x) == y for x, y in zip(a, b))]
    return {i for i, _ in good}, any(a != b for a, b in to.items()), min((p for _, p in good), default=-1)


def filter_bits(hashes: DataFrame) -> np.ndarray:
    """Flags of the leading FILTER_BITS bits of the hashes ``h``: Spark sets the bits, the driver gets a bitmap of fixed size."""
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(1 << FILTER_BITS, bool)
    for r in parts:
        flags = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        first = (r["b"] - 1) * len(flags)
        out[first : first + len(flags)] = flags[: len(out) - first].astype(bool)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, share, position, changed): documents that hold at least ``share`` of an item's eligible windows of ``size`` words.

    Windows match by hash after numbers, units and names have become placeholders. The windows of one hit lie near one diagonal (document
    position less item position), and their slots must agree with one mapping of the item's values; ``changed`` says whether a value
    differs from the item's. An item of LEAST_WORDS words or more without an eligible window (short, or placeholders mostly) is found
    where it stands word for word. A fixed bitmap of the benchmark's hashes thins out the documents' windows before the join on the whole
    hash. Null, empty or shorter texts match nothing. Repeated rows are reported once; rows without an id are left out; empty tables give
    no rows; further columns are ignored; of equally frequent values of a slot the one that doesn't change, then the smallest, is taken.
    """
    known = cut(windows(benchmark, item_col, item_text_col, size).select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "h", F.col("slots").alias("item_slots"), "n", "run").distinct())
    among, runs = filter_bits(known), [r.run for r in known.filter("run > 0").select("run").distinct().orderBy("run").collect()]
    known = known.drop("run")
    hits = windows(docs, id_col, text_col, size, among, runs).select(F.col("id").alias("doc_id"), "text_key", "pos", "h", "slots")
    small = known.count() <= BROADCAST_WINDOWS
    found = hits.join(F.broadcast(known) if small else known, "h").withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    phases = F.array(F.floor(F.col("diagonal") / DRIFT) * 2, F.floor((F.col("diagonal") + DRIFT // 2) / DRIFT) * 2 + 1)
    found = found.withColumn("band", F.explode(phases))
    groups = found.groupBy("doc_id", "text_key", "item_id", "band", "n").agg(F.collect_set(F.struct("item_pos", "pos", "item_slots", "slots")).alias("m"))
    groups = groups.filter(F.size(F.array_distinct(F.transform("m", lambda x: x.item_pos))) >= share * F.col("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, item, n, m in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "n", "m"))):
                good, changed, at = consistent([(x["item_pos"], x["pos"], x["item_slots"], x["slots"]) for x in m])
                if len(good) >= share * n:
                    out.append((doc, item, len(good) / n, at, changed))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()))], ["doc_id", "item_id", "share", "position", "changed"])

    best = map_arrow(groups.select("doc_id", "item_id", "n", "m"), run, "doc_id bigint, item_id bigint, share double, position bigint, changed boolean")
    return best.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", -F.col("position"), ~F.col("changed"))).alias("x")).select("doc_id", "item_id", "x.share", (-F.col("x.col2")).alias("position"), (~F.col("x.col3")).alias("changed"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the contaminated ones; rows without an id stay."""
    bad = cut(contaminated(docs, benchmark, id_col=id_col, **how).select(F.col("doc_id").alias("_bad_id")).distinct())
    return docs.join(bad, docs[id_col].cast("bigint") == bad["_bad_id"], "left_anti")

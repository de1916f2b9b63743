"""Token ids in Simple-8b words: encode whole texts, write them as segments in document order, and read them back."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.llm.common import cut, gathered, map_arrow, own_dir, pieces, small_table, worker_cache

#: Selector 1 to 15: how many values of how many bits share the 60 bits below the selector. Selector 0 is the escape: one value of any
#: size, kept as a raw word.
SELECTORS = [(1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
#: Values of a block, and the values after which a segment of the file is closed.
BLOCK, SEGMENT_IDS = 128, 1 << 18
MAGIC = b"S8B1"
_COUNTS = np.array([c for c, _ in SELECTORS])
_WIDTH = BLOCK + int(_COUNTS.max())
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _bit_lengths(v: np.ndarray) -> np.ndarray:
    if v.size and int(v.max()) >> 53:
        return np.searchsorted(_POWERS, v.ravel(), side="right").astype(np.uint8).reshape(v.shape)
    return np.frexp(v.astype(np.float64))[1].astype(np.uint8)


def _best_selectors(wide: np.ndarray) -> np.ndarray:
    """For each place of each block the selector that packs most values from there; widest holds the widest of the next ``span``."""
    best, widest, span = np.zeros((len(wide), BLOCK), np.uint8), wide, 1
    for s in range(len(SELECTORS) - 1, 0, -1):
        count, bits = SELECTORS[s]
        while span < count:
            step = min(span, count - span)
            after = np.zeros_like(widest)
            after[:, :-step] = widest[:, step:]
            widest, span = np.maximum(widest, after), span + step
        best[widest[:, :BLOCK] <= bits] = s
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, raw words, first word of each block, first raw word of each block), the last two with an end; uint64 in.

    All blocks are packed side by side: each step takes, for every block that isn't done, the selector that packs most of the next
    values. The last word of a block may hold fewer values than its selector says.
    """
    n = len(values)
    blocks = -(-n // BLOCK)
    v = np.zeros((blocks, _WIDTH), np.uint64)  # zeros beyond a block: its last word may be filled up with them
    whole = n // BLOCK
    v[:whole, :BLOCK] = values[: whole * BLOCK].reshape(whole, BLOCK)
    v[whole:, : n % BLOCK] = values[whole * BLOCK :]
    sizes = np.full(blocks, BLOCK, np.int64)
    if n % BLOCK:
        sizes[-1] = n % BLOCK
    best = _best_selectors(_bit_lengths(v))
    pos, live, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):
        at = pos[live]
        chosen = best[live, at]
        steps.append((live, at, chosen))
        pos[live] = at + _COUNTS[chosen]
        live = live[pos[live] < sizes[live]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    block, at, chosen = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(block * BLOCK + at)
    block, at, chosen = block[order], at[order], chosen[order]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, place = v.ravel(), block * _WIDTH + at
    for s in range(2, len(SELECTORS)):
        mine = np.flatnonzero(chosen == s)
        count, bits = SELECTORS[s]
        if len(mine):
            first, packed = place[mine], words[mine]
            for k in range(count):
                packed |= flat[first + k] << np.uint64(k * bits)
            words[mine] = packed
    escaped = chosen == 0
    raw = flat[place[escaped]]
    word_at = np.searchsorted(block, np.arange(blocks + 1))
    raw_at = np.searchsorted(block[escaped], np.arange(blocks + 1))
    return words, raw, word_at, raw_at


def unpack(words: np.ndarray, raw: np.ndarray, word_at: np.ndarray, n: int) -> np.ndarray:
    """The n values; every word is decoded at once, by selector, to the place that the counts before it in its block give."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[sel]
    block = np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))
    before = np.cumsum(counts) - counts
    first = before[word_at[:-1]] if len(words) else before
    at = block * _WIDTH + before - first[block] if len(words) else before
    out = np.zeros(max(len(word_at) - 1, 0) * _WIDTH, np.uint64)  # with room for what a block's last word says beyond the block
    for s in range(2, len(SELECTORS)):
        mine = np.flatnonzero(sel == s)
        count, bits = SELECTORS[s]
        mask, place, own = np.uint64((1 << bits) - 1), at[mine], words[mine]
        for k in range(count if len(mine) else 0):
            out[place + k] = (own >> np.uint64(k * bits)) & mask
    out[at[sel == 0]] = raw
    return out.reshape(-1, _WIDTH)[:, :BLOCK].ravel()[:n]


def to_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment, little-endian: magic, counts (documents, ids, words, raw words, blocks), document ids, lengths, block offsets, words, raw words."""
    words, raw, word_at, raw_at = pack(ids.astype(np.uint64))
    head = np.array([len(doc_ids), len(ids), len(words), len(raw), len(word_at) - 1], "<u4")
    return b"".join([MAGIC, *(x.astype(t).tobytes() for x, t in ((head, "<u4"), (doc_ids, "<i8"), (lengths, "<u4"), (word_at, "<u4"), (raw_at, "<u4"), (words, "<u8"), (raw, "<u8")))])


def from_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    docs, n, n_words, n_raw, blocks = np.frombuffer(data, "<u4", 5, 4).tolist()
    at, parts = 24, []
    for count, kind in ((docs, "<i8"), (docs, "<u4"), (blocks + 1, "<u4"), (blocks + 1, "<u4"), (n_words, "<u8"), (n_raw, "<u8")):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    doc_ids, lengths, word_at, _, words, raw = parts
    return doc_ids, lengths.astype(np.int64), unpack(words, raw, word_at.astype(np.int64), n)


class _Pieces:
    """Distinct pieces of text in one Arrow array, and where each one's ids lie in the encoder's ``flat``.

    Pieces are looked up by encoding them as a dictionary behind those known: the known ones keep their numbers and unknown ones come next,
    so that only unknown pieces become Python strings."""

    def __init__(self):
        self.known = pa.array([], pa.string())
        self.start, self.size, self.uses, self.mixed = (np.zeros(0, t) for t in (np.int32, np.int32, np.int32, bool))

    def codes(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(numbers, the unknown pieces); the caller has to ``add`` the latter."""
        coded = pa.chunked_array([self.known, pieces]).dictionary_encode().chunks[-1]
        fresh, self.known = coded.dictionary.slice(len(self.known)), coded.dictionary
        codes = coded.indices.to_numpy()
        used = np.bincount(codes, minlength=len(self.known)).astype(np.int32)
        used[: len(self.uses)] += self.uses
        self.uses = used
        return codes, fresh

    def add(self, start: np.ndarray, size: np.ndarray, mixed: np.ndarray) -> None:
        self.start, self.size, self.mixed = (np.concatenate([x, y.astype(x.dtype)]) for x, y in ((self.start, start), (self.size, size), (self.mixed, mixed)))

    def keep(self, which: np.ndarray) -> None:
        self.known = self.known.take(pa.array(which))
        self.start, self.size, self.uses, self.mixed = self.start[which], self.size[which], self.uses[which] // 2, self.mixed[which]


class ChunkEncoder:
    """The tokenizers library over chunks of text, each distinct chunk once.

    A chunk is a run of white space with the run of other characters after it. Byte-level BPE pre-tokens never go on from other
    characters into white space, so the ids of a text are those of its chunks in turn. Most texts have only single spaces and line
    feeds as white space, and are cut up by Arrow's split; a text where white space meets white space goes by the pattern. A text that
    holds one of the tokenizer's added tokens, which may reach over chunks, goes to the library whole. The control
    characters \\x1c to \\x1f, which Python alone calls white space, count as other characters.
    """

    CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
    #: Distinct pieces, bytes of them and ids kept from batch to batch; pieces that go to the library, and that are put together, at once.
    MOST, MOST_BYTES, MOST_IDS, JOINED, TAKEN = 250_000, 16 << 20, 4_000_000, 20_000, 1 << 18
    #: Words of Latin or Cyrillic letters of old, and the marks that may follow.
    MARKS = ".,;:!?"
    WORD = r"^\n?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{410}-\x{44F}]+[.,;:!?]?\z"

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(json)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)
        #: Bytes as the byte-level alphabet writes them, as little-endian code points; line feeds stay, as they part words.
        shown = sorted([*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
        self.alphabet = np.zeros(256, "<u4")
        self.alphabet[shown] = shown
        self.alphabet[[b for b in range(256) if b not in set(shown)]] = np.arange(256, 256 + 256 - len(shown))
        self.line_id, marks = self.tokenizer.token_to_id(chr(self.alphabet[10])), {ord(m): self.tokenizer.token_to_id(m) for m in self.MARKS}
        self.alphabet[10] = 10
        self.mark_ids = np.full(256, -1)
        self.mark_ids[list(marks)] = [-1 if i is None else i for i in marks.values()]
        before = self.tokenizer.pre_tokenizer
        self.by_words = self.tokenizer.normalizer is None and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space and None not in (self.line_id, *marks.values())
        if self.by_words:
            self.model_only = Tokenizer(self.tokenizer.model)
            self.model_only.pre_tokenizer = CharDelimiterSplit("\n")
        self._clear()

    def _clear(self) -> None:
        """``pieces`` begin with a line feed and stand for themselves, or stand for a space and themselves; ``chunks`` all stand for themselves."""
        self.pieces, self.chunks, self.flat, self.n_flat = _Pieces(), _Pieces(), np.zeros(1 << 16, np.uint32), 0

    def _forget(self) -> None:
        """Keep what has come more than once, if that is less than half; counts of uses are halved, so that the rest goes in time."""
        n, size = len(self.pieces.known) + len(self.chunks.known), self.pieces.known.nbytes + self.chunks.known.nbytes
        if n <= self.MOST and size <= self.MOST_BYTES and self.n_flat <= self.MOST_IDS:
            return
        kept = [(x, np.flatnonzero(x.uses > 1)) for x in (self.pieces, self.chunks)]
        ids = sum(int(x.size[which].sum()) for x, which in kept)
        if 2 * sum(len(which) for _, which in kept) > self.MOST or 2 * ids > self.MOST_IDS:
            kept = [(x, np.flatnonzero(x.uses > 4)) for x, _ in kept]
            ids = sum(int(x.size[which].sum()) for x, which in kept)
        for x, which in kept:
            x.keep(which)
        if self.pieces.known.nbytes + self.chunks.known.nbytes > self.MOST_BYTES // 2 or 2 * len(self.pieces.known) + 2 * len(self.chunks.known) > self.MOST or 2 * ids > self.MOST_IDS:
            self._clear()
            return
        flat, self.n_flat = [], 0
        for x, _ in kept:
            flat.append(self._take(x.start, x.size))
            x.start = (self.n_flat + np.cumsum(x.size) - x.size).astype(np.int32)
            self.n_flat += len(flat[-1])
        self.flat = np.concatenate(flat)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks encoded as one text. A byte-level token is as long as its bytes, so the ends of the chunks are ends of tokens."""
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        ends, want = np.cumsum(self.token_bytes[ids]), np.cumsum(pc.binary_length(pa.array(texts)).to_numpy(), dtype=np.int64)
        at = np.searchsorted(ends, want)
        if at[-1] >= len(ends) or not np.array_equal(ends[at], want):
            return self._each(texts)
        return ids, np.diff(at + 1, prepend=0)

    def _append(self, ids: np.ndarray) -> int:
        at = self.n_flat
        if at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[:at], np.zeros(max(at // 2, len(ids)), np.uint32)])
        self.flat[at : at + len(ids)] = ids
        self.n_flat += len(ids)
        return at

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words of letters, each with at most one space before it: pre-tokens as they are, so that the library's model takes them without
        the search for pre-tokens. None if the ends of the words aren't ends of tokens."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(words), self.JOINED):
            some = words.slice(first, self.JOINED)
            text = self.alphabet[np.frombuffer("\n".join(some.to_pylist()).encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids.append(np.array(self.model_only.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32))
            ends, want = np.cumsum(self.token_bytes[ids[-1]]), np.cumsum(pc.binary_length(some).to_numpy(), dtype=np.int64)
            at = np.searchsorted(ends, want)
            if at[-1] >= len(ends) or not np.array_equal(ends[at], want):
                return None
            sizes.append(np.diff(at + 1, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn_words(self, fresh: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """(start, size) of pieces that are words, perhaps after a line feed and before one mark: these are pre-tokens of one byte and one token."""
        lines = pc.starts_with(fresh, "\n").to_numpy(zero_copy_only=False)
        bare = pc.ascii_trim(fresh, "\n" + self.MARKS)
        coded = pc.binary_join_element_wise(pa.array(np.where(lines, "", " "), pa.string()), bare, "").dictionary_encode()
        found = self._words(coded.dictionary)
        if found is None:
            return None
        at, (ids, sizes), word = self._append(found[0]), found, coded.indices.to_numpy()
        starts, n, own = at + np.cumsum(sizes) - sizes, sizes[word], np.flatnonzero(lines)
        last = np.frombuffer(fresh.buffers()[2], np.uint8)[np.frombuffer(fresh.buffers()[1], np.int32)[fresh.offset + 1 : fresh.offset + len(fresh) + 1] - 1]
        marks = self.mark_ids[last]
        start, size = starts[word], n + lines + (marks >= 0)
        more = np.flatnonzero(lines | (marks >= 0))  # the others are where their words are
        words, whole = self._take(start[more], n[more]), size[more]
        ends = np.cumsum(whole)
        out, mine = np.zeros(int(ends[-1]) if len(more) else 0, np.uint32), np.ones(int(ends[-1]) if len(more) else 0, bool)
        head, tail = (ends - whole)[lines[more]], ends[marks[more] >= 0] - 1
        mine[head], mine[tail] = False, False
        out[mine], out[head], out[tail] = words, self.line_id, marks[more][marks[more] >= 0]
        start[more] = self._append(out) + ends - whole
        return start, size

    def _learn(self, fresh: pa.Array, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, mixed) of pieces, or of chunks if ``single``."""
        start, size, mixed = np.zeros(len(fresh), np.int32), np.zeros(len(fresh), np.int32), np.zeros(len(fresh), bool)
        others = np.arange(len(fresh))
        if self.by_words and not single:
            word = pc.match_substring_regex(fresh, self.WORD)
            words, word = fresh.filter(word), word.to_numpy(zero_copy_only=False)
            if len(words) and (found := self._learn_words(words)):
                start[word], size[word] = found
                others = np.flatnonzero(~word)
        for first in range(0, len(others), self.JOINED):
            own = others[first : first + self.JOINED]
            some = fresh.take(pa.array(own)).to_pylist()
            bare = some if single else [p[1:] if p[:1] == "\n" else p for p in some]
            uneven = np.fromiter((not x or len(x.strip()) < len(x) for x in bare), bool, len(bare))  # white space may meet white space at an end
            texts = some if single else [p if p[:1] == "\n" else f" {p}" for p in some]
            mixed[own] = uneven
            for which, how in ((np.arange(len(some)) if single else np.flatnonzero(uneven), self._each), (np.arange(0) if single else np.flatnonzero(~uneven), self._joined)):
                if len(which):
                    ids, sizes = how([texts[i] for i in which.tolist()])
                    start[own[which]], size[own[which]] = self._append(ids) + np.cumsum(sizes) - sizes, sizes
        return start, size, mixed

    def _known(self, strings: pa.Array, single: bool) -> np.ndarray:
        table = self.chunks if single else self.pieces
        codes, fresh = table.codes(strings)
        if len(fresh):
            table.add(*self._learn(fresh, single))
        return codes

    def _take(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ids from each start on, so many pieces at a time that what is put together in between stays small."""
        out, at = np.empty(int(size.sum(dtype=np.int64)), np.uint32), 0
        for i in range(0, len(start), self.TAKEN):
            some = size[i : i + self.TAKEN]
            ends = np.cumsum(some)
            n = int(ends[-1])
            place = np.repeat(start[i : i + self.TAKEN] - (ends - some), some)
            place += np.arange(n)
            np.take(self.flat, place, out=out[at : at + n])
            at += n
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, as uint32, and how many each has; null is empty."""
        self._forget()
        texts = pc.fill_null(texts, "")
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if holds.any():
            whole = np.flatnonzero(holds)
            ids, sizes = self._each(texts.take(pa.array(whole)).to_pylist())
            other, counts = self.encode(texts.filter(pa.array(~holds)))
            every = np.zeros(len(texts), np.int64)
            every[whole], every[~holds] = sizes, counts
            own = np.repeat(holds, every)
            out = np.zeros(int(every.sum()), np.uint32)
            out[own], out[~own] = ids, other
            return out, every
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
        flat = split.flatten()
        first = offsets[:-1]
        begins = flat.take(pa.array(first))
        codes = self._known(flat, False)
        del split, flat
        start, size = self.pieces.start[codes], self.pieces.size[codes]
        mixed = np.flatnonzero(np.logical_or.reduceat(self.pieces.mixed[codes], first))
        found = [self.CHUNK.findall(x) for x in texts.take(pa.array(mixed)).to_pylist()]
        chunks = self._known(pa.concat_arrays([begins, pa.array([c for x in found for c in x], pa.string())]), True)
        start[first], size[first] = self.chunks.start[chunks[: len(first)]], self.chunks.size[chunks[: len(first)]]
        if len(mixed):
            own, counts = np.zeros(len(texts), bool), np.diff(offsets)
            own[mixed] = True
            other, chunks = ~np.repeat(own, counts), chunks[len(first) :]
            counts[mixed] = [len(x) for x in found]
            own = np.repeat(own, counts)
            start, size, some, sizes = np.empty(len(own), np.int32), np.empty(len(own), np.int32), start, size
            start[own], start[~own] = self.chunks.start[chunks], some[other]
            size[own], size[~own] = self.chunks.size[chunks], sizes[other]
            offsets = np.r_[0, np.cumsum(counts)]
        upto = np.r_[0, np.cumsum(size, dtype=np.int64)][offsets]
        return self._take(start, size), np.diff(upto)


#: Rows and bytes of text that are encoded together at most, if no single text has more: words that come again are looked up once.
_TOGETHER_ROWS, _TOGETHER_BYTES = 8_000, 3 << 20


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(doc_id, text) of some batches at a time."""
    for batch in gathered(pieces(batches, _TOGETHER_BYTES), _TOGETHER_BYTES, _TOGETHER_ROWS):
        yield batch.column("doc_id").to_numpy(), batch.column("text")


def _encode(json, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(("chunk encoder", json.value), lambda: ChunkEncoder(json.value))
        part, seq = TaskContext.get().partitionId(), 0
        docs, sizes, ids, n = [], [], [], 0

        def out() -> pa.RecordBatch:
            data = to_segment(np.concatenate(docs), np.concatenate(sizes), np.concatenate(ids))
            columns = [[part], [seq], [sum(map(len, docs))], [n], [data]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["part", "seq", "n_docs", "n_ids", "data"])

        for own, texts in _merged(batches):
            found, counts = encoder.encode(texts)
            ends = np.cumsum(counts)
            found, counts = np.insert(found, ends, np.uint32(end_id)), counts + 1
            ends = np.cumsum(counts)
            at = 0
            while at < len(own):  # a segment closes with the document that reaches its size
                before = int(ends[at - 1]) if at else 0
                stop = min(int(np.searchsorted(ends, before + segment_ids - n)) + 1, len(own))
                docs.append(own[at:stop])
                sizes.append(counts[at:stop])
                ids.append(found[before : int(ends[stop - 1])])
                n += len(ids[-1])
                at = stop
                if n >= segment_ids:
                    yield out()
                    docs, sizes, ids, n, seq = [], [], [], 0, seq + 1
        if docs:
            yield out()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text, append ``end_id``, and write Parquet rows (part, seq, n_docs, n_ids, data): data is a segment.

    Segments in the order of (part, seq) hold the documents in ascending doc_id; a segment closes with the document that reaches
    ``segment_ids`` ids. Null text is empty; rows with the same id follow each other in the order of their texts; rows without an id
    are left out; further columns are ignored. Texts are dealt out by ranges of doc_id, and tokenised where they arrive.
    ``tokenizer`` is a file on the driver; its few MB go to the tasks by broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        json = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id", "text")
    out = map_arrow(rows, _encode(json, end_id, segment_ids), "part int, seq int, n_docs bigint, n_ids bigint, data binary", trims=False, keeps=True)
    out.write.option("compression", "lz4_raw").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the ids of all segments before: part totals are added up on the driver, one number a part."""
    found = spark.read.schema("part int, seq int, n_docs bigint, n_ids bigint, data binary").parquet(path)
    totals = found.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base = np.cumsum([0, *(r.n for r in totals)])[:-1]
    bases = small_table(spark, {"part": pa.array([r.part for r in totals], pa.int32()), "base": pa.array(base, pa.int64())})
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("within")).join(bases, "part")
    # written first, so that its size is known: while it is small the segments stay where they are
    starts = cut(starts.select("part", "seq", (F.col("base") + F.col("within")).alias("start")))
    return found.join(starts, ["part", "seq"])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data in zip(batch.column("start").to_pylist(), batch.column("data").to_pylist()):
            docs, lengths, ids = from_segment(data)
            ends = np.cumsum(lengths)
            ids = ids.astype("<u4")
            crc = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """From the files, for each document: doc_id, start (ids of all documents before it), n_tokens with the end, ids_crc32."""
    return map_arrow(read_segments(spark, path).select("start", "data"), _summaries, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            docs, lengths, ids = from_segment(data)
            offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))], ["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids array<bigint>) from the files."""
    return map_arrow(spark.read.parquet(path).select("data"), _ids, "doc_id bigint, ids array<bigint>")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files into this application's folder, which goes when it ends, and return their summaries; ``write_ids`` writes lasting ones."""
    path = f"{own_dir(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, tokenizer, path, end_id, id_col, text_col)
    return summaries(docs.sparkSession, path)

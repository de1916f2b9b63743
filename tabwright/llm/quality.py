"""Quality classifier: expectation-maximisation weighs overlapping labellers, and their posterior labels train a hashed linear scorer."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import cut, map_arrow, small_table

CLASSES = ("good", "low", "toxic")
#: A labeller's vote: 0 abstains, else 1 + the class. Labellers of quality see no difference between good and toxic texts, those of insults none
#: between good and low ones; the last one is a scorer fitted on other documents' given labels.
FAULT_LABELLERS = ("symbols", "capitals", "exclamations", "cells", "word_length")
QUALITY_LABELLERS = (*FAULT_LABELLERS, "sentences", "common_words", "plain_words", "capital_letters", "dominant_word", "repetition", "longest_run")
TOXIC_LABELLERS = ("insults", "different_insults", "insult_density")
LABELLERS = (*QUALITY_LABELLERS, *TOXIC_LABELLERS, "told")
#: Kinds of documents that EM tells apart, with their classes: low ones that look broken and low ones that say the same over and over share few votes.
KINDS = ("good", "broken", "toxic", "monotonous")
CLASS_OF_KIND = np.array([0, 1, 2, 1])
_SEES = {"sentences": (1, 3), "common_words": (1, 3), "plain_words": (1,), "capital_letters": (1,), "dominant_word": (3,), "repetition": (3,), "longest_run": (3,)}
# Words that the insult labellers know.
INSULTS = "bastard clown disgusting dumb fool garbage idiot idiots imbecile jerk loser losers moron morons pathetic scum stupid trash ugly worthless".split()
# Very common words of English, French, German and Spanish, which running text is full of.
COMMON = (
    "a an and are as at be by for from have he in is it not of on or that the they this to was we were what when which with you "
    "au aux avec ce dans de des du elle en est et il la le les mais ne nous par pas plus pour que qui sa se son sur un une "
    "als am auch auf aus bei das dem den der die ein eine es für hat ich im ist mit nicht sich sie sind und von wie wird zu "
    "al como con del el era esta ha las lo los no o para pero por su sus una y"
).split()
#: Buckets of the scorer (hashed words, then the shape features), documents that a scorer is trained on at most (about), and passes.
BUCKETS, SAMPLE_DOCS, PASSES = 1 << 20, 8_000, 200
#: Letters of a word's beginning; buckets that get a weight, those of the largest information gain, and the share of the sample's documents
#: that each must occur in (3 at least): rarer ones only tell texts apart.
PREFIX, CHOSEN, LEAST_SHARE = 4, 256, 1 / 300
#: Probability from which the scorer of given labels votes.
CERTAIN = 0.6
#: Bytes of rows whose words are looked at together: it takes some thirty times as much memory.
_PIECE = 4 << 20
_SHAPES = 13
_EDGES = ".,;:!?\"'()[]{}*#%&$|"
_COMMON_FORMS = [x + end for x in dict.fromkeys([*COMMON, *(x.capitalize() for x in COMMON)]) for end in ("", *".,;:!?")]
_PLAIN = r"^[\"'(\[«„“¿¡]?[\pL\pN][\pL\pM\pN'’.,:/%@+_-]*[!?…;]?[\"')\]»“”]?[.,;:]?$"

#: CRC-32 of single bytes, and the bytes of a word that are taken beside those of other words: longer ones are few.
_CRC_OF_BYTE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC_OF_BYTE = np.where(_CRC_OF_BYTE & 1, (_CRC_OF_BYTE >> 1) ^ np.uint32(0xEDB88320), _CRC_OF_BYTE >> 1)
_BESIDE = 64


def _laid_out(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of words one behind the other."""
    words = words.cast(pa.binary())
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = words.buffers()
    at = np.frombuffer(at, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def crc32s(words: pa.Array, start: int = 0) -> np.ndarray:
    """``zlib.crc32`` of each word, from ``start``: the first bytes of all words at once, then the second ones of those that have one, and so on."""
    data, at = _laid_out(words)
    sizes = np.minimum(np.diff(at), _BESIDE + 1)
    order = np.argsort(-sizes.astype(np.int8), kind="stable")
    begin, more = at[:-1][order], len(words) - np.cumsum(np.bincount(sizes, minlength=_BESIDE + 2))
    crc = np.full(len(words), start ^ 0xFFFFFFFF, np.uint32)
    for i, n in enumerate(more[: more.argmin()]):
        crc[:n] = _CRC_OF_BYTE[(crc[:n] ^ data[begin[:n] + i]) & 255] ^ (crc[:n] >> 8)
    out = np.empty(len(words), np.int64)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in order[: more[_BESIDE]]:
        out[i] = zlib.crc32(data[at[i] : at[i + 1]], start)
    return out


def characters(words: pa.Array, *patterns: str) -> list[np.ndarray]:
    """How many characters of each word match each pattern of one character, which is tried once on each different character."""
    data, _ = _laid_out(words)
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    except UnicodeDecodeError:  # bytes that only Arrow takes for characters
        return [pc.count_substring_regex(words, x).to_numpy() for x in patterns]
    known = np.zeros(points.max(initial=0) + 1, bool)
    known[points] = True
    different = np.flatnonzero(known)
    texts = pa.array([chr(x).encode("utf-8", "surrogatepass") for x in different], pa.binary()).view(pa.string())
    at, counts = np.r_[0, np.cumsum(pc.utf8_length(words).to_numpy(), dtype=np.int64)], []
    for x in patterns:
        known[different] = pc.count_substring_regex(texts, x).to_numpy() > 0
        total = np.r_[0, np.cumsum(known[points], dtype=np.int32)]
        counts.append(total[at[1:]] - total[at[:-1]])
    return counts


class Words:
    """The white-space words of a batch of texts: coded, with their text, and sums over each text."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        offsets = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        self.words, self.codes, self.rows = coded.dictionary, coded.indices.to_numpy(), len(texts)
        self.of = np.repeat(np.arange(self.rows), np.diff(offsets))
        if (blank := pc.equal(self.words, "")).true_count:  # an empty text is split into one empty word
            keep = ~blank.to_numpy(zero_copy_only=False)[self.codes]
            self.codes, self.of = self.codes[keep], self.of[keep]
        self.n = np.bincount(self.of, minlength=self.rows)

    def share(self, of_word: np.ndarray) -> np.ndarray:
        """Mean over each text's words; 0 for none."""
        return np.bincount(self.of, of_word.astype(np.float64)[self.codes], self.rows) / np.maximum(self.n, 1)

    def shapes(self) -> np.ndarray:
        """(texts, 13): shares of symbol words, capitals, doubled exclamation marks, repeats and table cells; mean length; shares of sentence
        ends, insults, common words, words that aren't plain, capital letters among letters, and the commonest word; longest run of a word."""
        w = self.words
        flag = lambda x: pc.fill_null(x, False).to_numpy(zero_copy_only=False)
        lengths = pc.utf8_length(w).to_numpy()
        repeats = np.zeros(len(self.codes))
        if len(self.codes) > 1:
            repeats[1:] = (self.codes[1:] == self.codes[:-1]) & (self.of[1:] == self.of[:-1])
        letters, uppers = characters(w, r"\pL", r"\p{Lu}")
        pair, n = np.unique(self.of * np.int64(len(w) + 1) + self.codes, return_counts=True)
        first = np.searchsorted(pair, np.arange(self.rows) * np.int64(len(w) + 1))
        most = np.maximum.reduceat(np.r_[n, 0], first) * (self.n > 0) if self.rows else np.zeros(0)
        new = np.flatnonzero(repeats == 0)
        first = np.searchsorted(self.of[new], np.arange(self.rows))
        run = np.maximum.reduceat(np.r_[np.diff(np.r_[new, len(repeats)]), 0], first) * (self.n > 0) if self.rows else np.zeros(0)
        insult = flag(pc.is_in(self.bare, value_set=pa.array(INSULTS)))
        return np.column_stack([
            self.share(flag(pc.match_substring_regex(w, r"[%$#&*^~<>{}=\\]{2}"))),
            self.share(flag(pc.utf8_is_upper(w)) & (lengths > 1)),
            self.share(flag(pc.match_substring(w, "!!"))),
            np.bincount(self.of, repeats, self.rows) / np.maximum(self.n, 1),
            self.share(flag(pc.equal(w, "|"))),
            self.share(lengths),
            self.share(flag(pc.match_substring_regex(w, r"[.!?][\"')]?$"))),
            self.share(insult),
            self.share(flag(pc.is_in(w, value_set=pa.array(_COMMON_FORMS)))),
            self.share(~flag(pc.match_substring_regex(w, _PLAIN))),
            self.share(uppers) / np.maximum(self.share(letters), 1e-9),
            most / np.maximum(self.n, 1),
            run,
        ])

    def different(self, among: list[str]) -> np.ndarray:
        """How many different words of ``among`` each text has."""
        at = pc.fill_null(pc.index_in(self.bare, value_set=pa.array(among)), len(among)).to_numpy()[self.codes]
        pair = np.unique(self.of[at < len(among)] * np.int64(len(among)) + at[at < len(among)])
        return np.bincount(pair // len(among), minlength=self.rows)

    @cached_property
    def bare(self) -> pa.Array:
        """Lower-case words without punctuation around them."""
        return pc.utf8_trim(pc.utf8_lower(self.words), characters=_EDGES)

    @cached_property
    def hashes(self) -> list[np.ndarray]:
        """CRC-32 of each bare word, and of its first PREFIX letters, of which few are different: taken once for all scorers."""
        begin = pc.utf8_slice_codeunits(self.bare, 0, PREFIX).dictionary_encode()
        return [crc32s(self.bare), crc32s(begin.dictionary, 1)[begin.indices.to_numpy()]]

    def features(self, buckets: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, bucket, value) of the hashed words, without punctuation around them, and of their first PREFIX letters; n of a kind have
        1 - 2 ** -n, so that two or three say nearly as much as many, in a text of any length. ``among``: flags of the buckets to take."""
        pairs = []
        for hashed in self.hashes:
            bucket = hashed & (buckets - 1)
            at = slice(None) if among is None else np.flatnonzero(among[bucket][self.codes])
            pairs.append(self.of[at] * np.int64(buckets) + bucket[self.codes[at]])
        pair, n = np.unique(np.concatenate(pairs), return_counts=True)
        return pair // buckets, pair % buckets, 1 - 0.5 ** n


def heuristic_votes(shapes: np.ndarray, n: np.ndarray, insults: np.ndarray) -> np.ndarray:
    """(texts, 15) votes of the heuristics on texts of n words with so many different insults. Of the labellers of quality the first five know
    one fault each and abstain where it is missing; the next seven look at the whole of a text from 20 words on, whatever its fault, and
    speak for it, too. So every fault is seen by several of them."""
    symbols, capitals, bangs, repeats, cells, length, ends, density, common, odd, uppers, most, run = shapes.T
    good, low, toxic = 1, 2, 3
    both = lambda bad, fine: np.where(n < 20, 0, np.where(bad, low, np.where(fine, good, 0)))
    votes = np.column_stack([
        np.where(symbols >= 0.15, low, 0),
        np.where(capitals >= 0.3, low, 0),
        np.where(bangs >= 0.15, low, 0),
        np.where(cells >= 0.1, low, 0),
        np.where((length < 2) | (length > 15), low, 0),
        both((ends <= 0.01) | (ends >= 0.4), (ends > 0.02) & (ends < 0.35)),
        both(common < 0.05, common >= 0.1),
        both(odd >= 0.2, odd <= 0.05),
        both(uppers >= 0.3, uppers <= 0.15),
        both(most >= 0.2, most <= 0.12),
        both(repeats >= 0.1, repeats <= 0.03),
        both(run >= 6, run <= 3),
        np.where(density * n >= 2, toxic, 0),
        np.where(insults >= 2, toxic, 0),
        np.where(density >= 0.004, toxic, 0),
    ])
    return np.where(n[:, None] > 0, votes, 0)


#: How often a labeller is believed right at first on good texts and on the bad ones that it sees; how much of its class a labeller of one fault
#: is believed to speak on, and how often it is believed to see it in a text without; the weight of these beliefs against all documents' votes.
TRUST, SEES, COVERS, SLIP, BELIEF = 0.9, 0.6, 0.15, 0.002, 0.05


def first_beliefs(labellers: tuple[str, ...] = LABELLERS) -> np.ndarray:
    """(labellers, kinds, votes) probabilities before any document is seen: labellers of one fault hardly slip, the others are mostly right."""
    out = np.zeros((len(labellers), len(KINDS), len(CLASSES) + 1))
    for j, name in enumerate(labellers):
        if name in TOXIC_LABELLERS:
            out[j, :, 3] = SLIP, SLIP, COVERS, SLIP
        elif name in FAULT_LABELLERS:
            out[j, :, 2] = SLIP, COVERS, SLIP, SLIP
        elif name in QUALITY_LABELLERS:
            bad = np.isin(np.arange(len(KINDS)), _SEES[name])
            out[j, :, 1], out[j, :, 2] = np.where(bad, 1 - SEES, TRUST), np.where(bad, SEES, 1 - TRUST)
        else:
            out[j, :, 1:] = 0.01
            out[j, np.arange(len(KINDS)), 1 + CLASS_OF_KIND] = TRUST
    out += 1e-4
    out[:, :, 0] = np.maximum(1 - out[:, :, 1:].sum(2), 1e-4)
    return out / out.sum(2, keepdims=True)


def fit_labellers(votes: np.ndarray, counts: np.ndarray, rounds: int = 60, labellers: tuple[str, ...] = LABELLERS, belief: float = BELIEF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kinds' shares, (labellers, kinds, votes) probabilities, posterior class of each pattern) by expectation-maximisation over vote patterns.

    How often each vote is cast on a kind is learnt; what it means that a labeller of insults abstains stays as first believed, and any
    other labeller that abstains says nothing: else a fault that most labellers don't know would pass for its absence. Kinds that a
    labeller can't tell apart share one row. The first beliefs go on to count as ``belief`` times as many imagined documents as there are
    real ones: a maximum a posteriori estimate.
    """
    k, n_votes, first = len(KINDS), len(CLASSES) + 1, first_beliefs(labellers)
    alike = [[0, 1, 3] if x in TOXIC_LABELLERS else [0, 2] if x in QUALITY_LABELLERS else [] for x in labellers]
    silent = np.array([first[j, :, 0] if x in TOXIC_LABELLERS else np.ones(k) for j, x in enumerate(labellers)])
    share, p, posterior = np.array([0.8, 0.07, 0.08, 0.05]), first.copy(), np.zeros((len(votes), k))
    for _ in range(rounds):
        p[:, :, 0] = silent
        log = np.log(share) + sum(np.log(p[j][:, votes[:, j]]).T for j in range(len(labellers)))
        posterior = np.exp(log - log.max(1, keepdims=True, initial=-np.inf))
        posterior /= posterior.sum(1, keepdims=True)
        weight = posterior * counts[:, None]
        share = (weight.sum(0) + 1) / (weight.sum() + k)
        for j, same in enumerate(alike):
            seen = np.stack([np.bincount(votes[:, j], weight[:, c], n_votes) for c in range(k)]) + (belief * counts.sum() * share[:, None] + 1) * first[j]
            seen[same] = seen[same].sum(0)
            p[j] = seen / seen.sum(1, keepdims=True)
    return share, p, np.stack([posterior[:, CLASS_OF_KIND == c].sum(1) for c in range(len(CLASSES))], 1)


def choose(of: np.ndarray, bucket: np.ndarray, target: np.ndarray, buckets: int, chosen: int = CHOSEN, least_share: float = LEAST_SHARE) -> np.ndarray:
    """Flags of the ``chosen`` buckets whose texts' classes differ most from all texts' (information gain of a text that has it)."""
    docs = np.bincount(bucket, minlength=buckets)
    gain, share = np.zeros(buckets), (target.sum(0) + 1) / (len(target) + target.shape[1])
    for c in range(target.shape[1]):
        own = np.bincount(bucket, target[of, c], buckets)
        gain += own * np.log((own + share[c]) / ((docs + 1) * share[c]))
    gain[docs < max(3, least_share * len(target))] = 0
    out = np.zeros(buckets, bool)
    out[np.argsort(-gain, kind="stable")[:chosen]] = True
    return out & (gain > 0)


def fit_scorer(of: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, width: int, weight: np.ndarray | None = None, passes: int = PASSES, rate: float = 0.2, penalty: float = 3e-4) -> np.ndarray:
    """(classes, width + 1) softmax weights, the bias last: AdaGrad over all rows in each pass, towards posterior labels. ``weight``: of the rows."""
    rows, k = target.shape
    used, small = np.unique(bucket, return_inverse=True)
    w, seen = np.zeros((k, len(used) + 1)), np.full((k, len(used) + 1), 1e-8)
    weight = np.ones(rows) if weight is None else weight
    weight = (weight / max(weight.sum(), 1e-9))[:, None]
    for _ in range(passes):
        z = np.stack([np.bincount(of, w[c, small] * value, rows) + w[c, -1] for c in range(k)], 1)
        z = np.exp(z - z.max(1, keepdims=True))
        gap = (z / z.sum(1, keepdims=True) - target) * weight
        for c in range(k):
            g = np.append(np.bincount(small, gap[of, c] * value, len(used)) + penalty * w[c, :-1], gap[:, c].sum())
            seen[c] += g * g
            w[c] -= rate * g / np.sqrt(seen[c])
    out = np.zeros((k, width + 1))
    out[:, used], out[:, -1] = w[:, :-1], w[:, -1]
    return out


class Scorer:
    """Softmax weights over hashed words and shapes, of which only the buckets that have any are kept: a scorer goes to every Python worker."""

    def __init__(self, weights: np.ndarray, buckets: int):
        self.buckets, self.chosen = buckets, np.flatnonzero(weights[:, :buckets].any(0))
        self.hashed, self.shapes, self.bias = weights[:, self.chosen], weights[:, buckets : buckets + _SHAPES].copy(), weights[:, -1].copy()

    def __call__(self, words: Words, shapes: np.ndarray) -> np.ndarray:
        """(texts, classes) probabilities."""
        among = np.zeros(self.buckets, bool)
        among[self.chosen] = True
        of, bucket, value = words.features(self.buckets, among)
        at, shapes = np.searchsorted(self.chosen, bucket), _scaled(shapes)
        z = np.stack([np.bincount(of, w[at] * value, words.rows) + shapes @ s + b for w, s, b in zip(self.hashed, self.shapes, self.bias)], 1)
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _scaled(shapes: np.ndarray) -> np.ndarray:
    return np.column_stack([np.sqrt(shapes[:, :5]), np.minimum(shapes[:, 5], 30) / 30, np.sqrt(shapes[:, 6:12]), np.minimum(shapes[:, 12:], 10) / 10])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _fold(seed: int):
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2)).cast("int")


def _features(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words(batch.column("text"))
            of, bucket, value = words.features(buckets)
            shapes = _scaled(words.shapes())
            of, bucket = np.r_[of, np.repeat(np.arange(words.rows), _SHAPES)], np.r_[bucket, np.tile(buckets + np.arange(_SHAPES), words.rows)]
            value = np.r_[value, shapes.ravel()]
            order = np.argsort(of, kind="stable")
            at = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=words.rows))], pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x[order].astype(t))) for x, t in ((bucket, np.int32), (value, np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("code"), batch.column("fold"), *lists], ["code", "fold", "buckets", "vals"])

    return run


class Sample:
    """Hashed features of a bounded sample of documents (doc_id, code) on the driver; an id counts once, with its first text."""

    def __init__(self, rows: DataFrame, chosen: DataFrame, buckets: int, seed: int):
        texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("code").alias("code"))
        found = map_arrow(texts.withColumn("fold", _fold(seed)), _features(buckets), "code bigint, fold int, buckets array<int>, vals array<float>", piece=_PIECE).toArrow()
        self.buckets, self.code, self.fold = buckets, found.column("code").to_numpy(), found.column("fold").to_numpy()
        lists = [found.column(c).combine_chunks() for c in ("buckets", "vals")]
        self.size = pc.list_value_length(lists[0]).to_numpy() if len(found) else np.zeros(0, np.int64)
        self.bucket, self.value = (x.flatten().to_numpy() for x in lists)

    def scorer(self, rows: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None) -> Scorer:
        """Fitted on the sample's ``rows`` with the class probabilities ``target``; without any rows every text is good."""
        width = self.buckets + _SHAPES
        if not len(rows):
            return Scorer(np.zeros((len(CLASSES), width + 1)) + np.array([[1.0], [0.0], [0.0]]) * (np.arange(width + 1) == width), self.buckets)
        at = np.isin(np.repeat(np.arange(len(self.size)), self.size), rows)
        of, bucket, value = np.repeat(np.arange(len(rows), dtype=np.int32), self.size[rows]), self.bucket[at], self.value[at]
        hashed = bucket < self.buckets
        among = np.append(choose(of[hashed], bucket[hashed], target, self.buckets), np.ones(_SHAPES, bool))[bucket]
        return Scorer(fit_scorer(of[among], bucket[among].astype(np.int64), value[among].astype(np.float64), target, width, weight), self.buckets)


def given_votes(labels: DataFrame) -> DataFrame:
    """(doc_id, code): one vote a document from rows of (doc_id, quality, toxic): toxic if any row says so, else low if any does; ids without a label are left out."""
    told = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    vote = F.when(F.col("toxic") == 1, 3).when(F.col("quality") == 0, 2).when(F.col("quality") == 1, 1)
    return told.select("doc_id", vote.cast("bigint").alias("code")).filter("code IS NOT NULL")


def fit_told(rows: DataFrame, labels: DataFrame, buckets: int, sample_docs: int, seed: int) -> list[Scorer]:
    """Two scorers of given labels, each fitted on one half of about ``sample_docs`` labelled documents, to vote on the documents of the other half."""
    given = cut(given_votes(labels))
    chosen = given.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(max(given.count(), 1))) < sample_docs)
    sample = Sample(rows, chosen, buckets, seed + 1)
    return [sample.scorer(at := np.flatnonzero(sample.fold == f), np.eye(len(CLASSES))[sample.code[at] - 1]) for f in (0, 1)]


def votes(rows: DataFrame, told: list[Scorer] | None, seed: int) -> DataFrame:
    """(doc_id, code): each document's vote pattern in base 4. ``told`` votes on each half of the documents with the scorer of the other half."""
    held = rows.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = Words(batch.column("text"))
                shapes = words.shapes()
                cast = heuristic_votes(shapes, words.n, words.different(INSULTS))
                last = np.zeros(words.rows, np.int64)
                if held.value is not None:
                    fold = pc.fill_null(batch.column("fold"), 0).to_numpy()
                    p = np.where(fold[:, None] == 0, held.value[1](words, shapes), held.value[0](words, shapes))
                    last = np.where((p.max(1) >= CERTAIN) & (words.n > 0), p.argmax(1) + 1, 0)
                code = np.column_stack([cast, last]) @ (4 ** np.arange(len(LABELLERS)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(code.astype(np.int64))], ["doc_id", "code"])

    return map_arrow(rows.withColumn("fold", _fold(seed + 1)), run, "doc_id bigint, code bigint", piece=_PIECE)


def unpacked(codes: np.ndarray) -> np.ndarray:
    """(patterns, labellers) votes of base-4 codes."""
    return (codes[:, None] // 4 ** np.arange(len(LABELLERS)) % 4).reshape(-1, len(LABELLERS))


def label(docs: DataFrame, labels: DataFrame | None, buckets: int = BUCKETS, sample_docs: int = SAMPLE_DOCS, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(votes of all documents, codes of the patterns, how many documents have each, their posteriors, the labellers' probabilities).

    Only counts of vote patterns reach the driver, of 500,000 possible ones. No document's own given label has a vote: given labels only fit
    the scorers of ``fit_told``, which vote on documents that they weren't fitted on, and are weighed by EM like every other labeller.
    """
    rows = _rows(docs, id_col, text_col)
    every = cut(votes(rows, None if labels is None else fit_told(rows, labels, buckets, sample_docs, seed), seed))
    patterns = every.groupBy("code").count().orderBy("code").toArrow()
    codes, counts = patterns.column("code").to_numpy(), patterns.column("count").to_numpy().astype(np.float64)
    _, p, posterior = fit_labellers(unpacked(codes), counts)
    return every, codes, counts, posterior, p


def fit(docs: DataFrame, labels: DataFrame | None, buckets: int = BUCKETS, sample_docs: int = SAMPLE_DOCS, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> tuple[Scorer, np.ndarray]:
    """The scorer, and the labellers' estimated probabilities.

    The scorer is fitted on the posterior labels of a sample of all documents, about a third of ``sample_docs`` of each class where there
    are so many, weighed by how many documents each stands for: their hashed features fit the driver.
    """
    every, codes, counts, posterior, p = label(docs, labels, buckets, sample_docs, seed, id_col, text_col)
    of_class = np.bincount(posterior.argmax(1), counts, len(CLASSES)) if len(codes) else np.zeros(len(CLASSES))
    share = np.minimum(1, sample_docs / len(CLASSES) / np.maximum(of_class, 1))[posterior.argmax(1)] if len(codes) else np.zeros(0)
    shares = small_table(docs.sparkSession, {"code": pa.array(codes, pa.int64()), "share": pa.array(share, pa.float64())})
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed + 2)), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    chosen = every.filter("doc_id IS NOT NULL").join(F.broadcast(shares), "code").filter(drawn).groupBy("doc_id").agg(F.min("code").alias("code"))
    sample = Sample(_rows(docs, id_col, text_col), chosen, buckets, seed)
    at = np.searchsorted(codes, sample.code)
    return sample.scorer(np.arange(len(at)), posterior[at], 1 / share[at]), p


def classify(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(row, p_good, p_low, p_toxic, keep): each row of ``docs`` as a struct, the scorer's probabilities, and whether it stays.

    A document stays if p_good is at least one half. Null text is empty; a text without words has nothing to judge and stays; repeated rows
    are scored alike; rows without an id are scored and vote, but don't train; an empty table gives no rows; further columns, whatever
    their names, are in ``row``. ``labels`` (doc_id, quality, toxic) may be missing or empty: the heuristics then stand alone.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col, **how)[0])

    at = docs.columns.index(text_col) if dict(docs.dtypes).get(text_col) == "string" else None  # the text goes to the tasks once, in its row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = Words(batch.column("text") if at is None else batch.column("row").field(at))
                p = scorer.value(words, words.shapes())
                yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(p[:, i]) for i in range(3)), pa.array((p[:, 0] >= 0.5) | (words.n == 0))], ["row", "p_good", "p_low", "p_toxic", "keep"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *([F.col(text_col).cast("string").alias("text")] if at is None else []))
    schema = T.StructType([rows.schema["row"], *(T.StructField(c, T.DoubleType()) for c in ("p_good", "p_low", "p_toxic")), T.StructField("keep", T.BooleanType())])
    return map_arrow(rows, run, schema, piece=_PIECE)


def keep_good(docs: DataFrame, labels: DataFrame | None, **how) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return classify(docs, labels, **how).filter("keep").select("row.*")

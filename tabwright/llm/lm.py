"""Language-model scores: a byte-context trie by partial matching, counted over the corpus, and a word-unigram base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut, map_arrow

#: Longest context in bytes; longest contexts and words whose counts go to every task (those seen most): the others are joined.
ORDER, HOT_CONTEXTS, HOT_WORDS = 4, 32_768, 50_000
#: (context, symbol) counts of an order that are broadcast to the join of rare contexts; more of them are shuffled to it.
BROADCAST_COUNTS = 200_000
#: Symbols are the bytes and the end of a text.
END, SYMBOLS = 256, 257
_CHUNK, _FLUSH = 1 << 20, 1_500_000
DOCS, WORD, GRAM = 0, 1, 2


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Offsets of the texts' words, and the words, A-Z lower-cased; null is empty."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    offsets = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
    flat = split.flatten()
    if len(flat) and (blank := pc.equal(flat, "")).true_count:  # an empty text is split into one empty word
        keep = pc.invert(blank).to_numpy(zero_copy_only=False)
        offsets = np.r_[0, np.cumsum(keep)][offsets]
        flat = flat.filter(pa.array(keep))
    return offsets, flat.dictionary_encode()


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= _CHUNK:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _symbols(texts: list[bytes], order: int, table: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as symbols, each after ``order`` zero bytes and before its end; where texts' own symbols stand; and where each text begins among those."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.cumsum(sizes + order)
    out = table[np.frombuffer(b"".join([b"\0" * order + x + b"\0" for x in texts]), np.uint8)]
    out[ends - 1] = end
    own = np.ones(len(out), bool)
    for k in range(1, order + 1):
        own[ends - sizes - k] = False
    return out, np.flatnonzero(own), np.cumsum(sizes) - sizes


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts): each symbol below the ``order`` bytes before it, the nearest in the lowest bits."""
    s, at, _ = _symbols(texts, order, np.arange(256, dtype=np.int64), END)
    keys = _keys(s, at, order)
    return _summed(keys, np.ones(len(keys), np.int64))


def _keys(s: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    keys = s[at]
    for k in range(1, order + 1):
        keys |= s[at - k] << (9 + 8 * (k - 1))
    return keys


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if (n == 1).all():
        keys, counts = np.unique(keys, return_counts=True)
        return keys, counts.astype(np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first) if len(first) else n[:0]


def held_out(doc_id: Column, parts: int = 7, rest: int = 2) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == rest


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, words, byte_grams, n_words, n_grams = 0, [], [], 0, 0

        def rows(kind: int, keys: pa.Array, gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(n), 100_000):
                part = slice(i, i + 100_000)
                size = len(n[part])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), keys[part], pa.array(gram[part]), pa.array(n[part])], ["kind", "word", "gram", "n"])

        def of_words() -> pa.Table:
            return pa.concat_tables(words).group_by("w").aggregate([("n", "sum")]).rename_columns(["w", "n"])

        def of_grams() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate(x) for x in zip(*byte_grams)))

        def emit_words(t: pa.Table) -> Iterator[pa.RecordBatch]:
            w = t.column("w").combine_chunks()
            yield from rows(WORD, w.combine_chunks() if isinstance(w, pa.ChunkedArray) else w, np.zeros(len(t), np.int64), t.column("n").to_numpy())

        def emit_grams(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from rows(GRAM, pa.array([""] * len(keys), pa.string()), keys, n)

        for batch in batches:
            if not batch.num_rows:
                continue
            docs += batch.num_rows
            texts = batch.column("text")
            _, coded = _words(texts)
            words.append(pa.table({"w": coded.dictionary, "n": np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))}))
            n_words += len(coded.dictionary)
            if n_words > _FLUSH:
                words = [of_words()]
                if (n_words := len(words[0])) > _FLUSH // 2:
                    yield from emit_words(words.pop())
                    n_words = 0
            for _, part in _pieces([x or b"" for x in texts.cast(pa.binary()).to_pylist()]):
                byte_grams.append(grams(part, order))
                n_grams += len(byte_grams[-1][0])
                if n_grams > _FLUSH:
                    byte_grams = [of_grams()]
                    if (n_grams := len(byte_grams[0][0])) > _FLUSH // 2:
                        yield from emit_grams(*byte_grams.pop())
                        n_grams = 0
        if words:
            yield from emit_words(of_words())
        if byte_grams:
            yield from emit_grams(*of_grams())
        if docs:
            yield from rows(DOCS, pa.array([""], pa.string()), np.zeros(1, np.int64), np.array([docs], np.int64))

    return run


def corpus_counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, word, gram, n) over all texts: the documents, each word, and each symbol after its ``order`` bytes. Tasks count first, then one aggregation adds up."""
    return map_arrow(train.select("text"), _count(order), "kind int, word string, gram bigint, n bigint").groupBy("kind", "word", "gram").agg(F.sum("n").alias("n"))


def _level(c: np.ndarray, above: np.ndarray, above_after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of every symbol's probability after each context, and after an escape from it), by method C with exclusion.

    ``c`` are the counts of the symbols (columns) after each context (rows); ``above`` those after the context without its farthest byte,
    and ``above_after`` that one's second result. After a context seen n times with d different symbols, a seen symbol has c / (n + d) and
    an escape d / (n + d); an escape excludes the symbols that were already possible. A context never seen has what the one above has.
    """
    got = c > 0
    total, kinds = c.sum(1, dtype=np.float64), got.sum(1)
    left = above.sum(1, dtype=np.float64) - np.where(got, above, 0).sum(1, dtype=np.float64)
    fresh = (above > 0).sum(1) - kinds
    with np.errstate(divide="ignore", invalid="ignore"):
        escaped = above_after + np.where(fresh > 0, np.log10(fresh) - np.log10(left + fresh), 0)[:, None]
        after = np.where(above > 0, np.log10(above) - np.log10(left + fresh)[:, None], escaped)
        escape = np.where(kinds > 0, np.log10(kinds) - np.log10(total + kinds), 0)[:, None]
        return np.where(got, np.log10(c) - np.log10(total + kinds)[:, None], escape + after), after


def _lowest(c: np.ndarray, unseen: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for the empty context: below it, the ``unseen`` symbols not seen at all are equally likely."""
    after = np.full(c.shape, -np.log10(max(1, unseen)))
    return _level(c, np.zeros_like(c), after)[0], after


class Trie:
    """The commonest longest contexts with the log10 probability of every symbol after them, escapes and exclusions worked out beforehand.

    ``counts`` are (context, symbol, n) for each order from 0; a context whose shorter one is missing is left out. Bytes never seen share
    one class.
    """

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        seen = np.unique(counts[0][1])
        own = np.unique(np.r_[0, seen[seen < END]]).astype(np.int64)
        self.n_classes, self.end, other = len(own) + 2, len(own), len(own) + 1
        self.byte_class = np.full(256, other, np.int32)
        self.byte_class[own] = np.arange(len(own))
        symbol_class = np.r_[self.byte_class, self.end]
        self.down: list[np.ndarray] = []
        below, ctxs = None, np.zeros(1, np.int64)
        for k, (ctx, sym, n) in enumerate(counts):
            nodes = np.unique(ctx) if k else np.zeros(1, np.int64)
            if k:
                suffix = nodes & ((1 << 8 * (k - 1)) - 1)
                up = np.searchsorted(ctxs, suffix)
                has = (up < len(ctxs)) & (ctxs[np.minimum(up, len(ctxs) - 1)] == suffix)
                nodes, up = nodes[has], up[has]
                step = np.full((len(ctxs) + 1, self.n_classes), len(nodes), np.int32)  # the last row and the last value: no such context
                step[up, self.byte_class[nodes >> 8 * (k - 1)]] = np.arange(len(nodes))
                self.down.append(step.ravel())
                inside = np.isin(ctx, nodes)
                ctx, sym, n = ctx[inside], sym[inside], n[inside]
            c = np.zeros((len(nodes), self.n_classes))
            c[np.searchsorted(nodes, ctx), symbol_class[sym]] = n
            self.table, after = _level(c, below[0][up], below[1][up]) if k else _lowest(c, SYMBOLS - int((c > 0).sum()))
            below, ctxs = (c, after), nodes
        self.size, self.table = len(self.table), self.table.ravel()

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each text's log10 probability with its end, but for the symbols after other contexts: these as (text, gram, times)."""
        out, rest = np.zeros(len(texts)), []
        order = len(self.down)
        for first, part in _pieces(texts):
            s, at, begin = _symbols(part, order, self.byte_class, self.end)
            local = np.zeros(len(at), np.int32)
            for k, step in enumerate(self.down, 1):
                local *= self.n_classes
                local += s[at - k]
                local = step[local]
            known = local < self.size
            local[~known] = 0
            local *= self.n_classes
            local += s[at]
            values = np.where(known, self.table[local], 0) if self.size else np.zeros(len(at))
            out[first : first + len(part)] = np.add.reduceat(values, begin)
            if not known.all():
                rare = at[~known]
                raw, _, _ = _symbols(part, order, np.arange(256, dtype=np.int64), END)
                of = np.searchsorted(begin, np.flatnonzero(~known), side="right") - 1
                rest.append(_distinct(first + of, _keys(raw, rare, order)))
        return out, *(np.concatenate(x) if rest else np.zeros(0, np.int64) for x in (zip(*rest) if rest else ((), (), ())))


def _distinct(of: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of two integer arrays that aren't empty, and how often each occurs."""
    order = np.lexsort((key, of))
    of, key = of[order], key[order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (key[1:] != key[:-1])])
    return of[first], key[first], np.diff(np.r_[first, len(of)])


def _levels(counts: DataFrame, order: int) -> list[DataFrame]:
    """(ctx, sym, n) of each order from 0: shorter contexts add up the longer ones' counts."""
    symbols, out = counts.filter(F.col("kind") == GRAM).select("gram", "n"), []
    for k in range(order + 1):
        ctx = F.shiftright("gram", 9).bitwiseAND(F.lit((1 << 8 * k) - 1))
        out.append(cut(symbols.groupBy(ctx.alias("ctx"), F.col("gram").bitwiseAND(F.lit(511)).alias("sym")).agg(F.sum("n").alias("n"))))
    return out


def train_trie(levels: list[DataFrame], hot_contexts: int = HOT_CONTEXTS) -> Trie:
    """The trie of the ``hot_contexts`` longest contexts seen most, and of what is left of them without their farthest bytes."""
    order, found = len(levels) - 1, []
    top = levels[-1].groupBy("ctx").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "ctx").limit(hot_contexts).select("ctx").toArrow().column("ctx").to_numpy()
    spark = levels[0].sparkSession
    for k, level in enumerate(levels):
        own = np.unique(top & ((1 << 8 * k) - 1))
        if k > 1:
            level = level.join(F.broadcast(spark.createDataFrame(pa.table({"ctx": own}))), "ctx", "left_semi")
        t = level.select("ctx", "sym", "n").toArrow()
        found.append(tuple(t.column(c).to_numpy() for c in ("ctx", "sym", "n")))
    return Trie(found)


def rare_grams(grams_: DataFrame, levels: list[DataFrame], broadcast_counts: int = BROADCAST_COUNTS) -> DataFrame:
    """(gram, logp): log10 of the probability of each distinct gram's symbol after its context, from the counts of all contexts.

    Grams meet by longest context, at most one row of 257 symbols each; the counts after it and after its shorter ones are joined to it
    order by order. Orders of up to ``broadcast_counts`` counts are broadcast: few short contexts have many longer ones.
    """
    order = len(levels) - 1
    asked = grams_.select("gram").distinct().groupBy(F.shiftright("gram", 9).alias("ctx")).agg(F.collect_list(F.col("gram").bitwiseAND(F.lit(511)).cast("int")).alias("asked"))
    for k in range(order, 0, -1):
        nodes = levels[k].groupBy(F.col("ctx").alias(f"c{k}")).agg(F.collect_list("sym").alias(f"s{k}"), F.collect_list("n").alias(f"n{k}"))
        small = levels[k].count() <= broadcast_counts
        asked = asked.withColumn(f"c{k}", F.col("ctx").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(F.broadcast(nodes) if small else nodes, f"c{k}", "left").drop(f"c{k}")
    lowest = levels[0].select("sym", "n").toArrow()
    base = np.zeros(SYMBOLS)
    base[lowest.column("sym").to_numpy()] = lowest.column("n").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            above = np.tile(base, (n, 1))
            table, after = _lowest(above, SYMBOLS - int((base > 0).sum()))
            for k in range(1, order + 1):
                syms, counts_, c = batch.column(f"s{k}"), batch.column(f"n{k}"), np.zeros((n, SYMBOLS))
                c[np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(syms), 0).to_numpy()), syms.flatten().to_numpy()] = counts_.flatten().to_numpy()
                table, after = _level(c, above, after)
                above = c
            which = batch.column("asked")
            row, sym = np.repeat(np.arange(n), pc.list_value_length(which).to_numpy()), which.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("ctx").to_numpy()[row] << 9 | sym), pa.array(table[row, sym])], ["gram", "logp"])

    return map_arrow(asked.select("ctx", "asked", *[f"{c}{k}" for k in range(1, order + 1) for c in "sn"]), run, "gram bigint, logp double")


def scores(docs: DataFrame, order: int = ORDER, hot_contexts: int = HOT_CONTEXTS, hot_words: int = HOT_WORDS, broadcast_counts: int = BROADCAST_COUNTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    Documents whose crc32 of the id is 2 modulo 7 are held out; the others train both models, all of them. Tokens are the words, A-Z
    lower-cased, and one end. ``base_score`` adds log10((c + 1) / (N + V + 1)) over the tokens; ``score`` is the log10 probability of the
    whole text's bytes and its end under the trie of all training texts' contexts. Tables of the ``hot_words`` commonest words and the
    ``hot_contexts`` commonest contexts go to every task; other words and grams are written once, joined to their counts and to their
    contexts' counts, and summed for each row. Null text is empty; each row is scored on its own, repeated ids too; rows without an id are
    left out; with nothing to train on every symbol is equally likely; an empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    counts = cut(corpus_counts(rows.filter(~held_out(F.col("doc_id"))), order))
    words = counts.filter(F.col("kind") == WORD)
    train_docs = int(counts.filter(F.col("kind") == DOCS).agg(F.sum("n")).first()[0] or 0)
    in_words, kinds = words.agg(F.sum("n"), F.count("*")).first()
    total, kinds = int(in_words or 0) + train_docs, int(kinds) + (train_docs > 0)
    scale = float(np.log10(total + kinds + 1))
    hot = words.select("word", "n").orderBy(F.desc("n"), "word").limit(hot_words).toArrow()
    context, levels = docs.sparkSession.sparkContext, _levels(counts, order)
    held = context.broadcast((hot.column("word").to_pylist(), hot.column("n").to_numpy()))
    trie = context.broadcast(train_trie(levels, hot_contexts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_seen = pa.array(held.value[0], pa.string()), held.value[1]
        logs = np.r_[np.log10(n_seen + 1.0) - scale, 0.0]
        model, row, names = trie.value, TaskContext.get().partitionId() << 40, ["row", "word", "gram", "times", "doc_id", "n_tokens", "n_known", "base", "score"]
        kinds_ = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

        def out(n: int, **columns) -> Iterator[pa.RecordBatch]:
            for i in range(0, n, 200_000):
                size = min(n - i, 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(columns[c][i : i + size], t) if c in columns else pa.nulls(size, t) for c, t in zip(names, kinds_)], names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            offsets, coded = _words(batch.column("text"))
            codes, texts = coded.indices.to_numpy(), batch.column("text").cast(pa.binary()).to_pylist()
            place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), len(known)).to_numpy()
            of = np.repeat(np.arange(n), np.diff(offsets))
            at = place[codes]
            base = np.bincount(of, logs[at], n) + (np.log10(train_docs + 1.0) - scale)
            near = np.bincount(of[at < len(known)], minlength=n) + (train_docs > 0)
            rare = np.flatnonzero(at == len(known))
            pair, times = np.unique(of[rare] * np.int64(len(coded.dictionary) or 1) + codes[rare], return_counts=True)
            own, word = pair // (len(coded.dictionary) or 1), pair % (len(coded.dictionary) or 1)
            ids = row + np.arange(n, dtype=np.int64)
            row += n
            score, text, gram, often = model.score([x or b"" for x in texts])
            yield from out(n, row=ids, doc_id=batch.column("doc_id").to_numpy(), n_tokens=np.diff(offsets) + 1, n_known=near, base=base, score=score)
            for i in range(0, len(pair), 200_000):
                part = slice(i, i + 200_000)
                yield from out(len(pair[part]), row=ids[own[part]], word=coded.dictionary.take(pa.array(word[part])), times=times[part])
            yield from out(len(gram), row=ids[text], gram=gram, times=often)

    # written once: the row numbers hold for all that is joined to them
    scored = cut(map_arrow(rows, run, "row bigint, word string, gram bigint, times bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double"))
    whole = scored.filter("doc_id IS NOT NULL").select("row", "doc_id", "n_tokens", "n_known", "base", "score")
    none = [F.lit(None).cast("bigint").alias(c) for c in ("doc_id", "n_tokens")]
    c = F.coalesce(F.col("c"), F.lit(0))
    of_words = scored.filter("word IS NOT NULL").select("row", "word", "times").join(words.select("word", F.col("n").alias("c")), "word", "left")
    of_words = of_words.select("row", *none, F.when(c > 0, F.col("times")).otherwise(0).alias("n_known"), (F.col("times") * (F.log10(c + F.lit(1.0)) - F.lit(scale))).alias("base"), F.lit(0.0).alias("score"))
    of_grams = scored.filter("gram IS NOT NULL").select("row", "gram", "times")
    of_grams = of_grams.join(rare_grams(of_grams, levels, broadcast_counts), "gram").select("row", *none, F.lit(0).cast("bigint").alias("n_known"), F.lit(0.0).alias("base"), (F.col("times") * F.col("logp")).alias("score"))
    every = whole.unionByName(of_words).unionByName(of_grams).groupBy("row").agg(*[f(c).alias(c) for c, f in (("doc_id", F.max), ("n_tokens", F.max), ("n_known", F.sum), ("base", F.sum), ("score", F.sum))])
    return every.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")

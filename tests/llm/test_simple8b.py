import zlib

import numpy as np
import pytest

from tabwright.llm.simple8b import encode_documents, pack, read_ids, unpack, write_ids

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("kind", ["small", "zeros", "mixed", "huge", "empty"])
def test_pack_round_trip(kind):
    rng = np.random.default_rng(3)
    v = {
        "small": rng.integers(0, 50_000, 10_007),
        "zeros": np.zeros(1000),
        "mixed": rng.integers(0, 2 ** rng.integers(0, 60, 5000)),
        "huge": rng.integers(0, 2**64, 300, np.uint64),
        "empty": np.zeros(0),
    }[kind].astype(np.uint64)
    words, raw, word_at, raw_at = pack(v)
    assert np.array_equal(unpack(words, raw, word_at, len(v)), v)
    assert len(raw) == int((v >= 2**60).sum()) and raw_at[-1] == len(raw)


def plain(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


TEXTS = [(5, "Hello  world\n\nfoo\tbar "), (1, None), (2, ""), (3, " "), (9, "x" * 5000 + " y" * 5000), (4, "école\x1c a b  c\x85d"), (7, "<|endoftext|> it's 'll\r\n\r\n  z"), (8, "x <|endoftext|> y<|endoftext|>"), (6, "<|endoftext|>"), (10, "a <|endof text|> b"), (5, "again")]


def test_files_hold_the_ids_of_the_library(spark, tmp_path):
    df = spark.createDataFrame([(i, t, 0) for i, t in TEXTS] + [(None, "lost", 0)], "doc_id bigint, text string, start int")
    write_ids(df, PATH, str(tmp_path / "ids"), segment_ids=100)
    got = sorted((r.doc_id, tuple(r.ids)) for r in read_ids(spark, str(tmp_path / "ids")).collect())
    assert got == sorted((i, tuple(plain(t))) for i, t in TEXTS)


def test_summaries_against_brute_force(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    want, at = [], 0
    for i, t in sorted(TEXTS, key=lambda x: (x[0], x[1] or "")):
        ids = plain(t)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, encode_documents(df, PATH).collect())) == sorted(want)


def test_empty_table(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0


def encoder():
    from tabwright.llm.simple8b import ChunkEncoder

    with open(PATH, encoding="utf-8") as f:
        return ChunkEncoder(f.read())


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    return ["".join(x) for x in np.array(list("abdeiklnorstuz\u00e9\u00f1"))[rng.integers(0, 16, (n, 9))]]


def test_known_pieces_take_little_memory():
    import gc
    import tracemalloc

    import pyarrow as pa

    e, texts = encoder(), pa.array([" ".join(["a", *made_up(1000, seed)]) for seed in range(100)])
    gc.collect()
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    e.encode(texts)
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert kept < 90 * 100_000


def test_what_came_often_stays_when_the_table_is_full():
    import pyarrow as pa

    e, often = encoder(), made_up(300, 1)
    e.MOST = 1000
    learnt = []
    for seed in range(2, 12):
        text = " ".join([*often, *made_up(400, seed), *often])
        ids, sizes = e.encode(pa.array([text, None, "", " x  y"]))
        assert ids.tolist() == plain(text)[:-1] + plain(" x  y")[:-1] and sizes.tolist()[1:3] == [0, 0]
        learnt.append(set(e.pieces.known.to_pylist()))
    assert all(set(often[1:]) <= x for x in learnt) and max(map(len, learnt)) < 2000


WORDS = ["plain words. And, marks! here; there: so? end", "one\ntwo.\nthree, \u00e9cole ma\u00f1ana\nNI\u00d1O. \u043c\u0438\u0440", "a b. c!? d... it's x1 1x 'tis (so) \u4e2d\u6587. \u00d7\u00f7 \u00aa \u01c5.", "\nx.\n\ny. .\n.", "tab\there. line\r\nend.\x1c x.\x1f", "e\u0301t\u00e9. \u00ad\u00ada \u00ffy."]


def test_words_with_marks_are_encoded_as_by_the_library():
    import pyarrow as pa

    texts = [*WORDS, *(" ".join(w + m for w, m in zip(made_up(500, seed), [".", ",", "", "?!", "\n", "\nx", "", ";"] * 63)) for seed in range(4))]
    e = encoder()
    for _ in range(2):
        ids, sizes = e.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [plain(t)[:-1] for t in texts]


def test_words_go_to_the_model_without_the_search_for_pre_tokens():
    import pyarrow as pa

    class Spy:
        def __init__(self, inner):
            self.inner, self.asked = inner, []

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **options):
            self.asked += texts
            return self.inner.encode_batch_fast(texts, **options)

    e = encoder()
    e.tokenizer = Spy(e.tokenizer)
    ids, _ = e.encode(pa.array(["plain words. And, marks!\nthe \u00e9cole; x1 words"]))
    assert ids.tolist() == plain("plain words. And, marks!\nthe \u00e9cole; x1 words")[:-1]
    assert sorted(x.strip() for x in e.tokenizer.asked) == ["plain", "x1"]  # a text's first chunk, and what isn't a word of letters

"""Encoding and token files: exact round trips against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from plumbline.llm import bpe, tokenfile
from plumbline.llm.common import shared_path, tokenizer_file
from plumbline.llm.wordbpe import WordEncoder

WORD, BYTE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "a", "  two  spaces ", "tab\tand\r\nfeed\n\n\n x", "don't we'll I'M 'tis 's", "Hello <|endoftext|> x<|startoftext|>y", "日本語 mixed é ﬁ", "é combining ́ x",
    "İstanbul ẞ ŉ", "a b c d ef", "x²³ 12345 ½", "“quote” – dash… €5", "word" * 900, "🙂 emoji 👩‍👩‍👧", "\x02\x03 marks \x01", "a\n b \n c\n", "end space ", "!!!??? ###*** a!!!b",
]


def corpus(seed=3, n=40):
    rng = random.Random(seed)
    vocabulary = ["the", "And", "tionéx", "l'été", "don't", "x-y_z", "###", "12", "Straße", "日本", "word!!", "a.b,c"] + [f"syl{i}la" for i in range(200)]
    passage = " ".join(rng.choices(vocabulary, k=900))
    texts = list(ODD)
    for _ in range(n):
        own = " ".join(rng.choices(vocabulary, k=rng.choice([3, 60, 400])))
        texts.append(own if rng.random() < 0.4 else own + rng.choice([" ", "\n", ""]) + passage[rng.randrange(50) :] + rng.choice(["", "tail", " tail"]))
    return texts + texts[-5:] + [None, passage.replace(" ", ""), passage * 20]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_encoder_equals_the_library(path):
    encoder, library = WordEncoder(path), Tokenizer.from_file(path)
    texts = [t or "" for t in corpus()]
    for _ in range(2):
        for text, raw in zip(texts, encoder.encode(texts), strict=True):
            ids = library.encode(text, add_special_tokens=False).ids
            assert encoder.ids(raw).tolist() == ids, text[:80]
            assert encoder.decode(raw) == library.decode(ids, skip_special_tokens=False)


def test_chunks_are_the_text_and_move_with_it():
    for text in [t or "" for t in corpus()]:
        assert b"".join(c for _, c in bpe.chunks(text)).decode() == text
    text = " ".join(f"word{i * i % 977}" for i in range(3000))
    one, two = {h for h, _ in bpe.chunks(text)}, {h for h, _ in bpe.chunks("something before " + text)}
    assert len(one & two) > 0.7 * len(one)
    assert all(bpe.LEAST <= len(c) <= bpe.MOST for _, c in bpe.chunks(text)[:-1])


def test_encode_equals_the_library(spark):
    texts = corpus()
    library = Tokenizer.from_file(WORD)
    docs = spark.createDataFrame([(i, t, "clash", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, seq int").repartition(3)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, WORD, "digests").collect()}
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert got == {i: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()) for i, x in ids.items()}
    assert {r.doc_id: list(r.ids) for r in bpe.encode(docs, WORD).collect()} == ids


def test_encode_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, WORD).count() == 0
    rows = spark.createDataFrame([(1, "same text " * 200)] * 3 + [(None, "same text " * 200), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in bpe.encode(rows, WORD, "digests").collect()) == [(0, 400), (1, 400), (1, 400), (1, 400), (2, 0)]


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 20])
def test_packing_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001).astype("<u4")
    packed = tokenfile.pack(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    for a, b in [(0, 1001), (0, 0), (5, 6), (333, 801), (1000, 1001)]:
        assert tokenfile.unpack(packed, width, a, b).tolist() == ids[a:b].tolist()
    assert tokenfile.width_of(50257) == 16 and tokenfile.width_of(1) == 1 and tokenfile.width_of(65537) == 17


def test_token_file_equals_the_library(spark):
    texts = corpus()
    library = Tokenizer.from_file(BYTE)
    docs = spark.createDataFrame([(i * 7 - 50, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, start int").repartition(5)
    path = shared_path(spark, "tokens")
    tokenfile.write(docs, path, BYTE, 2, block_ids=500)
    start, expected = 0, {}
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        expected[i * 7 - 50] = (start, ids)
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.digests(spark, path).collect()}
    assert got == {d: (s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, (s, x) in expected.items()}
    assert {r.doc_id: (r.start, list(r.ids)) for r in tokenfile.read(spark, path, [-50, 20]).collect()} == {d: expected[d] for d in (-50, 20)}
    assert tokenfile.blocks(spark, path).count() > 5


def test_token_file_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfile.written_and_read(empty, BYTE, 2).count() == 0
    rows = spark.createDataFrame([(3, "b"), (3, "b"), (None, None)], "doc_id long, text string")
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in tokenfile.written_and_read(rows, BYTE, 2).collect())
    assert got == [(0, 1, None), (1, 2, 3), (3, 2, 3)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_encoder_equals_the_library_on_odd_spacing(name):
    import random

    from tokenizers import Tokenizer

    from plumbline.llm.wordbpe import WordEncoder

    rng = random.Random(7)
    parts = ["a", "B", "é", "ß", "don't", "it's", "'S", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", " \n", "\n ", "7", "42", "...", "word,", "«x»", "\x02", "\x03", "\x1c", "\x7f", "İ", "中", "\xa0", " ", "<|endoftext|>", "\v", "€5"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(6_000)]
    path = tokenizer_file(name)
    library, encoder = Tokenizer.from_file(path), WordEncoder(path)
    library.no_truncation()
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert encoder.ids(raw).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_blocks_start_where_the_blocks_before_end(spark):
    docs = spark.createDataFrame([(i, "one two three " * (i % 7)) for i in range(300)], "doc_id long, text string")
    path = shared_path(spark, "tokens")
    tokenfile.write(docs, path, tokenizer_file("byte_bpe_50k.json"), end_id=2, block_ids=50)
    rows = sorted((r.start, r.n_ids) for r in tokenfile.blocks(spark, path).select("start", "n_ids").collect())
    assert len(rows) > 10 and rows[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:], strict=False))

"""Byte-level BPE and token files against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from conftest_llm import ODD
from llm import bpe, token_files

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_encode_as_the_library(library):
    rng = random.Random(5)
    alphabet = "aAeb tT  \n\t\r\x1c\x85  　'sdmrel0129.,!?-é ñß́日本\U0001f600_%$#'"
    encoder, text_of = bpe.Encoder(RANKS, P.PATTERN), bpe.decoder(RANKS)
    for length in [1, 2, 3, 5, 8, 20, 60] * 150:
        text = "".join(rng.choice(alphabet) for _ in range(length))
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert text_of(packed) == text.encode()


def test_long_words_fold_as_short_ones():
    rng = random.Random(6)
    for length in [65, 70, 100, 400]:
        word = "".join(rng.choice("abcdeinorst") for _ in range(length)).encode()
        parts = bpe._fold_long(word, RANKS)
        assert b"".join({v: k for k, v in RANKS.items()}[i] for i in parts) == word
    for word in [b"understanding", b"abababababab", b"xxxxxxxxxxxxxxx", "straße".encode()] * 2:
        assert bpe._fold_long(word, RANKS) == bpe.fold_merges(word, RANKS)


def test_digests_equal_the_library_on_odd_texts(make_docs, library, rows):
    got = rows(bpe.digests(make_docs(ODD), RANKS, P.PATTERN))
    want = []
    for doc_id, text in ODD:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_encode_then_decode_keeps_other_columns(make_docs):
    docs = make_docs(ODD)
    back = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS)
    assert [c for c in back.columns if c not in ("ids", "decoded")] == [c for c in docs.columns if c != "ids"]
    for row in back.collect():
        assert bytes(row.decoded) == (row.text or "").encode()


def test_query_equals_the_library_on_a_table(spark, small, library):
    from llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, small).collect()}
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids = library.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_packed_values_round_trip():
    rng = np.random.default_rng(1)
    for bits in (1, 8, 9, 16, 24, 32):
        values = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
        control, data = token_files.pack(values)
        assert len(control) == 251
        assert (token_files.unpack(control, data, 1001) == values).all()
        assert (token_files.unpack_some(control, data, 1001, 64) == values).all()
        packed = token_files.Packed()
        packed.SOME = 100
        for start in range(0, 1001, 7):
            packed.add(values[start: start + 7])
        ids, counts, back = token_files.read_file(packed.file([None, 5], [1000, 1]))
        assert ids == [None, 5] and counts.tolist() == [1000, 1] and (back == values).all()
    assert len(token_files.unpack(b"", b"", 0)) == 0


def test_parts_encoded_together_are_as_apart():
    rng = random.Random(9)
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    tokenizer = Tokenizer.from_str(definition)
    alphabet = [*"aAeb tT  \n\t\x85\xa0'sdm019.,!?-é ñß́日本\U0001f600_%$#'\ue000\ue001ΣΑ\x1c\x7f", "<|endoftext|>", "<|startoftext|>", "'LL", "'re"]
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in [0, 1, 2, 5, 20, 90] * 80]
    words = token_files.Words(definition)
    words.TOGETHER = 50
    for text, packed in zip(texts, words.encode(texts, 1)):
        assert np.frombuffer(packed, words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], repr(text)


def _wanted(pairs):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc_id, text in pairs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return want


def test_token_files_equal_the_library(make_docs, spark):
    pairs = [pair for pair in ODD if pair[0] is not None and pair[0] != 5] + [(13, f"text {'of ' * 40}")]
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    got = token_files.digests(make_docs(pairs), definition).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == _wanted(pairs)


def test_token_files_with_null_and_repeated_ids(make_docs):
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    got = token_files.digests(make_docs(ODD), definition).orderBy("start").collect()
    assert len(got) == len(ODD)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert [r.doc_id for r in got[:2]] == [None, None]
    assert token_files.digests(make_docs([]), definition).collect() == []


def test_small_files_hold_the_same_ids(make_docs, spark, tmp_path):
    pairs = [(k, f"some words of text {k}") for k in range(50)]
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    manifest = token_files.write(make_docs(pairs), definition, 1, str(tmp_path / "out"), file_tokens=20)
    assert manifest.count() > 20
    # a file of a task that was given up is not read
    (tmp_path / "out/files/part-000000-000000-lost.ids").write_bytes(token_files.Packed().file([1], [0]))
    got = token_files.read(spark, str(tmp_path / "out"), manifest).orderBy("doc_id").collect()
    want = _wanted(pairs)
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got] == want


def test_token_query_on_a_table(spark, small):
    from llm.queries import QUERIES

    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op6_token_files"](spark, small).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == _wanted([tuple(r) for r in texts])


def test_higher_order_functions_fold_as_the_library(spark, library):
    """The fold as column expressions with a literal rank map gives the ids of the fast one."""
    from llm import bpe_columns

    rng = random.Random(12)
    words = [b"understanding", b"abababababab", b" the", b"xxxxxxxxx", "straße".encode(), "日本語".encode(), bytes([0, 255, 10]), b"a", b""]
    words += ["".join(rng.choice("abcdeinorst é") for _ in range(rng.randrange(1, 14))).encode() for _ in range(40)]
    frame = spark.createDataFrame([(w,) for w in dict.fromkeys(words)] + [(None,)], "word binary").coalesce(2)
    for row in bpe_columns.join_pieces(bpe_columns.fold_words(frame, RANKS), RANKS).collect():
        assert row.ids == (bpe.fold_merges(bytes(row.word), RANKS) if row.word else [])
        assert bytes(row.decoded) == bytes(row.word or b"")

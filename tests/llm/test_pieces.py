"""Piece encoding and decoding, against the library whose models it reads."""

from __future__ import annotations

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from starmart.llm import pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABETS = ["  ab", "ab \n", "aeioun th", " \u2581", "0123 .,'", "日本語テスト", "éüß—“”", "\x00\t\r\U0001f600\u0301",
             "the and of ing ", "<s></s><0x0A><unk>"]
SCHEMA = "doc_id bigint, text string, ids int, decoded string"


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return S.read_vocabulary(PATH)


def packed(model, text: str) -> bytes:
    return array("I", model.encode(text, add_bos=True, add_eos=True)).tobytes()


def texts(vocabulary, seed: int, n: int):
    draw = random.Random(seed)
    known = [t for t in vocabulary.texts if t]
    for _ in range(n):
        if draw.random() < 0.3:
            yield "".join(draw.choices(known, k=draw.randint(0, 8)))
        else:
            yield "".join(draw.choices(draw.choice(ALPHABETS) + draw.choice(ALPHABETS), k=draw.randint(0, 40)))


def test_equals_the_library_on_nasty_texts(model, vocabulary):
    encoder = S.Encoder(vocabulary)
    for text in texts(vocabulary, 1, 20_000):
        ids = encoder.encode(text)
        assert ids == packed(model, text), repr(text)
        assert encoder.decode(ids) == model.decode(list(memoryview(ids).cast("I"))), repr(text)


@pytest.mark.parametrize("cut", range(len(S.CUTS)))
def test_cuts_and_full_caches_change_nothing(model, vocabulary, cut, monkeypatch):
    monkeypatch.setattr(S, "KEPT_SEGMENTS", 5)
    monkeypatch.setattr(S, "KEPT_PAIRS", 5)
    monkeypatch.setattr(S, "WHOLE_TEXT", 10)
    monkeypatch.setattr(S, "DECODE_IDS", 3)
    encoder = S.Encoder(vocabulary._replace(cut=S.CUTS[cut]))
    for text in texts(vocabulary, 2, 1500):
        ids = encoder.encode(text)
        assert ids == packed(model, text), repr(text)
        assert encoder.decode(ids) == model.decode(list(memoryview(ids).cast("I")))


def test_backtracking_alone_and_merging_in_step(model, vocabulary, monkeypatch):
    """Without the fast path for longest tiles; every tested pair against merging both texts."""
    monkeypatch.setattr(S.Encoder, "_sound", lambda *_: False)
    encoder = S.Encoder(vocabulary)
    for text in texts(vocabulary, 3, 3000):
        assert encoder.encode(text) == packed(model, text), repr(text)
    width = len(encoder.sizes)
    assert len(encoder.pairs) > 1000 and {True, False} == set(encoder.pairs.values())
    for key, apart in list(encoder.pairs.items())[:20_000]:
        a, b = (vocabulary.texts[i] for i in divmod(key, width))
        assert (S.merged([*a, *b], encoder.ids, vocabulary.ranks) == [a, b]) == apart, (a, b)


def test_decoding_any_ids(model, vocabulary):
    encoder, draw = S.Encoder(vocabulary), random.Random(4)
    some = [0, 1, 2, 3, 13, 195, 169, 172, 200, 230, 259, 260, 300, 1000, 29871, 31999, 240, 159]
    for _ in range(20_000):
        ids = array("I", draw.choices(some, k=draw.randint(0, 12)))
        assert encoder.decode(ids.tobytes()) == model.decode(list(ids)), list(ids)


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 200_000, "\n" * 100_000, "日" * 100_000 + "é", "ab cd " * 200_000])
def test_long_texts(model, vocabulary, text):
    assert S.Encoder(vocabulary).encode(text) == packed(model, text)


def test_documents(spark, model):
    rows = [(1, "two  words\n", 7, "x"), (1, "two  words\n", 7, "x"), (1, "", None, None), (2, None, 0, "y"),
            (None, "é\x00\U0001f600", 0, "z"), (3, "w " * 50_000, 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, S.encoding_digests(docs, PATH).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        ids = packed(model, text or "")
        decoded = model.decode(list(memoryview(ids).cast("I")))
        want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert S.encode_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_whole_table(spark, model):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in documents.collect()]
    got = {(bytes(r.ids), r.decoded) for r in S.encode_documents(documents, PATH).collect()}
    assert got == {(packed(model, t or ""), t or "") for t in texts}

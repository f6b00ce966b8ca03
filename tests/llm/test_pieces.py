"""SentencePiece by merge rounds, against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.helpers import docs_frame
from tremor.llm.common import documents
from tremor.llm.pieces import PieceBpe, piece_coded
from tremor.llm.queries import op11_piece_round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", " a", "a\n b\t", "e\u0301 \u2581x \u2581", "\x00a", "\uff21\uff22 \ufb01", "a\r\nb", "\xa0x",
    "<s> </s> <0x0A> <unk>", "\U0001f600 \u200b", " " * 37, "a" * 50, "ab" * 40, " \n \n", "\u2581\u2581a",
    " " * 33 + "x" + " " * 18, "\n" * 100, "\U0010ffff\U00010000",
]
ALPHABETS = [
    "abcdefghijklmnopqrstuvwxyz ", "ab ", "a ", "  \n\tx", "0123456789abcdef", "\u0410\u0411\u0412\u0433\u0434\u0435 \u044f\u0451",
    "\u7684\u4e00\u662f\u4e0d\u4e86\u4eba ", "()[]{}<>=+-*/_ .,;:!?", "thequickbrownfox", "=-_*# ", "\u2581 a", "\xe9\xf1\xfc\xdf\u0301 ",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def bpe():
    return PieceBpe(PATH)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def same(bpe, library, texts):
    for text, ids in zip(texts, bpe.encode([t.encode() for t in texts]), strict=True):
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert numbers(ids) == expected, text
        assert bpe.decode(ids).decode() == library.decode(expected), text


def test_odd_texts(bpe, library):
    same(bpe, library, ODD)


def test_random_texts_of_many_alphabets(bpe, library):
    rng = random.Random(4)
    same(bpe, library, ["".join(rng.choices(a, k=rng.randint(0, 70))) for a in ALPHABETS for _ in range(300)])


def test_any_characters(bpe, library):
    rng = random.Random(5)
    spans = [(0, 127), (0, 0x2FFF), (0xE000, 0x10FFFF)]
    same(bpe, library, ["".join(chr(rng.randint(*rng.choice(spans))) for _ in range(40)) for _ in range(500)])


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", "thequickbrown", "a", " "])
def test_one_long_word(bpe, library, alphabet):
    rng = random.Random(6)
    same(bpe, library, ["".join(rng.choices(alphabet, k=60_000))])


def test_words_joined_one_pair_at_a_time_agree(bpe):
    rng = random.Random(7)
    for _ in range(200):
        word = "".join(rng.choices("theandingo", k=rng.randint(1, 40)))
        symbols = bpe._symbol_of[[ord(c) for c in word]]
        together = bpe._joined(symbols, np.array([len(word)]))
        assert bpe._one_by_one(symbols.tolist()) == together.tolist()


def test_decoding_of_any_ids(bpe, library):
    rng = random.Random(8)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randint(0, 300), rng.randint(0, 31_999)]) for _ in range(rng.randint(0, 9))]
        assert bpe.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids), ids


def test_memo_is_bounded_and_changes_nothing(library):
    small = PieceBpe(PATH, memo_bytes=2000)
    texts = [f"word{k} of many, {k * k} more" for k in range(300)]
    for k in range(0, 300, 10):
        same(small, library, texts[k : k + 10])
    assert small._held < 20_000


def expected_row(library, doc_id, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    raw = np.array(ids, "<u4").tobytes()
    decoded = library.decode(ids).encode()
    return doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()


def test_whole_table(spark, library):
    found = sorted(map(tuple, op11_piece_round_trip(spark, "/root/testdata/sf0.001").collect()))
    rows = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()
    assert found == sorted(expected_row(library, *row) for row in rows)


def test_odd_rows_and_empty_table(spark, library):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "word " * 300_000), (4, "k" * 300_000)]
    docs = docs_frame(spark, rows)
    found = sorted(map(tuple, piece_coded(docs, PATH).collect()), key=str)
    assert found == sorted((expected_row(library, *row) for row in rows), key=str)
    assert piece_coded(docs.limit(0), PATH).count() == 0
    kept = piece_coded(docs, PATH, with_ids=True).where("doc_id = 3").first()
    assert kept.decoded == rows[4][1] and len(kept.ids) == 4 * kept.n_tokens

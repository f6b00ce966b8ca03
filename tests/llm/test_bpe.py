"""The trie encoder against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import docs_frame
from tremor.llm import bpe
from tremor.llm.queries import op2_bpe_round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " \t\n\x0b\x0c\r",
    "<|endoftext|>",
    "a<|endoftext|>b <|startoftext|>c<|end",
    "<|ENDOFTEXT|> <|",
    "I'll don't x1y22 €5 日本語  x\xa0y \x1c\x1d z\x85q can't'Ve'S",
    "é É ́x ﬁ İI ſ Σς ²½ª",
    "👩‍👩‍👧 \x00 �",
    "a" * 5000,
    "ab" * 2500 + "'s",
]


def noise():
    rng = random.Random(2)
    for _ in range(400):
        yield "".join(rng.choice("abcdeinrst'0 é\n.,!İ") for _ in range(rng.randint(0, 200)))
        yield "".join(
            chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0x36F), rng.randint(0x370, 0xD7FF), rng.randint(0x10000, 0x10FFFF)]))
            for _ in range(rng.randint(0, 60))
        )


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("memo_bytes", [64 << 20, 1000])
def test_same_ids_and_text_as_the_library(library, memo_bytes):
    mine = bpe.WordBpe(PATH, memo_bytes)
    texts = ODD + list(noise())
    for some in (texts, texts[:40], texts):
        ids = mine.encode([t.encode() for t in some])
        for text, own in zip(some, ids, strict=True):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own, "<u4").tolist() == expected, text
            assert mine.decode(own).decode() == library.decode(expected, skip_special_tokens=False)


def test_whole_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op2_bpe_round_trip(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text, add_special_tokens=False).ids
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark, library):
    docs = docs_frame(spark, [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), *enumerate(ODD, 10)])
    rows = bpe.coded(docs, PATH, with_ids=True, with_decoded=True).collect()
    assert len(rows) == 5 + len(ODD)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (1, 2)} == {(0, empty, empty)}
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert row.n_tokens == len(ids) and row.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.coded(docs_frame(spark, []), PATH).collect() == []

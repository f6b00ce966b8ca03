"""Token files: round trips, checksums, and the library's ids."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import docs_frame
from tremor.llm import rans, token_files
from tremor.llm.common import documents
from tremor.llm.queries import op5_token_files
from tremor.workspace import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def table_and_blocks(seed, sizes, kinds=500):
    rng = np.random.default_rng(seed)
    blocks = [np.minimum(rng.zipf(1.3, n), kinds - 1).astype(np.uint32) for n in sizes]
    counts = np.bincount(np.concatenate(blocks), minlength=kinds)
    return rans.Table.of(rans.scaled(counts)), blocks


@pytest.mark.parametrize("sizes", [[1], [64], [65, 1, 20_000], [70_000, 70_001, 3], [30_000] * 70])
def test_round_trip(sizes):
    table, blocks = table_and_blocks(1, sizes)
    coded = rans.encode(blocks, table)
    for block, back in zip(blocks, rans.decode(coded, table), strict=True):
        assert (block == back).all()
    for block, one in zip(blocks[:3], coded[:3], strict=True):
        assert (rans.decode_from_checkpoints(one, table) == block).all()
        assert rans.encode([block], table) == [one]


def test_size_is_near_the_entropy():
    table, blocks = table_and_blocks(2, [200_000])
    share = np.bincount(blocks[0]) / len(blocks[0])
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(blocks[0]) / 8
    assert len(rans.encode(blocks, table)[0]) < 1.05 * entropy + 8 * rans.LANES


def test_damage_is_found():
    table, blocks = table_and_blocks(3, [5000])
    coded = bytearray(rans.encode(blocks, table)[0])
    coded[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode([bytes(coded)], table)
    other = rans.Table.of(np.roll(table.frequency.astype(np.int64), 1))
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(rans.encode(blocks, table), other)


@pytest.mark.parametrize("counts", [[5], [0, 1, 0, 10**12], [1] * 49_408, [10**15, 0, 3]])
def test_scaled_frequencies(counts):
    frequency = rans.scaled(np.array(counts))
    assert frequency.sum() == 1 << rans.SCALE
    assert all((f > 0) == (c > 0) for f, c in zip(frequency, counts, strict=True))
    table = rans.Table.of(frequency)
    block = np.flatnonzero(frequency).astype(np.uint32)[:3000]
    assert (rans.decode(rans.encode([block], table), table)[0] == block).all()


def expected(texts):
    """Rows for ``(doc_id, text)`` in file order."""
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for number, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((number, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.01"
    rows = op5_token_files(spark, sf).collect()
    texts = sorted((r.doc_id, r.text) for r in documents(spark, sf).collect())
    assert sorted(tuple(r) for r in rows) == expected(texts)


def test_odd_rows_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 8)
    rows = [(7, "a b c " * 9), (7, "a b c"), (None, "z"), (None, None), (3, ""), (5, None), (-2, "<|endoftext|> \x1c é")]
    docs = docs_frame(spark, rows)
    folder = new_folder(spark, "token-files")
    token_files.write_token_files(docs, folder, PATH, 2)
    got = token_files.read_token_files(spark, folder, with_ids=True).collect()
    order = [(None, ""), (None, "z"), (-2, rows[6][1]), (3, ""), (5, ""), (7, "a b c"), (7, "a b c " * 9)]
    assert sorted(tuple(r)[1:4] for r in got) == sorted(r[1:] for r in expected(order))
    by_start = {r.start: r.doc_id for r in got}
    assert {s: n for n, s, _, _ in expected(order)} == by_start
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 2 for r in got)


def test_empty_table(spark):
    folder = new_folder(spark, "token-files")
    token_files.write_token_files(docs_frame(spark, []), folder, PATH, 2)
    assert token_files.read_token_files(spark, folder).collect() == []


def test_encoder_equals_the_library_on_noise():
    from tests.llm.test_bpe import ODD, noise

    library, mine = Tokenizer.from_file(PATH), token_files.LibraryEncoder(PATH)
    texts = ODD + list(noise())
    for text, own in zip(texts, mine.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", [
    "abc' sdtrevml", "\u0130\u0131\u017f\u01c5\u023a\u023e\u2126\xe9 \xb2\xb3\xbc\xaa\xba'", "a1 !<|endoftext|> <", "\x1c\x85\xa0 \u0301ab", "'s't're've'm'll'dX ",
    "".join(map(chr, [*range(9, 14), *range(32, 127), *range(0xA1, 0x250)])),
])
def test_encoder_equals_the_library_on_plain_and_other_texts(alphabet):
    rng = random.Random(9)
    library, mine = Tokenizer.from_file(PATH), token_files.LibraryEncoder(PATH, memo_bytes=20_000)
    for _ in range(20):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(50)]
        for text, own in zip(texts, mine.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert mine._held < 40_000


def test_library_is_asked_for_many_words_at_a_time():
    mine = token_files.LibraryEncoder(PATH)
    asked, ask = [], mine._model.encode_batch_fast

    class Model:
        def encode_batch_fast(self, lines, **settings):
            asked.extend(line.count("\n") + 1 for line in lines)
            return ask(lines, **settings)

    mine._model = Model()
    texts = [" ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}, it's" for k in range(j, 600)) for j in (0, 300, 0)]
    library = Tokenizer.from_file(PATH)
    for text, own in zip(texts, mine.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(asked) == 603 and len(asked) == 2  # 600 words, a comma and the two of "it's"


def test_edges_of_runs_and_words():
    """Empty texts, blanks at edges, runs of several words, runs that are not plain, and words that look like ends."""
    texts = ["", " ", "\t a\n", "a", "don't'll x'y 'tis </w> w> <", "İstanbul İ ÀÉ! 1½2", "á e\x1cf\x85g\xa0h", "x" * 3000, "\x0ba\x0c "]
    library, mine = Tokenizer.from_file(PATH), token_files.LibraryEncoder(PATH)
    for some in (texts, texts[::-1], *([t] for t in texts), []):
        for text, own in zip(some, mine.encode([t.encode() for t in some]), strict=True):
            assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

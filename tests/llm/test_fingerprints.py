"""Document fingerprints against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import docs_frame
from tremor.llm import fingerprints
from tremor.llm.common import documents
from tremor.llm.queries import op10_fingerprints

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    words = text.encode().lower().split()
    pairs = Counter(b" ".join(p) for p in zip(words, words[1:])) or Counter(words)
    votes = [0] * 128
    for term, n in pairs.items():
        h = xxhash.xxh3_128_intdigest(term)
        for b in range(128):
            votes[b] += n if h >> b & 1 else -n
    return sum(1 << b for b in range(128) if votes[b] > 0)


def expected_rows(texts):
    """``texts``: (id, text) in the order of the documents."""
    out = []
    for k, (number, text) in enumerate(texts):
        other = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + other[:cut]
        out.append((number, len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, other))
    return out


def test_query_equals_plain_python(spark):
    rows = {r.doc_id: r for r in op10_fingerprints(spark, SF).collect()}
    texts = sorted(((r.doc_id, r.text) for r in documents(spark, SF).collect()), reverse=True)
    assert len(rows) == len(texts)
    fps = {t: slow_fingerprint(t) for _, t in texts[::5]}
    for number, chars, sha, text, changed, other in expected_rows(texts):
        row = rows[number]
        assert (row.n_chars, row.edited_sha256) == (chars, sha)
        if text in fps:
            mine, edit = fps[text], slow_fingerprint(changed)
            assert row.fingerprint == f"{mine:032x}" and row.edited_fingerprint == f"{edit:032x}"
            assert row.near_edited == 1 - (mine ^ edit).bit_count() / 128
    by_id = [rows[n] for n, _ in texts]
    for row, after in zip(by_id, by_id[1:] + by_id[:1], strict=True):
        assert row.near_next == 1 - (int(row.fingerprint, 16) ^ int(after.fingerprint, 16)).bit_count() / 128
    all_fps = np.array([int(r.fingerprint, 16) for r in by_id], object)
    for row in by_id:
        near = sum((int(row.fingerprint, 16) ^ f).bit_count() <= 4 for f in all_fps) - 1
        assert row.n_near == near
    ahead = np.mean([r.near_edited > r.near_next for r in by_id])
    assert ahead > 0.97


def test_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c"), (5, "a b c"), (None, "zz zz zz"), (9, None), (7, "é😀é"), (None, None)]
    docs = docs_frame(spark, rows)
    got = fingerprints.fingerprinted(docs).collect()
    order = [(9, ""), (7, "é😀é"), (5, "a b c"), (5, "a b c"), (5, "a b c d e f"), (None, ""), (None, "zz zz zz")]
    expected = Counter((n, c, s) for n, c, s, *_ in expected_rows(order))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    assert {bytes(r.fp) for r in got if r.n_chars == 0} == {bytes(16)}
    near = fingerprints.with_near_counts(fingerprints.fingerprinted(docs), 4).collect()
    assert Counter((r.doc_id, r.n_near) for r in near)[5, 1] >= 2 and len(near) == 7
    single = fingerprints.fingerprinted(docs_frame(spark, [(3, "abcdef")])).first()
    assert (single.near_next, single.edited_sha256) == (1.0, hashlib.sha256(b"abcdab").hexdigest())
    only_null = fingerprints.fingerprinted(docs_frame(spark, [(None, "x"), (None, "y")])).collect()
    assert len(only_null) == 2
    empty = fingerprints.fingerprinted(docs_frame(spark, []))
    assert empty.collect() == [] and fingerprints.with_near_counts(empty, 4).collect() == []


@pytest.mark.parametrize("block", [512, 5])
def test_near_counts_of_a_dense_cloud(spark, block, monkeypatch):
    monkeypatch.setattr(fingerprints, "ENTRY_BLOCK", block)
    rng = np.random.default_rng(4)
    fps = []
    for k in range(150):
        bits = np.zeros(128, np.uint8)
        bits[: 3 * (k % 2)] = 1
        bits[rng.choice(128, rng.integers(0, 4), replace=False)] ^= 1
        fps.append(np.packbits(bits).tobytes())
    rows = spark.createDataFrame([(k, bytearray(f)) for k, f in enumerate(fps)], "doc_id bigint, fp binary")
    got = {r.doc_id: r.n_near for r in fingerprints.with_near_counts(rows, 4).collect()}
    numbers = [int.from_bytes(f, "big") for f in fps]
    assert got == {k: sum((a ^ b).bit_count() <= 4 for b in numbers) - 1 for k, a in enumerate(numbers)}

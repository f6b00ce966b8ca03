"""LM scoring: base scores by brute force, and the mixer against a plain decision-by-decision version."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tremor.llm import context_mixing as cm
from tremor.llm import lm_scoring
from tremor.llm.common import documents
from tremor.llm.lm_scoring import Scoring
from tremor.llm.queries import op7_lm_scoring

SF = "/root/testdata/sf0.01"
TEXTS = ["The cat sat on the mat. " * 20, "the hat", "", "Où est le chat?  là\tbas " * 9, "a", "ä ö ü \x01 \x0e " * 50, "zq" * 70]
LONG = "sixteen-and-more-bytes-alike"


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def words_of(text):
    return [*text.encode().lower().split(), cm.END]


def closed(word):
    return word if word == cm.END else word + b" "


class Slow:
    """The model by plain counting, and the bits of a text one decision after another."""

    def __init__(self, training, weights=None):
        counts = Counter(w for t in training for w in words_of(t))
        letters, self.after, self.pair = Counter(), defaultdict(Counter), defaultdict(Counter)
        for word, n in counts.items():
            line = closed(word)
            for k, byte in enumerate(line):
                letters[byte] += n
                self.after[line[:k]][byte] += n
                self.pair[(b"  " + line)[k : k + 2]][byte] += n
        self.alphabet = cm.Alphabet.of(np.array([letters[b] for b in range(256)]))
        self.weights = weights

    def split(self, counter, node, less=None):
        first, middle, end = self.alphabet.spans[node]
        zeros = ones = 0
        for byte, n in counter.items():
            place = self.alphabet.place_of[byte]
            n -= byte == less
            zeros += n * (first <= place < middle)
            ones += n * (middle <= place < end)
        return zeros, ones

    def decisions(self, word, less=False):
        """Levels, class, and whether it is a byte's first, of each decision, as (word, pair, class, first, (node, sign))."""
        a, line = self.alphabet, closed(word)
        for k, byte in enumerate(line):
            for j in range(a.starts[byte], a.starts[byte + 1]):
                level = kind = 0
                if k < cm.DEPTH:
                    zeros, ones = self.split(self.after[line[:k]], a.nodes[j], byte if less else None)
                    right, wrong = (ones, zeros) if a.signs[j] > 0 else (zeros, ones)
                    level = max(-31, min(31, np.rint(math.log((right + cm.SMOOTHING) / (wrong + cm.SMOOTHING)) / 0.25)))
                    kind = sum(right + wrong > n for n in cm.SURE)
                zeros, ones = self.split(self.pair[(b"  " + line)[k : k + 2]], a.nodes[j])
                pair = max(-15, min(15, np.rint(math.log((ones + cm.SMOOTHING) / (zeros + cm.SMOOTHING)) / 0.5))) * a.signs[j]
                yield level * 0.25, pair * 0.5, kind, j == a.starts[byte], (a.nodes[j], a.signs[j])

    def bits(self, text):
        words, total = words_of(text), 0.0
        last_of, weights, block = {}, self.weights.astype(float).copy(), []
        before, last = None, None
        for word in words:
            guess, kind = None, 0
            for n, context in ((1, (last,)), (2, (before, last))):
                if last is not None and context in last_of:
                    guess, kind = last_of[context], n
            path = [d[4] for d in self.decisions(guess)] if guess else []
            agrees = bool(guess)
            for k, (w, p, sure, first, step) in enumerate(self.decisions(word)):
                m = 0
                if agrees:
                    agrees = k < len(path) and path[k] == step
                    m = cm.MATCHES[kind] * (1 if agrees else -1)
                gate = (kind if m else 0) * 8 + sure * 2 + first
                block.append((gate, np.array([w, p, m], float)))
                if len(block) == cm.BLOCK:
                    total += self.close(block, weights)
            if last is not None:
                last_of[(last,)] = word
                last_of[(before, last)] = word
            before, last = last, word
        return (total + self.close(block, weights)) / math.log(2)

    def close(self, block, weights):
        cost, pull = 0.0, np.zeros_like(weights)
        for gate, x in block:
            miss = 1 / (1 + math.exp(max(-20, min(20, x @ weights[gate]))))
            cost -= math.log1p(-miss)
            pull[gate] += miss * x
        weights += np.clip(cm.RATE * pull, -cm.MOST_STEP, cm.MOST_STEP)
        np.clip(weights, -cm.MOST_WEIGHT, cm.MOST_WEIGHT, out=weights)
        block.clear()
        return cost


def vocabulary(spark, training, others, range_words):
    counts = Counter(w for t in training for w in words_of(t))
    rows = [(0, w.decode(), counts[w]) for w in {w for t in [*training, *others] for w in words_of(t)}]
    return lm_scoring._ranges(spark.createDataFrame(rows, "chunk int, word string, n bigint"), Scoring(range_words=range_words))


def quick_bits(model, known, texts):
    words, _, levels = lm_scoring._known([bytes(r.known) for r in known.collect()])
    scorer = cm.Scorer(words, levels, model)
    number = {w: k for k, w in enumerate(words)}
    return scorer.bits([np.array([number[w] for w in words_of(t)]) for t in texts])


def test_levels_equal_plain_counts_however_the_vocabulary_is_cut(spark):
    training, others = TEXTS[:4] + [f"{LONG * 3} {LONG * 3}x ab\x01c ab abc"], [*TEXTS, "unheard of cats", LONG * 3 + "y"]
    slow = Slow(training)
    for range_words in (1000, 7, 2):
        model, known = lm_scoring.learned(vocabulary(spark, training, others, range_words))
        words, _, levels = lm_scoring._known([bytes(r.known) for r in known.collect()])
        at = 0
        for word in words:
            expected = [(w, k) for w, _, k, _, _ in slow.decisions(word)]
            assert [((b & 63) * 0.25 - 7.75, b >> 6) for b in levels[at : at + len(expected)].tolist()] == expected, word
            at += len(expected)
        assert at == len(levels)
        assert (model.alphabet.starts == slow.alphabet.starts).all()


def crowded(spark, range_words, chunks=10):
    """A vocabulary in ranges, whose words are in every chunk."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(1500)})
    rows = [(chunk, w, rng.randint(0, 3)) for w in [*words, cm.END.decode()] for chunk in range(chunks)]
    frame = spark.createDataFrame(rows, "chunk int, word string, n bigint")
    return lm_scoring._ranges(frame, Scoring(range_words=range_words))


def known_of(known):
    """The words of each chunk with their counts and levels."""
    packed, found = defaultdict(list), {}
    for row in known.collect():
        packed[row.chunk].append(bytes(row.known))
    for chunk, own in packed.items():
        words, counts, levels = lm_scoring._known(own)
        assert len(set(words)) == len(words)
        found[chunk] = dict(zip(words, counts.tolist(), strict=True)), Counter(levels.tolist())
    return found


def test_ranges_make_no_rows_of_their_own(spark, monkeypatch):
    """A task adds up the decisions of all its ranges, and packs what it knows of them for a chunk together."""
    made, plain = {}, lm_scoring.stored

    def noted(df, label, *rest):
        made[label] = plain(df, label, *rest)
        return made[label]

    monkeypatch.setattr(lm_scoring, "stored", noted)
    seen = []
    for range_words in (5000, 6):
        vocabulary = crowded(spark, range_words)
        model, known = lm_scoring.learned(vocabulary)
        tally, rows = Counter(), 0
        for row in made["lm-known"].where("code IS NOT NULL").collect():
            tally[row.code] += row.n
            rows += 1
        tasks = vocabulary.rdd.getNumPartitions()
        assert rows <= tasks * len(tally) and known.count() <= tasks * 10
        seen.append((vocabulary.count(), tally, known_of(known), model.weights.tolist()))
    assert seen[0][0] == 4 and seen[1][0] > 200
    assert seen[0][1:] == seen[1][1:]


def test_what_is_known_does_not_depend_on_the_lots(spark):
    vocabulary = crowded(spark, 100)
    _, whole = lm_scoring.learned(vocabulary)
    _, cut = lm_scoring.learned(vocabulary, Scoring(known_bytes=5000))
    assert cut.count() > 2 * whole.count()
    assert known_of(cut) == known_of(whole)


def test_one_occurrence_is_left_out_of_the_fit():
    training = TEXTS[:4]
    slow = Slow(training)
    counts = Counter(w for t in training for w in words_of(t))
    words = sorted(counts, key=closed)
    _, without = cm.word_bytes(words, np.array([counts[w] for w in words]), slow.alphabet, {})
    expected = [(w, k) for word in words for w, _, k, _, _ in slow.decisions(word, less=True)]
    assert [((b & 63) * 0.25 - 7.75, b >> 6) for b in without.tolist()] == expected


def test_mixer_equals_a_plain_version(spark, monkeypatch):
    training = [*TEXTS[:5], "on the mat sat the cat and the cat sat on the mat, on the hat"]
    rng = random.Random(3)
    texts = [*TEXTS, " ".join(rng.choices(["the", "cat", "sat", LONG + "a", LONG + "b", "où", "ÿþ"], k=300)), "the cat " * 200]
    model, known = lm_scoring.learned(vocabulary(spark, training, texts, 5))
    slow = Slow(training, model.weights)
    assert quick_bits(model, known, texts) == pytest.approx([slow.bits(t) for t in texts], rel=1e-3)
    alone = quick_bits(model, known, texts)
    monkeypatch.setattr(cm, "BATCH", 50)
    assert quick_bits(model, known, texts) == pytest.approx(alone, rel=1e-5)


def test_repeating_texts_get_cheap(spark):
    """A phrase of unheard words, repeated for 45 KB, costs ever less."""
    phrase = "wyrd qux zonk blim frod "
    texts = [phrase * 20, phrase * 1900]
    model, known = lm_scoring.learned(vocabulary(spark, ["The cat sat on the mat. " * 20], texts, 100))
    short, long = quick_bits(model, known, texts)
    assert long / len(texts[1]) < 0.1 and long / len(texts[1]) < short / len(texts[0]) / 4


def test_code_is_complete():
    """The symbols' Huffman codes satisfy Kraft's equality, so every byte has a probability."""
    lengths = np.diff(Slow(TEXTS).alphabet.starts)
    assert sum(2.0 ** -int(n) for n in lengths) == 1


def test_fit_never_costs_more_and_stays_finite():
    rng = np.random.default_rng(5)
    word, pair, gate = cm._tables()

    def cost(weights, n):
        z = np.clip(word * weights[gate, 0] + pair * weights[gate, 1], -20, 20)
        return (n * np.logaddexp(0, -z)).sum()

    flat = np.tile(cm.FLAT, (cm.GATES, 1))
    for scale in (1, 1e3, 1e12):
        for kind in (rng.random(cm.CODES) < 0.01, word > 7, word < -7, (word > 7) & (pair < -7)):
            n = (kind * rng.integers(0, 50, cm.CODES) * scale).astype(np.int64)
            weights = cm.fitted(n)
            assert np.isfinite(weights).all() and np.abs(weights).max() <= cm.MOST_WEIGHT
            assert cost(weights, n) <= cost(flat, n) * (1 + 1e-6) + 1e-6
    assert (cm.fitted(np.zeros(cm.CODES, np.int64)) == np.array(cm.FLAT, np.float32)).all()


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op7_lm_scoring(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    assert len(rows) == len(texts)
    out = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    counts = Counter(t for k, text in texts.items() if not out[k] for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    for k, text in texts.items():
        row, own = rows[k], tokens_of(text)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out[k], len(own), n)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0
    held = [r for r in rows.values() if r.held_out]
    size = sum(sum(len(closed(w)) for w in words_of(texts[r.doc_id])) for r in held)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert -sum(r.score for r in held) / math.log10(2) / size < 2.4


def test_scores_do_not_depend_on_the_cut(spark):
    docs = documents(spark, SF).where("doc_id < 120")
    trains = F.col("doc_id") % 7 != 0
    one = {r.doc_id: r for r in lm_scoring.scored(docs, trains, Scoring()).collect()}
    cut = Scoring(chunk_bytes=20_000, range_words=900)
    two = {r.doc_id: r for r in lm_scoring.scored(docs.repartition(5), trains, cut).collect()}
    for k, row in one.items():
        assert two[k].base_score == pytest.approx(row.base_score, rel=1e-12)
        assert two[k].score == pytest.approx(row.score, rel=1e-5)


def test_odd_rows(spark):
    docs = docs_frame(spark, [(1, "a b A"), (2, None), (None, "b"), (3, "zz \x00 é"), (3, "zz \x00 é"), (4, "")])
    rows = lm_scoring.scored(docs, F.coalesce(F.col("doc_id") == 1, F.lit(False)), Scoring()).collect()
    assert len(rows) == 6 and {r.train_tokens for r in rows} == {4}
    by = {(r.doc_id, r.n_tokens, r.n_known) for r in rows}
    assert by == {(1, 4, 4), (2, 1, 1), (None, 2, 2), (3, 4, 1), (4, 1, 1)}
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    untrained = lm_scoring.scored(docs, F.lit(False), Scoring()).collect()
    assert {(r.train_tokens, r.n_known) for r in untrained} == {(0, 0)}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in untrained)
    assert lm_scoring.scored(docs_frame(spark, []), F.lit(True), Scoring()).collect() == []


def test_every_score_of_odd_training_texts_is_finite(spark):
    rng = random.Random(1)
    noise = "".join(chr(rng.randint(33, 0x2FFF)) for _ in range(5000))
    key = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=20_000))
    texts = ["a" * 200_000, key, "A short sentence, as it were.", "aaa " * 9000, noise, "\x00\x01 \x02", "the " * 3 + key[:100], " ", "é" * 3000]
    docs = docs_frame(spark, [*enumerate(texts), *enumerate(texts[::-1], 100)])
    rows = lm_scoring.scored(docs, F.col("doc_id") < 100, Scoring()).collect()
    sizes = {k: max(len(t.encode()), 1) for k, t in [*enumerate(texts), *enumerate(texts[::-1], 100)]}
    assert len(rows) == 18 and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert all(-r.score / math.log10(2) / sizes[r.doc_id] < 16 for r in rows if sizes[r.doc_id] > 50)


def test_cost_works_in_few_arrays():
    """A decision takes three bytes on the way in and a few more while it is sorted, not arrays of numbers for all at once."""
    lanes, blocks = 8, 400
    rng = np.random.default_rng(4)
    codes = rng.integers(0, cm.CODES, lanes * blocks * cm.BLOCK).astype(np.uint16)
    match = rng.choice(np.array([-3, -1, 0, 0, 0, 1, 3], np.int8), len(codes))
    lengths = np.full(lanes, blocks * cm.BLOCK, np.int64)
    tracemalloc.start()
    cm._cost(codes, match, lengths, np.tile(np.array(cm.FLAT, np.float32), (cm.GATES, 1)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * len(codes)


def test_pieces_are_the_words_of_any_bytes():
    texts = [bytes([a]) + b"aB" + bytes([b]) * 2 for a in range(256) for b in (*range(8, 15), 28, 31, 32, 33, 133, 160)]
    texts += [b"", b" ", b"\xff\xfe \x00 \xc3", "ÀÉ z".encode(), b"zz"]
    sizes, packed = [len(t) for t in texts], lm_scoring._packed(b"".join(texts))
    pieces, text = lm_scoring._pieces(sizes, packed)
    own = [[] for _ in texts]
    for number, piece in zip(text.tolist(), pieces.cast(pa.binary()).to_pylist(), strict=True):
        own[number] += [piece] * (piece != b"")
    assert own == [t.lower().split() for t in texts]
    words = sorted({w for o in own for w in o} | {cm.END})
    found = lm_scoring._documents(sizes, packed, words)
    assert [[words[k] for k in d.tolist()] for d in found] == [[*o, cm.END] for o in own]
    with pytest.raises(ValueError, match="lacks"):
        lm_scoring._documents(sizes, packed, [w for w in words if w != b"zz"])


def test_expected_words_equal_a_plain_search():
    rng = np.random.default_rng(8)
    for top in (3, 40, 1 << 52):  # with numbers so large that sorting them with their places has no room
        words = rng.integers(1, 4, 600) * (top // 3)
        document = np.sort(rng.integers(0, 5, 600))
        found, kind = cm._expected(words, document)
        seen, last = {}, (None, 0, 0)
        for k, (d, w) in enumerate(zip(document.tolist(), words.tolist(), strict=True)):
            if d != last[0]:
                seen, last = {}, (d, 0, 0)
            _, before, previous = last
            guess = (seen.get((before, previous)), 2) if (before, previous) in seen else (seen.get(previous, 0), int(previous in seen))
            assert (found[k], kind[k]) == guess
            seen[before, previous] = seen[previous] = w
            last = (d, previous, w)

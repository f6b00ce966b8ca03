"""Language ID against a plain PPM coder and held-out accuracy."""

from __future__ import annotations

import base64
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import docs_frame
from tremor.llm import language_id
from tremor.llm.common import documents
from tremor.llm.language_id import Limits, Ppm
from tremor.llm.queries import op6_language_id

SF = "/root/testdata/sf0.01"


class SlowPpm:
    """One language's tree as dictionaries, coding byte by byte."""

    def __init__(self, texts, order, kept, known):
        self.order, self.kept, self.known = order, kept, known
        self.follow = defaultdict(Counter)
        line = b" " * order + (b" " * order).join(texts)
        for k in range(order + 1):
            for i in range(len(line) - k):
                self.follow[line[i : i + k]][line[i + k]] += 1

    def bits(self, text):
        line, total = b" " * self.order + text, 0.0
        for i in range(self.order, len(line)):
            total -= math.log2(self.chance(line[i - self.order : i], line[i]))
        return total

    def chance(self, context, byte):
        while context and context not in self.kept:
            context = context[1:]
        share, out = 1.0, set()
        while True:
            counts = {b: n for b, n in self.follow[context].items() if b not in out}
            whole = sum(counts.values()) + len(counts)
            if byte in counts:
                return share * counts[byte] / whole
            if counts:
                share *= len(counts) / whole
            out |= counts.keys()
            if not context:
                return share / (256 - len(out & self.known))
            context = context[1:]


def test_code_lengths_equal_a_plain_coder():
    samples = {
        "aa": [b"the cat sat on the mat. the end", b"the hat on the cat"],
        "bb": ["où est le chat, là où il était".encode(), b"le chat est la"],
    }
    ppm = Ppm(order=3, least=2)
    trees = language_id.learn(samples, ppm)
    assert trees.languages == ["aa", "bb"]
    seen = defaultdict(set)
    for lang, texts in samples.items():
        line = b" " * 3 + (b" " * 3).join(texts)
        for k in range(1, 4):
            counts = Counter(line[i : i + k] for i in range(len(line) - k))
            seen[lang] |= {c for c, n in counts.items() if n >= 2}
    kept = seen["aa"] | seen["bb"]
    known = set(b" ".join(t for texts in samples.values() for t in texts))
    texts = [b"the cat", "là où".encode(), b"zzz \xff", b"T", b"on the mat where the chat est"]
    got = language_id.code_lengths(texts, trees)
    for column, lang in enumerate(trees.languages):
        slow = SlowPpm(samples[lang], 3, kept, known)
        for row, text in enumerate(texts):
            assert got[row, column] == pytest.approx(slow.bits(text.lower()), rel=1e-5)


def test_long_texts_in_pieces(monkeypatch):
    trees = language_id.learn({"aa": [b"the cat sat on the mat" * 5], "bb": [b"le chat est la" * 9]}, Ppm())
    texts = [b"the mat on the cat " * 40, b"", b"le chat " * 33]
    whole = language_id.code_lengths(texts, trees)
    monkeypatch.setattr(language_id, "_PIECE", 16)
    assert language_id.code_lengths(texts, trees) == pytest.approx(whole, rel=1e-9)


def test_query_on_held_out_documents(spark):
    rows = op6_language_id(spark, SF).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    out = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == langs[r.doc_id] for r in out)
    assert len(out) > 100 and right / len(out) > 0.98


def test_prediction_ignores_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    trees = language_id.learned(docs, Ppm(sample_docs=20))
    plain = language_id.identified(docs.select("doc_id", "text"), trees).collect()
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "doc_id": F.col("doc_id")})
    again = language_id.identified(other, trees).select("doc_id", "text", "lang_pred", "score", "bits_per_byte").collect()
    assert sorted(plain) == sorted(again)


def test_odd_rows(spark):
    docs = docs_frame(spark, [(1, None), (2, ""), (3, "12 34 !"), (4, "der Hund"), (4, "der Hund"), (None, "É"), (6, "²½")])
    labelled = docs_frame(spark, [(1, "der Hund und die Katze"), (2, "the dog and the cat")], lang=["de", "en"])
    trees = language_id.learned(labelled, Ppm())
    rows = language_id.identified(docs.withColumn("score", F.lit("x")), trees).collect()
    assert [(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 6)] == [("und", 0.0)] * 4
    assert [r.lang_pred for r in rows if r.doc_id == 4] == ["de", "de"]
    assert next(r for r in rows if r.doc_id is None).lang_pred in ("de", "en")
    nothing = language_id.learned(docs_frame(spark, []), Ppm())
    assert {r.lang_pred for r in language_id.identified(docs, nothing).collect()} == {"und"}
    assert language_id.identified(docs_frame(spark, []), trees).collect() == []


def test_pipeline_stage_drops_unlearned_languages_and_noise(spark):
    rng = random.Random(4)
    strange = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        base64.b64encode(rng.randbytes(3000)).decode(),
        base64.b64encode(rng.randbytes(30)).decode(),
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)),
        "asdf jkl; qwer zxcv uiop sdfg hjkl xcvb qwpo",
    ]
    strange += [t * 40 for t in strange[:3]]
    docs = documents(spark, SF)
    rows = [(10**9 + k, text, None, "planted", len(text)) for k, text in enumerate(strange)]
    planted = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    both = docs.unionByName(planted)
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, both, SF).collect()}
    assert {k for k in kept if k >= 10**9} == set()
    clean = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert len(clean - kept) <= len(clean) // 200


def test_limits_without_enough_documents():
    limits = Limits(least=4)
    few = language_id.rate_limits({"aa": [b"the cat sat", b"the hat on"]}, Ppm(), limits)
    assert few == {"aa": [math.inf] * len(limits.lengths)}
    texts = [b"the cat sat on mat %d" % k for k in range(8)]
    own = language_id.rate_limits({"aa": texts, "bb": [b"le chat"]}, Ppm(), limits)
    assert own["aa"] == sorted(own["aa"], reverse=True) and own["bb"] == pytest.approx(own["aa"], abs=1)


def test_all_labelled_texts_are_counted(spark, monkeypatch):
    """Counts against plain ones: every text, in its half; nothing is drawn, neither for the trees nor for the limits."""
    monkeypatch.setattr(language_id, "sampled", lambda *_: pytest.fail("a sample"))
    rng = random.Random(5)
    texts = [(rng.choice("ab"), "".join(rng.choice("xyzÜ E") for _ in range(rng.randrange(30)))) for _ in range(700)]
    docs = docs_frame(spark, [(k, t) for k, (_, t) in enumerate(texts)], lang=[lang for lang, _ in texts]).repartition(5)
    ppm = Ppm(least=1, least_share=0.0)
    halves = language_id.gram_counts(docs, ppm)
    for half in (0, 1):
        for lang in "ab":
            lines = [b"   " + t.encode().lower() + b"   " for own, t in texts if own == lang and zlib.crc32(t.encode()) % 2 == half]
            for k, (codes, counts) in enumerate(halves[half][lang]):
                slow = Counter(line[i : i + k + 1] for line in lines for i in range(len(line) - 3))
                assert {int(c).to_bytes(k + 1, "big"): int(n) for c, n in zip(codes, counts, strict=True)} == slow
    whole = language_id.learn_counts(language_id.added_up(halves), ppm)
    # The joined texts of a language end without the blanks that every text is followed by here.
    plain = language_id.learn({lang: [t.encode() for own, t in texts if own == lang] for lang in "ab"}, ppm)
    probes = [b"xyz", "Üx".encode(), b"q", b"zz yy"]
    assert language_id.code_lengths(probes, whole) == pytest.approx(language_id.code_lengths(probes, plain), rel=1e-2)
    corpus_pipeline.known_language(spark, docs, SF).collect()
    limits = Limits()
    found = language_id.limits_of_all(docs, halves, ppm, limits)
    for lang in "ab":
        rates = []
        for half in (0, 1):
            trees = language_id.learn_counts(halves[1 - half], ppm)
            own = {t.encode() for of, t in texts if of == lang and zlib.crc32(t.encode()) % 2 == half}
            cut = [t[:15] for t in own if len(t) >= 8 and language_id.has_letter(t)]
            rates += [b[trees.languages.index(lang)] / len(t) for t, b in zip(cut, language_id.code_lengths(cut, trees), strict=True)]
        rates.sort()
        place = math.ceil(limits.quantile * len(rates)) - 1
        assert found[lang][0] - limits.margin == pytest.approx(rates[place], abs=2 / 1024) or found[lang][0] == found[lang][1]


def test_rare_contexts_of_a_large_corpus_stay_out(spark):
    texts = [f"{k} " + "the cat sat on the mat " * 50 for k in range(200)] + ["qzx"] * 8
    docs = docs_frame(spark, list(enumerate(texts)), lang=["en"] * len(texts))
    kept = language_id.added_up(language_id.gram_counts(docs, Ppm(least_share=2.0**-10)))["en"][3][0]
    assert {int(c).to_bytes(4, "big") for c in kept} >= {b"the ", b"cat "}
    assert not any(int(c).to_bytes(4, "big").startswith(b"qzx") for c in kept)

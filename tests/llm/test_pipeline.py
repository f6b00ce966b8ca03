"""Every stage of the pipeline against a brute-force version, on its own input."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import docs_frame
from tests.llm.test_mixing import slow_targets
from tests.llm.test_near_dups import slow_components, slow_fingerprint
from tests.llm.test_secrets import RULES, SLOW, slow_spans
from tremor.llm.common import WORD, documents

SF = "/root/testdata/sf0.001"
# The rules beyond the base ones, as Python writes them.
MORE = {r.kind: (r.pattern, lambda m: True) for r in RULES[3:]}


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of each stage."""
    docs, result = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        result[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    return result


def test_all_but_the_last_keep_the_columns(spark, steps):
    columns = documents(spark, SF).columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and all(steps[n][2] == columns for n in names[:-1])


def test_language_stage_keeps_all_with_letters(steps):
    before, after, _ = steps["language_id"]
    with_letters = {r for r in before if r.text and any(c.isalpha() for c in r.text)}
    assert set(after) == with_letters


def test_near_duplicate_stage(steps):
    before, after, _ = steps["near_duplicates"]
    groups = slow_components({r.doc_id: slow_fingerprint(r.text, 4) for r in before}, 4)
    heads = {r for r in before if groups[r.doc_id] == r.doc_id}
    assert set(after) == heads and len(after) == len(heads) < len(before)


def test_secret_stage(steps):
    before, after, _ = steps["secret_scan"]
    rows = {r.doc_id: r for r in after}
    for r in before:
        out, at = "", 0
        for start, _, _, end in slow_spans(r.text, SLOW | MORE):
            if start >= at:
                out += r.text[at:start] + "[secret]"
            at = max(at, end)
        out += r.text[at:]
        assert rows[r.doc_id].text == out and rows[r.doc_id].n_chars == len(out)
    assert len(after) == len(before)


def test_mixing_stage(steps):
    before, after, _ = steps["mixing"]
    size, taken, per_doc = Counter(), Counter(), Counter()
    texts = {r.doc_id: r for r in before}
    for r in before:
        size[r.source] += len(re.findall(WORD, r.text))
    for r in after:
        n = len(re.findall(WORD, r.text))
        taken[r.source] += n
        per_doc[r.doc_id] += n
        assert r.source == texts[r.doc_id].source and r.n_chars == len(r.text)
        assert not set(r.text.split()) - set(texts[r.doc_id].text.split())
    names = sorted(size)
    aims = slow_targets([size[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    for name, aim in zip(names, aims, strict=True):
        assert abs(taken[name] - aim) <= 128
    assert all(n <= 3 * len(re.findall(WORD, texts[k].text)) for k, n in per_doc.items())


def test_coding_stage(steps):
    before, after, _ = steps["bpe"]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    expected = Counter()
    for r in before:
        ids = library.encode(r.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected[r.doc_id, np.array(ids, "<u4").tobytes(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.decoded_sha256) for r in after) == expected


def test_run_gives_the_stages_result(spark, steps):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in rows) == Counter((r.doc_id, r.ids_sha256) for r in steps["bpe"][1])


def test_odd_rows_and_empty_table(spark):
    rows = [(1, "the dog and the cat"), (1, "the dog and the cat"), (None, "un chien"), (None, "un chien"), (2, None)]
    rows += [(3, ""), (4, "123"), (5, "token=abcdefg " * 300)]
    docs = docs_frame(spark, rows, lang=["en", "en", "fr", "fr", None, None, None, "en"], source=["a", "a", None, "b"] * 2)
    for table, ids in ((docs, [None, 1, 5]), (docs_frame(spark, []), [])):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, SF).cache()
            if number == 1:
                assert sorted((r.doc_id for r in out.collect()), key=lambda k: k or 0) == ids
            if number == 2:
                assert {r.text for r in out.where("doc_id = 5").collect()} <= {"[secret] " * 300}
            table = out
        assert {r.doc_id for r in table.collect()} <= set(ids)


def test_rows_that_share_an_id_are_apart_unless_alike(spark):
    a, b = "one two three four five six seven", "a text of wholly other words, and more of them"
    rows = [(5, a), (5, b), (9, b), (9, b), (5, a), (None, a), (None, "alone without an id, as it were"), (7, None), (8, "")]
    docs = docs_frame(spark, rows)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(5, a), (5, b), (None, rows[6][1]), (7, None)])


def test_columns_whose_names_the_stages_use_themselves(spark):
    base = documents(spark, SF).limit(60)
    extra = ["score", "lang_pred", "bits_per_byte", "_near_head", "_near_id", "fp", "node", "group", "row", "c0", "component"]
    docs = base.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in extra]).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns and out.count()
        for name in extra:
            assert out.where(F.col(name) != F.concat(F.lit(f"{name} "), "doc_id")).isEmpty()
        docs = out

"""Quality rules against plain Python."""

from __future__ import annotations

import re
from collections import Counter

from tests.llm.helpers import docs_frame
from tremor.llm import quality
from tremor.llm.common import WORD, documents
from tremor.llm.queries import op4_quality_rules
from tremor.llm.quality import BOILERPLATE, NAVIGATION, LineRules

SF = "/root/testdata/sf0.01"
RULES = LineRules()
ODD = [
    None,
    "",
    " \n\t\n",
    "one two three",
    "a b c a b c",
    "x x x x x",
    "a b c d\na b c d\n\n \na b c d",
    "é ü | # * $ %\x0b& < > é ü",
    "w " * 60,
    "Home | About | Login | Menu\n" + "A proper sentence of some seven words. " * 12,
    " ".join(f"word{k}" for k in range(80)) + ".\nAll rights reserved by nobody at all.",
    " ".join(f"W{k}!!" for k in range(80)),
    "\n".join(f"line {k} without an end" for k in range(40)),
]


def words_of(text):
    return re.findall(WORD, text)


def line_passes(line):
    words = len(words_of(line))
    last = line.rstrip(" \t\n\x0b\x0c\r")[-1:]
    ended = last in tuple(".!?:;…。！？\"'”’»)]")
    noisy = len(re.findall(r"[#*$%&|<>]+|[!?]{2,}", line)) > words * RULES.mark_share
    menu = len(re.findall(r"[|»›•·→]| > ", line)) >= RULES.separators
    link = words <= RULES.navigation_words and re.search(rf"\b(?:{'|'.join(NAVIGATION)})\b", line.lower())
    return ended and not noisy and not menu and not link and not any(b in line.lower() for b in BOILERPLATE)


def slow(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    stay = [line for line in lines if line_passes(line)]
    chars, left = sum(map(len, lines)), sum(map(len, stay))
    lost = 1 - left / chars if chars else 1.0
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": failed,
        "lost_share": lost,
        "kept": not failed and lost <= RULES.most_lost,
        "cleaned": "\n".join(stay),
    }


def test_query_equals_plain_python(spark):
    rows = op4_quality_rules(spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    assert len(rows) == len(texts)
    for row in rows:
        expected = slow(texts[row.doc_id])
        del expected["cleaned"]
        assert {k: row[k] for k in expected} == expected
    assert any(r.n_repeat_words for r in rows) and any(not r.base_failed and not r.kept for r in rows)


def test_junk_goes_and_clean_documents_stay(spark):
    kept = {r.doc_id: r.kept for r in op4_quality_rules(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    short = {r.doc_id for r in op4_quality_rules(spark, "/root/testdata/sf0.1").where("n_words < 50").collect()}
    good = [r.doc_id for r in labels if r.quality == 1 and r.doc_id not in short]
    bad = [r.doc_id for r in labels if r.quality == 0]
    print("kept of good", sum(kept[k] for k in good) / len(good), "of bad", sum(kept[k] for k in bad) / len(bad))
    assert sum(kept[k] for k in good) >= 0.99 * len(good)
    assert sum(kept[k] for k in bad) <= 0.05 * len(bad)


def test_odd_texts(spark):
    docs = docs_frame(spark, list(enumerate(ODD)) + [(3, ODD[3]), (None, "x")])
    rows = quality.quality(docs, RULES).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        expected = slow(row.text)
        assert {k: row[k] for k in expected} == expected, row.text
    assert quality.quality(docs_frame(spark, []), RULES).collect() == []

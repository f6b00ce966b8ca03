"""Spelling variants, against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import docs_frame
from tremor.llm.common import documents
from tremor.llm.queries import op13_spelling_variants
from tremor.llm.variants import Spelling, frequent_words, near_pairs, variant_groups


def counted(rows, slips, least_chars=6, least_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and hashed % slips == 0:
                run = "".join(c for k, c in enumerate(run) if k != hashed % len(run))
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def links(words):
    by_length = defaultdict(list)
    for word in words:
        by_length[len(word)].append(word)
    near = {}
    for word in words:
        others = by_length[len(word)] + by_length[len(word) - 1] + by_length[len(word) + 1]
        near[word] = [o for o in others if one_edit(word, o)]
    return near


def grouped(words, ratio=5):
    near = links(words)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= ratio * words[word]:
            form[word] = best
    rows = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, n, len(near[word]), form.get(word), words.get(form.get(word)), root))
    return sorted(rows)


def test_whole_table(spark):
    rows = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()
    words = counted(rows, 199)
    assert len(words) > 300
    found = op13_spelling_variants(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect())) == grouped(words)


@pytest.mark.parametrize(("parts", "block"), [(1, 512), (2, 7), (3, 512), (3, 5), (4, 2)])
def test_pairs_are_found_once_however_the_work_is_cut(spark, parts, block):
    rng = random.Random(parts * 100 + block)
    words = {"".join(rng.choices("ab\xe9", k=rng.randint(1, 5))): rng.randint(5, 90) for _ in range(250)}
    words |= {"".join(rng.choices("ab", k=rng.randint(6, 9))): rng.randint(5, 90) for _ in range(250)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    spelling = Spelling(least_chars=1, parts=parts, block=block)
    found = Counter(map(tuple, near_pairs(frame, spelling).collect()))
    assert found == Counter((w, o, words[o]) for w, others in links(words).items() for o in others)


def test_one_group_with_most_words_is_cut_into_tiles(spark):
    """All words share their first two thirds, so one key holds them all."""
    rng = random.Random(3)
    words = {"stemstemst" + "".join(rng.choices("abcdefgh", k=5)): rng.randint(5, 900) for _ in range(1500)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = Counter((w, o) for w, o, _ in near_pairs(frame, Spelling(block=64)).collect())
    assert found == Counter((w, o) for w, others in links(words).items() for o in others)


def test_chains_of_forms_and_ties(spark):
    counts = {"strecken": 5, "streckens": 30, "streckenst": 160, "streckensta": 900, "strecke": 5, "trecken": 25,
              "zebraa": 50, "zebrab": 50, "zebrac": 10, "lonely": 7}
    docs = docs_frame(spark, [(k, f"{w} " * n) for k, (w, n) in enumerate(counts.items())])
    found = {r[0]: tuple(r) for r in variant_groups(docs, Spelling()).collect()}
    assert sorted(found.values()) == grouped(counts)
    assert found["strecken"][3:] == ("streckens", 30, "streckensta")
    assert found["zebrac"][3:] == ("zebraa", 50, "zebraa")
    assert found["lonely"][2:] == (0, None, None, "lonely")


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None), (2, ""), (None, "Nullable \xc0\xff\xd7\xf7abc " * 6), (3, "Repeat Repeax " * 5), (3, "Repeat Repeax " * 5),
            (4, "İstanbul İstanbul " * 9), (5, "x" * 500_000 + " "), (6, ("y" * 3000 + " ") * 5 + ("y" * 3001 + " ") * 25),
            (7, "\U0001f600abcdefgĀhijklmn " * 7)]
    docs = docs_frame(spark, rows)
    for slips in (0, 2):
        expected = grouped(counted(rows, slips))
        assert sorted(map(tuple, variant_groups(docs, Spelling(slips=slips)).collect())) == expected
    assert variant_groups(docs.limit(0), Spelling()).collect() == []
    assert variant_groups(docs.where("doc_id < 3"), Spelling()).collect() == []


def test_counts_do_not_depend_on_when_tasks_hand_them_on(spark):
    rows = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    expected = counted(rows.collect(), 199, 4, 3)
    found = frequent_words(rows, Spelling(least_chars=4, least_count=3, slips=199, held=10))
    assert dict(map(tuple, found.collect())) == expected
    with pytest.raises(ValueError, match="more frequent"):
        Spelling(ratio=1)

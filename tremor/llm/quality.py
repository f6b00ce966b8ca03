"""Quality rules, lines first.

Every line with a word is held against rules on punctuation, navigation and boilerplate. Lines
that break one are removed, and a document that loses too much of its text that way is
rejected. All of it, the base counts included, is built-in Spark SQL functions on one row: no
Python, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import WORD
from tremor.llm.spans import let

# Phrases and words by which boilerplate and navigation are known.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "distributed under the",
    "copyright",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "subscribe to our",
    "sign up for",
    "click here",
    "enable javascript",
    "lorem ipsum",
    "powered by",
)
NAVIGATION = (
    "home",
    "login",
    "log in",
    "sign in",
    "menu",
    "next",
    "previous",
    "read more",
    "skip to content",
    "back to top",
    "contact us",
    "about us",
    "sitemap",
    "share this",
)


@dataclass(frozen=True)
class LineRules:
    """``mark_share``: marks per word from which a line is noise. ``navigation_words``: how long a
    line of navigation is at most. ``separators``: how many of them make a line a menu or table
    row. ``most_lost``: the share of its text that a document may lose."""

    mark_share: float = 0.25
    navigation_words: int = 6
    separators: int = 3
    most_lost: float = 0.4


_ENDS = r"""[.!?:;…。！？"'”’»)\]][\x20\x09-\x0D]*$"""
_MARKS = r"[#*$%&|<>]+|[!?]{2,}"
_SEPARATORS = r"[|»›•·→]|[\x20]>[\x20]"


def line_passes(line: Column, rules: LineRules) -> Column:
    """Whether the line breaks no rule."""
    words = F.regexp_count(line, F.lit(WORD))
    ended = line.rlike(_ENDS)
    noisy = F.regexp_count(line, F.lit(_MARKS)) > words * rules.mark_share
    menu = F.regexp_count(line, F.lit(_SEPARATORS)) >= rules.separators
    link = (words <= rules.navigation_words) & line.rlike(rf"(?i)\b(?:{'|'.join(NAVIGATION)})\b")
    boilerplate = line.rlike(f"(?i)(?:{'|'.join(BOILERPLATE)})")
    return ended & ~noisy & ~menu & ~link & ~boilerplate


def repeated_words(words: Column) -> Column:
    """How many of the words lie in a 3-word window that occurs twice or more among them."""

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(order: Column, at: Column, own: Column) -> Column:
            return F.coalesce(F.get(order, at)["h"] == own["h"], F.lit(False))

        repeated = let(
            placed, lambda z: F.filter(z, lambda e, k: same(z, k - 1, e) | same(z, k + 1, e))
        )
        starts = F.sort_array(F.transform(repeated, lambda e: e["i"]))
        # Windows overlap: each adds the words up to the next one's start, three at most.
        own = let(
            starts,
            lambda s: F.zip_with(
                s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))
            ),
        )
        covered = F.aggregate(own, F.lit(0), lambda a, b: a + b)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)

    def of_words(w: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(numbers, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(hashes, of_windows))

    return let(words, of_words)


def quality(docs: DataFrame, rules: LineRules, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``cleaned``, ``lost_share`` and ``kept``.

    ``cleaned`` is the text without the lines that break a rule, ``lost_share`` the share of the
    characters of lines with words that went with them. A NULL or wordless text has counts of
    zero, an empty ``cleaned``, and fails. Repeated rows and NULLs elsewhere change nothing, an
    empty table gives an empty result, and columns of the added names are replaced.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(content, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(WORD))

    def word_counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
        )

    def line_counts(own: Column) -> Column:
        left = F.filter(own, lambda line: line_passes(line, rules))
        return let(
            left,
            lambda stay: F.struct(
                (F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("n_dup_lines"),
                F.char_length(F.array_join(own, "")).alias("chars"),
                F.char_length(F.array_join(stay, "")).alias("chars_left"),
                F.array_join(stay, "\n").alias("cleaned"),
            ),
        )

    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    added += ["base_failed", "cleaned", "lost_share", "kept"]
    own = [c for c in docs.columns if c not in added]
    symbols = F.char_length(F.regexp_replace(content, r"[^#*$%&|<>]+", "")).cast("bigint")
    counted = docs.select(
        *own, let(words, word_counts).alias("_words"), let(lines, line_counts).alias("_lines"), symbols.alias("n_symbols")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.when(F.col("_lines.chars") > 0, 1 - F.col("_lines.chars_left") / F.col("_lines.chars")).otherwise(F.lit(1.0))
    return (
        counted.withColumns(
            {
                "n_words": F.col("_words.n_words"),
                "word_chars": F.col("_words.word_chars"),
                "n_dup_lines": F.col("_lines.n_dup_lines"),
                "n_repeat_words": F.col("_words.n_repeat_words"),
                "cleaned": F.col("_lines.cleaned"),
                "lost_share": lost,
            }
        )
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= rules.most_lost))
        .select(*own, *added)
    )

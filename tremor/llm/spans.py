"""Native expressions over arrays and over the places where a pattern matches a text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often the lambdas in it are called."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element what ``combine`` makes of all elements before it, in blocks.

    An element looks at the rest of its own block only, so long arrays stay cheap.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, combine)

    def with_values(v: Column) -> Column:
        count = F.ceil(F.size(v) / F.lit(_BLOCK)).cast("int")
        numbers = F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1))), F.lit(1), count)
        blocks = F.transform(numbers, lambda b: fold(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))
        return let(
            blocks,
            lambda whole: let(
                F.transform(numbers, lambda b: fold(F.slice(whole, F.lit(1), b))),
                lambda before: F.transform(
                    v,
                    lambda _, i: combine(
                        F.get(before, F.floor(i / F.lit(_BLOCK)).cast("int")),
                        fold(F.slice(v, i - i % _BLOCK + 1, i % _BLOCK)),
                    ),
                ),
            ),
        )

    return let(values, with_values)


def match_spans(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """``(start, end)`` in code points of the pattern's matches, left to right, without overlaps.

    Matches whose ``group`` is shorter than ``least`` are left out, but like any match they use
    up their characters. The text is cut at the matches, and the lengths of the pieces give
    the places.
    """
    step = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    lengths = F.transform(
        step,
        lambda s: F.struct(
            F.char_length(s["piece"]).alias("piece"),
            F.char_length(s["hit"]).alias("hit"),
            F.char_length(s["part"]).alias("part"),
        ),
    )

    def places(of: Column) -> Column:
        whole = F.transform(of, lambda s: s["piece"] + F.coalesce(s["hit"], F.lit(0)))
        before = running(whole, lambda a, b: a + b, F.lit(0))
        found = F.zip_with(
            of,
            before,
            lambda s, b: F.struct(
                (b + s["piece"]).alias("start"), (b + s["piece"] + s["hit"]).alias("end"), s["part"].alias("part")
            ),
        )
        kept = F.filter(found, lambda s: s["part"] >= least)
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    return let(lengths, places)


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every run of overlapping spans, sorted by start, replaced by the mask."""

    def build(s: Column) -> Column:
        ends = F.transform(s, lambda x: x["end"])
        reached = running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
        pieces = F.zip_with(
            s,
            reached,
            lambda x, r: F.when(x["start"] < r, F.lit("")).otherwise(
                F.concat(F.substring(text, r + 1, x["start"] - r), F.lit(mask))
            ),
        )
        tail = F.substring(text, F.array_max(ends) + 1, F.char_length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans) > 0, let(spans, build)).otherwise(text)

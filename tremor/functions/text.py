"""Text cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAKS = ("\r\n", "\r", "\n")


def strict_or_null(value: Column, to: str, lenient: bool = False) -> Column:
    """Cast that fails on malformed input, or gives NULL when ``lenient``."""
    return value.try_cast(to) if lenient else value.cast(to)


def decimal_comma(value: Column, to: str = "double", lenient: bool = False) -> Column:
    """A number written with a decimal comma, such as ``2,55``."""
    return strict_or_null(F.replace(value, F.lit(","), F.lit(".")), to, lenient)


def with_decimal_comma(value: Column, scale: int) -> Column:
    """The inverse: a number as text with a decimal comma and ``scale`` decimals."""
    return F.replace(value.cast(f"decimal(28,{scale})").cast("string"), F.lit("."), F.lit(","))


def parts(line: Column, sep: str) -> Column:
    """Every piece of a line between separators, empty pieces kept, quotes not special."""
    return F.split(line, re.escape(sep))


def part(line: Column, sep: str, index: int) -> Column:
    """Piece ``index`` (from 0) of a line. A line that is too short fails the query."""
    return parts(line, sep)[index]


def line_of(sep: str, *fields: str) -> Column:
    """Fields joined to a line; a NULL one is empty, so that none changes its place."""
    return F.concat_ws(sep, *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])


def filled(piece: Column) -> Column:
    """A piece of a line, NULL where it is empty."""
    return F.nullif(piece, F.lit(""))


def words_of_lines(text: Column) -> Column:
    """Blank-separated words of every line of a text; empty words are kept.

    Line breaks become blanks first: splitting at a single character needs no regular
    expression engine and takes about half the time.
    """
    for line_break in LINE_BREAKS:
        text = F.replace(text, F.lit(line_break), F.lit(" "))
    return F.split(text, " ")


def characters(text: Column) -> Column:
    return F.split(text, "")


def quotes_to_spaces(text: Column) -> Column:
    return F.translate(text, "'", " ")


def capitalized(text: Column) -> Column:
    """First letter of each alphanumeric run upper case, the rest lower case.

    Spark's ``initcap`` starts a word only after a blank; PostgreSQL's does so after any
    character that is neither letter nor digit (``bay-x`` gives ``Bay-X``), which is what
    stored locations are grouped by.
    """
    runs = F.split(text, r"(?<=[^\p{L}\p{N}])")
    cased = F.transform(
        runs, lambda run: F.concat(F.upper(F.substr(run, F.lit(1), F.lit(1))), F.lower(F.substr(run, F.lit(2))))
    )
    return F.array_join(cased, "")

"""Expressions over free-text locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.functions.text import capitalized


def before_comma(location: Column) -> Column:
    """``Malatya, TR`` gives ``Malatya``; blanks are kept."""
    return F.split_part(location, F.lit(","), F.lit(1))


def upper_case(text: Column, turkish: bool = False) -> Column:
    """Upper case; with ``turkish`` dotted and dotless i stay different letters."""
    return F.upper(F.translate(text, "iı", "İI") if turkish else text)


def location_key(location: Column, turkish: bool = False) -> Column:
    """The form in which a user's location is compared with city names."""
    return upper_case(before_comma(location), turkish)


def location_label(location: Column) -> Column:
    """The form in which stored locations are grouped for display."""
    return before_comma(capitalized(location))

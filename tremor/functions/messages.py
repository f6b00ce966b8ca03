"""Message feeds: JSON records and the tagged line format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions.text import parts

# Separators of the tagged line format, and the live feed's default subscription.
RECORD_MARK = "mgnsmgns"
PLACE_MARK = "mrtaydn"
PLACE_END = "**"
FEED_LANGUAGE = "tr"
FEED_BOX = (-130.0, -20.0, 100.0, 50.0)
FEED_TERM = "#deprem"

_BROKEN = "_broken"
# Every field as text: a defect in one then spoils neither the others nor the record.
_MESSAGE_SCHEMA = (
    f"id STRING, text STRING, lang STRING, place STRING, user STRING, coordinates STRING, {_BROKEN} STRING"
)


def parsed_messages(lines: DataFrame, value: str = "value", keep: str | None = None) -> DataFrame:
    """``(id, text, lang, place, location, lon, lat)`` of every line that holds a JSON object.

    Only lines that are no JSON object are dropped; a field that is absent, null or of another
    type than expected is NULL by itself. ``keep`` names a column of the line to hand on. ``id`` stays text, as feeds write it both as a number
    of any length and as text. The corrupt-record column keeps Spark from returning the
    readable half of a cut-off record. Exploding a one-element array keeps filters on the fields above the parse;
    written as a plain column, the parse would be repeated in every filter.
    """
    own = [] if keep is None else [F.col(keep)]
    message = F.from_json(F.col(value), _MESSAGE_SCHEMA, {"columnNameOfCorruptRecord": _BROKEN})
    return (
        lines.select(F.explode(F.array(message)).alias("m"), *own)
        .where(F.col("m").isNotNull() & F.col(f"m.{_BROKEN}").isNull())
        .select(
            *own,
            "m.id",
            "m.text",
            "m.lang",
            F.get_json_object("m.place", "$.name").alias("place"),
            F.get_json_object("m.user", "$.location").alias("location"),
            F.get_json_object("m.coordinates", "$.coordinates[0]").try_cast("double").alias("lon"),
            F.get_json_object("m.coordinates", "$.coordinates[1]").try_cast("double").alias("lat"),
        )
    )


def messages_with_place(lines: DataFrame, need_text: bool = False) -> DataFrame:
    """Messages that name a place (and have a text, for feeds that carry both)."""
    messages = parsed_messages(lines).where(F.col("place").isNotNull())
    return messages.where(F.col("text").isNotNull()) if need_text else messages


def stored_location(value: Column) -> Column:
    """``user.location`` of a stored JSON message; NULL where absent or null.

    As for ``parsed_messages``, a line that is no whole JSON object is no message, so a cut-off record has none.
    The lambda names the parsed message, so that it is parsed once.
    """
    message = F.from_json(value, f"user STRING, {_BROKEN} STRING", {"columnNameOfCorruptRecord": _BROKEN})
    located = F.transform(
        F.array(message),
        lambda m: F.when(m[_BROKEN].isNull(), F.get_json_object(m["user"], "$.location")),
    )
    return F.get(located, 0)


def subscription(
    language: str = FEED_LANGUAGE, box: tuple[float, float, float, float] = FEED_BOX, term: str = FEED_TERM
) -> Column:
    """Predicate on ``lang``, ``lon``, ``lat`` and ``text``: the language, and either the box or the term."""
    west, south, east, north = box
    inside = F.col("lon").between(west, east) & F.col("lat").between(south, north)
    return (F.col("lang") == language) & (inside | F.col("text").contains(term))


def subscribed(lines: DataFrame, predicate: Column, value: str = "value") -> DataFrame:
    """The lines, as they came, whose message meets the predicate; broken lines do not."""
    return parsed_messages(lines, value, keep=value).where(predicate).select(value)


def tagged_line(text: Column, place: Column, record_mark: str = RECORD_MARK, place_mark: str = PLACE_MARK) -> Column:
    """One message in the tagged line format."""
    mark = F.lit(f" {record_mark} ")
    return F.concat(mark, text, mark, place, F.lit(PLACE_END + place_mark), mark)


def tagged_places(
    lines: DataFrame,
    value: str = "value",
    trim: bool = True,
    record_mark: str = RECORD_MARK,
    place_mark: str = PLACE_MARK,
) -> DataFrame:
    """``(location)`` rows of tagged lines. Untrimmed, names keep the blank the format puts before them."""
    records = lines.select(F.explode(parts(F.col(value), record_mark)).alias("record"))
    pieces = records.where(F.col("record").contains(place_mark)).select(
        F.explode(parts(F.col("record"), PLACE_END)).alias("piece")
    )
    places = pieces.where(~F.col("piece").contains(place_mark))
    return places.select((F.trim("piece") if trim else F.col("piece")).alias("location"))

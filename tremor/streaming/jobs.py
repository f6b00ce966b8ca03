"""Streaming jobs over line feeds.

Each job returns the started query. ``trigger`` holds the keyword arguments of
``DataStreamWriter.trigger``; the default is a batch every 30 seconds. Errors in a batch
fail the query; it resumes from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.functions.messages import parsed_messages, stored_location
from tremor.functions.places import location_key, upper_case
from tremor.functions.text import part, quotes_to_spaces
from tremor.streaming.ledger import CounterLedger, DistinctLedger
from tremor.streaming.snapshots import dashboard_payload, top_places, write_batch

EVERY_30_SECONDS = {"processingTime": "30 seconds"}


def _start(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str, trigger: dict
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(handle).start()


_settings = Lock()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, object]) -> Iterator[None]:
    """Sets what is not None for a query started inside; a started query keeps its own copy.

    One start at a time, as all of them share the session's settings.
    """
    wanted = {name: value for name, value in settings.items() if value is not None}
    with _settings:
        before = {name: spark.conf.get(name, None) for name in wanted}
        for name, value in wanted.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _written(rows: DataFrame, root: str, batch_id: int) -> DataFrame:
    """The batch's rows, written and read back, so that what follows does not compute them again."""
    write_batch(rows, root, batch_id)
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/batch_id={batch_id}")


def running_counts(places: DataFrame) -> DataFrame:
    """``(location, location_count)`` since the start of the stream; state never expires."""
    return places.groupBy("location").agg(F.count(F.lit(1)).alias("location_count"))


def start_running_counts(
    places: DataFrame,
    checkpoint: str,
    snapshots: str | None,
    top: str | None = None,
    payloads: str | None = None,
    k: int = 10,
    trigger: dict = EVERY_30_SECONDS,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts in the query's state. Each batch stores them all in ``snapshots``, their top
    ``k`` in ``top``, and that top's dashboard payload in ``payloads``, each if given.

    Batches send at most one row per place and task to the state, so far fewer
    ``state_partitions`` than lines would suggest may do; that depends on how many different
    places there are, and a checkpoint keeps the number it began with. The default is the session's.
    """

    def handle(counts: DataFrame, batch_id: int) -> None:
        rows = counts
        if snapshots:
            rows = _written(counts, snapshots, batch_id)
        if top:
            rows = _written(top_places(rows, k), top, batch_id)
        if payloads:
            write_batch(dashboard_payload(rows if top else top_places(rows, k)), payloads, batch_id)

    with session_settings(places.sparkSession, {"spark.sql.shuffle.partitions": state_partitions}):
        return _start(running_counts(places), handle, checkpoint, "complete", trigger)


def start_persisted_counts(
    places: DataFrame,
    checkpoint: str,
    ledger: CounterLedger,
    top: str | None = None,
    payloads: str | None = None,
    k: int = 10,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Counts added to persisted totals; the top ``k`` is that of the totals, earlier runs included."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        ledger.record(batch, batch_id)
        if top or payloads:
            leaders = ledger.top_at(batch.sparkSession, batch_id, k)
            if top:
                leaders = _written(leaders, top, batch_id)
            if payloads:
                write_batch(dashboard_payload(leaders), payloads, batch_id)

    return _start(places, handle, checkpoint, "append", trigger)


def start_distinct_users(
    rows: DataFrame, checkpoint: str, ledger: DistinctLedger, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Different users per place of ``rows(location, user_id)``, as sketches in the ledger."""
    return _start(rows.select("location", "user_id"), ledger.record, checkpoint, "append", trigger)


def start_city_counts(
    messages: DataFrame,
    checkpoint: str,
    ledger: CounterLedger,
    dimension: DataFrame,
    trigger: dict = EVERY_30_SECONDS,
    turkish: bool = False,
) -> StreamingQuery:
    """Persisted counts of JSON messages per city of ``dimension(id, city)``, by the user's location.

    Locations are matched before they are counted, so the ledger holds cities only, by the key
    they are matched on, each once however many rows of the dimension have it. Read the result
    with ``city_totals``. ``turkish`` keeps dotted and dotless i apart.
    """
    located = parsed_messages(messages).where(F.col("location").isNotNull())
    keys = located.select(location_key(F.col("location"), turkish).alias("location"))
    names = dimension.select(upper_case(F.col("city"), turkish).alias("location")).distinct()
    return start_persisted_counts(keys.join(names, "location"), checkpoint, ledger, trigger=trigger)


def city_totals(dimension: DataFrame, totals: DataFrame, turkish: bool = False) -> DataFrame:
    """``(id, city, n)`` for every row of the dimension, 0 where none was counted."""
    counts = totals.select(F.col("location").alias("_key"), F.col("location_count").alias("n"))
    same = upper_case(F.col("city"), turkish) == F.col("_key")
    return dimension.join(counts, same, "left").select(
        "id", "city", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def start_batch_counts(
    lines: DataFrame, checkpoint: str, out: str, position: int = 1, sep: str = ";", trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Counts of one field of delimited lines within each batch alone, by location downwards."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = batch.select(part(F.col("value"), sep, position).alias("location")).groupBy("location").count()
        write_batch(counts.withColumnRenamed("count", "location_count").orderBy(F.desc("location")), out, batch_id)

    return _start(lines, handle, checkpoint, "append", trigger)


def start_copy(
    lines: DataFrame, checkpoint: str, out: str, fmt: str = "text", trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Every line as it came, appended to a folder (or shown, with format ``console``)."""
    writer = lines.writeStream.format(fmt).option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.start() if fmt == "console" else writer.start(out)


def start_archive(
    messages: DataFrame,
    checkpoint: str,
    out: str,
    located_only: bool = False,
    clean_quotes: bool = False,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Raw JSON messages appended to a parquet table ``(tweet)``: all lines as they came, or only whole messages
    with a location."""
    value = F.col("value")
    if located_only:
        messages = messages.where(stored_location(value).isNotNull())
    rows = messages.select((quotes_to_spaces(value) if clean_quotes else value).alias("tweet"))
    return start_copy(rows, checkpoint, out, "parquet", trigger)


def start_location_log(
    messages: DataFrame, checkpoint: str, out: str, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """Locations of JSON messages appended to text files, one per line; messages without one are left out."""
    located = parsed_messages(messages).where(F.col("location").isNotNull())
    return start_copy(located.select(F.col("location").alias("value")), checkpoint, out, "text", trigger)


def start_message_log(
    messages: DataFrame, checkpoint: str, out: str, trigger: dict = EVERY_30_SECONDS
) -> StreamingQuery:
    """``(id, text, place, location)`` of JSON messages appended to files of JSON lines."""
    rows = parsed_messages(messages).select("id", "text", "place", "location")
    return start_copy(rows, checkpoint, out, "json", trigger)

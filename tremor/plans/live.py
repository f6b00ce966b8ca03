"""Streaming queries: a feed is replayed through a streaming job to its end, and the job's table returned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.functions.messages import stored_location, subscribed, subscription
from tremor.plans import feeds
from tremor.plans.registry import registered
from tremor.sources.cities import cities
from tremor.sources.tables import stored_table, table
from tremor.streaming import jobs, snapshots
from tremor.streaming.ledger import CounterLedger
from tremor.workspace import new_folder

ALL_NOW = {"availableNow": True}

_COUNTS_SQL = f"WITH {feeds.PLACES_SQL} SELECT location, count(*) AS location_count FROM places GROUP BY location"
_TOP_SQL = f"{_COUNTS_SQL} ORDER BY location_count DESC, location LIMIT 10"


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _n_events(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "events").count()


def _place_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.place_rows(spark, sf_dir).select(F.col("location").alias("value"))
    stream = feeds.replayed(spark, lines, _n_events(spark, sf_dir), "places")
    return stream.select(F.col("value").alias("location"))


@registered(_COUNTS_SQL)
def st_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "running")
    places = _place_stream(spark, sf_dir)
    query = jobs.start_running_counts(places, f"{out}/checkpoint", f"{out}/counts", trigger=ALL_NOW)
    _finish(query)
    return snapshots.last_batch(spark, f"{out}/counts")


@registered(_TOP_SQL)
def st_topk_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "state-top")
    places = _place_stream(spark, sf_dir)
    query = jobs.start_running_counts(places, f"{out}/checkpoint", None, top=f"{out}/top", trigger=ALL_NOW)
    _finish(query)
    return snapshots.last_batch(spark, f"{out}/top")


@registered(_COUNTS_SQL)
def st_snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest count of each place over all appended snapshots; counts only grow, so it is the last."""
    out = new_folder(spark, "snapshots")
    places = _place_stream(spark, sf_dir)
    query = jobs.start_running_counts(places, f"{out}/checkpoint", f"{out}/counts", trigger=ALL_NOW)
    _finish(query)
    appended = snapshots.read_batches(spark, f"{out}/counts")
    return appended.groupBy("location").agg(F.max("location_count").alias("location_count"))


@registered(_COUNTS_SQL)
def st_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "batches")
    lines = feeds.place_rows(spark, sf_dir).select(F.concat(F.lit("user;"), "location", F.lit(";tr")).alias("value"))
    stream = feeds.replayed(spark, lines, _n_events(spark, sf_dir), "batch-lines")
    _finish(jobs.start_batch_counts(stream, f"{out}/checkpoint", f"{out}/counts", trigger=ALL_NOW))
    batches = snapshots.read_batches(spark, f"{out}/counts")
    return batches.groupBy("location").agg(F.sum("location_count").alias("location_count"))


@registered(f"WITH {feeds.PLACES_SQL} SELECT location AS value FROM places")
def st_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "copy")
    lines = _place_stream(spark, sf_dir).select(F.col("location").alias("value"))
    _finish(jobs.start_copy(lines, f"{out}/checkpoint", f"{out}/lines", trigger=ALL_NOW))
    return spark.read.text(f"{out}/lines")


@registered(_COUNTS_SQL.replace("count(*)", "3 * count(*)"))
def st_counter_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the same feed, each with a checkpoint of its own; the first is resumed after the second
    began and again after the third ended, when all of its feed but the beginning is new to it."""
    out = new_folder(spark, "ledger")
    steps = feeds.Steps(spark, feeds.event_steps(spark, sf_dir), f"{out}/feed")

    def run(name: str, until: int) -> CounterLedger:
        ledger = CounterLedger(f"{out}/ledger", name, f"{out}/checkpoint-{name}", fold_every=2)
        for stream in steps.streams(name, until):
            _finish(jobs.start_persisted_counts(stream, f"{out}/checkpoint-{name}", ledger, trigger=ALL_NOW))
        return ledger

    run("first", 1)
    run("second", 3)
    run("first", 2)
    run("third", 3)
    return run("first", 3).totals(spark)


@registered(_TOP_SQL)
def st_topk_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "persisted-top")
    ledger = CounterLedger(f"{out}/ledger", uuid.uuid4().hex, f"{out}/checkpoint", fold_every=2)
    places = _place_stream(spark, sf_dir)
    query = jobs.start_persisted_counts(places, f"{out}/checkpoint", ledger, top=f"{out}/top", trigger=ALL_NOW)
    _finish(query)
    return snapshots.last_batch(spark, f"{out}/top")


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL},
    keys AS (SELECT upper(split_part(location, ',', 1)) AS k FROM messages WHERE location IS NOT NULL AND NOT broken),
    named AS (SELECT id, city FROM cities UNION ALL SELECT id + 1000, city FROM cities WHERE id % 10 = 0)
    SELECT id, city, count(k) AS n FROM named LEFT JOIN keys ON k = upper(city) GROUP BY id, city"""
)
def st_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "city-counts")
    ledger = CounterLedger(f"{out}/ledger", uuid.uuid4().hex, f"{out}/checkpoint")
    dimension = _repeated_cities(spark)
    stream = feeds.replayed(spark, feeds.message_lines(spark, sf_dir), _n_events(spark, sf_dir), "messages")
    _finish(jobs.start_city_counts(stream, f"{out}/checkpoint", ledger, dimension, trigger=ALL_NOW))
    return jobs.city_totals(dimension, ledger.totals(spark))


def _repeated_cities(spark: SparkSession) -> DataFrame:
    """The cities, every tenth of them under a second id as well."""
    again = cities(spark).where("id % 10 = 0").select((F.col("id") + 1000).alias("id"), "city")
    return cities(spark).unionByName(again)


@registered(
    f"""
    WITH top AS ({_TOP_SQL})
    SELECT to_json(list(location ORDER BY location_count DESC, location))::VARCHAR AS label,
           to_json(list(location_count ORDER BY location_count DESC, location))::VARCHAR AS data
    FROM top"""
)
def st_dashboard_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "dashboard")
    ledger = CounterLedger(f"{out}/ledger", uuid.uuid4().hex, f"{out}/checkpoint")
    places = _place_stream(spark, sf_dir)
    query = jobs.start_persisted_counts(
        places, f"{out}/checkpoint", ledger, top=f"{out}/top", payloads=f"{out}/payload", trigger=ALL_NOW
    )
    _finish(query)
    return snapshots.as_json_fields(snapshots.last_batch(spark, f"{out}/payload"))


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT location, count(*) AS n FROM messages WHERE location IS NOT NULL AND NOT broken GROUP BY location"""
)
def st_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "archive")
    lines = feeds.message_lines(spark, sf_dir)
    stream = feeds.replayed(spark, lines, _n_events(spark, sf_dir), "messages")
    _finish(jobs.start_archive(stream, f"{out}/checkpoint", f"{out}/tweets", located_only=True, trigger=ALL_NOW))
    archived = stored_table(spark, "parquet", f"{out}/tweets")
    located = archived.select(stored_location(F.col("tweet")).alias("location"))
    return located.groupBy("location").agg(F.count(F.lit(1)).alias("n"))


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT location, count(*) AS n FROM messages WHERE location IS NOT NULL AND NOT broken GROUP BY location"""
)
def st_location_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "location-log")
    stream = feeds.replayed(spark, feeds.message_lines(spark, sf_dir), _n_events(spark, sf_dir), "messages")
    _finish(jobs.start_location_log(stream, f"{out}/checkpoint", f"{out}/locations", trigger=ALL_NOW))
    return spark.read.text(f"{out}/locations").groupBy(F.col("value").alias("location")).agg(F.count(F.lit(1)).alias("n"))


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT id, text, place, location FROM messages
    WHERE NOT broken AND ((lon BETWEEN -130 AND 100 AND lat BETWEEN -20 AND 50) OR contains(text, 'deprem error'))"""
)
def st_json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subscribed messages of the live feed, appended as JSON lines."""
    out = new_folder(spark, "message-log")
    stream = feeds.replayed(spark, feeds.message_lines(spark, sf_dir), _n_events(spark, sf_dir), "messages")
    wanted = subscribed(stream, subscription(term="deprem error"))
    _finish(jobs.start_message_log(wanted, f"{out}/checkpoint", f"{out}/messages", trigger=ALL_NOW))
    schema = "id STRING, text STRING, place STRING, location STRING"
    return stored_table(spark, "json", f"{out}/messages", schema=schema)

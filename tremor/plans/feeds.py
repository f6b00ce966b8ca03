"""Feeds derived from the test tables: places, messages, retail lines, and replayable line files.

Events play the messages; a user's nation is the place a message comes from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions.text import line_of, with_decimal_comma
from tremor.sources.cities import CITIES
from tremor.sources.streams import folder_lines
from tremor.sources.tables import table
from tremor.workspace import new_folder

REPLAY_BATCHES = 4


def user_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, c_mktsegment, place)``, one row per user."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", F.col("n_name").alias("place")
    )


def place_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(location)``, one row per event."""
    events = table(spark, sf_dir, "events").select("user_id")
    return events.join(user_places(spark, sf_dir), "user_id").select(F.col("place").alias("location"))


def place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(location, location_count)``.

    Events are counted per user before the join: the shuffle then carries one row per user
    and task, and a user with a large share of the events is an ordinary row.
    """
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    placed = per_user.join(user_places(spark, sf_dir), "user_id")
    return placed.groupBy(F.col("place").alias("location")).agg(F.sum("n").alias("location_count"))


def _home_city(user_id: Column) -> Column:
    """A city for users whose id modulo 97 is one of the 81 city numbers, else a foreign one."""
    names = F.array(*[F.lit(c) for c in CITIES])
    number = F.pmod(user_id, F.lit(97)).cast("int")
    return F.coalesce(F.get(names, number), F.lit("Berlin"))


def _written_location(user_id: Column, segment: Column) -> Column:
    """The home city in the spelling of the user's segment; NULL for one of the five."""
    city = _home_city(user_id)
    return (
        F.when(segment == "BUILDING", F.lit(None).cast("string"))
        .when(segment == "MACHINERY", F.upper(city))
        .when(segment == "AUTOMOBILE", F.concat(city, F.lit("/merkez, TR")))
        .when(segment == "FURNITURE", F.concat(city, F.lit(", TR")))
        .otherwise(city)
    )


# SQL of the message feed: (id, text, place, location, lon, lat, broken) with broken = cut-off JSON.
# Some ids are text or longer than 64 bits, and some users and places are not the objects expected.
MESSAGES_SQL = f"""
cities AS (
  SELECT * FROM (VALUES {", ".join(f"({n}, '{c}')" for n, c in enumerate(CITIES, start=1))}) AS t(id, city)),
homes AS (
  SELECT c_custkey, c_mktsegment, n_name, coalesce(city, 'Berlin') AS home
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN cities ON id = c_custkey % 97 + 1),
messages AS (
  SELECT CASE event_id % 11 WHEN 1 THEN 'm' || event_id WHEN 2 THEN event_id || '00000000000000000000'
              ELSE event_id::VARCHAR END AS id,
         '#deprem ' || event_type || '''s ' || props AS text,
         CASE WHEN event_type <> 'error' AND event_id % 17 <> 4 THEN n_name END AS place,
         CASE WHEN event_id % 7 <> 5 THEN (event_id * 37 % 360 - 180)::DOUBLE END AS lon,
         CASE WHEN event_id % 7 <> 5 THEN (event_id * 17 % 180 - 90)::DOUBLE END AS lat,
         CASE WHEN event_id % 13 = 3 OR c_mktsegment = 'BUILDING' THEN NULL ELSE CASE c_mktsegment WHEN 'MACHINERY' THEN upper(home)
              WHEN 'AUTOMOBILE' THEN home || '/merkez, TR' WHEN 'FURNITURE' THEN home || ', TR'
              ELSE home END END AS location,
         value < 1 AS broken
  FROM events JOIN homes ON user_id = c_custkey)
"""

PLACES_SQL = """
places AS (
  SELECT event_id, n_name AS location
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text, place, location, lon, lat, broken)``, one row per event, and ``event_id``."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    joined = events.join(user_places(spark, sf_dir), "user_id")
    event = F.col("event_id")
    number = event.cast("string")
    own_id = (
        F.when(event % 11 == 1, F.concat(F.lit("m"), number))
        .when(event % 11 == 2, F.concat(number, F.lit("0" * 20)))
        .otherwise(number)
    )
    placed = event % 7 != 5
    return joined.select(
        event,
        own_id.alias("id"),
        F.concat(F.lit("#deprem "), "event_type", F.lit("'s "), "props").alias("text"),
        F.when((F.col("event_type") != "error") & (event % 17 != 4), F.col("place")).alias("place"),
        F.when(event % 13 != 3, _written_location(F.col("user_id"), F.col("c_mktsegment"))).alias("location"),
        F.when(placed, (event * 37 % 360 - 180).cast("double")).alias("lon"),
        F.when(placed, (event * 17 % 180 - 90).cast("double")).alias("lat"),
        (F.col("value") < 1).alias("broken"),
    )


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: JSON messages, some of them odd in a field and some cut off.

    An id may be text or longer than 64 bits, a place null or a bare text, a user a bare text.
    """
    event = F.col("event_id")
    keep_nulls = {"ignoreNullFields": "false"}
    number = F.when(event % 11 == 1, F.concat(F.lit('"'), "id", F.lit('"'))).otherwise(F.col("id"))
    named = F.when(F.col("place").isNotNull(), F.to_json(F.struct(F.col("place").alias("name"))))
    place = F.when(event % 17 == 4, F.lit('"somewhere"')).otherwise(F.coalesce(named, F.lit("null")))
    user = F.when(event % 13 == 3, F.lit('"nobody"')).otherwise(F.to_json(F.struct("location"), keep_nulls))
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    where = F.when(F.col("lon").isNotNull(), point).otherwise(F.lit("null"))
    rest = F.to_json(F.struct("text", F.lit("tr").alias("lang")))
    json = F.concat(
        F.lit('{"id":'), number, F.lit(',"place":'), place, F.lit(',"user":'), user, F.lit(',"coordinates":'), where,
        F.lit(","), F.substr(rest, F.lit(2)),
    )
    json = F.when(F.col("broken"), F.substr(json, F.lit(1), F.length(json) - 3)).otherwise(json)
    return message_rows(spark, sf_dir).select(json.alias("value"))


def retail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the retail layout; cancelled invoices start with C, numbers have up to ten decimals.

    The stock code is unknown on every seventh line, the quantity on every sixth.
    """
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""), F.col("l_orderkey").cast("string")).alias(
            "InvoiceNo"
        ),
        F.when(line != 7, F.col("l_partkey").cast("string")).alias("StockCode"),
        F.concat(F.lit("LINE "), line.cast("string")).alias("Description"),
        F.when(line != 6, (F.col("l_quantity") + F.col("l_tax")).cast("decimal(28,10)").cast("string")).alias("Quantity"),
        F.col("l_shipdate").cast("date").cast("string").alias("InvoiceDate"),
        with_decimal_comma(price, 10).alias("UnitPrice"),
    )


# SQL of a retail row's quantity and price.
QUANTITY_SQL = "CASE WHEN l_linenumber <> 6 THEN l_quantity + l_tax END"
PRICE_SQL = "l_extendedprice * (1 - l_discount)"


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: the retail rows as ``;`` separated lines."""
    rows = retail_rows(spark, sf_dir)
    return rows.select(line_of(";", *rows.columns).alias("value"))


def order_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the order item layout: name, order, product, quantity, subtotal."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("item "), F.col("l_linenumber").cast("string")).alias("item_name"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_linenumber") != 6, F.col("l_quantity")).alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sub_total"),
    )


def judgement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, quality, revision)``: the labels, those of toxic documents corrected by a second revision.

    Most documents have none, so looking them up misses often.
    """
    labels = table(spark, sf_dir, "labels")
    first = labels.select("doc_id", "quality", F.lit(1).alias("revision"))
    second = labels.where("toxic = 1").select("doc_id", (F.col("quality") + 2).alias("quality"), F.lit(2).alias("revision"))
    return first.unionByName(second)


JUDGEMENTS_SQL = """
judgements AS (
  SELECT doc_id, quality, 1 AS revision FROM labels
  UNION ALL SELECT doc_id, quality + 2, 2 FROM labels WHERE toxic = 1)
"""


STEPS = 3
JITTER_MINUTES = 30
# SQL of the feed that arrives in steps, out of order: (event_id, user_id, location, us, step, mark), with the time in
# microseconds and the watermark (before its delay) that each step's rows find.
STEPS_SQL = f"""
timed AS (
  SELECT event_id, user_id, n_name AS location, epoch_us(ts) AS us,
         epoch_us(ts) + (event_id * 7919 % {2 * JITTER_MINUTES + 1} - {JITTER_MINUTES}) * 60000000 AS arrival
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
stepped AS (
  SELECT event_id, user_id, location, us,
         {" + ".join(f"(arrival >= low + (high - low) * {k} // {STEPS})::INT" for k in range(1, STEPS))} AS step
  FROM timed, span),
marks AS (SELECT s AS of_step, max(us) // 1000 * 1000 AS mark FROM stepped, range({STEPS + 1}) AS r(s) WHERE step < s GROUP BY s),
steps AS (SELECT stepped.*, coalesce(mark, 0) AS mark FROM stepped LEFT JOIN marks ON step = of_step),
final AS (SELECT mark AS closing FROM marks WHERE of_step = {STEPS})
"""


def instant(time: Column) -> tuple[Column, Column]:
    """A table's zoneless time, read as UTC: its microseconds since 1970, and the instant."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time.cast("timestamp_ntz"))
    return micros, F.timestamp_micros(micros)


def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, user_id, location, us, at, step)``, one row per event. The steps deal the events out in
    the order of their times, give or take half an hour, so that steps overlap in time."""
    micros, at = instant(F.col("ts"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", micros.alias("us"), at.alias("at"))
    span = events.agg(F.min("us").alias("low"), F.max("us").alias("high")).first()
    jitter = F.col("event_id") * 7919 % (2 * JITTER_MINUTES + 1) - JITTER_MINUTES
    arrival = F.col("us") + jitter * 60_000_000
    step = F.lit(0)
    for k in range(1, STEPS) if span.low is not None else ():
        step = step + F.when(arrival >= span.low + (span.high - span.low) * k // STEPS, 1).otherwise(0)
    placed = events.join(user_places(spark, sf_dir), "user_id")
    return placed.select("event_id", "user_id", F.col("place").alias("location"), "us", "at", step.alias("step"))


class Steps:
    """A feed that arrives step by step: each step's rows are written when a run gets to them, and read by
    that run in one batch. Every run has a copy of the feed."""

    def __init__(self, spark: SparkSession, rows: DataFrame, folder: str):
        self._spark = spark
        self._rows = rows
        self._folder = folder
        self._written: dict[str, int] = {}

    def streams(self, run: str = "feed", until: int = STEPS) -> Iterator[DataFrame]:
        """The run's stream once more for each further step, to be read to its end before the next."""
        own = self._rows.drop("step")
        folder = f"{self._folder}/{run}"
        for step in range(self._written.get(run, 0), until):
            self._rows.where(F.col("step") == step).drop("step").write.mode("append").parquet(folder)
            self._written[run] = step + 1
            yield self._spark.readStream.schema(own.schema).parquet(folder)


def replayed(spark: SparkSession, lines: DataFrame, rows: int, label: str) -> DataFrame:
    """A stream over ``lines`` (column ``value``), written to text files first and read in a few batches.

    The files keep the writing tasks' partitioning, cut further only where there are too few
    to make the batches; every batch reads its files in parallel.
    """
    folder = new_folder(spark, label)
    per_file = max(1, math.ceil(rows / (2 * REPLAY_BATCHES)))
    lines.write.option("maxRecordsPerFile", per_file).text(folder)
    files = lines.rdd.getNumPartitions() + 2 * REPLAY_BATCHES
    return folder_lines(spark, folder, files_per_trigger=math.ceil(files / REPLAY_BATCHES))

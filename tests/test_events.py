"""Streams by event time: late rows, restarts, repeats, and state that expires."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tremor.streaming import events

NOW = {"availableNow": True}
MINUTE = 60_000_000
#: Minutes of the feeds begin here: a watermark of 1970 itself leaves out what is not after it.
START = 600


def rows_frame(spark, rows):
    """``(event_id, location, at)`` from ``(event_id, location, minute)``."""
    rows = [(event, place, START + float(minute)) for event, place, minute in rows]
    frame = spark.createDataFrame(rows, "event_id bigint, location string, minute double")
    return frame.select("event_id", "location", F.timestamp_micros((F.col("minute") * MINUTE).cast("bigint")).alias("at"))


class Feed:
    """Rows given step by step; each step is a start of the job from its checkpoint."""

    def __init__(self, spark, folder, made, start=events.start_appended):
        self.spark, self.folder, self.made, self.start = spark, folder, made, start

    def give(self, rows):
        frame = rows_frame(self.spark, rows)
        frame.write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(frame.schema).parquet(f"{self.folder}/in")
        query = self.start(self.made(stream), f"{self.folder}/checkpoint", f"{self.folder}/out", NOW)
        query.awaitTermination()
        return query

    def rows(self):
        return self.spark.read.parquet(f"{self.folder}/out")


def episodes(feed):
    return sorted((r.location, r.start // MINUTE - START, r.end // MINUTE - START, r.n) for r in feed.rows().collect())


def held(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_windows_wait_for_the_watermark_and_drop_what_is_later(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: events.windowed_counts(s, "10 minutes", "5 minutes"))
    feed.give([(1, "a", 1), (2, "a", 9), (3, "b", 12)])
    assert feed.rows().count() == 0
    feed.give([(4, "a", 8), (5, "a", 16)])  # late, but within the delay; then the first windows close
    feed.give([(6, "a", 9.5), (7, "a", 14)])  # too late for the first window, in time for the second
    feed.give([(8, "c", 60)])
    found = Counter({(r.location, r.start // MINUTE - START): r.n for r in feed.rows().collect()})
    assert found == Counter({("a", 0): 3, ("a", 10): 2, ("b", 10): 1})


def test_window_counts_are_taken_before_the_shuffle(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id event_id", "if(id % 3 = 0, 'hot', 'p' || id) location", "timestamp_seconds(id) at")
    plan = events.windowed_counts(rows, "1 hour", "1 minute")._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "partial_count" in before and "Python" not in plan


def test_sessions_grow_together(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: events.session_counts(s, "10 minutes", "30 minutes"))
    feed.give([(1, "a", 0), (2, "a", 18)])
    feed.give([(3, "a", 9)])  # joins the two
    feed.give([(4, "a", 200)])
    assert episodes(feed) == [("a", 0, 18, 3)]


def test_episodes_merge_in_any_order():
    rng = random.Random(2)
    for _ in range(100):
        times = [rng.randint(0, 300) for _ in range(rng.randint(1, 40))]
        whole = events.merged([(t, t, 1) for t in times], 7)
        parts = [[] for _ in range(4)]
        for t in times:
            rng.choice(parts).append((t, t, 1))
        found = []
        for part in parts:
            found = events.merged(found + events.merged(part, 7), 7)
        assert found == whole and sum(n for *_, n in whole) == len(times)
        assert all(b[0] - a[1] > 7 for a, b in zip(whole, whole[1:], strict=False))


def test_a_silent_place_is_given_out_and_forgotten(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: events.idle_episodes(s, 600, "5 minutes"))
    feed.give([(1, "a", 0), (2, "a", 8), (3, "b", 1), (4, None, 2)])
    assert feed.rows().count() == 0
    feed.give([(5, "a", 17), (6, "b", 20), (7, "c", 16)])
    assert episodes(feed) == [("b", 1, 1, 1)]
    query = feed.give([(8, "z", 500)])
    assert episodes(feed) == [("a", 0, 17, 3), ("b", 1, 1, 1), ("b", 20, 20, 1), ("c", 16, 16, 1)]
    # One state row for the place that is left, and its timer's.
    assert held(query) <= 3


@pytest.mark.parametrize("steps", [1, 3])
def test_state_counts_go_on_after_restarts(spark, tmp_path, steps):
    places = ["hot"] * 60 + [f"p{k % 7}" for k in range(30)]
    random.Random(1).shuffle(places)
    feed = Feed(spark, tmp_path, events.state_counts, events.start_updated)
    for step in range(steps):
        feed.give([(k, p, 1.0) for k, p in enumerate(places[step::steps])])
    newest = feed.rows().groupBy("location").agg(F.max_by("location_count", "batch_id").alias("n")).collect()
    assert Counter({r.location: r.n for r in newest}) == Counter(places)


def test_a_frequent_place_reaches_the_state_as_a_row_per_task(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', 'p' || id % 50) location")
    counted = events.counted_by_task(rows.repartition(4))
    assert counted.where("location = 'hot'").count() <= 8
    assert counted.agg(F.sum("n")).first()[0] == 20_000


def test_repeats_count_once_and_keys_are_forgotten(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: events.without_repeats(s, "event_id", "30 minutes"))
    feed.give([(1, "a", 0), (1, "a", 0), (2, "b", 5), (None, "n", 6), (None, "n", 6)])
    feed.give([(1, "a", 0), (2, "b", 5), (3, "c", 20)])
    query = feed.give([(4, "d", 300)])
    assert sorted((r.location for r in feed.rows().collect())) == ["a", "b", "c", "d", "n"]
    assert held(query) == 1


def test_corrections_in_time(spark, tmp_path):
    def made(stream):
        fixes = stream.sparkSession.readStream.schema("event_id bigint, value string, corrected_at timestamp").parquet(f"{tmp_path}/fixes")
        return events.with_corrections(stream, fixes, "event_id", "10 MINUTES", "5 minutes")

    def fix(*rows):
        rows = [(event, value, START + float(minute)) for event, value, minute in rows]
        frame = spark.createDataFrame(rows, "event_id bigint, value string, minute double")
        at = F.timestamp_micros((F.col("minute") * MINUTE).cast("bigint")).alias("corrected_at")
        frame.select("event_id", "value", at).write.mode("append").parquet(f"{tmp_path}/fixes")

    feed = Feed(spark, tmp_path, made)
    fix((1, "x", 4), (2, "late", 30))
    feed.give([(1, "a", 0), (2, "b", 1), (3, "c", 2)])
    assert [tuple(r) for r in feed.rows().select("event_id", "corrected").collect()] == [(1, "x")]
    fix((3, "z", 3), (9, "none", 100))
    feed.give([(4, "d", 100)])
    query = feed.give([(5, "e", 101)])
    found = {r.event_id: r.corrected for r in feed.rows().collect()}
    assert found == {1: "x", 2: None, 3: "z"}
    assert held(query) <= 6


def test_empty_feed(spark, tmp_path):
    for k, made in enumerate([lambda s: events.idle_episodes(s, 60, "1 minute"), lambda s: events.windowed_counts(s, "1 minute", "1 minute")]):
        feed = Feed(spark, tmp_path / str(k), made)
        feed.give([])
        assert feed.rows().count() == 0

"""Streams by event time: windows, sessions, repeats, corrections, and state of one's own per place.

The watermark trails the latest event time by ``delay``. Rows that are later than that are dropped, state that no row can
reach any more is too, and results are appended once they can no longer change. Times are
those of column ``at``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tremor.streaming.jobs import EVERY_30_SECONDS, session_settings, start_copy
from tremor.streaming.snapshots import write_batch

#: What ``transformWithState`` needs: state beside the heap, saved by what changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def windowed_counts(rows: DataFrame, every: str, delay: str) -> DataFrame:
    """``(location, start, n)`` per place and window of ``every``; ``start`` in microseconds since 1970.

    Counts are taken per task before the shuffle, so a frequent place costs a row per task and window.
    """
    counts = rows.withWatermark("at", delay).groupBy(F.window("at", every), "location").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("location", F.unix_micros("window.start").alias("start"), "n")


def session_counts(rows: DataFrame, gap: str, delay: str) -> DataFrame:
    """``(location, start, end, n)`` per place and session, which ends when ``gap`` has passed without a row; ``end`` is
    the last row's time. Sessions are merged per task before the shuffle."""
    sessions = rows.withWatermark("at", delay).groupBy(F.session_window("at", gap), "location").agg(
        F.count(F.lit(1)).alias("n"), F.max("at").alias("last")
    )
    return sessions.select(
        "location", F.unix_micros("session_window.start").alias("start"), F.unix_micros("last").alias("end"), "n"
    )


def without_repeats(rows: DataFrame, key: str, delay: str) -> DataFrame:
    """The first row of each ``key``. A key is forgotten when the watermark is ``delay`` past its row, so
    a repeat that comes within that time is dropped whatever its own time."""
    return rows.withWatermark("at", delay).dropDuplicatesWithinWatermark([key])


def with_corrections(rows: DataFrame, corrections: DataFrame, key: str, within: str, delay: str) -> DataFrame:
    """``rows`` with ``corrected``, the value of a correction ``(key, value, corrected_at)`` that came at most
    ``within`` after the row, or NULL once the watermarks of both say that none can come any more."""
    left = rows.withWatermark("at", delay)
    right = corrections.select(F.col(key).alias("_key"), F.col("value").alias("corrected"), "corrected_at").withWatermark(
        "corrected_at", delay
    )
    in_time = F.col("corrected_at").between(F.col("at"), F.col("at") + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(key) == F.col("_key")) & in_time, "left").drop("_key", "corrected_at")


def counted_by_task(rows: DataFrame) -> DataFrame:
    """``(location, n)`` of each Arrow batch of rows: what a task sends on for a place is a few rows, however frequent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby("location", dropna=False, as_index=False).size().rename(columns={"size": "n"})

    return rows.select("location").mapInPandas(run, "location string, n bigint")


class RunningCounts(StatefulProcessor):
    """Adds ``(location, n)`` rows to the place's count, and gives the new one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self._count.get()[0] if self._count.exists() else 0
        now = before + sum(row.n for row in rows)
        self._count.update((now,))
        yield Row(location=key[0], location_count=now)

    def close(self) -> None:
        pass


def state_counts(rows: DataFrame) -> DataFrame:
    """``(location, location_count)`` of every place that a batch changes, by a state function that never forgets."""
    grouped = counted_by_task(rows).groupBy("location")
    return grouped.transformWithState(RunningCounts(), "location string, location_count bigint", "Update", "None")


def merged(episodes: list[tuple[int, int, int]], idle: int) -> list[tuple[int, int, int]]:
    """``(start, end, n)`` in order, those joined between which no more than ``idle`` passes."""
    result: list[tuple[int, int, int]] = []
    for start, end, n in sorted(episodes):
        if result and start - result[-1][1] <= idle:
            first, last, before = result[-1]
            result[-1] = first, max(last, end), before + n
        else:
            result.append((start, end, n))
    return result


def episodes_by_task(rows: DataFrame, idle: int) -> DataFrame:
    """``(location, at, start, end, n)``: each Arrow batch's rows, joined as ``merged`` would; ``at`` is the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch.sort_values(["location", "us"], ignore_index=True)
            apart = (own["location"] != own["location"].shift()) | (own["us"].diff() > idle)
            joined = own.groupby(apart.cumsum()).agg(
                location=("location", "first"), start=("us", "min"), end=("us", "max"), n=("us", "size")
            )
            yield joined[["location", "start", "end", "n"]]

    located = rows.where(F.col("location").isNotNull()).select("location", F.unix_micros("at").alias("us"))
    found = located.mapInPandas(run, "location string, start bigint, end bigint, n bigint")
    return found.withColumn("at", F.timestamp_micros("end"))


class Episodes(StatefulProcessor):
    """Holds a place's episodes until no row can join them any more, then gives them out and forgets them.

    A timer stands at the time the first of them ends; a place without episodes has no state.
    """

    def __init__(self, idle: int):
        self._idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "starts array<bigint>, ends array<bigint>, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        yield from self._settle(key, self._held() + [(r.start, r.end, r.n) for r in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        yield from self._settle(key, self._held(), timerValues)

    def _held(self) -> list[tuple[int, int, int]]:
        return list(zip(*self._open.get(), strict=True)) if self._open.exists() else []

    def _settle(self, key, episodes, timer_values) -> Iterator[Row]:
        now = 1000 * timer_values.getCurrentWatermarkInMs()
        episodes = merged(episodes, self._idle)
        open_ = [e for e in episodes if e[1] + self._idle > now]
        for start, end, n in episodes:
            if end + self._idle <= now:
                yield Row(location=key[0], start=start, end=end, n=n)
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if open_:
            self._open.update(tuple(list(v) for v in zip(*open_, strict=True)))
            self._handle.registerTimer(-(-(open_[0][1] + self._idle) // 1000))
        else:
            self._open.clear()

    def close(self) -> None:
        pass


def idle_episodes(rows: DataFrame, idle_seconds: int, delay: str) -> DataFrame:
    """``(location, start, end, n)``: a place's rows from one idle time to the next, given out, and the place's state
    dropped, once the watermark is ``idle_seconds`` past the last of them. Rows without a place are left out."""
    idle = idle_seconds * 1_000_000
    grouped = episodes_by_task(rows, idle).withWatermark("at", delay).groupBy("location")
    schema = "location string, start bigint, end bigint, n bigint"
    return grouped.transformWithState(Episodes(idle), schema, "Append", "EventTime")


def start_appended(rows: DataFrame, checkpoint: str, out: str, trigger: dict = EVERY_30_SECONDS) -> StreamingQuery:
    """Results of any of the above, appended to a Parquet table, each once, whatever restarts there are."""
    with session_settings(rows.sparkSession, STATE_STORE):
        return start_copy(rows, checkpoint, out, "parquet", trigger)


def start_updated(rows: DataFrame, checkpoint: str, out: str, trigger: dict = EVERY_30_SECONDS) -> StreamingQuery:
    """What each batch changes, as one folder per batch, which a replay replaces."""
    with session_settings(rows.sparkSession, STATE_STORE):
        writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(**trigger)
        return writer.foreachBatch(lambda batch, number: write_batch(batch, out, number)).start()

"""Streaming queries by event time. The feed arrives in steps that overlap in time; each step is a start from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.plans import feeds
from tremor.plans.registry import registered
from tremor.streaming import events, jobs
from tremor.streaming.ledger import DistinctLedger, TopLedger
from tremor.streaming.snapshots import last_batch, read_batches
from tremor.workspace import new_folder

ALL_NOW = {"availableNow": True}
#: A row may be this much later than the latest before it. Rows of the feed are late by up to an hour.
LENIENT, STRICT = "60 minutes", "20 minutes"
WINDOW_MINUTES, IDLE_MINUTES, LATEST_CORRECTION = 15, 20, 40

Made = Callable[[DataFrame], DataFrame]


def _appended(spark: SparkSession, rows: DataFrame, made: Made, label: str) -> DataFrame:
    out = new_folder(spark, label)
    for stream in feeds.Steps(spark, rows, f"{out}/feed").streams():
        query: StreamingQuery = events.start_appended(made(stream), f"{out}/checkpoint", f"{out}/rows", ALL_NOW)
        query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _minutes(delay: str) -> int:
    return int(delay.split()[0]) * 60_000_000


_WINDOWS_SQL = f"""
WITH {feeds.STEPS_SQL},
placed AS (SELECT *, us - us % {WINDOW_MINUTES * 60_000_000} AS start FROM steps),
kept AS (SELECT * FROM placed WHERE step = 0 OR start + {WINDOW_MINUTES * 60_000_000} > mark - {{delay}})
SELECT location, start, count(*) AS n FROM kept, final
WHERE start + {WINDOW_MINUTES * 60_000_000} <= closing - {{delay}} GROUP BY location, start, closing"""


@registered(_WINDOWS_SQL.format(delay=_minutes(LENIENT)))
def st_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per place and quarter of an hour, of the windows that are closed when the feed ends."""
    rows = feeds.event_steps(spark, sf_dir)
    every = f"{WINDOW_MINUTES} minutes"
    return _appended(spark, rows, lambda stream: events.windowed_counts(stream, every, LENIENT), "windows")


@registered(_WINDOWS_SQL.format(delay=_minutes(STRICT)))
def st_window_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a watermark that many rows of a step are too late for."""
    rows = feeds.event_steps(spark, sf_dir)
    every = f"{WINDOW_MINUTES} minutes"
    return _appended(spark, rows, lambda stream: events.windowed_counts(stream, every, STRICT), "late-windows")


_EPISODES_SQL = f"""
WITH {feeds.STEPS_SQL},
gaps AS (
  SELECT location, us, coalesce(us - lag(us) OVER w > {IDLE_MINUTES * 60_000_000}, TRUE)::INT AS apart
  FROM steps WINDOW w AS (PARTITION BY location ORDER BY us)),
episodes AS (SELECT location, us, sum(apart) OVER (PARTITION BY location ORDER BY us, apart DESC ROWS UNBOUNDED PRECEDING) AS e FROM gaps)
SELECT location, min(us) AS start, max(us) AS "end", count(*) AS n FROM episodes, final
GROUP BY location, e, closing HAVING max(us) + {IDLE_MINUTES * 60_000_000} <= closing - {_minutes(LENIENT)}"""


@registered(_EPISODES_SQL)
def st_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place's sessions, which end when it is silent for twenty minutes."""
    rows = feeds.event_steps(spark, sf_dir)
    gap = f"{IDLE_MINUTES} minutes"
    return _appended(spark, rows, lambda stream: events.session_counts(stream, gap, LENIENT), "sessions")


@registered(_EPISODES_SQL)
def st_idle_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a state function of one's own, whose timers drop the state of places that fall silent."""
    rows = feeds.event_steps(spark, sf_dir)
    return _appended(spark, rows, lambda stream: events.idle_episodes(stream, 60 * IDLE_MINUTES, LENIENT), "idle")


_COUNTS_SQL = f"WITH {feeds.STEPS_SQL} SELECT location, count(*) AS location_count FROM steps GROUP BY location"


@registered(_COUNTS_SQL)
def st_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts by a state function, stopped and started again for every step."""
    out = new_folder(spark, "state-counts")
    for stream in feeds.Steps(spark, feeds.event_steps(spark, sf_dir), f"{out}/feed").streams():
        events.start_updated(events.state_counts(stream), f"{out}/checkpoint", f"{out}/counts", ALL_NOW).awaitTermination()
    newest = F.max_by("location_count", "batch_id").alias("location_count")
    return read_batches(spark, f"{out}/counts").groupBy("location").agg(newest)


@registered(_COUNTS_SQL)
def st_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed twice, every row's repeat in its own step and, for rows of a step's last hours, in the next one, too."""
    rows = feeds.event_steps(spark, sf_dir)
    last = rows.groupBy(F.col("step").alias("_step")).agg(F.max("us").alias("until"))
    recent = rows.join(last, (F.col("step") == F.col("_step")) & (F.col("us") > F.col("until") - 3 * 3_600_000_000))
    again = recent.where(F.col("step") < feeds.STEPS - 1).select(*rows.drop("step").columns, (F.col("step") + 1).alias("step"))
    fed = rows.unionByName(rows).unionByName(again)
    found = _appended(spark, fed, lambda stream: events.without_repeats(stream, "event_id", "4 hours"), "deduplicated")
    return found.groupBy("location").agg(F.count(F.lit(1)).alias("location_count"))


@registered(
    f"""
    WITH {feeds.STEPS_SQL},
    fixes AS (
      SELECT event_id AS fixed, 'P' || event_id % 9 AS corrected FROM steps
      WHERE event_id % 3 = 0 AND event_id % 60 <= {LATEST_CORRECTION})
    SELECT event_id, location, corrected FROM steps LEFT JOIN fixes ON event_id = fixed, final
    WHERE corrected IS NOT NULL OR us < closing - 4 * 3600000000"""
)
def st_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its correction, if that came within forty minutes. A third of the events have one, up to an
    hour after them. Events without one are compared up to four hours before the end, when they are settled."""
    rows = feeds.event_steps(spark, sf_dir)
    micros = F.col("us") + F.col("event_id") % 60 * 60_000_000
    fixes = rows.where("event_id % 3 = 0").select(
        "event_id",
        F.concat(F.lit("P"), (F.col("event_id") % 9).cast("string")).alias("value"),
        F.timestamp_micros(micros).alias("corrected_at"),
        "step",
    )
    out = new_folder(spark, "corrections")
    within = f"{LATEST_CORRECTION} MINUTES"
    messages = feeds.Steps(spark, rows, f"{out}/feed").streams()
    corrections = feeds.Steps(spark, fixes, f"{out}/fixes").streams()
    for message, fix in zip(messages, corrections, strict=True):
        joined = events.with_corrections(message, fix, "event_id", within, "2 hours")
        events.start_appended(joined, f"{out}/checkpoint", f"{out}/rows", ALL_NOW).awaitTermination()
    settled = rows.agg(F.max("us")).first()[0] or 0
    found = spark.read.parquet(f"{out}/rows").select("event_id", "location", "corrected", "us")
    kept = F.col("corrected").isNotNull() | (F.col("us") < settled // 1000 * 1000 - 4 * 3_600_000_000)
    return found.where(kept).select("event_id", "location", "corrected")


@registered(
    f"""
    WITH {feeds.STEPS_SQL}
    SELECT location, count(DISTINCT user_id) AS n_users, TRUE AS near FROM steps GROUP BY location"""
)
def st_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different users per place by sketches of two runs over overlapping parts of the feed, beside the exact numbers:
    ``near`` says that the estimate is within four standard errors."""
    out = new_folder(spark, "distinct-users")
    rows = feeds.event_steps(spark, sf_dir)
    steps = feeds.Steps(spark, rows, f"{out}/feed")
    for run, until in (("one", 2), ("two", feeds.STEPS), ("one", feeds.STEPS)):
        ledger = DistinctLedger(f"{out}/ledger", run, f"{out}/checkpoint-{run}", fold_every=2)
        for stream in steps.streams(run, until):
            jobs.start_distinct_users(stream, f"{out}/checkpoint-{run}", ledger, ALL_NOW).awaitTermination()
    exact = rows.groupBy("location").agg(F.count_distinct("user_id").alias("n_users"))
    estimated = ledger.totals(spark).select(F.col("location").alias("_place"), F.col("n_users").alias("_estimate"))
    bound = 4 * 1.04 / 2 ** (ledger.lg_k / 2) * F.col("n_users") + 1
    near = F.abs(F.col("_estimate") - F.col("n_users")) <= bound
    joined = exact.join(estimated, F.col("location") == F.col("_place"), "left")
    return joined.select("location", "n_users", F.coalesce(near, F.lit(False)).alias("near"))


@registered(
    f"""
    WITH {feeds.STEPS_SQL}
    SELECT user_id::VARCHAR AS location, 2 * count(*) AS location_count FROM steps GROUP BY 1
    ORDER BY location_count DESC, location LIMIT 10"""
)
def st_topk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten busiest users of two runs, found by summaries of the leading ones and counted exactly."""
    out = new_folder(spark, "summary-top")
    rows = feeds.event_steps(spark, sf_dir).select(F.col("user_id").cast("string").alias("location"), "step")
    steps = feeds.Steps(spark, rows, f"{out}/feed")
    for run in ("one", "two"):
        ledger = TopLedger(f"{out}/ledger", run, f"{out}/checkpoint-{run}", fold_every=2, kept=400)
        for stream in steps.streams(run):
            query = jobs.start_persisted_counts(stream, f"{out}/checkpoint-{run}", ledger, top=f"{out}/top-{run}", trigger=ALL_NOW)
            query.awaitTermination()
    return last_batch(spark, f"{out}/top-two")

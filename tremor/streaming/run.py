"""Command line for the streaming jobs.

    spark-submit tremor/streaming/run.py persisted --source kafka --option subscribe=messages \\
        --option kafka.bootstrap.servers=host:9092 --format json --run-id 2020-01 \\
        --checkpoint /shared/checkpoint --out /shared/impact
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.functions.messages import (
    FEED_BOX,
    FEED_LANGUAGE,
    FEED_TERM,
    messages_with_place,
    subscribed,
    subscription,
    tagged_places,
)
from tremor.sources.cities import cities
from tremor.sources.streams import folder_lines, kafka_lines, socket_lines
from tremor.streaming import jobs
from tremor.streaming.ledger import CounterLedger

JOBS = ("running", "persisted", "cities", "batch", "copy", "archive", "locations", "messages")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run a streaming job over a line feed.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--source", choices=("folder", "socket", "kafka"), default="folder")
    parser.add_argument("--path", help="folder to read")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="source option")
    parser.add_argument("--format", choices=("place", "tagged", "json"), default="place", help="what a line holds")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--run-id", help="names this checkpoint's run in the ledger (jobs persisted, cities)")
    parser.add_argument("--top", type=int, default=10)
    parser.add_argument("--seconds", type=int, default=30, help="time between batches")
    parser.add_argument(
        "--state-partitions", type=int, help="tasks that hold the counts (job running); the session's shuffle setting"
    )
    parser.add_argument("--top-only", action="store_true", help="store the top, not all counts (job running)")
    parser.add_argument("--subscribe", action="store_true", help="keep JSON messages in the language and box or with the term")
    parser.add_argument("--language", default=FEED_LANGUAGE)
    parser.add_argument("--box", type=float, nargs=4, default=FEED_BOX, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    parser.add_argument("--term", default=FEED_TERM)
    parser.add_argument("--turkish", action="store_true", help="keep dotted and dotless i apart (job cities)")
    parser.add_argument("--located-only", action="store_true", help="messages with a location alone (job archive)")
    parser.add_argument("--clean-quotes", action="store_true", help="quotes become blanks (job archive)")
    parser.add_argument("--position", type=int, default=1, help="field to count, from 0 (job batch)")
    parser.add_argument("--sep", default=";", help="between the fields (job batch)")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    return parser.parse_args(argv)


def lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = dict(option.split("=", 1) for option in args.option)
    if args.source == "folder":
        feed = folder_lines(spark, args.path, **options)
    elif args.source == "socket":
        feed = socket_lines(spark, options.pop("host"), int(options.pop("port")), **options)
    else:
        feed = kafka_lines(spark, **options)
    return subscribed(feed, subscription(args.language, tuple(args.box), args.term)) if args.subscribe else feed


def places(feed: DataFrame, form: str) -> DataFrame:
    """``(location)`` rows of a feed of lines."""
    if form == "tagged":
        return tagged_places(feed)
    if form == "json":
        return messages_with_place(feed).select(F.col("place").alias("location"))
    return feed.select(F.col("value").alias("location"))


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    feed = lines(spark, args)
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.seconds} seconds"}
    if args.job == "running":
        return jobs.start_running_counts(
            places(feed, args.format), args.checkpoint, None if args.top_only else f"{args.out}/counts",
            f"{args.out}/top", f"{args.out}/payload", args.top, trigger, args.state_partitions,
        )
    if args.job in ("persisted", "cities"):
        if not args.run_id:
            raise SystemExit(f"job {args.job} needs --run-id")
        ledger = CounterLedger(f"{args.out}/ledger", args.run_id, args.checkpoint)
        if args.job == "cities":
            return jobs.start_city_counts(feed, args.checkpoint, ledger, cities(spark), trigger, args.turkish)
        return jobs.start_persisted_counts(
            places(feed, args.format), args.checkpoint, ledger,
            f"{args.out}/top", f"{args.out}/payload", args.top, trigger,
        )
    if args.job == "batch":
        return jobs.start_batch_counts(
            feed, args.checkpoint, f"{args.out}/counts", args.position, args.sep, trigger=trigger
        )
    if args.job == "copy":
        return jobs.start_copy(feed, args.checkpoint, f"{args.out}/lines", trigger=trigger)
    if args.job == "archive":
        return jobs.start_archive(
            feed, args.checkpoint, f"{args.out}/tweets", args.located_only, args.clean_quotes, trigger=trigger
        )
    if args.job == "messages":
        return jobs.start_message_log(feed, args.checkpoint, f"{args.out}/messages", trigger=trigger)
    return jobs.start_location_log(feed, args.checkpoint, f"{args.out}/locations", trigger=trigger)


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"tremor-{args.job}").getOrCreate()
    start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()

"""The command line starts each job on each line format."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tremor.functions.messages import tagged_line
from tremor.streaming import run, snapshots
from tremor.streaming.ledger import CounterLedger

FEED = ["Ankara", "Van", "Ankara", "Kars"]


def as_lines(spark, form):
    if form == "place":
        return FEED
    if form == "json":
        return [json.dumps({"text": "x", "place": {"name": p}}) for p in FEED] + ['{"text":"x","place":null}', "{"]
    df = spark.createDataFrame([(p,) for p in FEED], "p STRING")
    return [r.line for r in df.select(tagged_line(F.lit("x"), F.col("p")).alias("line")).collect()]


@pytest.mark.parametrize("form", ["place", "json", "tagged"])
def test_persisted(spark, tmp_path, form):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "feed.txt").write_text("\n".join(as_lines(spark, form)) + "\n", encoding="utf-8")
    out = str(tmp_path / "out")
    args = run.arguments(
        ["persisted", "--path", str(tmp_path / "in"), "--format", form, "--checkpoint", str(tmp_path / "ck"),
         "--out", out, "--run-id", "r1", "--top", "1", "--once"]
    )
    run.start(spark, args).awaitTermination()
    totals = CounterLedger(f"{out}/ledger", "r1", str(tmp_path / "ck")).totals(spark).collect()
    assert {r.location: r.location_count for r in totals} == {"Ankara": 2, "Van": 1, "Kars": 1}
    assert snapshots.last_batch(spark, f"{out}/payload").first().label == ["Ankara"]


@pytest.mark.parametrize(
    "job,table,column", [("running", "top", "location"), ("copy", "lines", "value"), ("archive", "tweets", "tweet")]
)
def test_other_jobs(spark, tmp_path, job, table, column):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "feed.txt").write_text("Ankara\nAnkara\n", encoding="utf-8")
    paths = ["--path", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "ck"), "--out", str(tmp_path / "out")]
    args = run.arguments([job, *paths, "--once"])
    run.start(spark, args).awaitTermination()
    path = f"{tmp_path}/out/{table}"
    rows = spark.read.text(path) if job == "copy" else spark.read.parquet(path)
    assert {r[column] for r in rows.collect()} == {"Ankara"}


def test_run_id_is_required(spark, tmp_path):
    args = run.arguments(["persisted", "--path", str(tmp_path), "--checkpoint", "c", "--out", "o"])
    with pytest.raises(SystemExit):
        run.start(spark, args)

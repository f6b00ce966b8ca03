"""Streaming jobs: equal to batch whatever the split, and unchanged by restarts and replays."""

from __future__ import annotations

import json
import os
import random
import uuid
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tremor.sources.cities import cities
from tremor.sources.streams import folder_lines
from tremor.sources.tables import stored_table
from tremor.streaming import jobs, snapshots
from tremor.streaming.ledger import CounterLedger, DistinctLedger, TopLedger
from tremor.streaming.small_files import SmallFiles

NOW = {"availableNow": True}
FEED = ["Ankara", "İzmir", "Ankara", "Van", "Ankara", "İzmir", "Bursa", "Ankara", "Van", "Ankara", "Kars", "Van"]
TOTALS = Counter(FEED)


def write_files(folder, parts, start=0):
    folder.mkdir(exist_ok=True)
    for n, part in enumerate(parts, start=start):
        path = folder / f"part-{n:03d}.txt"
        path.write_text("".join(f"{line}\n" for line in part), encoding="utf-8")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def split(rows, n):
    return [rows[i::n] for i in range(n)]


def places(spark, folder):
    return folder_lines(spark, str(folder), files_per_trigger=1).select(F.col("value").alias("location"))


def finish(query):
    query.awaitTermination()


def as_counter(df):
    return Counter({r.location: r.location_count for r in df.collect()})


@pytest.mark.parametrize("n_files", [1, 3, 5])
def test_running_counts_equal_batch_counts(spark, tmp_path, n_files):
    write_files(tmp_path / "in", split(FEED, n_files))
    out = str(tmp_path / "counts")
    finish(jobs.start_running_counts(places(spark, tmp_path / "in"), str(tmp_path / "ck"), out, trigger=NOW))
    assert as_counter(snapshots.last_batch(spark, out)) == TOTALS
    per_batch = snapshots.read_batches(spark, out).groupBy("batch_id").agg(F.sum("location_count").alias("n")).collect()
    seen = 0
    for batch, part in enumerate(split(FEED, n_files)):
        seen += len(part)
        assert {r.batch_id: r.n for r in per_batch}[batch] == seen


def test_newest_batch_is_found_without_its_name(spark, tmp_path):
    root = str(tmp_path / "table")
    for batch in (0, 1, 10, 2):
        snapshots.write_batch(spark.createDataFrame([(f"p{batch}",)], "location STRING"), root, batch)
    assert snapshots.last_batch(spark, root).first().location == "p2"  # named by whoever wrote last
    os.rename(f"{root}_newest", f"{root}_lost")
    assert snapshots.last_batch(spark, root).first().location == "p10"


def test_running_counts_resume_from_their_checkpoint(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED[:6], 2))
    out, checkpoint = str(tmp_path / "counts"), str(tmp_path / "ck")
    finish(jobs.start_running_counts(places(spark, tmp_path / "in"), checkpoint, out, trigger=NOW))
    write_files(tmp_path / "in", split(FEED[6:], 2), start=2)
    finish(jobs.start_running_counts(places(spark, tmp_path / "in"), checkpoint, out, trigger=NOW))
    assert as_counter(snapshots.last_batch(spark, out)) == TOTALS


def test_state_partitions_are_the_query_s_own(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED, 1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    feed = places(spark, tmp_path / "in")
    out = str(tmp_path / "counts")
    finish(jobs.start_running_counts(feed, str(tmp_path / "ck"), out, trigger=NOW, state_partitions=2))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "2"
    assert sorted(p.name for p in (tmp_path / "ck" / "state" / "0").iterdir() if p.name.isdigit()) == ["0", "1"]
    assert as_counter(snapshots.last_batch(spark, out)) == TOTALS


def test_state_top_and_payload(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED, 2))
    out = tmp_path / "out"
    feed = places(spark, tmp_path / "in")
    query = jobs.start_running_counts(
        feed, str(tmp_path / "ck"), f"{out}/counts", f"{out}/top", f"{out}/payload", k=3, trigger=NOW
    )
    finish(query)
    assert as_counter(snapshots.last_batch(spark, f"{out}/top")) == Counter({"Ankara": 5, "Van": 3, "İzmir": 2})
    payload = snapshots.last_batch(spark, f"{out}/payload")
    assert [tuple(r) for r in payload.collect()] == [(["Ankara", "Van", "İzmir"], [5, 3, 2])]
    fields = snapshots.as_json_fields(payload).first()
    assert (json.loads(fields.label), json.loads(fields.data)) == (["Ankara", "Van", "İzmir"], [5, 3, 2])


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_ledger_totals_and_persisted_top(spark, tmp_path, fold_every):
    write_files(tmp_path / "in", split(FEED, 5))
    out = tmp_path / "out"
    ledger = CounterLedger(f"{out}/ledger", "first", str(tmp_path / "ck"), fold_every)
    query = jobs.start_persisted_counts(
        places(spark, tmp_path / "in"), str(tmp_path / "ck"), ledger, f"{out}/top", f"{out}/payload", k=2, trigger=NOW
    )
    finish(query)
    assert as_counter(ledger.totals(spark)) == TOTALS
    for batch in range(5):
        so_far = Counter(line for part in split(FEED, 5)[: batch + 1] for line in part)
        assert as_counter(ledger.totals_at(spark, batch)) == so_far
    assert as_counter(snapshots.last_batch(spark, f"{out}/top")) == Counter({"Ankara": 5, "Van": 3})
    assert snapshots.last_batch(spark, f"{out}/payload").first().label == ["Ankara", "Van"]


def test_runs_write_in_any_order(spark, tmp_path):
    """Three runs over the same feed take turns; the first goes on after later ones have begun and ended."""
    root, folder = str(tmp_path / "ledger"), tmp_path / "in"
    batches = split(FEED, 6)
    expected, ledgers = Counter(), {}

    def go_on(run, step):
        ledger = ledgers[run] = CounterLedger(root, run, str(tmp_path / run), fold_every=2 if run == "a" else 3)
        write_files(folder / run, [batches[step]], start=step)
        finish(jobs.start_persisted_counts(places(spark, folder / run), str(tmp_path / run), ledger, trigger=NOW))
        expected.update(batches[step])

    folder.mkdir()
    steps = Counter()
    for run in "abaacbabacba":
        go_on(run, steps[run])
        steps[run] += 1
        for ledger in ledgers.values():
            assert as_counter(ledger.totals(spark)) == expected
        assert as_counter(ledgers[run].totals_at(spark, steps[run] - 1)) == expected
    with pytest.raises(ValueError, match="fold_every"):
        CounterLedger(root, "a", str(tmp_path / "a"), fold_every=9).record(spark.createDataFrame([("x",)], "location string"), 9)


def test_distinct_users_of_overlapping_runs(spark, tmp_path):
    root = str(tmp_path / "ledger")
    rows = lambda low, high: spark.range(low, high).selectExpr("if(id % 2 = 0, 'even', 'odd') location", "id AS user_id")
    one, two = (DistinctLedger(root, run, run, fold_every=2) for run in ("one", "two"))
    for batch, (low, high) in enumerate([(0, 6000), (3000, 9000), (0, 9000)]):
        one.record(rows(low, high), batch)
    two.record(rows(5000, 20_000).unionByName(spark.createDataFrame([("even", None), ("none", None)], "location string, user_id bigint")), 0)
    one.record(rows(0, 10), 3)
    found = {r.location: r.n_users for r in two.totals(spark).collect()}
    assert found.pop("none") == 0
    assert found.keys() == {"even", "odd"} and all(abs(n - 10_000) < 4 * 0.0163 * 10_000 for n in found.values())
    again = {r.location: r.n_users for r in one.totals(spark).collect()}
    assert again == {**found, "none": 0}


@pytest.mark.parametrize("kept", [3, 12, 1000])
def test_top_by_summaries_is_exact(spark, tmp_path, kept):
    """However few places the summaries keep: where they cannot tell, all totals are read."""
    rng = random.Random(kept)
    draw = lambda: [rng.choice(["hot", "hot", "warm", "warm2", None, *(f"p{n}" for n in range(40))]) for _ in range(200)]
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "location string")
    root, counts = str(tmp_path / "ledger"), Counter()
    one, two = (TopLedger(root, run, run, fold_every=2, kept=kept) for run in ("one", "two"))
    for ledger, batch in ((one, 0), (two, 0), (one, 1), (one, 1), (two, 1)):
        names = draw() if (ledger, batch) != (one, 1) or not counts["done"] else []
        ledger.record(frame(names), batch)
        counts.update(n if n else "none" for n in names)
        counts["done"] += (ledger, batch) == (one, 1)
    del counts["done"]
    found = two.top_at(spark, 1, 4).collect()
    expected = sorted(((n, -c) for n, c in counts.items()), key=lambda x: (x[1], "" if x[0] == "none" else x[0]))[:4]
    assert [(r.location or "none", -r.location_count) for r in found] == expected
    sizes = [spark.read.parquet(f"{root}/leaders/run_id={run}/batch_id={b}").count() for run in ("one", "two") for b in (0, 1)]
    assert max(sizes) <= kept
    plain = CounterLedger.top_at(two, spark, 1, 4).collect()
    assert plain == found


def test_a_batch_counts_from_its_commit(spark, tmp_path):
    """A fold that failed half way is written anew for the version it began with."""
    root = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("x",), ("y",)], "location string")
    one, two = (CounterLedger(root, run, run, fold_every=2) for run in ("one", "two"))
    one.record(rows, 0)
    commit = SmallFiles.write

    def failing(self, path, text):
        if "/commits/one/1" in path:
            raise OSError("lost")
        commit(self, path, text)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(SmallFiles, "write", failing)
        with pytest.raises(OSError, match="lost"):
            one.record(rows, 1)
    assert as_counter(one.totals(spark)) == Counter(x=1, y=1)
    two.record(rows, 0)
    one.record(rows, 1)
    one.record(rows, 1)
    for ledger in (one, two):
        assert as_counter(ledger.totals(spark)) == Counter(x=3, y=3)
    assert as_counter(one.totals_at(spark, 1)) == Counter(x=2, y=2)
    assert as_counter(two.totals_at(spark, 0)) == Counter(x=2, y=2)
    assert not [n for n in SmallFiles(spark).names(f"{root}/commits/one") if n.endswith(".tmp")]


def test_ledger_ignores_replays_and_adds_runs(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED, 3))
    root = str(tmp_path / "ledger")
    first = CounterLedger(root, "first", str(tmp_path / "ck1"), fold_every=2)

    def run(ledger, checkpoint):
        feed = places(spark, tmp_path / "in")
        finish(jobs.start_persisted_counts(feed, str(tmp_path / checkpoint), ledger, trigger=NOW))

    run(first, "ck1")
    for batch, part in enumerate(split(FEED, 3)):
        first.record(spark.createDataFrame([(p,) for p in part], "location STRING"), batch)
    assert as_counter(first.totals(spark)) == TOTALS
    run(first, "ck1")  # nothing new
    assert as_counter(first.totals(spark)) == TOTALS
    second = CounterLedger(root, "second", str(tmp_path / "ck2"), fold_every=2)
    run(second, "ck2")
    doubled = Counter({k: 2 * n for k, n in TOTALS.items()})
    assert as_counter(second.totals(spark)) == doubled
    assert as_counter(second.totals_at(spark, 2)) == doubled


def test_failed_batch_is_retried_without_double_counting(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED, 3))
    out = tmp_path / "out"

    class Failing(CounterLedger):
        fail = True

        def record(self, batch, batch_id):
            super().record(batch, batch_id)
            if batch_id == 1 and self.fail:
                raise RuntimeError("lost after the write")

    ledger = Failing(f"{out}/ledger", "run", str(tmp_path / "ck"), fold_every=2)

    def start():
        feed = places(spark, tmp_path / "in")
        return jobs.start_persisted_counts(feed, str(tmp_path / "ck"), ledger, f"{out}/top", trigger=NOW)

    with pytest.raises(Exception, match="lost after the write"):
        finish(start())
    ledger.fail = False
    finish(start())
    assert as_counter(ledger.totals(spark)) == TOTALS
    assert as_counter(snapshots.last_batch(spark, f"{out}/top")) == TOTALS


def test_batch_counts_stand_alone(spark, tmp_path):
    parts = split(FEED, 3)
    write_files(tmp_path / "in", [[f"u;{p};tr" for p in part] for part in parts])
    out = str(tmp_path / "counts")
    lines = folder_lines(spark, str(tmp_path / "in"), files_per_trigger=1)
    finish(jobs.start_batch_counts(lines, str(tmp_path / "ck"), out, trigger=NOW))
    rows = snapshots.read_batches(spark, out).collect()
    for batch, part in enumerate(parts):
        assert Counter({r.location: r.location_count for r in rows if r.batch_id == batch}) == Counter(part)


def test_copy_archive_and_location_log(spark, tmp_path):
    message = lambda n, location: json.dumps({"id": n, "text": "it's", "user": {"location": location}})
    raw = [message(1, "Malatya"), message(2, None), message(3, "Van, TR")]
    write_files(tmp_path / "in", split(raw, 2))
    lines = lambda: folder_lines(spark, str(tmp_path / "in"), files_per_trigger=1)
    out = tmp_path / "out"
    finish(jobs.start_copy(lines(), str(tmp_path / "ck1"), f"{out}/copy", trigger=NOW))
    assert sorted(r.value for r in spark.read.text(f"{out}/copy").collect()) == sorted(raw)
    finish(jobs.start_archive(lines(), str(tmp_path / "ck2"), f"{out}/all", trigger=NOW))
    assert sorted(r.tweet for r in stored_table(spark, path=f"{out}/all").collect()) == sorted(raw)
    located = {"located_only": True, "clean_quotes": True}
    finish(jobs.start_archive(lines(), str(tmp_path / "ck3"), f"{out}/located", **located, trigger=NOW))
    kept = sorted(r.tweet for r in stored_table(spark, path=f"{out}/located").collect())
    assert kept == sorted(m.replace("'", " ") for m in (raw[0], raw[2]))
    finish(jobs.start_location_log(lines(), str(tmp_path / "ck4"), f"{out}/log", trigger=NOW))
    assert sorted(r.value for r in spark.read.text(f"{out}/log").collect()) == ["Malatya", "Van, TR"]


def test_city_counts(spark, tmp_path):
    located = ["Ankara, TR", "ankara", "VAN", "Ank", None, "Paris", "Van,x"]
    raw = [json.dumps({"id": n, "text": "t", "user": {"location": place}}) for n, place in enumerate(located)]
    write_files(tmp_path / "in", split([*raw, "{broken"], 2))
    ledger = CounterLedger(str(tmp_path / "ledger"), "run", str(tmp_path / "ck"))
    lines = folder_lines(spark, str(tmp_path / "in"), files_per_trigger=1)
    finish(jobs.start_city_counts(lines, str(tmp_path / "ck"), ledger, cities(spark), trigger=NOW))
    assert as_counter(ledger.totals(spark)) == Counter({"ANKARA": 2, "VAN": 2})
    rows = jobs.city_totals(cities(spark), ledger.totals(spark)).collect()
    assert len(rows) == 81 and sum(r.n for r in rows) == 4


def test_city_counts_of_a_repeated_name_in_turkish(spark, tmp_path):
    raw = [json.dumps({"user": {"location": place}}) for place in ("izmir", "İZMİR", "ısparta")]
    write_files(tmp_path / "in", [raw])
    dimension = spark.createDataFrame([(1, "İzmir"), (2, "İzmir"), (3, "Isparta"), (4, "Van")], "id INT, city STRING")
    ledger = CounterLedger(str(tmp_path / "ledger"), "run", str(tmp_path / "ck"))
    lines = folder_lines(spark, str(tmp_path / "in"))
    finish(jobs.start_city_counts(lines, str(tmp_path / "ck"), ledger, dimension, trigger=NOW, turkish=True))
    totals = jobs.city_totals(dimension, ledger.totals(spark), turkish=True).collect()
    assert {r.id: r.n for r in totals} == {1: 2, 2: 2, 3: 1, 4: 0}


def test_a_run_id_cannot_be_reused_with_another_checkpoint(spark, tmp_path):
    write_files(tmp_path / "in", split(FEED, 2))
    root = str(tmp_path / "ledger")
    ledger = CounterLedger(root, "r", str(tmp_path / "ck1"))
    finish(jobs.start_persisted_counts(places(spark, tmp_path / "in"), str(tmp_path / "ck1"), ledger, trigger=NOW))
    other = CounterLedger(root, "r", str(tmp_path / "ck2"))
    with pytest.raises(Exception, match="another checkpoint"):
        finish(jobs.start_persisted_counts(places(spark, tmp_path / "in"), str(tmp_path / "ck2"), other, trigger=NOW))
    assert as_counter(ledger.totals(spark)) == TOTALS
    rows = spark.createDataFrame([("Van",)], "location STRING")
    with pytest.raises(ValueError, match="another checkpoint"):
        CounterLedger(root, "r", "elsewhere").record(rows, 0)


def test_a_cluster_needs_a_shared_folder():
    from tremor.workspace import shared_root

    def session(master, folder):
        context = SimpleNamespace(master=master, applicationId="none")
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)

    assert shared_root(session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("spark://host:7077", None))


def test_shared_folder_comes_from_the_session(spark):
    from tremor.workspace import new_folder, shared_root

    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root.rstrip("/")
    assert new_folder(spark, "x").startswith(root) and new_folder(spark, "x") != new_folder(spark, "x")
    assert uuid.UUID(new_folder(spark, "x").rsplit("-", 1)[1])

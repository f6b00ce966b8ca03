"""Persisted totals per place that survive restarts, replays and several writers."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.ranking import top_k
from tremor.streaming.small_files import SmallFiles

#: The last committed batch of each run.
Version = dict[str, int]


class CounterLedger:
    """Counts per place, run and batch; a place's total is the sum of its counts over all runs.

    ``run_id`` belongs to one checkpoint: keep it (and ``fold_every``) when resuming, and take a new
    one with a fresh checkpoint, whose batch ids start at 0 again. The ledger notes the checkpoint's
    own id with the run and refuses any other.

    Every run writes to folders of its own only, so any number of them may write, in turn or at a time, and
    an older run may go on after a newer one has begun. A batch counts from its commit on: a small file,
    written last, that holds the version the batch saw, that is, every run's last committed batch. What is
    committed never changes. A batch that is replayed after its commit adds nothing, and one that failed
    before is written anew.

    Totals of a version are a fold, the totals of an earlier version, and the batches since. A run folds
    before its first batch and after every ``fold_every``; so a reader opens about that many folders of
    each run that writes at the time, and none of runs that ended before.
    """

    #: What a batch adds to a place. ``_measured``, ``_merged`` and ``_shown`` go with it.
    SCHEMA = "location STRING, delta BIGINT"

    def __init__(self, root: str, run_id: str, checkpoint: str, fold_every: int = 100):
        self.root = root
        self.run_id = run_id
        self.checkpoint = checkpoint
        self.fold_every = fold_every
        self._owned = False

    def record(self, batch: DataFrame, batch_id: int) -> None:
        """Store the batch's own counts. ``batch`` has a ``location`` column."""
        spark = batch.sparkSession
        files = SmallFiles(spark)
        self._claim(spark, files)
        if files.exists(self._commit(self.run_id, batch_id)):
            return
        if batch_id == 0:
            self._fold(spark, files, -1, self._others(files))
        self._measured(batch).write.mode("overwrite").parquet(self._deltas(self.run_id, batch_id))
        seen = {**self._others(files), self.run_id: batch_id}
        if (batch_id + 1) % self.fold_every == 0:
            seen = self._fold(spark, files, batch_id, seen)
        files.write(self._commit(self.run_id, batch_id), json.dumps(seen, sort_keys=True))

    def totals_at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``(location, location_count)`` of the version that a batch of this run saw, however far others are now."""
        files = SmallFiles(spark)
        version = json.loads(files.read(self._commit(self.run_id, batch_id)))
        last = self._last_fold(files, self.run_id, batch_id)
        return self._shown(self._since(spark, version, self.run_id, last, self._folded(files, self.run_id, last)))

    def totals(self, spark: SparkSession) -> DataFrame:
        """``(location, location_count)`` of all batches that any run has committed by now."""
        files = SmallFiles(spark)
        version = self._newest(files)
        if not version:
            return self._shown(spark.createDataFrame([], self.SCHEMA))
        return self._shown(self._since(spark, version, *self._nearest_fold(files, version)))

    def top_at(self, spark: SparkSession, batch_id: int, k: int) -> DataFrame:
        """The first ``k`` of ``totals_at`` by count, then by name."""
        return top_k(self.totals_at(spark, batch_id), "location_count", k, "location")

    def _nearest_fold(self, files: SmallFiles, version: Version, own: int | None = None) -> tuple[str, int, Version]:
        """The fold that lacks the fewest batches of the version: its run, batch and own version.

        ``own`` is this run's last committed batch where the version is ahead of it.
        """
        folds = []
        for run, newest in version.items():
            committed = newest if own is None or run != self.run_id else own
            last = self._last_fold(files, run, committed)
            fold = self._folded(files, run, last)
            if all(batch <= version.get(r, -1) for r, batch in fold.items()):
                folds.append((sum(version[r] - fold.get(r, -1) for r in version), run, last, fold))
        return min(folds, key=lambda f: f[:3])[1:]

    def _measured(self, batch: DataFrame) -> DataFrame:
        return batch.groupBy("location").agg(F.count(F.lit(1)).alias("delta"))

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("location").agg(F.sum("delta").alias("delta"))

    def _shown(self, rows: DataFrame) -> DataFrame:
        return self._merged(rows).withColumnRenamed("delta", "location_count")

    def _claim(self, spark: SparkSession, files: SmallFiles) -> None:
        """Binds the run to the checkpoint, or fails if it is bound to another."""
        if self._owned:
            return
        own = {"owner": _checkpoint_id(spark, self.checkpoint), "fold_every": self.fold_every}
        path = f"{self.root}/runs/{self.run_id}"
        files.write(path, json.dumps(own))
        held = json.loads(files.read(path))
        if held["owner"] != own["owner"]:
            raise ValueError(f"run {self.run_id} belongs to another checkpoint; take a new run id")
        if held["fold_every"] != self.fold_every:
            raise ValueError(f"run {self.run_id} began with fold_every={held['fold_every']}; keep it")
        self._owned = True

    def _last_fold(self, files: SmallFiles, run: str, batch: int) -> int:
        """The batch of a run through which its last fold before or at a batch goes; -1 before all."""
        every = self.fold_every
        if run != self.run_id:
            every = json.loads(files.read(f"{self.root}/runs/{run}"))["fold_every"]
        return batch - (batch + 1) % every

    def _newest(self, files: SmallFiles) -> Version:
        found = {run: self._last_commit(files, run) for run in files.names(f"{self.root}/runs")}
        return {run: batch for run, batch in found.items() if batch >= 0}

    def _others(self, files: SmallFiles) -> Version:
        return {run: batch for run, batch in self._newest(files).items() if run != self.run_id}

    def _last_commit(self, files: SmallFiles, run: str) -> int:
        """Batches are committed without gaps, so a search in doubling steps finds the last."""

        def committed(batch: int) -> bool:
            return files.exists(self._commit(run, batch))

        if not committed(0):
            return -1
        step = 1
        while committed(step):
            step *= 2
        low, high = step // 2, step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if committed(middle) else (low, middle)
        return low

    def _since(self, spark: SparkSession, version: Version, run: str, last: int, fold: Version) -> DataFrame:
        """The counts of a version: those of a run's fold, and the batches that it lacks."""
        folders = [self._fold_folder(run, last)]
        for other, newest in sorted(version.items()):
            folders += [self._deltas(other, batch) for batch in range(fold.get(other, -1) + 1, newest + 1)]
        return spark.read.schema(self.SCHEMA).parquet(*folders)

    def _fold(self, spark: SparkSession, files: SmallFiles, batch_id: int, version: Version) -> Version:
        """Writes the totals of a version. A fold that was begun before keeps the version it had."""
        path = self._fold_version(self.run_id, batch_id)
        files.write(path, json.dumps(version, sort_keys=True))
        version = json.loads(files.read(path))
        if version:
            rows = self._since(spark, version, *self._nearest_fold(files, version, batch_id - 1))
        else:
            rows = spark.createDataFrame([], self.SCHEMA)
        self._merged(rows).write.mode("overwrite").parquet(self._fold_folder(self.run_id, batch_id))
        return version

    def _folded(self, files: SmallFiles, run: str, last: int) -> Version:
        return json.loads(files.read(self._fold_version(run, last)))

    def _deltas(self, run: str, batch_id: int) -> str:
        return f"{self.root}/deltas/run_id={run}/batch_id={batch_id}"

    def _commit(self, run: str, batch_id: int) -> str:
        return f"{self.root}/commits/{run}/{batch_id}"

    def _fold_folder(self, run: str, batch_id: int) -> str:
        return f"{self.root}/folds/run_id={run}/through={batch_id}"

    def _fold_version(self, run: str, batch_id: int) -> str:
        return f"{self.root}/versions/{run}/{batch_id}"


class TopLedger(CounterLedger):
    """A counter ledger whose top places do not take the totals of all places.

    Beside its counts, every batch writes a summary of its run so far: the ``kept`` places that lead, each with a
    number it has at least, and an ``error``, by which any place may have more (Misra and Gries, "Finding
    repeated elements", 1982; that such summaries merge: Agarwal et al., "Mergeable summaries", 2012). The error is at most the
    run's rows divided by ``kept``. The top ``k`` are then counted exactly, among the few places that may belong to it; where
    the error is too large to tell which these are, all totals are read.
    """

    def __init__(self, root: str, run_id: str, checkpoint: str, fold_every: int = 100, kept: int = 1000):
        super().__init__(root, run_id, checkpoint, fold_every)
        self.kept = kept

    def record(self, batch: DataFrame, batch_id: int) -> None:
        super().record(batch, batch_id)
        spark, files = batch.sparkSession, SmallFiles(batch.sparkSession)
        if files.exists(self._error_file(self.run_id, batch_id)):
            return
        rows = spark.read.schema(self.SCHEMA).parquet(self._deltas(self.run_id, batch_id))
        error = 0
        if batch_id:
            before = spark.read.schema(self.SCHEMA).parquet(self._leaders(self.run_id, batch_id - 1))
            rows = self._merged(rows.unionByName(before))
            error = int(files.read(self._error_file(self.run_id, batch_id - 1)))
        less = self._led(spark, rows, self._leaders(self.run_id, batch_id))
        files.write(self._error_file(self.run_id, batch_id), str(error + less))

    def top_at(self, spark: SparkSession, batch_id: int, k: int) -> DataFrame:
        files = SmallFiles(spark)
        version = json.loads(files.read(self._commit(self.run_id, batch_id)))
        if not all(files.exists(self._error_file(run, batch)) for run, batch in version.items()):
            return super().top_at(spark, batch_id, k)
        folders = [self._leaders(run, batch) for run, batch in version.items()]
        led = self._merged(spark.read.schema(self.SCHEMA).parquet(*folders))
        error = sum(int(files.read(self._error_file(run, batch))) for run, batch in version.items())
        # At most ``kept`` places of each run.
        rows = led.where("location IS NOT NULL OR delta > 0").orderBy(F.desc("delta")).collect()
        least = rows[k - 1].delta if len(rows) >= k else 0
        if error and error >= least:
            return super().top_at(spark, batch_id, k)
        names = [r.location for r in rows if r.delta + error >= least]
        candidate = F.col("location").isin([n for n in names if n is not None])
        if None in names:
            candidate = F.coalesce(candidate, F.lit(True))
        last = self._last_fold(files, self.run_id, batch_id)
        counts = self._since(spark, version, self.run_id, last, self._folded(files, self.run_id, last)).where(candidate)
        return top_k(self._shown(counts), "location_count", k, "location")

    def _led(self, spark: SparkSession, rows: DataFrame, folder: str) -> int:
        """Writes the leading places, each less by what the first place left out has; returns that."""
        first = rows.orderBy(F.desc("delta"), "location").limit(self.kept + 1).collect()
        less = first.pop().delta if len(first) > self.kept else 0
        left = [(r.location, r.delta - less) for r in first if r.delta > less]
        spark.createDataFrame(left, self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(folder)
        return less

    def _leaders(self, run: str, batch_id: int) -> str:
        return f"{self.root}/leaders/run_id={run}/batch_id={batch_id}"

    def _error_file(self, run: str, batch_id: int) -> str:
        return f"{self.root}/errors/{run}/{batch_id}"


class DistinctLedger(CounterLedger):
    """The number of different users per place, over all runs: ``(location, n_users)``.

    ``record`` takes ``(location, user_id)``. A place's users are held as a sketch of at most about
    ``2 ** lg_k`` bytes, which merges with any other of them, so repeats across batches and runs count once. The
    relative standard error of the number is ``1.04 / sqrt(2 ** lg_k)``: 1.6 % at 12. NULL users count as none.
    """

    SCHEMA = "location STRING, delta BINARY"

    def __init__(self, root: str, run_id: str, checkpoint: str, fold_every: int = 100, lg_k: int = 12):
        super().__init__(root, run_id, checkpoint, fold_every)
        self.lg_k = lg_k

    def _measured(self, batch: DataFrame) -> DataFrame:
        return batch.groupBy("location").agg(F.hll_sketch_agg("user_id", self.lg_k).alias("delta"))

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("location").agg(F.hll_union_agg("delta").alias("delta"))

    def _shown(self, rows: DataFrame) -> DataFrame:
        return self._merged(rows).select("location", F.hll_sketch_estimate("delta").alias("n_users"))


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint gives itself, or its path where no stream has begun."""
    try:
        return spark.read.text(f"{checkpoint}/metadata").first().value
    except AnalysisException:
        return checkpoint

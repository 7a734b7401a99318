"""Processing only new or changed records.

Source rows are deliveries: each carries the record's key, a version time
(``modified_at``) and an arrival time (``received_at``).  Arrival is the
monotonic commit sequence.  A run fixes its upper bound when it starts, handles
what arrived up to it since the watermark, and commits its output together with
the new watermark in one atomic step; a run that fails commits neither, so the
next run starts from the same watermark and nothing is skipped or repeated.

Two entry points give the same changes:

* :func:`replay_runs` derives the windows from a ledger of runs and returns what
  every succeeded run committed;
* :class:`IncrementalJob` performs one run for real against a commit log.  It
  reads only its window of the source, and keeps the current row of every key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.session import fresh_name, materialise

FILING_FIELDS = [
    "cik", "company", "filing_type", "filing_date", "complete_text_file_link", "html_index", "crawled_filing_date",
    "period_of_report", "sic", "htm_file_link", "state_of_inc", "state_location", "fiscal_year_end", "filename",
]


def run_windows(runs: DataFrame, run_id="run_id", started="started_at", upper="seen_until", status="run_status", done="succeeded") -> DataFrame:
    """``(run_id, seq, lo, hi)`` for every succeeded run.

    ``lo`` is the high watermark before the run (null at first) and ``hi`` the
    one after it.  A watermark never moves back: a run whose bound lies at or
    below the watermark has an empty window.  Failed and killed runs move
    nothing.  Runs without a bound or start are not committed runs.
    """
    # one row per run: the ledger is control data, so a window over it is small
    order = Window.orderBy("started", "run_id")
    ok = (
        runs.filter((F.col(status) == done) & F.col(upper).isNotNull() & F.col(started).isNotNull())
        .select(F.col(run_id).alias("run_id"), F.col(started).alias("started"), F.col(upper).alias("bound"))
        .distinct()
    )
    high = ok.withColumn("hi", F.max("bound").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("seq", F.row_number().over(order))
    return high.withColumn("lo", F.lag("hi").over(order)).select("run_id", "seq", "lo", "hi").filter(F.col("lo").isNull() | (F.col("hi") > F.col("lo")))


def _in_windows(rows: DataFrame, windows: DataFrame, arrival: str) -> DataFrame:
    """Each row with the one window its arrival falls in, as an equi-join on the day.

    A window is spread over the days it touches, so the interval condition is
    checked for the few windows of a day only, whatever their number.
    """
    # one row: where the first window ends; earlier arrivals belong to it
    first = windows.agg(F.to_date(F.min("hi")).alias("first_day"))
    days = windows.crossJoin(F.broadcast(first)).withColumn("day", F.explode(F.sequence(F.to_date(F.coalesce("lo", "hi")), F.to_date("hi")))).drop("first_day")
    keyed = rows.crossJoin(F.broadcast(first)).withColumn("_day", F.greatest(F.to_date(arrival), F.col("first_day"))).drop("first_day")
    inside = (F.col("_day") == F.col("day")) & (F.col(arrival) <= F.col("hi")) & (F.col("lo").isNull() | (F.col(arrival) > F.col("lo")))
    return keyed.join(days, inside).drop("_day", "day")


def changes_in_windows(rows: DataFrame, windows: DataFrame, key: str = "html_index", fields: Sequence[str] = FILING_FIELDS, version: str = "modified_at", arrival: str = "received_at") -> DataFrame:
    """Records whose current state after a window differs from that before it.

    The current state is the visible row with the greatest ``version``; ties go
    to the later arrival, then to the greater field values, and a null version
    is the oldest.  Any difference in ``fields`` counts and null equals null.
    Rows without arrival are never visible.  A null key is one record.
    Other columns of ``rows`` are ignored.  Output: run_id, key, the other
    fields, version and arrival of the current row, and ``change``.

    Rows collapse to one per key and window by a partial aggregate before any
    window function, so a key holding a third of all rows leaves at most as many
    rows as there are runs.
    """
    wide = _wide(rows, key, fields, version, arrival)
    placed = _in_windows(wide, windows, "_arrival")
    latest = placed.groupBy("_key", "seq", "run_id").agg(F.max("_row").alias("_row"))
    order = Window.partitionBy("_key").orderBy("seq")
    state = latest.withColumn("_now", F.max("_row").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_before", F.lag("_now").over(order))
    return _changed(state, key, fields, version, arrival)


def _wide(rows: DataFrame, key: str, fields: Sequence[str], version: str, arrival: str) -> DataFrame:
    """(_key, _arrival, _row); rows of one key are ordered by version, arrival, then field values."""
    keep = dict.fromkeys([key, *fields])
    return rows.select(
        F.col(key).alias("_key"),
        F.col(arrival).alias("_arrival"),
        F.struct(F.col(version).alias("version"), F.col(arrival).alias("arrival"), F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(keep)]).alias("state")).alias("_row"),
    )


def _changed(state: DataFrame, key: str, fields: Sequence[str], version: str, arrival: str) -> DataFrame:
    """Of rows with ``_before`` and ``_now`` those whose fields differ, under their names."""
    keep = list(dict.fromkeys([key, *fields]))
    changed = state.filter(F.col("_before").isNull() | ~F.col("_before.state").eqNullSafe(F.col("_now.state")))
    return changed.select(
        "run_id",
        *[F.col(f"_now.state.f{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(f"_now.{part}").alias(fresh_name(name, ["run_id", "change", *keep])) for part, name in (("version", version), ("arrival", arrival))],
        F.when(F.col("_before").isNull(), "added").otherwise("changed").alias("change"),
    )


def replay_runs(rows: DataFrame, runs: DataFrame, **options) -> DataFrame:
    """What each succeeded run of the ledger committed; see :func:`changes_in_windows`."""
    return changes_in_windows(rows, run_windows(runs), **options)


class CommitLog:
    """Numbered commit files in a folder of any Hadoop file system.

    A commit is one small file that names the watermark and the data folder of
    its output.  It is written aside and renamed into its number; the rename is
    refused if the number is taken, so two runs cannot both commit after the
    same watermark and a reader sees output and watermark together or not at all.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/commits"))

    def _read(self, path) -> dict:
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/commits"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def last(self) -> dict | None:
        known = self.numbers()
        return self._read(self._path(f"{self.root}/commits/{known[-1]:012d}.json")) if known else None

    def commit(self, number: int, entry: dict) -> None:
        final = self._path(f"{self.root}/commits/{number:012d}.json")
        aside = self._path(f"{self.root}/commits/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        try:
            if self._fs.exists(final):
                raise RuntimeError(f"commit {number} exists: another run got there first")
            if not self._fs.rename(aside, final):
                raise RuntimeError(f"commit {number} was refused: another run got there first")
        finally:
            if self._fs.exists(aside):
                self._fs.delete(aside, False)

    def data_paths(self) -> list[str]:
        return [self._read(self._path(f"{self.root}/commits/{n:012d}.json"))["data"] for n in self.numbers()]


#: folders the kept state is partitioned into by a hash of the key, so a run reads those of its keys only
SLOTS = 64


class IncrementalJob:
    """One job's target folder: ``commits/``, ``data/`` and ``state/``.

    ``run`` may be called again after any failure.  What a run that died before
    its commit wrote stays unreferenced and is never read.

    ``state/`` holds the current row of every key.  A run adds the rows it
    changed; after ``compact_every`` such additions it rewrites the whole.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "html_index", fields: Sequence[str] = FILING_FIELDS, version: str = "modified_at", arrival: str = "received_at", compact_every: int = 16):
        self.spark, self.log, self.compact_every = spark, CommitLog(spark, root), compact_every
        self.key, self.names, self.arrival = key, (key, list(fields), version, arrival), arrival

    def run(self, rows: DataFrame, upper: datetime | None = None, transform: Callable[[DataFrame], DataFrame] | None = None) -> dict | None:
        """Process what arrived up to ``upper``, by default the latest arrival now present.

        The window is closed at both ends: a record that lands at the watermark's
        own tick after that run is found by the next one, and those already
        processed are known from the kept state and not repeated.  Returns the
        commit, with the number of deliveries read, or None if nothing is new.
        """
        last = self.log.last()
        low = datetime.fromisoformat(last["watermark"]) if last else None
        arrived, kind = F.col(self.arrival), dict(rows.dtypes)[self.arrival]
        at = lambda t: F.lit(t.isoformat()).cast(kind) if kind == "timestamp_ntz" else F.lit(t)
        since = rows.filter(arrived.isNotNull() if low is None else arrived >= at(low))
        if upper is None:
            upper = since.agg(F.max(self.arrival)).first()[0]
        if upper is None or (low is not None and upper < low):
            return None
        number = last["number"] + 1 if last else 1
        read = Observation()
        window = since.filter(arrived <= at(upper)).observe(read, F.count(F.lit(1)).alias("n"))
        step = materialise(self._step(window, last, number), "step")
        moved = step.filter(~F.col("_now").eqNullSafe(F.col("_before")))
        if low is not None and upper == low and moved.limit(1).count() == 0:
            return None
        name = f"{number:012d}-{uuid.uuid4().hex}"
        out = _changed(step, *self.names)
        data = f"{self.log.root}/data/{name}"
        (transform(out) if transform else out).write.parquet(data)
        entry = {"number": number, "watermark": upper.isoformat(), "data": data, "state": self._keep(moved, last, name), "n_read": read.get["n"]}
        self.log.commit(number, entry)
        return entry

    def _state(self, folders: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.log.root}/state").parquet(*folders)

    def _step(self, window: DataFrame, last: dict | None, number: int) -> DataFrame:
        """(run_id, _slot, _key, _before, _now) of the keys in the window; rows of a key collapse by a partial aggregate."""
        key = F.col("_key")
        newest = _wide(window, *self.names).groupBy("_key").agg(F.max("_row").alias("_new")).withColumn("_slot", F.pmod(F.xxhash64("_key"), F.lit(SLOTS)).cast("int"))
        if last and last["state"]:
            newest = materialise(newest, "window")
            slots = [r[0] for r in newest.select("_slot").distinct().collect()]  # at most SLOTS
            held = self._state(last["state"]).filter(F.col("_slot").isin(slots)).groupBy("_key").agg(F.max("_row").alias("_before"))
            held = held.withColumnRenamed("_key", "_held")
            newest = newest.join(held, key.eqNullSafe(F.col("_held")), "left").drop("_held")
        else:
            newest = newest.withColumn("_before", F.lit(None).cast(newest.schema["_new"].dataType))
        return newest.select(F.lit(number).cast("bigint").alias("run_id"), "_slot", "_key", "_before", F.greatest("_before", "_new").alias("_now"))

    def _keep(self, moved: DataFrame, last: dict | None, name: str) -> list[str]:
        """Write the moved rows to the state; returns the folders that make it up."""
        folders = last["state"] if last else []
        path = f"{self.log.root}/state/_run={name}"
        rows = moved.select("_slot", "_key", F.col("_now").alias("_row"))
        if len(folders) + 1 >= self.compact_every:
            every = self._state(folders).select("_slot", "_key", "_row").unionByName(rows)
            rows, folders = every.groupBy("_slot", "_key").agg(F.max("_row").alias("_row")), []
        rows.repartition("_slot").write.partitionBy("_slot").parquet(path)
        return [*folders, path]

    def committed(self) -> DataFrame | None:
        """All committed output; None before the first commit."""
        paths = self.log.data_paths()
        return self.spark.read.parquet(*paths) if paths else None

"""Session helpers: shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCRATCH: list[tuple[SparkSession, str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "sheafwork", cores: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    and all tasks run in this process, as in tests, a temporary folder is made and
    set; on a cluster a folder of one machine would be wrong, so that is an error.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not known:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        known = current.get() if current.isDefined() else None
    if not known:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="sheafwork-")
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    if path.startswith("file:"):
        return shutil.rmtree(path[len("file://") :], ignore_errors=True)
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may be gone at interpreter exit
        pass


@atexit.register
def drop_scratch() -> None:
    """Drop all intermediate tables written so far; a long session calls it between jobs whose results it has taken."""
    while _SCRATCH:
        _delete(*_SCRATCH.pop())


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, dropped at the end with all others."""
    path = f"{scratch_dir(spark)}/{label}-{os.getpid()}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared folder and reading it back.

    Used where a result feeds several branches: a lost executor then costs a
    re-read, not a recomputation, and every branch sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_table(df: DataFrame) -> None:
    """Drop a materialised table that no plan still to run reads."""
    _SCRATCH[:] = [x for x in _SCRATCH if x[1] != df._scratch]
    _delete(df.sparkSession, df._scratch)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that start and end in here leave no shuffle files; for those whose result is written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def broadcast_if_small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows.

    Counts at most ``max_rows + 1`` rows; callers pass a materialised table.
    Beyond the bound the plain frame is returned and Spark joins by shuffle.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for costly work on wide rows.

    With keys it is partitioned by them, which a later grouping on them reuses.
    Without, only a frame of fewer partitions, say one small file, is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    now = df._jdf.rdd().getNumPartitions() if not keys else 0
    if keys:
        wanted = max(cores, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return df.repartition(wanted, *keys)
    return df if now >= cores else df.repartition(cores)


def fresh_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, or the first of ``wanted_2, wanted_3, ...`` not in ``taken`` (case ignored, as Spark does)."""
    used = {t.lower() for t in taken}
    name, n = wanted, 1
    while name.lower() in used:
        n += 1
        name = f"{wanted}_{n}"
    return name

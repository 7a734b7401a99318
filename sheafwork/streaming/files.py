"""Incremental extraction as a file stream.

The file source's checkpoint remembers which raw filings were handled; each
micro-batch is joined with the metadata, extracted, and appended under a path
named for the batch, so a batch repeated after a failure overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheafwork.operators.metadata import not_yet_held
from sheafwork.plans.extract import Options, extract, with_raw

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def raw_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """(filing_type, filename, content) of raw filings as they arrive under ``folder/{type}/``."""
    files = spark.readStream.format("binaryFile").schema(_BINARY).option("maxFilesPerTrigger", max_files).load(f"{folder}/*/*")
    parts = F.split("path", "/")
    return files.select(F.url_decode(F.element_at(parts, -2)).alias("filing_type"), F.url_decode(F.element_at(parts, -1)).alias("filename"), "content")


def extract_stream(raw: DataFrame, metadata: Callable[[], DataFrame], out: str, checkpoint: str, options: Options = Options(), once: bool = True) -> StreamingQuery:
    """Extract each micro-batch; ``metadata`` is asked anew for every batch.

    Files without metadata are left out of the batch's output.
    """

    def handle(batch: DataFrame, number: int) -> None:
        rows = metadata().join(batch.select("filing_type", "filename"), ["filing_type", "filename"], "left_semi")
        extract(with_raw(rows, batch), options).write.mode("overwrite").parquet(f"{out}/batch={number:012d}")

    writer = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def index_stream(index: DataFrame, held: Callable[[], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append index rows not held by ``html_index``; repeats within a batch stay, as in the batch operator."""

    def handle(batch: DataFrame, number: int) -> None:
        not_yet_held(batch, held()).write.mode("overwrite").parquet(f"{out}/batch={number:012d}")

    writer = index.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

"""Shared pieces: reading items as rows, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: text columns are wide, so Arrow batches hold few rows
TEXT_BATCH = 512


def item_rows(filings: DataFrame, items: Iterable[str], key: str = "filename", name: str = "item_name", text: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per filing and item: key, extra columns, item name, text.

    Only the named columns are read.  Null items give no row.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias(name), F.col(i).alias(text)) for i in items])
    return filings.select(key, *extra, F.inline(pairs)).filter(F.col(text).isNotNull())


def scan_arrow(df: DataFrame, function, schema: str, batch_rows: int = TEXT_BATCH) -> DataFrame:
    """``mapInArrow`` with batches re-cut to ``batch_rows`` rows, whatever the session's batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, batch_rows):
                    yield batch.slice(at, batch_rows)

        yield from function(cut())

    return df.mapInArrow(run, schema)

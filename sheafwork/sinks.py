"""Sinks: metadata, raw documents, one JSON per filing, index tables, company attributes.

Files are written by the tasks that hold the rows, on any file system; a path
without a scheme is for one machine or a folder all machines share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sheafwork.files import locate, replace_file
from sheafwork.operators.incremental import CommitLog
from sheafwork.operators.metadata import json_filename
from sheafwork.plans.extract import filing_json
from sheafwork.schemas import FILE_COLUMNS, METADATA
from sheafwork.sources.files import read_metadata


#: values are written with the blanks around them
_AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


class MetadataTable:
    """The metadata table: CSV parts with a header in folders that numbered commits name.

    ``append`` adds filings as they are finished and ``replace`` swaps the whole;
    either is one rename, so a reader sees the table before or after, and a run
    that is interrupted keeps what it committed.  ``replace`` may read the table itself.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.commits = spark, CommitLog(spark, path)

    def read(self) -> DataFrame:
        last = self.commits.last()
        return read_metadata(self.spark, last["live"]) if last else self.spark.createDataFrame([], METADATA)

    def append(self, metadata: DataFrame) -> dict:
        last = self.commits.last()
        return self._commit(metadata, last["live"] if last else [])

    def replace(self, metadata: DataFrame) -> dict:
        return self._commit(metadata, [])

    def _commit(self, metadata: DataFrame, live: list[str]) -> dict:
        last = self.commits.last()
        number = last["number"] + 1 if last else 1
        folder = f"{self.commits.root}/data/{number:012d}-{uuid.uuid4().hex}"
        metadata.select(*[F.col(v).alias(k) for k, v in FILE_COLUMNS.items()]).write.csv(folder, header=True, escape='"', **_AS_IS)
        entry = {"number": number, "data": folder, "live": [*live, folder]}
        self.commits.commit(number, entry)
        return entry


def write_raw(documents: DataFrame, folder: str) -> None:
    """Bytes of (filing_type, filename, body) to ``folder/{type}/{filename}``; rows without body are passed over."""

    def save(rows: Iterator[Row]) -> None:
        for row in rows:
            if row.body is not None:
                replace_file(f"{folder}/{row.filing_type}/{row.filename}", bytes(row.body))

    documents.select("filing_type", "filename", "body").foreachPartition(save)


def write_filings(extracted: DataFrame, folder: str) -> None:
    """One indented JSON file per extracted filing at ``folder/{type}/{name}.json``."""
    rows = extracted.filter(F.col("items").isNotNull()).withColumn("_json", json_filename(F.col("filename")))

    def save(part: Iterator[Row]) -> None:
        for row in part:
            values = row.asDict(recursive=True)
            replace_file(f"{folder}/{values['filing_type']}/{values['_json']}", filing_json(values).encode())

    rows.foreachPartition(save)


def write_items_table(extracted: DataFrame, path: str) -> None:
    """The analytic form: Parquet partitioned by form type, all items of a filing in one row."""
    extracted.filter(F.col("items").isNotNull()).write.mode("append").partitionBy("filing_type").parquet(path)


_INDEX = list(FILE_COLUMNS.values())[:6]


def write_index(index: DataFrame, folder: str) -> None:
    """Bar-separated index tables, a folder per year and quarter; ``index`` has year and quarter columns."""
    index.select(*_INDEX, "year", "quarter").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "quarter").csv(folder, sep="|", **_AS_IS)


def write_index_files(index: DataFrame, folder: str) -> None:
    """One file ``{year}_QTR{q}.tsv`` per quarter, for tools that expect these.

    A quarter's rows pass through one task, which writes them as they come.
    """

    def save(rows: Iterator[Row]) -> None:
        for (year, quarter), own in groupby(rows, lambda r: (r.year, r.quarter)):
            system, path = locate(f"{folder}/{year}_QTR{quarter}.tsv")
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(f"{path}.tmp") as out:
                for r in own:
                    out.write(("|".join(r[c] or "" for c in _INDEX) + "\n").encode())
            system.move(f"{path}.tmp", path)

    placed = index.select(*_INDEX, "year", "quarter").filter("year IS NOT NULL AND quarter IS NOT NULL")
    placed.repartition("year", "quarter").sortWithinPartitions("year", "quarter").foreachPartition(save)


def write_companies(companies: DataFrame, path: str, max_companies: int = 2_000_000) -> None:
    """Company attributes as one JSON object; the table of companies is bounded and the bound is checked."""
    rows = companies.limit(max_companies + 1).collect()
    if len(rows) > max_companies:
        raise ValueError("too many companies for one JSON file; write the table as Parquet")
    names = {"Company Name": "company_name", "SIC": "sic", "State location": "state_location", "State of Inc": "state_of_inc", "Fiscal Year End": "fiscal_year_end"}
    replace_file(path, json.dumps({r["cik"]: {k: r[v] for k, v in names.items()} for r in rows}, indent=4).encode())

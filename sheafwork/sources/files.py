"""Readers: indexes, metadata, raw filings, lists of companies, tickers, company attributes."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork import schemas
from sheafwork.files import exists, listed
from sheafwork.operators.metadata import index_page_link

#: header lines before the entries of a quarterly master index
INDEX_HEADER_LINES = 11


def _nulls(df: DataFrame) -> DataFrame:
    """Empty strings and the usual marks of a missing value become null."""
    marks = ["", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a", "<NA>", "#N/A"]
    return df.select(*[F.when(~F.col(c).isin(marks), F.col(c)).alias(c) for c in df.columns])


def read_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Quarterly index tables, header-less and separated by bars: all paths in one scan, a bag union.

    Only six columns exist in the files; the other metadata columns are null.
    """
    df = _nulls(spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="|", header=False, schema=schemas.INDEX))
    missing = [f.name for f in schemas.METADATA.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def index_paths(spark: SparkSession, folder: str, periods: Sequence[tuple[int, int]], present: bool = True) -> list[tuple[int, int, str]]:
    """(year, quarter, path) of the periods' index tables that exist, or of those that do not."""
    paths = [(y, q, f"{folder}/{y}_QTR{q}.tsv") for y, q in periods]
    return [p for p in paths if exists(spark, p[2]) == present]


_MASTER = "cik string, company string, filing_type string, filing_date string, complete_text_file_link string, source_file string"


def parse_master_files(files: DataFrame) -> DataFrame:
    """(path, content) of master index archives (zip) or plain files to index rows, with the derived link of the index page.

    Each file is parsed where it is; lines that lack a field are passed over.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                raw = content
                if raw[:2] == b"PK":
                    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
                        raw = archive.read(next(n for n in archive.namelist() if n.endswith(".idx")))
                lines = raw.decode("latin-1").split("\n")[INDEX_HEADER_LINES:]
                rows = [f for f in (line.strip().split("|") for line in lines) if len(f) == 5]
                yield pd.DataFrame(rows, columns=["cik", "company", "filing_type", "filing_date", "complete_text_file_link"], dtype=str).assign(source_file=path)

    rows = files.filter("content IS NOT NULL").mapInPandas(parse, _MASTER)
    return rows.withColumn("html_index", index_page_link(F.col("complete_text_file_link")))


def parse_master_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The index rows of stored master index files; see :func:`parse_master_files`."""
    return parse_master_files(spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path", "content"))


def read_metadata(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The metadata table: header row, all strings, empty is null."""
    df = spark.read.csv(path, header=True, schema=schemas.METADATA_FILE, multiLine=True, escape='"')
    return _nulls(df.select(*[F.col(f"`{k}`").alias(v) for k, v in schemas.FILE_COLUMNS.items()]))


def decode(content: pd.Series) -> pd.Series:
    """Bytes to text: wrong bytes show as ``\\xNN``, all line ends become line feeds."""
    return content.map(lambda b: None if b is None else re.sub("\r\n?", "\n", b.decode("utf-8", "backslashreplace")))


def read_raw(spark: SparkSession, folder: str, types: Sequence[str] | None = None) -> DataFrame:
    """(filing_type, filename, content) of the raw filings under ``folder/{type}/``; content is binary, a row per file."""
    paths = [f"{folder}/{t}/*" for t in types] if types else f"{folder}/*/*"
    files = spark.read.format("binaryFile").load(paths)
    parts = F.split("path", "/")
    return files.select(F.url_decode(F.element_at(parts, -2)).alias("filing_type"), F.url_decode(F.element_at(parts, -1)).alias("filename"), "content")


def list_raw(spark: SparkSession, folder: str) -> DataFrame:
    """(filing_type, filename) of the raw filings, whose contents stay unread; none if there is no folder."""
    parts = F.split("path", "/")
    return listed(spark, folder, "*/*").select(F.url_decode(F.element_at(parts, -2)).alias("filing_type"), F.url_decode(F.element_at(parts, -1)).alias("filename"))


def read_names(spark: SparkSession, names: Sequence[str] | str) -> DataFrame:
    """(name) of companies: given ones, or the lines of a file, trimmed, blank ones dropped."""
    if isinstance(names, str):  # a path
        lines = spark.read.text(names).select(F.trim("value").alias("name"))
    else:
        lines = spark.createDataFrame([(str(n).strip(),) for n in names], "name string")
    return lines.filter(F.length("name") > 0)


def parse_tickers(text: DataFrame, value: str = "value") -> DataFrame:
    """(ticker, cik_str) of JSON objects of entries, in the order of tickers."""
    entry = T.StructType([T.StructField("cik_str", T.StringType()), T.StructField("ticker", T.StringType())])
    parsed = text.select(F.explode(F.map_values(F.from_json(value, T.MapType(T.StringType(), entry)))).alias("e"))
    return parsed.select("e.ticker", "e.cik_str").orderBy("ticker")


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The tickers of a stored JSON object; see :func:`parse_tickers`."""
    return parse_tickers(spark.read.text(path, wholetext=True))


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company attributes from a JSON object by company; an absent file is an empty table."""
    names = {"Company Name": "company_name", "SIC": "sic", "State location": "state_location", "State of Inc": "state_of_inc", "Fiscal Year End": "fiscal_year_end"}
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.COMPANY)
    entry = T.StructType([T.StructField(n, T.StringType()) for n in names])
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), entry))).alias("cik", "e"))
    return rows.select("cik", *[F.col(f"e.`{k}`").alias(v) for k, v in names.items()])

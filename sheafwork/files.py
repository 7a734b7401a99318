"""Whole files on any file system, written and read where the rows are."""

from __future__ import annotations

import os
import uuid
from functools import lru_cache
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=32)
def _system(root: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(root)[0]


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it; a path without a scheme is one of this machine."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), os.path.abspath(uri if not parts.scheme else parts.path)
    return _system(f"{parts.scheme}://{parts.netloc}/"), fs.FileSystem.from_uri(uri)[1]


def replace_file(uri: str, data: bytes) -> None:
    """Write aside and rename, so a reader sees the old or the new file, whole."""
    system, path = locate(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(aside) as out:
        out.write(data)
    try:
        system.move(aside, path)
    except OSError:  # file systems that do not rename over a file
        system.delete_file(path)
        system.move(aside, path)


def read_file(uri: str) -> bytes | None:
    """The bytes of a file, None if there is none."""
    system, path = locate(uri)
    try:
        with system.open_input_stream(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


@F.pandas_udf(T.BinaryType())
def _contents(uris: pd.Series) -> pd.Series:
    return uris.map(lambda u: read_file(u) if isinstance(u, str) else None)


def contents(uri: Column) -> Column:
    """The bytes of each row's file as a column, null where there is none; read by the task that has the row."""
    return _contents.asNondeterministic()(uri)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path) of the files under a folder that match a pattern; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    if found is None or len(found) == 0:
        return spark.createDataFrame([], "path string")
    return spark.read.format("binaryFile").load(f"{folder}/{pattern}").select("path")

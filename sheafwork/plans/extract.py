"""From filing metadata and raw filings to items: long rows, wide rows, one JSON object each.

One Arrow hop: documents are chosen, cleaned and cut by a kernel that sees one
filing at a time; everything around it is relational.  Filings reach tens of
megabytes, so sessions that extract them set
``spark.sql.execution.arrow.maxRecordsPerBatch`` low, say 32.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.files import contents
from sheafwork.functions import html as H
from sheafwork.functions.text import clean_text_py
from sheafwork.operators.items import UnknownForm, header_core, items_for, requested_items
from sheafwork.operators.metadata import json_filename
from sheafwork.operators.segment import extract as cut
from sheafwork.schemas import OUTPUT_KEYS

@dataclass(frozen=True)
class Options:
    """What to extract; ``items`` in any order and for any mix of forms, none for all."""

    items: tuple[str, ...] = ()
    remove_tables: bool = True
    include_signature: bool = False


# The tags of a submission, of tables in plain text, and of spans with margins.
_PDF = re.compile(r"<PDF>.*?</PDF>", re.I | re.S)
_DOCUMENT = re.compile(r"<DOCUMENT>.*?</DOCUMENT>", re.I | re.S)
_TYPE = re.compile(r"\n[^\S\r\n]*<TYPE>(.*?)\n", re.I | re.S)
_TEXT_TABLE = re.compile(r"<TABLE>.*?</TABLE>", re.I | re.S)
_SIDE_SPAN, _UP_SPAN = (
    re.compile(rf'<span[^>]*style="[^"]*(?:{sides}):\s*[\d.]+pt[^"]*"[^>]*>.*?</span>', re.I) for sides in ("margin-left|margin-right", "margin-top|margin-bottom")
)


def main_document(content: str) -> str:
    """The last sub-document whose type starts with 10 or 8, else the whole content."""
    chosen = content
    for block in _DOCUMENT.findall(content):
        kind = _TYPE.search(block)
        if kind and kind.group(1).startswith(("10", "8")):
            chosen = block
    return chosen


@lru_cache(maxsize=16)
def _any_header(form: str, date: str | None) -> re.Pattern:
    return re.compile(r"\n[^\S\r\n]*(?:" + "|".join(header_core(i) for i in items_for(form, date)) + r")[.*~\-:\s]", re.I)


def plain_text(document: str, form: str, date: str | None, remove_tables: bool) -> str:
    """Tables and spans resolved, markup stripped, text cleaned."""
    if re.search(r"<td[\s>/]", document, re.I) and re.search(r"<tr[\s>/]", document, re.I):
        root = H.parse(document)
        if H.is_html(root):
            if remove_tables:
                H.drop_numeric_tables(root, _any_header(form, date))
            H.resolve_spans(root)
            return clean_text_py(H.strip_markup(root.serialise()))
    if remove_tables:
        document = _TEXT_TABLE.sub("", document)
    document = _UP_SPAN.sub("\n", _SIDE_SPAN.sub(" ", document))
    return clean_text_py(H.strip_markup(document))


def items_of(content: str, form: str, date: str | None, options: Options = Options()) -> list[tuple[str, str]] | None:
    """(key, value) of a raw filing's items in order; None if every wanted item is empty."""
    wanted = requested_items(form, date, list(options.items))
    return cut(plain_text(main_document(_PDF.sub("", content)), form, date, options.remove_tables), form, date, wanted, options.include_signature)


ITEMS_TYPE = "status string, items array<struct<key: string, value: string>>"


def _kernel(options: Options):
    def one(content, form, date) -> tuple[str, list | None]:
        if content is None:
            return "no raw file", None
        text = content.decode("utf-8", "backslashreplace") if isinstance(content, bytes) else content
        try:
            found = items_of(re.sub("\r\n?", "\n", text), form or "", date, options)
        except UnknownForm as error:
            return str(error), None
        return ("extracted", found) if found else ("no item found", None)

    @F.pandas_udf(f"struct<{ITEMS_TYPE.replace('status string', 'status: string').replace('items array', 'items: array')}>")
    def run(content: pd.Series, form: pd.Series, date: pd.Series) -> pd.DataFrame:
        found = [one(c, f, d if isinstance(d, str) else None) for c, f, d in zip(content, form, date)]
        items = [None if i is None else [{"key": k, "value": v} for k, v in i] for _, i in found]
        return pd.DataFrame({"status": [s for s, _ in found], "items": items})

    # else the optimizer infers a filter from exploding the items and evaluates the kernel once more for it
    return run.asNondeterministic()


def extract(filings: DataFrame, options: Options = Options(), content: str = "content", form: str = "filing_type", date: str = "filing_date") -> DataFrame:
    """``filings`` without content, with ``status`` and ``items`` (key, value; null unless status is ``extracted``).

    The status is ``extracted``, ``no item found``, ``no raw file``, or why the
    form cannot be handled; nothing raises for a single bad filing.
    """
    run = _kernel(options)
    found = filings.withColumn("_found", run(F.col(content), F.col(form), F.col(date)))
    return found.select(*[c for c in filings.columns if c != content], "_found.status", "_found.items")


def with_raw(metadata: DataFrame, raw: DataFrame) -> DataFrame:
    """Metadata with the raw content by form type and file name; null content where the file is missing."""
    files = raw.select(F.col("filing_type").alias("_t"), F.col("filename").alias("_f"), "content")
    return metadata.join(files, (F.col("filing_type") == F.col("_t")) & (F.col("filename") == F.col("_f")), "left").drop("_t", "_f")


def with_contents(metadata: DataFrame, folder: str) -> DataFrame:
    """Metadata with the raw content at ``folder/{type}/{filename}``; null where there is no file.

    The path is made from the row and the file read by the task that extracts it,
    so contents are never shuffled.
    """
    return metadata.withColumn("content", contents(F.concat(F.lit(f"{folder}/"), "filing_type", F.lit("/"), "filename")))


def long_items(extracted: DataFrame, keep: Sequence[str] = ("filename",)) -> DataFrame:
    """One row per filing and key: kept columns, ord, key, value."""
    return extracted.select(*keep, F.posexplode("items").alias("ord", "item")).select(*keep, "ord", F.col("item.key").alias("key"), F.col("item.value").alias("value"))


def wide_items(extracted: DataFrame, keys: Sequence[str], keep: Sequence[str] = ("filename",)) -> DataFrame:
    """One row per filing with a column per key; null where the filing has none."""
    by_key = F.map_from_arrays(F.transform("items", lambda i: i["key"]), F.transform("items", lambda i: i["value"]))
    return extracted.filter(F.col("items").isNotNull()).withColumn("_m", by_key).select(*keep, *[F.col("_m")[k].alias(k) for k in keys])


def filing_json(row: dict, indent: int | None = 4) -> str:
    """An extracted filing as the JSON object written for it: metadata keys, then items in order, nulls kept."""
    out = {key: row.get(source) for key, source in OUTPUT_KEYS.items()}
    out |= {item["key"]: item["value"] for item in row["items"]}
    return json.dumps(out, indent=indent, ensure_ascii=False)


def json_column(extracted: DataFrame) -> Column:
    """The same object as a native expression, compact, nulls kept."""
    known = {c.lower() for c in extracted.columns}
    meta = F.to_json(F.struct(*[(F.col(s) if s.lower() in known else F.lit(None).cast("string")).alias(k) for k, s in OUTPUT_KEYS.items()]), {"ignoreNullFields": "false"})
    items = F.to_json(F.map_from_entries(F.transform("items", lambda i: F.struct(i["key"], i["value"]))))
    return _join_objects(meta, items)


def _join_objects(a: Column, b: Column) -> Column:
    head, tail = F.regexp_replace(a, r"\}$", ""), F.regexp_replace(b, r"^\{", "")
    return F.concat(head, F.when(tail == "}", F.lit("")).otherwise(F.lit(",")), tail)


def status_counts(extracted: DataFrame) -> DataFrame:
    return extracted.groupBy("status").agg(F.count("*").alias("n_filings"))


def not_yet_extracted(metadata: DataFrame, done: DataFrame) -> DataFrame:
    """Metadata whose JSON name is not among those written."""
    names = done.select(F.col(done.columns[0]).alias("_name")).distinct()
    return metadata.join(names, json_filename(F.col("filename")) == F.col("_name"), "left_anti")

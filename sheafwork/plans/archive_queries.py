"""Queries of sources, sinks, fetched pages and quarterly-report repairs over whole tables.

Archives, files and pages are composed from the tables, written where files are
at stake, and read back by the operators; the checking SQL states what must come back.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork import sinks
from sheafwork.functions import text as X
from sheafwork.operators import metadata as M
from sheafwork.operators.items import ITEMS_10K, output_key
from sheafwork.plans import acquire
from sheafwork.plans.extract import extract, long_items, with_contents, with_raw
from sheafwork.plans.filing_queries import _ESCAPED, _KEYS_10Q, _P1, _P2, _PART1, _PART2, _TENK, _VALUES_10Q, _WHOLE2, _clean_sql, _collapse_sql, _compose, _expect, _filings, _long, _mixed, _piece
from sheafwork.plans.registry import Registry, table
from sheafwork.schemas import METADATA
from sheafwork.session import scratch_folder
from sheafwork.sources import files
from sheafwork.sources.fetch import FetchError, fetch_all, with_retries

ARCHIVES = Registry()


# ---- indexes ----------------------------------------------------------------------------------------------------

_SIX = ["cik", "company", "filing_type", "filing_date", "complete_text_file_link", "html_index"]
#: company names of the index in the archive's encoding, the same in both engines
_NAME = "regexp_replace(coalesce(company, ''), '[^ -~]', '?'{0})"


def _archives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A zipped master index of each batch of lines, behind a header of eleven lines."""
    for frame in frames:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("master.idx", "\n".join([*["header|a|b|c|d"] * 11, *frame["line"], "a line|without the rest", ""]).encode("latin-1"))
        yield pd.DataFrame({"filing_type": ["idx"], "filename": [f"{uuid.uuid4().hex}.zip"], "body": [packed.getvalue()]})


@ARCHIVES.query(
    f"""SELECT cik, {_NAME.format(", 'g'")} AS company, filing_type, filing_date, complete_text_file_link, replace(complete_text_file_link, '.txt', '-index.html') AS html_index FROM filing_index"""
)
def master_index_archives(spark, sf):
    """Zipped master indexes written and parsed: header lines skipped, short lines passed over, the page's link derived."""
    lines = table(spark, sf, "filing_index").selectExpr(f"concat_ws('|', cik, {_NAME.format('')}, filing_type, filing_date, complete_text_file_link) AS line")
    folder = scratch_folder(spark, "master")
    sinks.write_raw(lines.mapInPandas(_archives, "filing_type string, filename string, body binary"), folder)
    return files.parse_master_index(spark, f"{folder}/idx/*.zip").drop("source_file")


def _by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    date = F.to_date("filing_date")
    return table(spark, sf, "filing_index").select(*_SIX, F.year(date).alias("year"), F.quarter(date).alias("quarter"))


@ARCHIVES.query(f"SELECT {', '.join(_SIX)}, company IS NULL AND cik IS NULL AS rest_is_null FROM filing_index")
def index_tables_round_trip(spark, sf):
    """Index tables written by year and quarter and read in one scan; the other metadata columns are null."""
    folder = scratch_folder(spark, "index")
    sinks.write_index(_by_quarter(spark, sf), folder)
    return files.read_index(spark, f"{folder}/*/*").selectExpr(*_SIX, "filename IS NOT NULL AS rest_is_null")


@ARCHIVES.query(f"SELECT {', '.join(_SIX)} FROM filing_index WHERE year(filing_date::date) BETWEEN 2009 AND 2012 AND quarter(filing_date::date) <> 3")
def index_files_of_periods(spark, sf):
    """One file a quarter; of the periods asked for, also long before and after, those that exist are read."""
    folder = scratch_folder(spark, "quarters")
    sinks.write_index_files(_by_quarter(spark, sf).filter("year BETWEEN 2009 AND 2012"), folder)
    found = files.index_paths(spark, folder, M.periods(1990, 2040, (1, 2, 4), "2100-01-01"))
    return files.read_index(spark, [path for _, _, path in found]).select(*_SIX)


@ARCHIVES.query(
    """WITH p AS (SELECT y::int AS year, q::int AS quarter FROM range(1990, 2041) a(y), range(1, 5) b(q))
SELECT year, quarter FROM p WHERE NOT EXISTS (SELECT 1 FROM filing_index i WHERE year(i.filing_date::date) = p.year AND quarter(i.filing_date::date) = p.quarter)"""
)
def index_files_to_fetch(spark, sf):
    """The quarters whose index is not yet present."""
    folder = scratch_folder(spark, "present")
    sinks.write_index_files(_by_quarter(spark, sf), folder)
    absent = files.index_paths(spark, folder, M.periods(1990, 2040, (1, 2, 3, 4), "2100-01-01"), present=False)
    return spark.createDataFrame([(y, q) for y, q, _ in absent], "year int, quarter int")


@ARCHIVES.query(
    """WITH t AS (SELECT max(filing_date)::date AS today FROM filing_index), p AS (SELECT y::int AS year, q::int AS quarter FROM range(1993, 2100) a(y), range(1, 5) b(q))
SELECT year, quarter FROM p, t WHERE year < year(today) OR (year = year(today) AND quarter <= quarter(today))"""
)
def periods_until_today(spark, sf):
    """Quarters of all years to that of the latest filing, in which later quarters have not begun."""
    today = table(spark, sf, "filing_index").agg(F.max("filing_date")).first()[0]
    return spark.createDataFrame(M.periods(1993, int(today[:4]), (1, 2, 3, 4), today), "year int, quarter int")


# ---- metadata, companies, names ---------------------------------------------------------------------------------

_META = METADATA.names


@ARCHIVES.query(f"SELECT {', '.join(_META)} FROM filing_index")
def metadata_round_trip(spark, sf):
    """The metadata table committed in two parts, the second of annual reports, and read back; missing values stay null."""
    rows = table(spark, sf, "filing_index").select(*_META)
    held = sinks.MetadataTable(spark, scratch_folder(spark, "metadata"))
    held.append(rows.filter("filing_type <> '10-K' OR filing_type IS NULL"))
    held.append(rows.filter("filing_type = '10-K'"))
    return held.read().select(*_META)


@ARCHIVES.query("SELECT cik_str AS name FROM company_tickers UNION ALL SELECT ticker FROM company_tickers WHERE ticker IS NOT NULL")
def company_name_lines(spark, sf):
    """Company numbers and tickers from a file of lines with blanks around them and empty lines between."""
    folder = scratch_folder(spark, "names")
    table(spark, sf, "company_tickers").selectExpr("explode(array(concat('  ', cik_str, ' '), '', '   ', ticker)) AS line").filter("line IS NOT NULL").write.text(folder)
    return files.read_names(spark, folder)


@ARCHIVES.query("SELECT ticker, cik_str FROM (SELECT DISTINCT ticker, cik_str FROM company_tickers)")
def ticker_object(spark, sf):
    """Tickers from one JSON object, in the order of tickers."""
    entries = table(spark, sf, "company_tickers").distinct().select(F.struct(F.concat_ws(" ", "ticker", "cik_str"), F.struct("cik_str", "ticker")).alias("e"))
    path = scratch_folder(spark, "tickers")
    # one object is one row by its nature; there is one entry per listed company
    entries.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value")).coalesce(1).write.text(path)
    return files.read_tickers(spark, path)


_COMPANY_ROWS = "SELECT DISTINCT ltrim(cik, '0') || '/' || snapshot_date || '/' || loaded_at AS cik, trim(company) AS company_name, sic, state_location, state_of_inc, fiscal_year_end FROM company_snapshots"


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat(F.ltrim(F.col("cik"), F.lit("0")), F.lit("/"), "snapshot_date", F.lit("/"), F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "company_snapshots").select(key.alias("cik"), F.trim("company").alias("company_name"), "sic", "state_location", "state_of_inc", "fiscal_year_end").distinct()


@ARCHIVES.query(_COMPANY_ROWS)
def company_attributes_round_trip(spark, sf):
    """Company attributes written as one JSON object and read back; nulls stay null."""
    path = f"{scratch_folder(spark, 'companies')}/companies.json"
    sinks.write_companies(_companies(spark, sf), path)
    return files.read_companies(spark, path).select("cik", "company_name", "sic", "state_location", "state_of_inc", "fiscal_year_end")


# ---- fetched pages ----------------------------------------------------------------------------------------------


def _text(column: str) -> str:
    return _ESCAPED.format(column)


_COMPANY_PAGE = (
    "concat('<html><div class=\"companyInfo\"><span class=\"companyName\"> ', " + _text("coalesce(company, '')") + ", ' <acronym>CIK</acronym></span><p class=\"identInfo\">'"
    ", coalesce(concat('SIC: <a href=\"/cgi?action=x&amp;SIC=', sic, '\">', sic, '</a> - kind<br/>'), ''), coalesce(concat('State location: <a href=\"/cgi?action=x&amp;State=', state_location, '\">', state_location, '</a>'), '')"
    ", coalesce(concat(' | State of Inc.: <strong>', state_of_inc, '</strong>'), ''), coalesce(concat(' | Fiscal Year End: ', fiscal_year_end), ''), '<br/></p></div></html>')"
)


@ARCHIVES.query(
    "SELECT cik, snapshot_date, loaded_at, nullif(trim(company), '') AS company_name, sic, state_location, state_of_inc, CASE WHEN trim(fiscal_year_end) <> '' THEN fiscal_year_end END AS fiscal_year_end FROM company_snapshots"
)
def company_pages(spark, sf):
    """A company page composed for every snapshot; its facts read back."""
    pages = table(spark, sf, "company_snapshots").selectExpr("cik", "snapshot_date", "loaded_at", f"{_COMPANY_PAGE} AS body")
    facts = acquire.company_columns(pages).select("cik", "snapshot_date", "loaded_at", "company_page.*")
    return facts.withColumn("company_name", F.nullif("company_name", F.lit("")))


_WANTED = ["10-K", "10-Q", "8-K"]
_FORM_TABLE = (
    "'<table class=\"tableFile\" summary=\"Document Format Files\"><tr><th>Seq</th><th>Description</th><th>Document</th><th>Type</th></tr>"
    "<tr><td>1</td><td>exhibit</td><td><a href=\"/x/exhibit.htm\">e</a></td><td>EX-99</td></tr>'"
    ", '<tr><td>2</td><td>', " + _text("filing_type") + ", '</td><td><a href=\"/x/', coalesce(filename, 'none.txt'), '\">d</a></td><td>', " + _text("filing_type") + ", '</td></tr>'"
    ", '<tr><td></td><td>Complete submission text file</td><td><a href=\"/', complete_text_file_link, '\">c</a></td><td>&nbsp;</td></tr>'"
    ", '<tr><td>3</td><td>later</td><td><a href=\"/x/later.htm\">l</a></td><td>10-K</td></tr></table>'"
)
_INDEX_PAGE = (
    "concat('<html><div class=\"formGrouping\"><div class=\"infoHead\">Filing Date</div><div class=\"info\">', filing_date, '</div><div class=\"infoHead\">Accepted</div></div>'"
    ", coalesce(concat('<div><div class=\"infoHead\">Period of Report</div><div class=\"info\">', period_of_report, '</div></div>'), ''), " + _FORM_TABLE
    + ", '<div class=\"companyInfo\"><p class=\"identInfo\">CIK: ', cik, coalesce(concat(' | State of Incorp.: <strong>', state_of_inc, '</strong>'), '')"
    ", coalesce(concat(' | Fiscal Year End: <strong>', fiscal_year_end, '</strong>'), ''), coalesce(concat(' | SIC: <a href=\"/cgi?SIC=', sic, '\">', sic, '</a>'), ''), '</p></div></html>')"
)
_TAKEN = "filing_type IN ('10-K', '10-Q', '8-K') AND coalesce(filename, 'none.txt') SIMILAR TO '.*[.]html?'"


@ARCHIVES.query(
    f"""SELECT html_index, modified_at, received_at, filing_date, period_of_report, state_of_inc, fiscal_year_end, sic,
  CASE WHEN {_TAKEN} THEN '/x/' || filename END AS htm_link, CASE WHEN NOT coalesce({_TAKEN}, false) THEN '/' || complete_text_file_link END AS text_link, CASE WHEN {_TAKEN} THEN filing_type END AS document_type
FROM filing_index"""
)
def index_pages(spark, sf):
    """A filing's index page for every delivery: dates by their labels, company facts, and the document to take."""
    pages = table(spark, sf, "filing_index").selectExpr("html_index", "modified_at", "received_at", f"{_INDEX_PAGE} AS body")
    return acquire.index_page_columns(pages, _WANTED).select("html_index", "modified_at", "received_at", "page.*")


@ARCHIVES.query(
    f"""WITH i AS (SELECT DISTINCT {', '.join(_META)} FROM filing_index WHERE complete_text_file_link IS NOT NULL)
SELECT html_index, CASE WHEN period_of_report IS NULL THEN NULL WHEN {_TAKEN} THEN 'https://s/x/' || filename ELSE 'https://s/' || complete_text_file_link END AS document_link,
  CASE WHEN {_TAKEN} THEN cik || '_' || replace(filing_type, '-', '') || '_' || substr(period_of_report, 1, 4) || '_' || regexp_extract(complete_text_file_link, '([^/]*)[.]txt$', 1) || '.' || split_part(filename, '.', -1)
    ELSE cik || '_' || regexp_replace(filing_type, '[-/]', '', 'g') || '_' || substr(period_of_report, 1, 4) || '_' || regexp_extract(complete_text_file_link, '([^/]*)[.]txt$', 1) || '.txt' END AS filename,
  CASE WHEN period_of_report IS NULL THEN 'no period of report' END AS reason FROM i"""
)
def enriched_filings(spark, sf):
    """Metadata filled from index pages: the document to fetch and the name it gets, and filings that cannot be placed."""
    rows = table(spark, sf, "filing_index").filter("complete_text_file_link IS NOT NULL").select(*_META).distinct()
    numbered = rows.withColumn("_at", F.concat("html_index", F.lit("#"), F.sha2(F.to_json(F.struct(*_META), {"ignoreNullFields": "false"}), 256)))
    pages = numbered.selectExpr("_at AS url", f"{_INDEX_PAGE} AS body")
    found = acquire.enrich(numbered.withColumn("html_index", F.col("_at")).drop("_at"), pages, spark.createDataFrame([], files.schemas.COMPANY), _WANTED, site="https://s")
    key = F.substring_index("html_index", "#", 1).alias("html_index")
    taken = found.filings.select(key, "document_link", "filename", F.lit(None).cast("string").alias("reason"))
    return taken.unionByName(found.rejects.select(key, "reason"), allowMissingColumns=True)


_NOTICE = "Your request will be managed until action is taken to declare your traffic."


@ARCHIVES.query(f"SELECT doc_id, lang IS NULL OR contains(text, '{_NOTICE[13:]}') AS throttled FROM documents")
def throttle_pages(spark, sf):
    """Documents as fetched pages, those of no language with the notice to a throttled client in the middle."""
    body = F.when(F.col("lang").isNull(), F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit(_NOTICE), F.lit("</p>"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(M.throttled(body), F.lit(False)).alias("throttled"))


def _archive_server():
    """A stored archive that answers like a busy one: first with an error, then with a notice, then the page; annual reports never, amendments are gone."""
    asked: dict[str, int] = {}

    def get(url: str) -> bytes:
        asked[url] = asked.get(url, 0) + 1
        if url.endswith("/gone"):
            raise FetchError(f"{url}: 404")
        if asked[url] == 1:
            raise OSError("reset")
        if asked[url] == 2 or url.endswith("/busy"):
            return _NOTICE.encode()
        return b"page of " + url.encode()

    return get


@ARCHIVES.query(
    """WITH u AS (SELECT DISTINCT html_index || CASE WHEN filing_type LIKE '%/A' THEN '/gone' WHEN filing_type = '4' THEN '/busy' ELSE '/ok' END AS url FROM filing_index)
SELECT url, CASE WHEN url LIKE '%/ok' THEN 'page of ' || url END AS body, CASE WHEN url LIKE '%/gone' THEN url || ': 404' WHEN url LIKE '%/busy' THEN url || ': throttled' END AS error FROM u"""
)
def fetched_pages(spark, sf):
    """Every index page through the fetch adapter with its retries; what cannot be fetched has the reason."""
    kind = F.when(F.col("filing_type").like("%/A"), "/gone").when(F.col("filing_type") == "4", "/busy").otherwise("/ok")
    urls = table(spark, sf, "filing_index").select(F.concat("html_index", kind).alias("url")).distinct()
    found = fetch_all(urls, with_retries(_archive_server(), tries=3, transport_tries=2, backoff=0.0))
    return found.select("url", F.col("body").cast("string").alias("body"), "error")


# ---- raw filings ------------------------------------------------------------------------------------------------

_RAW = "concat(coalesce(item_1, ''), chr(10), coalesce(item_7, ''), chr(233))"


def _stored(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Filings with their own form type and name; those with a first item have a raw file in the folder."""
    rows = table(spark, sf, "extracted_filings").select("filename", "filing_type", "item_1", "item_7").dropDuplicates(["filename"])
    rows = rows.withColumn("filing_type", F.regexp_replace("filing_type", "/", "_"))
    folder = scratch_folder(spark, "raw")
    sinks.write_raw(rows.filter("item_1 IS NOT NULL").select("filing_type", "filename", F.encode(F.expr(_RAW), "UTF-8").alias("body")), folder)
    return rows.select("filename", "filing_type"), folder


_RAW_SQL = f"WITH f AS (SELECT DISTINCT filename, replace(filing_type, '/', '_') AS filing_type, item_1, item_7 FROM extracted_filings) SELECT filename, filing_type, CASE WHEN item_1 IS NOT NULL THEN md5({_RAW}) END AS md5 FROM f"


@ARCHIVES.query(_RAW_SQL)
def raw_files_joined(spark, sf):
    """Raw files written, listed and joined with the metadata by form type and name."""
    rows, folder = _stored(spark, sf)
    return with_raw(rows, files.read_raw(spark, folder)).select("filename", "filing_type", F.md5("content").alias("md5"))


@ARCHIVES.query(_RAW_SQL)
def raw_files_by_path(spark, sf):
    """The same contents read by the rows' own paths, without a join."""
    rows, folder = _stored(spark, sf)
    return with_contents(rows, folder).select("filename", "filing_type", F.md5("content").alias("md5"))


@ARCHIVES.query(
    "WITH f AS (SELECT DISTINCT filename, replace(filing_type, '/', '_') AS filing_type, item_1 FROM extracted_filings WHERE item_1 IS NOT NULL) SELECT filename, filing_type FROM f"
)
def raw_file_listing(spark, sf):
    """The stored raw files, without their contents."""
    return files.list_raw(spark, _stored(spark, sf)[1]).select("filename", "filing_type")


@ARCHIVES.query(
    f"""WITH f AS (SELECT DISTINCT * FROM extracted_filings WHERE filing_type = '10-K' AND item_3 IS NOT NULL)
SELECT filename, cik, company, filing_html_index, {_collapse_sql(_clean_sql(f"concat(chr(10), 'Item 2. ', {_piece('item_2')})"))} AS item_2, '' AS item_16 FROM f"""
)
def extracted_files(spark, sf):
    """One JSON file per extracted filing, written and read back."""
    renamed = {"filing_html_index": "html_index", "htm_filing_link": "htm_file_link", "complete_text_filing_link": "complete_text_file_link"}
    found = extract(_mixed(spark, sf)).withColumnsRenamed(renamed)
    folder = scratch_folder(spark, "extracted")
    sinks.write_filings(found, folder)
    return spark.read.schema("filename string, cik string, company string, filing_html_index string, item_2 string, item_16 string").json(f"{folder}/*/*.json", multiLine=True)


@ARCHIVES.query(
    "WITH f AS (SELECT DISTINCT filename FROM extracted_filings), k AS (SELECT * FROM (VALUES "
    + ", ".join(f"({n}, '{k}')" for n, k in enumerate(output_key(i) for i in ITEMS_10K if i != "SIGNATURE"))
    + ") v(ord, key)) SELECT filename, ord, key FROM f, k"
)
def items_in_order(spark, sf):
    """Items come out in the order of the form's list."""
    found = long_items(extract(_filings(spark, sf, _compose(_TENK), "10-K")))
    return found.select("filename", "ord", "key")


# ---- texts over many lines, quarterly reports ---------------------------------------------------------------------


def _lines(column: str) -> str:
    """An item over its own lines; no line of it looks like a header, which a mark before the word prevents."""
    out = f"concat(chr(10), coalesce({column}, ''))"
    for word in ("item", "part", "signature"):
        for form in (word, word.upper(), word.capitalize()):
            for lead in ("", " ", "  ", "    "):
                out = f"replace({out}, concat(chr(10), '{lead}{form}'), concat(chr(10), '{lead}~{form}'))"
    return f"concat('first line', {out}, chr(10), 'see ~Item 7 and', chr(10), '12', chr(10), 'last line')"


_LINED = "concat(" + ", ".join(f"chr(10), 'Item {k}. ', {_lines(c)}" for k, c in _TENK.items()) + ", chr(10), 'SIGNATURES', chr(10), 'by')"


@ARCHIVES.query(_expect([output_key(i) for i in ITEMS_10K if i != "SIGNATURE"], {f"item_{k}": _collapse_sql(_clean_sql(f"concat(chr(10), 'Item {k}. ', {_lines(c)}, chr(10))")) for k, c in _TENK.items()}))
def items_10k_lines(spark, sf):
    """Items over many lines, with page numbers between and mentions of other items inside."""
    return _long(spark, sf, _LINED, "10-K")


_TOC_10Q = (
    "concat(chr(10), 'PART I', " + ", ".join(f"chr(10), 'Item {k}. {n}'" for n, k in enumerate(_P1, 3)) + ", chr(10), 'PART II', " + ", ".join(f"chr(10), 'Item {k}. {n}'" for n, k in enumerate(_P2, 30)) + ")"
)
_LONG_1 = f"concat({_PART1}, repeat(' financial statements of the quarter', 400))"
_TENQ_TOC = f"concat({_TOC_10Q}, chr(10), 'PART I', {_LONG_1}, ' ', chr(10), 'PART II', {_PART2}, chr(10), 'SIGNATURES', chr(10), 'by')"
_FOURTH = _collapse_sql(_clean_sql(f"concat(chr(10), 'Item 4. ', {_piece('item_9a')}, repeat(' financial statements of the quarter', 400))"))


@ARCHIVES.query(_expect([*_KEYS_10Q[:4], "part_2", *_KEYS_10Q[4:]], _VALUES_10Q | {"part_2": _WHOLE2, "part_1_item_4": _FOURTH}))
def items_10q_toc_part2(spark, sf):
    """A table of contents names both parts: their headers there are passed over."""
    return _long(spark, sf, _TENQ_TOC, "10-Q").filter("key <> 'part_1'")


_NO_HEADER_1 = f"concat({_TOC_10Q}, chr(10), 'front matter', {_LONG_1}, ' ', chr(10), 'PART II', {_PART2}, chr(10), 'SIGNATURES', chr(10), 'by')"
_BEFORE_2 = _collapse_sql(_clean_sql(f"concat({_TOC_10Q}, chr(10), 'front matter', {_LONG_1}, ' ')"))


# the longest stretch up to a second item begins where the contents name the first item of part two
_FIRST = _collapse_sql(_clean_sql("concat(" + ", ".join(f"chr(10), 'Item {k}. {n}'" for n, k in enumerate(_P2, 30)) + f", chr(10), 'front matter', chr(10), 'Item 1. ', {_piece('item_1')})"))


@ARCHIVES.query(_expect(["part_1", *_KEYS_10Q[:4], "part_2", *_KEYS_10Q[4:]], _VALUES_10Q | {"part_1": _BEFORE_2, "part_2": _WHOLE2, "part_1_item_1": _FIRST, "part_1_item_4": _FOURTH}))
def items_10q_excess(spark, sf):
    """Part one is named only in the contents, so part two would run over both: headers are passed over until it does not."""
    return _long(spark, sf, _NO_HEADER_1, "10-Q")


_MENTION = "chr(10), 'Part II, Item 1A of our annual report', repeat(' tells of further risks', 20)"
_WIDE = f"concat(chr(10), 'Part I', {_PART1}, {_MENTION}, ' ', chr(10), 'PART II', {_PART2}, chr(10), 'SIGNATURE', chr(10), 'by')"
_WIDE_1 = _collapse_sql(_clean_sql(f"concat(chr(10), 'Part I', {_PART1}, {_MENTION}, ' ')"))
_WIDE_4 = _collapse_sql(_clean_sql(f"concat(chr(10), 'Item 4. ', {_piece('item_9a')}, {_MENTION})"))


@ARCHIVES.query(_expect(["part_1", *_KEYS_10Q[:4], "part_2", *_KEYS_10Q[4:]], _VALUES_10Q | {"part_1": _WIDE_1, "part_2": _WHOLE2, "part_1_item_4": _WIDE_4}))
def items_10q_wide_gap(spark, sf):
    """A mention of part two ends part one too early: what stands before the header of part two belongs to part one."""
    return _long(spark, sf, _WIDE, "10-Q")


# ---- pages and line ends -----------------------------------------------------------------------------------------


@ARCHIVES.query("SELECT doc_id, regexp_matches(text, '(?i)<td[ />]') AND regexp_matches(text, '(?i)<tr[ />]') OR coalesce(source, '') = '10-k' AS html FROM documents")
def html_pages_told_apart(spark, sf):
    """Documents of one source laid out in a table are pages, the others texts."""
    page = F.when(F.col("source") == "10-k", F.concat(F.lit("<TABLE><tr align=left><TD>"), "text", F.lit("</TD></tr></TABLE>"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", X.looks_like_html(page).alias("html"))


@ARCHIVES.query("SELECT doc_id, md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10) || chr(10) || 'x') AS md5 FROM documents")
def line_ends_made_one(spark, sf):
    """Line ends of all kinds become line feeds."""
    odd = F.concat(F.regexp_replace("text", "\n", "\r\n"), F.lit("\r\r\nx"))
    return table(spark, sf, "documents").select("doc_id", F.md5(X.universal_newlines(odd)).alias("md5"))

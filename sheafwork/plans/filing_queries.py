"""Queries of the acquisition and extraction operators over the whole filing tables.

Raw filings are composed inside the queries from the items of
``extracted_filings`` by the same SQL text on both sides; the checking SQL knows
the pieces it composed, so it needs no segmentation to state the result.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.functions import html as H
from sheafwork.functions import text as X
from sheafwork.operators import metadata as M
from sheafwork.operators.items import ITEMS_8K, ITEMS_8K_OLD, ITEMS_10K, item_table, output_key, with_items
from sheafwork.plans.extract import Options, extract, json_column, long_items, not_yet_extracted, plain_text, status_counts
from sheafwork.plans.registry import Registry, table
from sheafwork.session import spread

FILINGS = Registry()
ARCHIVE = "https://archive.filings.test/Archives/"

# ---- acquisition ------------------------------------------------------------------------------------------------


@FILINGS.query("SELECT html_index, filing_type, filing_date FROM filing_index WHERE filing_type IN ('10-K', '10-Q', '8-K')")
def index_filter_type(spark, sf):
    return M.of_types(table(spark, sf, "filing_index"), ["10-K", "10-Q", "8-K"]).select("html_index", "filing_type", "filing_date")


@FILINGS.query("SELECT html_index, cik, company FROM filing_index WHERE cik IN (SELECT cik_str FROM company_tickers)")
def index_filter_company(spark, sf):
    companies = table(spark, sf, "company_tickers").select("cik_str")
    return M.of_companies(table(spark, sf, "filing_index"), companies).select("html_index", "cik", "company")


@FILINGS.query(
    f"""SELECT html_index AS relative_link, '{ARCHIVE}' || coalesce(html_index, 'nan') AS index_link, '{ARCHIVE}' || coalesce(complete_text_file_link, 'nan') AS text_link,
    replace(complete_text_file_link, '.txt', '-index.html') AS derived_link FROM filing_index"""
)
def index_link_projection(spark, sf):
    rows = table(spark, sf, "filing_index").withColumns({"relative_link": F.col("html_index"), "derived_link": M.index_page_link(F.col("complete_text_file_link"))})
    return M.with_links(rows, ARCHIVE).select("relative_link", F.col("html_index").alias("index_link"), F.col("complete_text_file_link").alias("text_link"), "derived_link")


_ACC = "regexp_replace(regexp_extract(complete_text_file_link, '([^/]*)$', 1), '([^.])\\.[^.]*$', '\\1')"
_EXT = "regexp_extract(coalesce(htm_file_link, complete_text_file_link), '([^.]*)$', 1)"


@FILINGS.query(
    f"""SELECT html_index, {_ACC} AS accession, {_EXT} AS ext,
    cik || '_' || regexp_replace(filing_type, '[-/\\\\]', '', 'g') || '_' || substr(period_of_report, 1, 4) || '_' || {_ACC} || '.' || {_EXT} AS raw_name FROM filing_index"""
)
def raw_filename_build(spark, sf):
    link = F.coalesce("htm_file_link", "complete_text_file_link")
    text_link = F.col("complete_text_file_link")
    name = M.raw_filename(F.col("cik"), F.col("filing_type"), F.col("period_of_report"), text_link, M.extension(link))
    return table(spark, sf, "filing_index").select("html_index", M.accession_number(text_link).alias("accession"), M.extension(link).alias("ext"), name.alias("raw_name"))


@FILINGS.query("SELECT html_index, 'https://a.test/' || htm_file_link AS link, 'htm' AS ext FROM filing_index WHERE htm_file_link IS NOT NULL")
def viewer_link_fix(spark, sf):
    viewer = F.concat(F.lit("https://a.test/ix?doc=/"), "htm_file_link")
    return table(spark, sf, "filing_index").filter("htm_file_link IS NOT NULL").select("html_index", M.direct_link(viewer).alias("link"), M.document_extension(viewer).alias("ext"))


@FILINGS.query("SELECT filename, split_part(filename, '.', 1) || '.json' AS json_name FROM filing_index")
def json_filename_build(spark, sf):
    return table(spark, sf, "filing_index").select("filename", M.json_filename(F.col("filename")).alias("json_name"))


@FILINGS.query(
    """WITH w AS (SELECT DISTINCT cik AS name FROM filing_index UNION ALL SELECT ticker FROM company_tickers UNION ALL SELECT 'no ' || ticker FROM company_tickers)
SELECT name, name AS cik FROM w WHERE regexp_full_match(name, '[0-9]+')
UNION ALL SELECT w.name, t.cik_str FROM w JOIN (SELECT DISTINCT * FROM company_tickers) t ON w.name = t.ticker WHERE NOT regexp_full_match(w.name, '[0-9]+')"""
)
def ticker_resolve(spark, sf):
    tickers = table(spark, sf, "company_tickers")
    wanted = table(spark, sf, "filing_index").select(F.col("cik").alias("name")).distinct().union(tickers.select("ticker")).union(tickers.select(F.concat(F.lit("no "), "ticker")))
    return M.resolve_tickers(wanted, tickers)


@FILINGS.query(f"SELECT html_index, filing_date, filename FROM filing_index i WHERE NOT EXISTS (SELECT 1 FROM extracted_filings e WHERE e.filing_html_index = '{ARCHIVE}' || i.html_index)")
def incremental_antijoin(spark, sf):
    held = table(spark, sf, "extracted_filings").select(F.replace("filing_html_index", F.lit(ARCHIVE), F.lit("")).alias("html_index"))
    return M.not_yet_held(table(spark, sf, "filing_index"), held).select("html_index", "filing_date", "filename")


@FILINGS.query("SELECT html_index, filename FROM filing_index i WHERE EXISTS (SELECT 1 FROM extracted_filings e WHERE e.filename = i.filename)")
def existing_semijoin(spark, sf):
    return M.with_present_file(table(spark, sf, "filing_index"), table(spark, sf, "extracted_filings")).select("html_index", "filename")


_LATEST = """SELECT regexp_replace(cik, '^0+', '') AS k, max_by(sic, (snapshot_date, loaded_at)) FILTER (sic IS NOT NULL) AS sic,
  max_by(state_location, (snapshot_date, loaded_at)) FILTER (state_location IS NOT NULL) AS state_location FROM company_snapshots GROUP BY 1"""


@FILINGS.query(
    f"""SELECT i.html_index, i.cik, coalesce(i.sic, d.sic) AS sic, coalesce(i.state_location, d.state_location) AS state_location, i.modified_at
FROM filing_index i LEFT JOIN ({_LATEST}) d ON i.cik = d.k"""
)
def company_fill_missing(spark, sf):
    when = F.struct("snapshot_date", "loaded_at")
    dim = table(spark, sf, "company_snapshots").groupBy(F.regexp_replace("cik", "^0+", "").alias("cik")).agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(when.alias("w"), F.col(c).alias("v")))).getField("v").alias(c) for c in ("sic", "state_location")]
    )
    return M.fill_from_companies(table(spark, sf, "filing_index"), dim, columns=("sic", "state_location")).select("html_index", "cik", "sic", "state_location", "modified_at")


@FILINGS.query("SELECT year(filing_date::date)::int AS year, quarter(filing_date::date)::int AS quarter, count(*) AS n_filings FROM filing_index GROUP BY 1, 2")
def quarter_counts(spark, sf):
    date = F.to_date("filing_date")
    return table(spark, sf, "filing_index").groupBy(F.year(date).alias("year"), F.quarter(date).alias("quarter")).agg(F.count("*").alias("n_filings"))


@FILINGS.query("SELECT html_index, filing_date FROM filing_index WHERE filing_type IN ('10-K', '10-Q') AND year(filing_date::date) BETWEEN 2008 AND 2012 AND quarter(filing_date::date) IN (1, 3)")
def quarter_prune_union(spark, sf):
    """The bag union of the chosen quarters in one scan, pruned and filtered by type."""
    date = F.to_date("filing_date")
    wanted = [y * 10 + q for y, q in M.periods(2008, 2012, (1, 3), "2024-01-01")]
    rows = M.of_types(table(spark, sf, "filing_index"), ["10-K", "10-Q"]).filter((F.year(date) * 10 + F.quarter(date)).isin(wanted))
    return rows.select("html_index", "filing_date")


@FILINGS.query("SELECT html_index, 'no period of report' AS reason FROM filing_index WHERE period_of_report IS NULL")
def period_rejects(spark, sf):
    return M.split_rejects(table(spark, sf, "filing_index"))[1].select("html_index", "reason")


@FILINGS.query(
    f"""SELECT html_index, filename FROM filing_index i WHERE NOT EXISTS (SELECT 1 FROM extracted_filings e WHERE e.filing_html_index = '{ARCHIVE}' || i.html_index)
UNION ALL SELECT replace(filing_html_index, '{ARCHIVE}', ''), filename FROM extracted_filings"""
)
def metadata_upsert(spark, sf):
    held = table(spark, sf, "extracted_filings").select(F.replace("filing_html_index", F.lit(ARCHIVE), F.lit("")).alias("html_index"), "filename")
    return M.upsert(held, M.not_yet_held(table(spark, sf, "filing_index").select("html_index", "filename"), held))


@FILINGS.query(
    """WITH done AS (SELECT DISTINCT split_part(filename, '.', 1) || '.json' AS n FROM extracted_filings)
SELECT html_index, filename FROM filing_index WHERE split_part(filename, '.', 1) || '.json' NOT IN (SELECT n FROM done WHERE n IS NOT NULL) OR filename IS NULL"""
)
def extracted_antijoin(spark, sf):
    done = table(spark, sf, "extracted_filings").select(M.json_filename(F.col("filename")).alias("n"))
    return not_yet_extracted(table(spark, sf, "filing_index"), done).select("html_index", "filename")


# ---- item lists -------------------------------------------------------------------------------------------------

_ERA = "CASE WHEN form_name <> '8-K' THEN true WHEN era_name = 'new' THEN filing_date::date > DATE '2004-08-23' ELSE NOT (filing_date::date > DATE '2004-08-23') END"


@FILINGS.query(
    f"""SELECT html_index, modified_at, item_pos::int - 1 AS ord, CASE WHEN part_name IS NULL THEN item_id ELSE part_name || '__' || item_id END AS item
FROM filing_index i JOIN item_lists l ON i.filing_type = l.form_name AND {_ERA}"""
)
def item_list_by_era(spark, sf):
    return with_items(table(spark, sf, "filing_index"), dim=item_table(table(spark, sf, "item_lists"))).select("html_index", "modified_at", "ord", "item")


@FILINGS.query(
    f"""SELECT html_index, modified_at, item_id AS item FROM filing_index i JOIN item_lists l ON i.filing_type = l.form_name AND {_ERA}
WHERE part_name IS NULL AND item_id IN ('1A', '7', '5.02', '9.01', '12')"""
)
def requested_items_intersect(spark, sf):
    wanted = F.array(*[F.lit(i) for i in ("1A", "7", "5.02", "9.01", "12")])
    per = with_items(table(spark, sf, "filing_index"), dim=item_table(table(spark, sf, "item_lists"))).groupBy("html_index", "modified_at", "received_at", "cik", "filename").agg(F.array_sort(F.collect_list("item")).alias("known"), F.count("*").alias("n"))
    # repeated deliveries repeat the list; the intersection is the same
    copies = F.aggregate("known", F.lit(0), lambda a, x: a + F.when(x == "SIGNATURE", 1).otherwise(0))
    chosen = per.select("html_index", "modified_at", F.explode(F.sequence(F.lit(1), copies)).alias("copy"), F.array_intersect(wanted, "known").alias("items"))
    return chosen.select("html_index", "modified_at", F.explode("items").alias("item"))


@FILINGS.query(
    """SELECT form_name AS form, item_pos::int - 1 AS ord, count(*) OVER (PARTITION BY form_name, era_name ORDER BY item_pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_next,
  part_name IS DISTINCT FROM lag(part_name) OVER (PARTITION BY form_name, era_name ORDER BY item_pos) AS part_changed FROM item_lists"""
)
def item_order_windows(spark, sf):
    return item_table(table(spark, sf, "item_lists")).selectExpr(
        "form", "ord", "size(collect_list(item) OVER (PARTITION BY form, era ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))::bigint AS n_next",
        "NOT (part <=> lag(part) OVER (PARTITION BY form, era ORDER BY ord)) AS part_changed",
    )


# ---- text functions ---------------------------------------------------------------------------------------------


def _re2(pattern: str) -> str:
    """A Java pattern of ours in the checking engine's syntax."""
    return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", pattern).replace("'", "''")


_H2, _W2 = _re2(X.HWS), _re2(X.WS)


def _sub(expr: str, pattern: str, replacement: str, flags: str = "gi") -> str:
    return f"regexp_replace({expr}, '{pattern}', {replacement}, '{flags}')"


def _clean_sql(expr: str) -> str:
    """Text cleaning in the checking engine, where a replacement knows nine groups: signatures are closed up in two steps."""
    chars = "chr(160) || chr(8203) || chr(8201) || " + " || ".join(f"chr({c})" for c in range(0x91, 0x9A)) + " || " + " || ".join(f"chr({c})" for c in range(0x2010, 0x2016))
    out = f"translate({expr}, {chars}, '   ‘’“”•--˜™------')"
    for word, tail in (("PART", rf"({_H2}+)((?:\p{{Nd}}{{1,2}}|[IV]{{1,2}})[AB]?)"), ("ITEM", rf"({_H2}+)(\p{{Nd}}{{1,2}}[AB]?)")):
        letters = f"{_H2}*".join(f"({c})" for c in word)
        out = _sub(out, rf"(\n{_H2}*){letters}{tail}", r"'\1\2\3\4\5\6\7'")
    spaced = lambda w: f"{_H2}*".join(w)
    end = rf"{_H2}*(?:S|\({_H2}*s{_H2}*\))?{_H2}+{_H2}?"
    first = f"{_H2}*".join(f"({c})" for c in "SIGN")
    out = _sub(out, rf"(\n{_H2}*){first}{_H2}*({spaced('ATURE')}{end})", r"'\1\2\3\4\5\6'")
    second = f"{_H2}*".join(f"({c})" for c in "ATURE")
    out = _sub(out, rf"(\n{_H2}*SIGN){second}{_H2}*((?:S|\({_H2}*s{_H2}*\))?)({_H2}+{_H2}?)", r"'\1\2\3\4\5\6\7\8'")
    out = _sub(out, rf"(\n{_H2}*SIGNATURE)\({_H2}*(s){_H2}*\)({_H2}+)", r"'\1(\2)\3'")
    out = _sub(out, rf"(ITEM|PART)({_W2}+\p{{Nd}}{{1,2}}[AB]?)([-•])", r"'\1\2 \3 '")
    for pattern, replacement in X.CLEANING[4:]:
        out = _sub(out, _re2(pattern), "chr(10)" if replacement == "\n" else "''")
    return out


def _collapse_sql(expr: str) -> str:
    out = _sub(f"translate({_sub(expr, r' *\n *\n[ \n]*', chr(39) + '#NEWLINE' + chr(39), 'g')}, chr(10), ' ')", "(?:#NEWLINE)+", "chr(10)", "g")
    return _sub(_sub(out, rf"^{_W2}+|{_W2}+$", "''", "g"), " {2,}", "' '", "g")


#: broken headers, navigation lines, page numbers and odd characters between whole items, the same in both engines
_MESSY = (
    "concat(chr(10), 'I t E M  1A-Risk', chr(160), 'x', chr(10), coalesce(item_1a, ''), chr(10), '-12-', chr(10), 'TABLE OF  CONTENTS', chr(10), 'see F-3', chr(10), "
    "'Page 7 ', chr(10), coalesce(item_7, ''), chr(10), 'P art II–x', chr(10), '3', chr(10), 'S i gnature ( s )  end', chr(10), chr(10), chr(10), coalesce(item_2, ''), ' #NEWLINE')"
)


@FILINGS.query(f"SELECT filename, {_clean_sql('m')} AS cleaned FROM (SELECT filename, {_MESSY} AS m FROM extracted_filings)")
def clean_text_items(spark, sf):
    return spread(table(spark, sf, "extracted_filings").select("filename", "item_1a", "item_2", "item_7")).selectExpr("filename", f"{_MESSY} AS m").select("filename", X.clean_text(F.col("m")).alias("cleaned"))


@FILINGS.query(f"SELECT filename, {_collapse_sql('m')} AS collapsed FROM (SELECT filename, {_MESSY} AS m FROM extracted_filings)")
def collapse_lines_items(spark, sf):
    return spread(table(spark, sf, "extracted_filings").select("filename", "item_1a", "item_2", "item_7")).selectExpr("filename", f"{_MESSY} AS m").select("filename", X.collapse_lines(F.col("m")).alias("collapsed"))


@FILINGS.query(
    f"""SELECT doc_id, CASE WHEN solid > 0 THEN digits / solid ELSE 0.0 END AS number_ratio, CASE WHEN n > 0 THEN (n - solid) / n ELSE 0.0 END AS blank_ratio FROM (
  SELECT doc_id, length(text) AS n, length(regexp_replace(text, '{_W2}', '', 'g')) AS solid, length(text) - length(regexp_replace(text, '\\p{{Nd}}', '', 'g')) AS digits FROM documents)"""
)
def char_ratio_documents(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select("doc_id", X.number_ratio(text).alias("number_ratio"), X.blank_ratio(text).alias("blank_ratio"))


_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_PAGE = f"concat('<html><body><p class=\"a\">', {_ESCAPED.format('text')}, '</p><div>', coalesce(source, ''), '</DIV></ div >x<br>y<br/>z<table><tr><td>1</td><td>2</ td></tr></table>&copy;&nbsp;<!-- gone --><i>end</i>')"
_PLAIN = "concat(text, chr(10), chr(10), coalesce(source, ''), chr(10), chr(10), 'x', chr(10), chr(10), 'y', chr(10), chr(10), 'z1  2  ', chr(10), chr(10), chr(169), chr(160), 'end')"


@F.pandas_udf(T.StringType())
def _strip(pages: pd.Series) -> pd.Series:
    return pages.map(H.strip_markup)


@FILINGS.query(f"SELECT doc_id, {_PLAIN} AS plain FROM documents")
def strip_markup_documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text", "source")).selectExpr("doc_id", f"{_PAGE} AS page").select("doc_id", _strip("page").alias("plain"))


@FILINGS.query(
    f"""SELECT doc_id, replace(replace(replace(replace({_PAGE}, '</p><div>', '</p>' || chr(10) || chr(10) || '<div>'), '</ div >x<br>y<br/>z', '</ div >' || chr(10) || chr(10) || 'x<br>' || chr(10) || chr(10) || 'y<br/>' || chr(10) || chr(10) || 'z'),
  '<tr><td>1</td><td>2</ td></tr>', '<tr><td>1 </td> <td>2 </ td> </tr>' || chr(10) || chr(10)), 'never there', '') AS marked FROM documents"""
)
def mark_block_ends_documents(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id", f"{_PAGE} AS page").select("doc_id", X.mark_block_ends(F.col("page")).alias("marked"))


_BODY = "concat(chr(10), coalesce(item_2, ''), chr(10))"
_SGML = (
    f"concat('<SEC-HEADER>', chr(10), '<DOCUMENT>', chr(10), '<TYPE>EX-99', chr(10), coalesce(item_3, ''), '</DOCUMENT><PDF>', coalesce(item_3, ''), chr(10), '</PDF>', "
    f"'<document>', chr(10), '<TYPE>', filing_type, chr(10), {_BODY}, '</document><DOCUMENT>no type', chr(10), '</DOCUMENT>')"
)


@FILINGS.query(f"SELECT filename, concat('<document>', chr(10), '<TYPE>', filing_type, chr(10), {_BODY}, '</document>') AS chosen, 3 AS n_documents FROM extracted_filings WHERE filing_type LIKE '10%' OR filing_type LIKE '8%'")
def sgml_main_document(spark, sf):
    rows = table(spark, sf, "extracted_filings").selectExpr("filename", f"{_SGML} AS raw").select("filename", X.drop_pdf(F.col("raw")).alias("raw"))
    return rows.select("filename", X.main_document(F.col("raw")).alias("chosen"), F.size(X.sub_documents(F.col("raw"))).alias("n_documents"))


@FILINGS.query(f"SELECT filename, concat({_BODY}, '<table border=1>', coalesce(item_6, ''), '</table>') AS kept FROM extracted_filings")
def text_table_removal(spark, sf):
    raw = f"concat({_BODY}, '<TABLE>', chr(10), coalesce(item_6, ''), '</table>', '<table border=1>', coalesce(item_6, ''), '</table>')"
    return table(spark, sf, "extracted_filings").selectExpr("filename", f"{raw} AS raw").select("filename", X.drop_text_tables(F.col("raw")).alias("kept"))


@FILINGS.query(f"SELECT filename, concat({_BODY}, 'Item', ' ', 'x', chr(10), 'y<span style=\"color:red\">', filename, '</span>') AS kept FROM extracted_filings")
def text_span_margin(spark, sf):
    raw = f"concat({_BODY}, 'Item<span style=\"font:x; margin-left: 3.5pt;\">a', cik, '</span>x<SPAN style=\"margin-top:2pt\"></SPAN>y<span style=\"color:red\">', filename, '</span>')"
    return table(spark, sf, "extracted_filings").selectExpr("filename", f"{raw} AS raw").select("filename", X.resolve_text_spans(F.col("raw")).alias("kept"))


# ---- composed filings -------------------------------------------------------------------------------------------


def _piece(column: str) -> str:
    """An item's whole text on one line; never empty."""
    return f"coalesce(nullif(trim(translate({column}, concat(chr(10), chr(13)), '  ')), ''), 'Not applicable to the registrant.')"


def _value(title: str, column: str) -> str:
    """What extraction must give for a piece under its title."""
    return _collapse_sql(_clean_sql(f"concat(chr(10), '{title}', {_piece(column)})"))


_ITEM_COLUMNS = ["item_1", "item_1a", "item_2", "item_3", "item_6", "item_7", "item_7a", "item_8", "item_9a", "signature"]
_TENK = {"1": "item_1", "1A": "item_1a", "2": "item_2", "3": "item_3", "6": "item_6", "7": "item_7", "7A": "item_7a", "8": "item_8", "9A": "item_9a"}


def _compose(pieces: dict[str, str], titles: str = "Item {0}. ", front: str = "''", signed: bool = True) -> str:
    body = ", ".join(f"chr(10), '{titles.format(k)}', {_piece(c)}" for k, c in pieces.items())
    return f"concat({front}, {body}" + (f", chr(10), 'SIGNATURES', chr(10), {_piece('signature')})" if signed else ")")


def _once(rows: DataFrame) -> DataFrame:
    """Rows without repeats: per filename and a hash of the row, so wide texts are not compared."""
    made = rows.withColumns({"_a": F.xxhash64(*rows.columns), "_b": F.xxhash64(F.lit(1), *rows.columns)})
    return made.dropDuplicates(["filename", "_a", "_b"]).drop("_a", "_b")


def _filings(spark: SparkSession, sf: str, raw: str, form: str, date: str = "filing_date") -> DataFrame:
    columns = ["filename", "filing_date", *_ITEM_COLUMNS]
    rows = _once(spread(table(spark, sf, "extracted_filings").select(*columns), "filename"))
    return rows.selectExpr("filename", f"'{form}' AS filing_type", f"{date} AS filing_date", f"{raw} AS content")


def _long(spark: SparkSession, sf: str, raw: str, form: str, options: Options = Options(), date: str = "filing_date") -> DataFrame:
    return long_items(extract(_filings(spark, sf, raw, form, date), options)).select("filename", "key", "value")


def _expect(keys: list[str], values: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT filename, '{k}' AS key, {values.get(k, chr(39) * 2)} AS value FROM f" for k in keys)
    columns = "filename, item_1, item_1a, item_2, item_3, item_6, item_7, item_7a, item_8, item_9a, signature"
    return f"WITH f AS (SELECT DISTINCT {columns} FROM extracted_filings) {rows}"


_KEYS_10K = [output_key(i) for i in ITEMS_10K if i != "SIGNATURE"]
_VALUES_10K = {f"item_{k}": _value(f"Item {k}. ", c) for k, c in _TENK.items()}
_TOC = "concat(chr(10), 'INDEX', " + ", ".join(f"chr(10), 'Item {k}. {n}'" for n, k in enumerate(_TENK, 3)) + ", chr(10), 'SIGNATURES 44', chr(10))"


@FILINGS.query(_expect(_KEYS_10K, _VALUES_10K))
def items_10k(spark, sf):
    return _long(spark, sf, _compose(_TENK), "10-K")


@FILINGS.query(_expect(_KEYS_10K, _VALUES_10K))
def items_10k_toc(spark, sf):
    """A table of contents in front must not be taken for the items."""
    return _long(spark, sf, _compose(_TENK, front=_TOC), "10-K")


@FILINGS.query(_expect(["item_1A", "item_7", "item_16"], _VALUES_10K))
def items_10k_requested_subset(spark, sf):
    return _long(spark, sf, _compose(_TENK), "10-K", Options(items=("7", "1A", "16", "5.02")))


@FILINGS.query(_expect([*_KEYS_10K, "SIGNATURE"], _VALUES_10K | {"SIGNATURE": _collapse_sql(_clean_sql(f"concat(chr(10), 'SIGNATURES', chr(10), {_piece('signature')})"))}))
def signature_tail(spark, sf):
    return _long(spark, sf, _compose(_TENK), "10-K", Options(include_signature=True))


_8K = {"1.01": "item_1", "2.02": "item_7", "5.02": "item_2", "8.01": "item_1a", "9.01": "item_6"}
_8K_OLD = {"1": "item_1", "4": "item_7", "5": "item_1a", "7": "item_2", "12": "item_3"}


@FILINGS.query(_expect([output_key(i) for i in ITEMS_8K if i != "SIGNATURE"], {f"item_{k}": _value(f"ITEM {k} ", c) for k, c in _8K.items()}))
def items_8k_new(spark, sf):
    return _long(spark, sf, _compose(_8K, "ITEM {0} "), "8-K", date="'2012-05-01'")


@FILINGS.query(_expect([output_key(i) for i in ITEMS_8K_OLD if i != "SIGNATURE"], {f"item_{k}": _value(f"Item {k}: ", c) for k, c in _8K_OLD.items()}))
def items_8k_obsolete(spark, sf):
    return _long(spark, sf, _compose(_8K_OLD, "Item {0}: "), "8-K", date="'2004-08-23'")


@FILINGS.query(_expect([output_key(i) for i in ITEMS_8K if i != "SIGNATURE"], {"item_5.02": _value("Item 5.02 ", "item_1a")}))
def items_8k_single(spark, sf):
    """One item and no signature: it runs to the end of the text."""
    return _long(spark, sf, _compose({"5.02": "item_1a"}, "Item {0} ", signed=False), "8-K", date="'2012-05-01'")


_P1 = {"1": "item_1", "2": "item_1a", "3": "item_7a", "4": "item_9a"}
_P2 = {"1": "item_3", "1A": "item_2", "6": "signature"}
_KEYS_10Q = [*[f"part_1_item_{i}" for i in "1234"], *[f"part_2_item_{i}" for i in ("1", "1A", "2", "3", "4", "5", "6")]]
_VALUES_10Q = {f"part_1_item_{k}": _value(f"Item {k}. ", c) for k, c in _P1.items()} | {f"part_2_item_{k}": _value(f"Item {k}. ", c) for k, c in _P2.items()}
_PART1, _PART2 = (f"concat({', '.join(f'chr(10), {chr(39)}Item {k}. {chr(39)}, {_piece(c)}' for k, c in p.items())})" for p in (_P1, _P2))
_WHOLE1 = _collapse_sql(_clean_sql(f"concat(chr(10), 'PART I', {_PART1}, ' ')"))
_WHOLE2 = _collapse_sql(_clean_sql(f"concat(chr(10), 'PART II', {_PART2})"))
_TENQ = f"concat(chr(10), 'PART I', {_PART1}, ' ', chr(10), 'PART II', {_PART2}, chr(10), 'SIGNATURES', chr(10), 'by')"
_TENQ_NO_1 = f"concat({_PART1}, ' ', chr(10), 'PART II', {_PART2}, chr(10), 'SIGNATURES', chr(10), 'by')"


@FILINGS.query(_expect(["part_1", *_KEYS_10Q[:4], "part_2", *_KEYS_10Q[4:]], _VALUES_10Q | {"part_1": _WHOLE1, "part_2": _WHOLE2}))
def items_10q_parts(spark, sf):
    return _long(spark, sf, _TENQ, "10-Q")


@FILINGS.query(
    _expect(["part_1", *_KEYS_10Q[:4], "part_2", *_KEYS_10Q[4:]], _VALUES_10Q | {"part_1": _collapse_sql(_clean_sql(f"concat({_PART1}, ' ')")), "part_2": _WHOLE2})
)
def items_10q_missing_part1(spark, sf):
    """No header of part one: all before part two is part one."""
    return _long(spark, sf, _TENQ_NO_1, "10-Q")


_HTML = (
    "concat('<html><body>', "
    + ", ".join(f"'<p>Item <span>{k}</span>. <span style=\"margin-left:3pt\"></span>', {_ESCAPED.format(_piece(c))}, '</p>'" for k, c in _TENK.items())
    + ", '<table><tr bgcolor=\"#CCEEFF\"><td>drop', {0}, '</td><td>1</td></tr></table><table><tr><td>kept</td><td>2</td></tr></table><p>SIGNATURES<br/>by</p></body></html>')".format(_ESCAPED.format(_piece("item_6")))
)
_LAST = _collapse_sql(_clean_sql(f"concat(chr(10), 'Item 9A.  ', {_piece('item_9a')}, chr(10), chr(10), ' kept  2 ')"))
_VALUES_HTML = {f"item_{k}": _value(f"Item {k}.  ", c) for k, c in _TENK.items()} | {"item_9A": _LAST}


@FILINGS.query(_expect(_KEYS_10K, _VALUES_HTML))
def items_10k_html(spark, sf):
    """An HTML filing: spans inside headers, a coloured table dropped, a plain one kept."""
    return _long(spark, sf, f"concat(chr(10), {_HTML})", "10-K")


@F.pandas_udf(T.StringType())
def _plain_10k(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: plain_text(p, "10-K", None, True))


@FILINGS.query(
    f"""SELECT DISTINCT filename, {_clean_sql("concat('a', chr(10), chr(10), 'k  2  ', chr(10), chr(10), '  ', chr(10), chr(10), 'Item 1. in a table  ', chr(10), chr(10), t, ' b')")} AS plain
FROM (SELECT filename, {_piece('item_2')} AS t FROM extracted_filings)"""
)
def html_table_removal(spark, sf):
    colour = 'style="background-color:#cceeff"'
    html = (
        f"concat('<p>a</p><table><tr {colour}><td>gone', {_ESCAPED.format(_piece('item_6'))}, '</td></tr></table><table><tr style=\"background:white\"><td>k</td><td>2</td></tr></table>', "
        f"'<table><tr><td></td></tr><tr {colour}><td>Item 1. in a table</td></tr></table>', {_ESCAPED.format(_piece('item_2'))}, '<span> </span>b')"
    )
    return _once(spread(table(spark, sf, "extracted_filings").selectExpr("filename", f"{html} AS page"), "filename")).select("filename", _plain_10k("page").alias("plain"))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Every filing under its own form; amendments and old annual forms have no item list."""
    raw = f"CASE WHEN item_3 IS NULL THEN 'nothing to find here' ELSE {_compose(_TENK)} END"
    return _once(spread(table(spark, sf, "extracted_filings"), "filename")).selectExpr("*", f"{raw} AS content")


@FILINGS.query(
    """SELECT CASE WHEN filing_type <> '10-K' THEN 'no item list for ' || filing_type WHEN item_3 IS NULL THEN 'no item found' ELSE 'extracted' END AS status, count(*) AS n_filings
FROM (SELECT DISTINCT * FROM extracted_filings) GROUP BY 1"""
)
def extraction_status_counts(spark, sf):
    return status_counts(extract(_mixed(spark, sf)))


@FILINGS.query("SELECT DISTINCT filename FROM extracted_filings WHERE filing_type = '10-K' AND item_3 IS NULL")
def all_null_reject(spark, sf):
    return extract(_mixed(spark, sf)).filter("status = 'no item found'").select("filename")


_META_JSON = ["cik", "company", "filing_type", "filing_date", "period_of_report", "sic", "state_of_inc", "state_location", "fiscal_year_end", "filing_html_index", "htm_filing_link", "complete_text_filing_link", "filename"]


@FILINGS.query(
    f"""WITH f AS (SELECT DISTINCT * FROM extracted_filings WHERE filing_type = '10-K' AND item_3 IS NOT NULL)
SELECT filename, cik, htm_filing_link, {_VALUES_10K['item_2']} AS item_2, '' AS item_16, true AS has_null_key FROM f"""
)
def extracted_json(spark, sf):
    found = extract(_mixed(spark, sf)).filter("status = 'extracted'")
    found = found.withColumnsRenamed({"filing_html_index": "html_index", "htm_filing_link": "htm_file_link", "complete_text_filing_link": "complete_text_file_link"})
    made = found.withColumn("json", json_column(found))
    keys = F.json_object_keys("json")
    return made.select(
        F.get_json_object("json", "$.filename").alias("filename"), F.get_json_object("json", "$.cik").alias("cik"), F.get_json_object("json", "$.htm_filing_link").alias("htm_filing_link"),
        F.get_json_object("json", "$.item_2").alias("item_2"), F.get_json_object("json", "$.item_16").alias("item_16"), F.array_contains(keys, "htm_filing_link").alias("has_null_key"),
    )


@FILINGS.query(
    "SELECT filing_type, item_name, count(t) AS n_present, sum(length(t))::bigint AS n_chars FROM (SELECT filing_type, "
    + ", ".join(_ITEM_COLUMNS) + " FROM extracted_filings) UNPIVOT INCLUDE NULLS (t FOR item_name IN (" + ", ".join(_ITEM_COLUMNS) + ")) GROUP BY 1, 2"
)
def item_coverage_by_form(spark, sf):
    pairs = F.array(*[F.struct(F.lit(c).alias("item_name"), F.length(c).cast("bigint").alias("n")) for c in _ITEM_COLUMNS])
    rows = table(spark, sf, "extracted_filings").select("filing_type", F.inline(pairs))
    return rows.groupBy("filing_type", "item_name").agg(F.count("n").alias("n_present"), F.sum("n").alias("n_chars"))


@FILINGS.query(
    "SELECT filename, item_name, n FROM (SELECT filename, item_name, length(t) AS n, row_number() OVER (PARTITION BY filename ORDER BY length(t) DESC, item_name) AS r FROM (SELECT DISTINCT filename, "
    + ", ".join(_ITEM_COLUMNS) + " FROM extracted_filings) UNPIVOT (t FOR item_name IN (" + ", ".join(_ITEM_COLUMNS) + "))) WHERE r = 1"
)
def longest_item_per_filing(spark, sf):
    """The first of the longest by name: a map-side aggregate on (length, name) instead of a window."""
    pairs = F.array(*[F.struct(F.length(c).cast("bigint").alias("n"), F.lit(c).alias("item_name")) for c in _ITEM_COLUMNS])
    best = F.array_sort(F.filter(pairs, lambda p: p["n"].isNotNull()), lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1)).otherwise(F.when(a["item_name"] < b["item_name"], -1).otherwise(1)))
    rows = table(spark, sf, "extracted_filings").select("filename", F.get(best, 0).alias("b")).filter("b IS NOT NULL").distinct()
    return rows.select("filename", "b.item_name", "b.n")

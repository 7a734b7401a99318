"""From quarterly indexes to metadata of new filings with their raw documents.

Stages are DataFrames; network access is an adapter, so the plan runs on stored
pages.  A company's page is fetched once, an index page once per new filing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import html as H
from sheafwork.operators import metadata as M
from sheafwork.schemas import METADATA
from sheafwork.sources.fetch import Fetcher, fetch_all

_PAGE = "filing_date string, period_of_report string, state_of_inc string, fiscal_year_end string, sic string, htm_link string, text_link string, document_type string"
_COMPANY = "company_name string, sic string, state_location string, state_of_inc string, fiscal_year_end string"


def _text(body) -> str | None:
    return None if body is None else body if isinstance(body, str) else bytes(body).decode("utf-8", "replace")


def index_page_columns(pages: DataFrame, filing_types: Sequence[str], body: str = "body") -> DataFrame:
    """``pages`` with ``page``, the facts of each index page."""
    types = list(filing_types)
    names = [f.split()[0] for f in _PAGE.split(", ")]

    @F.pandas_udf("struct<" + _PAGE.replace(" string", ": string") + ">")
    def read(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([H.index_page_facts(_text(b) or "", types) for b in bodies], columns=names, dtype=object)

    return pages.withColumn("page", read(body))


def company_columns(pages: DataFrame, body: str = "body") -> DataFrame:
    """``pages`` with ``company_page``, the facts of each company page."""
    names = [f.split()[0] for f in _COMPANY.split(", ")]

    @F.pandas_udf("struct<" + _COMPANY.replace(" string", ": string") + ">")
    def read(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([H.company_page_facts(_text(b) or "") for b in bodies], columns=names, dtype=object)

    return pages.withColumn("company_page", read(body))


def select_filings(index: DataFrame, filing_types: Sequence[str], companies: DataFrame | Sequence[str] | None = None, held: DataFrame | None = None, archive: str = M.ARCHIVE) -> DataFrame:
    """Index rows of the wanted types and companies with absolute links, without those held."""
    chosen = M.with_links(M.of_companies(M.of_types(index, filing_types), companies), archive)
    return chosen if held is None else M.not_yet_held(chosen, held)


@dataclass(frozen=True)
class Enriched:
    filings: DataFrame  # metadata columns and ``document_link``, ``document_type``
    rejects: DataFrame  # html_index, reason


def enrich(filings: DataFrame, index_pages: DataFrame, companies: DataFrame, filing_types: Sequence[str], site: str = "https://www.sec.gov") -> Enriched:
    """Fill metadata from fetched index pages (url, body) and the company table, and choose each filing's document.

    Rejected: no page, no period of report, no document to take.
    """
    pages = index_page_columns(index_pages.select(F.col("url").alias("_url"), "body"), filing_types).select("_url", "page", F.col("body").isNotNull().alias("_has"))
    joined = filings.join(pages, F.col("html_index") == F.col("_url"), "left")
    p = F.col
    viewer = F.concat(F.lit(site), p("page.htm_link"))
    filled = joined.withColumns({
        "crawled_filing_date": F.coalesce(p("page.filing_date"), p("crawled_filing_date")),
        "period_of_report": p("page.period_of_report"),
        "sic": F.coalesce(p("page.sic"), p("sic")),
        "state_of_inc": F.coalesce(p("page.state_of_inc"), p("state_of_inc")),
        "fiscal_year_end": F.coalesce(p("page.fiscal_year_end"), p("fiscal_year_end")),
        "htm_file_link": F.when(p("page.htm_link").isNotNull(), M.direct_link(viewer)).otherwise(p("htm_file_link")),
        "complete_text_file_link": F.coalesce(F.concat(F.lit(site), p("page.text_link")), p("complete_text_file_link")),
    })
    link = F.coalesce(F.when(p("page.htm_link").isNotNull(), p("htm_file_link")), F.when(p("page.text_link").isNotNull(), p("complete_text_file_link")))
    ext = F.when(p("page.htm_link").isNotNull(), M.document_extension(viewer)).otherwise(M.extension(link))
    kind = F.coalesce(p("page.document_type"), p("filing_type"))
    filled = filled.withColumns({"document_link": link, "document_type": kind, "filename": M.raw_filename(p("cik"), kind, p("period_of_report"), p("complete_text_file_link"), ext)})
    reason = F.when(F.col("_has").isNull() | ~F.col("_has"), "no index page").when(p("period_of_report").isNull(), "no period of report").when(p("document_link").isNull(), "no document")
    judged = filled.withColumn("reason", reason)
    good = M.fill_from_companies(judged.filter("reason IS NULL"), companies)
    return Enriched(good.select(*METADATA.names, "document_link", "document_type"), judged.filter("reason IS NOT NULL").select("html_index", "reason"))


def new_companies(filings: DataFrame, companies: DataFrame, site: str = "https://www.sec.gov") -> DataFrame:
    """(cik, url) of companies not in the table, each once."""
    missing = filings.select("cik").distinct().join(companies.select("cik"), "cik", "left_anti")
    return missing.withColumn("url", F.concat(F.lit(f"{site}/cgi-bin/browse-edgar?CIK="), "cik"))


def fetch_companies(missing: DataFrame, fetcher: Fetcher) -> DataFrame:
    """Rows of the company table for (cik, url)."""
    pages = fetch_all(missing, fetcher, keep=("cik",)).filter("body IS NOT NULL")
    return company_columns(pages).select("cik", "company_page.*")


def fetch_documents(filings: DataFrame, fetcher: Fetcher) -> DataFrame:
    """(filing_type, filename, url, body, error) of the chosen documents, for the raw sink."""
    wanted = filings.select(F.col("document_type").alias("filing_type"), "filename", F.col("document_link").alias("url"))
    return fetch_all(wanted, fetcher, keep=("filing_type", "filename"))

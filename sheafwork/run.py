"""The two pipelines from a settings file: ``python -m sheafwork.run settings.json [acquire] [extract]``."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork import config as C
from sheafwork.files import exists, listed
from sheafwork.log import get_logger
from sheafwork.operators import metadata as M
from sheafwork.plans import acquire as A
from sheafwork.plans import extract as E
from sheafwork.session import build_session, drop_scratch, materialise, spread
from sheafwork.sinks import MetadataTable, write_companies, write_filings, write_index_files, write_raw
from sheafwork.sources import files
from sheafwork.sources.fetch import Fetcher, fetch_all, http_fetcher

#: filings fetched and committed together; an interrupted run repeats at most so many
BATCH_FILINGS = 2000


def fetch_indexes(spark: SparkSession, settings: C.AcquireConfig, fetcher: Fetcher, today: str, log) -> list[str]:
    """Fetch the index tables of the wanted quarters, all or those not yet present; returns the paths of all present ones."""
    periods = M.periods(settings.start_year, settings.end_year, settings.quarters, today)
    absent = files.index_paths(spark, settings.indices_folder, periods, present=False)
    wanted = [(y, q) for y, q, _ in absent] if settings.skip_present_indices else periods
    log.info("%d of %d quarterly indexes to fetch", len(wanted), len(periods))
    if wanted:
        urls = spark.createDataFrame([(y, q, f"{settings.archive}edgar/full-index/{y}/QTR{q}/master.zip") for y, q in wanted], "year int, quarter int, url string")
        pages = materialise(fetch_all(urls.repartition(len(wanted)), fetcher, keep=("year", "quarter")), "indexes")
        for row in pages.filter("body IS NULL").select("url", "error").collect():  # a row per quarter
            log.info("no index from %s: %s", row.url, row.error)
        rows = files.parse_master_files(pages.select(F.concat_ws("/", "year", "quarter").alias("path"), F.col("body").alias("content")))
        period = F.split("source_file", "/")
        write_index_files(rows.withColumn("year", period[0].cast("int")).withColumn("quarter", period[1].cast("int")), settings.indices_folder)
    return [path for _, _, path in files.index_paths(spark, settings.indices_folder, periods)]


def wanted_companies(spark: SparkSession, settings: C.AcquireConfig, fetcher: Fetcher, tickers_url: str = "https://www.sec.gov/files/company_tickers.json") -> DataFrame | None:
    """(cik) of the companies asked for, None for all; the list of tickers is fetched only if a ticker was given."""
    if not settings.cik_tickers:
        return None
    names = files.read_names(spark, settings.cik_tickers)
    if names.filter(~F.col("name").rlike(r"^\p{Nd}+$")).isEmpty():
        return names.select(F.col("name").alias("cik"))
    known = files.parse_tickers(spark.createDataFrame([(fetcher(tickers_url).decode(),)], "value string"))
    return M.resolve_tickers(names, known).select("cik").distinct()


def acquire(spark: SparkSession, settings: C.AcquireConfig, fetcher: Fetcher | None = None, today: str | None = None, companies_file: str = "companies_info.json", batch: int = BATCH_FILINGS, log_file: str | None = None) -> dict:
    """Indexes, the filings not yet held, their pages and documents; the metadata table grows batch by batch.

    Held are filings whose metadata is in the table and whose raw file exists.
    Returns how many filings were new, stored and rejected.
    """
    log = get_logger("sheafwork.acquire", log_file)
    fetcher = fetcher or http_fetcher(settings.user_agent)
    paths = fetch_indexes(spark, settings, fetcher, today or date.today().isoformat(), log)
    counts = {"new": 0, "stored": 0, "rejected": 0}
    if not paths:
        log.info("no index, nothing to do")
        return counts
    table = MetadataTable(spark, settings.filings_metadata_file)
    known = table.read()
    held = materialise(M.with_present_file(known, files.list_raw(spark, settings.raw_filings_folder)), "held")
    if held.count() < known.count():
        table.replace(held)  # filings whose raw file is gone are fetched anew
    chosen = A.select_filings(files.read_index(spark, paths), settings.filing_types, wanted_companies(spark, settings, fetcher), held, settings.archive)
    new = materialise(chosen, "new")
    counts["new"] = new.count()
    log.info("%d filings are new", counts["new"])
    batches = -(-counts["new"] // batch)
    for n in range(batches):
        part = spread(new.filter(F.pmod(F.xxhash64("html_index"), F.lit(batches)) == n))
        pages = materialise(fetch_all(part.select(F.col("html_index").alias("url")), fetcher), "pages")
        companies = files.read_companies(spark, companies_file)
        found = materialise(A.fetch_companies(A.new_companies(part, companies), fetcher), "companies")
        companies = materialise(companies.unionByName(found), "companies")
        result = A.enrich(part, pages, companies, settings.filing_types)
        filings = materialise(result.filings, "filings")
        documents = materialise(A.fetch_documents(filings, fetcher), "documents")
        write_raw(documents, settings.raw_filings_folder)
        got = documents.filter("body IS NOT NULL").select(F.col("filing_type").alias("document_type"), "filename").distinct()
        # the raw file lies under the type of the document, so that is the filing's type from here on
        stored = materialise(filings.join(got, ["document_type", "filename"], "left_semi").withColumn("filing_type", F.col("document_type")), "stored")
        table.append(stored)
        if found.limit(1).count():
            write_companies(companies, companies_file)
        counts["stored"] += stored.count()
        rejects = result.rejects.unionByName(documents.filter("body IS NULL").select(F.col("url").alias("html_index"), F.col("error").alias("reason")))
        for row in rejects.groupBy("reason").count().orderBy("reason").limit(20).collect():
            log.info("%d filings rejected: %s", row["count"], row.reason)
        counts["rejected"] = counts["new"] - counts["stored"]
        log.info("batch %d of %d committed", n + 1, batches)
    return counts


def extract(spark: SparkSession, settings: C.ExtractConfig, log_file: str | None = None) -> dict[str, int]:
    """One JSON file per filing of the metadata table; returns how many filings have which status.

    Filings whose file exists are passed over if ``skip_extracted_filings`` is set.
    """
    log = get_logger("sheafwork.extract", log_file)
    rows = MetadataTable(spark, settings.filings_metadata_file).read() if exists(spark, f"{settings.filings_metadata_file}/commits") else files.read_metadata(spark, settings.filings_metadata_file)
    rows = M.of_types(rows, settings.filing_types)
    if settings.skip_extracted_filings:
        done = listed(spark, settings.extracted_filings_folder, "*/*.json").select(F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("name"))
        rows = E.not_yet_extracted(rows, done)
    options = E.Options(tuple(settings.items_to_extract), settings.remove_tables, settings.include_signature)
    found = materialise(E.extract(E.with_contents(spread(rows), settings.raw_filings_folder), options), "extracted")
    write_filings(found, settings.extracted_filings_folder)
    counts = {r.status: r.n_filings for r in E.status_counts(found).collect()}
    for status, n in sorted(counts.items()):
        log.info("%d filings: %s", n, status)
    return counts


def main(arguments: Sequence[str]) -> None:
    path, *stages = arguments
    settings = C.load(path)
    spark = build_session()
    try:
        if not stages or "acquire" in stages:
            acquire(spark, settings.acquire, log_file="acquire.log")
        if not stages or "extract" in stages:
            extract(spark, settings.extract, log_file="extract.log")
    finally:
        drop_scratch()
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

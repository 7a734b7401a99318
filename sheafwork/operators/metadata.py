"""Relational operators over filing indexes, metadata and company attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARCHIVE = "https://www.sec.gov/Archives/"
# Fixed value: the notice to a throttled client.
THROTTLED = "will be managed until action is taken to declare your traffic."


def with_links(index: DataFrame, archive: str = ARCHIVE, columns: Sequence[str] = ("complete_text_file_link", "html_index")) -> DataFrame:
    """Relative links made absolute; a missing link reads ``nan`` behind the prefix."""
    return index.withColumns({c: F.concat(F.lit(archive), F.coalesce(F.col(c), F.lit("nan"))) for c in columns})


def index_page_link(text_link: Column) -> Column:
    """The index page of a submission: every ``.txt`` becomes ``-index.html``."""
    return F.replace(text_link, F.lit(".txt"), F.lit("-index.html"))


def of_types(df: DataFrame, types: Sequence[str], column: str = "filing_type") -> DataFrame:
    """Exact form types; amendments only if named.  No types means all."""
    return df.filter(F.col(column).isin(*types)) if types else df


def of_companies(df: DataFrame, companies: DataFrame | Sequence[str] | None, column: str = "cik") -> DataFrame:
    """Rows of the given companies, exact strings; none given means all.

    A frame of companies, first column, is joined left-semi, so it may be of any size.
    """
    if companies is None:
        return df
    if isinstance(companies, DataFrame):
        wanted = companies.select(F.col(companies.columns[0]).alias("_wanted")).distinct()
        return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
    return df.filter(F.col(column).isin(*companies)) if companies else df


def resolve_tickers(wanted: DataFrame, tickers: DataFrame, name: str = "name", ticker: str = "ticker", cik: str = "cik_str") -> DataFrame:
    """(name, cik): numbers pass through, tickers are looked up letter by letter, unknown ones drop out."""
    number = wanted.filter(F.col(name).rlike(r"^\p{Nd}+$")).select(F.col(name).alias("name"), F.col(name).alias("cik"))
    symbol = wanted.filter(~F.col(name).rlike(r"^\p{Nd}+$")).select(F.col(name).alias("name"))
    known = tickers.select(F.col(ticker).alias("name"), F.col(cik).cast("string").alias("cik")).distinct()
    return number.unionByName(symbol.join(known, "name"))


def not_yet_held(index: DataFrame, held: DataFrame, key: str = "html_index") -> DataFrame:
    """Index rows whose key is not among those held; repeats within the index stay."""
    return index.join(held.select(F.col(key).alias("_held")).distinct(), F.col(key) == F.col("_held"), "left_anti")


def with_present_file(metadata: DataFrame, files: DataFrame, key: str = "filename") -> DataFrame:
    """Metadata whose raw file exists."""
    return metadata.join(files.select(F.col(key).alias("_file")).distinct(), F.col(key) == F.col("_file"), "left_semi")


def fill_from_companies(filings: DataFrame, companies: DataFrame, key: str = "cik", columns: Sequence[str] = ("sic", "state_of_inc", "state_location", "fiscal_year_end")) -> DataFrame:
    """Missing attributes filled from the company table, which holds one row per company."""
    dim = companies.select(F.col(key).alias("_cik"), *[F.col(c).alias(f"_dim_{c}") for c in columns])
    joined = filings.join(dim, F.col(key) == F.col("_cik"), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_dim_{c}")) for c in columns}).drop("_cik", *[f"_dim_{c}" for c in columns])


def type_name(filing_type: Column) -> Column:
    return F.regexp_replace(filing_type, r"[\-/\\]", "")


def accession_number(text_link: Column) -> Column:
    """The last path part of the complete-text link without its last extension."""
    base = F.element_at(F.split(text_link, "/"), -1)
    return F.regexp_replace(base, r"(?<=[^.])\.[^.]*$", "")


def extension(link: Column) -> Column:
    return F.element_at(F.split(link, r"\."), -1)


VIEWER = "ix?doc=/"


def direct_link(link: Column) -> Column:
    """The document behind a viewer link."""
    return F.replace(link, F.lit(VIEWER), F.lit(""))


def document_extension(link: Column) -> Column:
    return F.when(F.contains(link, F.lit(VIEWER)), F.lit("htm")).otherwise(extension(link))


def raw_filename(cik: Column, filing_type: Column, period: Column, text_link: Column, ext: Column) -> Column:
    """``{cik}_{type}_{year}_{accession}.{ext}``; null if any part is."""
    stem = F.concat(cik, F.lit("_"), type_name(filing_type), F.lit("_"), F.substring(period, 1, 4), F.lit("_"), accession_number(text_link))
    return F.concat(stem, F.lit("."), ext)


def json_filename(filename: Column) -> Column:
    """Up to the first dot."""
    return F.concat(F.substring_index(filename, ".", 1), F.lit(".json"))


def split_rejects(filings: DataFrame, period: str = "period_of_report") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with reason): filings without a period of report cannot be placed."""
    return filings.filter(F.col(period).isNotNull()), filings.filter(F.col(period).isNull()).withColumn("reason", F.lit("no period of report"))


def upsert(held: DataFrame, new: DataFrame) -> DataFrame:
    return held.unionByName(new, allowMissingColumns=True)


def throttled(body: Column) -> Column:
    """Whether a fetched page is the notice of a throttled client."""
    return F.contains(body, F.lit(THROTTLED))


def periods(start_year: int, end_year: int, quarters: Sequence[int], today: str) -> list[tuple[int, int]]:
    """(year, quarter) to fetch; within the current year stops at the first quarter that has not begun."""
    year, month = int(today[:4]), int(today[5:7])
    out = []
    for y in range(start_year, end_year + 1):
        for q in quarters:
            if q not in (1, 2, 3, 4):
                raise ValueError(f"no quarter {q}")
            if y == year and q > -(-month // 3):
                break
            out.append((y, q))
    return out

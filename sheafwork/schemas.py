"""Schemas of the filing tables.  All values are strings; a missing one is null."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the index and metadata files, in order, with our names for them.
FILE_COLUMNS = {
    "CIK": "cik", "Company": "company", "Type": "filing_type", "Date": "filing_date",
    "complete_text_file_link": "complete_text_file_link", "html_index": "html_index",
    "Filing Date": "crawled_filing_date", "Period of Report": "period_of_report", "SIC": "sic",
    "htm_file_link": "htm_file_link", "State of Inc": "state_of_inc", "State location": "state_location",
    "Fiscal Year End": "fiscal_year_end", "filename": "filename",
}
# Keys of an extracted filing, in order, and the metadata they come from.
OUTPUT_KEYS = {
    "cik": "cik", "company": "company", "filing_type": "filing_type", "filing_date": "filing_date",
    "period_of_report": "period_of_report", "sic": "sic", "state_of_inc": "state_of_inc",
    "state_location": "state_location", "fiscal_year_end": "fiscal_year_end", "filing_html_index": "html_index",
    "htm_filing_link": "htm_file_link", "complete_text_filing_link": "complete_text_file_link", "filename": "filename",
}

METADATA = T.StructType([T.StructField(c, T.StringType()) for c in FILE_COLUMNS.values()])
METADATA_FILE = T.StructType([T.StructField(c, T.StringType()) for c in FILE_COLUMNS])
INDEX = T.StructType(METADATA.fields[:6])
COMPANY = T.StructType([T.StructField(c, T.StringType()) for c in ("cik", "company_name", "sic", "state_location", "state_of_inc", "fiscal_year_end")])

"""Settings of the two plans, readable from one JSON file with a section for each."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class AcquireConfig:
    start_year: int = 2023
    end_year: int = 2023
    quarters: tuple[int, ...] = (1, 2, 3, 4)
    filing_types: tuple[str, ...] = ("10-K", "10-Q", "8-K")
    #: company numbers or tickers, or the path of a file with one a line; empty for all companies
    cik_tickers: tuple[str, ...] | str = ()
    user_agent: str = ""
    raw_filings_folder: str = "RAW_FILINGS"
    indices_folder: str = "INDICES"
    filings_metadata_file: str = "FILINGS_METADATA.csv"
    skip_present_indices: bool = True
    archive: str = "https://www.sec.gov/Archives/"

    def __post_init__(self) -> None:
        wrong = [q for q in self.quarters if q not in (1, 2, 3, 4)]
        if wrong:
            raise ValueError(f"quarters must be 1 to 4, not {wrong}")


@dataclass(frozen=True)
class ExtractConfig:
    raw_filings_folder: str = "RAW_FILINGS"
    extracted_filings_folder: str = "EXTRACTED_FILINGS"
    filings_metadata_file: str = "FILINGS_METADATA.csv"
    filing_types: tuple[str, ...] = ("10-K", "10-Q", "8-K")
    include_signature: bool = False
    items_to_extract: tuple[str, ...] = ()
    remove_tables: bool = True
    skip_extracted_filings: bool = True


@dataclass(frozen=True)
class Config:
    acquire: AcquireConfig = field(default_factory=AcquireConfig)
    extract: ExtractConfig = field(default_factory=ExtractConfig)


def load(path: str) -> Config:
    """Sections ``download_filings`` and ``extract_items``; unknown keys are ignored, missing ones take defaults."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)

    def make(kind, section: str):
        known = {f.name for f in fields(kind)}
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.get(section, {}).items() if k in known}
        return kind(**values)

    return Config(make(AcquireConfig, "download_filings"), make(ExtractConfig, "extract_items"))

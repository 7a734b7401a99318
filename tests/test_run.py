"""Both pipelines on a stored archive."""

import io
import json
import zipfile

from sheafwork import run
from sheafwork.config import AcquireConfig, ExtractConfig
from sheafwork.sinks import MetadataTable
from sheafwork.sources.fetch import FetchError

SITE = "https://www.sec.gov"
TENK = "\nItem 1. Business\nWe sell.\nItem 2. Properties\nNone.\nSIGNATURES\nby"


def page(cik, period="2019-12-31"):
    when = f'<div class="infoHead">Period of Report</div><div class="info">{period}</div>' if period else ""
    return f"""<div><div class="infoHead">Filing Date</div><div class="info">2020-02-03</div>{when}</div>
<table summary="Document Format Files"><tr><th>a</th></tr><tr><td>1</td><td>x</td><td><a href="/d/{cik}.htm">d</a></td><td>10-K</td></tr></table>"""


def archive():
    """(pages by address); company 3 has no period of report, company 4 no document, company 5 no page."""
    lines = ["h"] * 11 + [f"{c}|Company {c}|10-K|2020-02-03|edgar/data/{c}/000{c}-20-1.txt" for c in range(1, 6)] + ["6|Other|4|2020-02-03|edgar/data/6/0006-20-1.txt"]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("master.idx", "\n".join(lines) + "\n")
    out = {f"{SITE}/Archives/edgar/full-index/2020/QTR1/master.zip": packed.getvalue()}
    for c in range(1, 5):
        out[f"{SITE}/Archives/edgar/data/{c}/000{c}-20-1-index.html"] = page(c, None if c == 3 else "2019-12-31").encode()
        out[f"{SITE}/cgi-bin/browse-edgar?CIK={c}"] = b'<div class="companyInfo"><p class="identInfo">State location: <a href="/x&amp;State=CA">CA</a></p></div>'
    for c in (1, 2):
        out[f"{SITE}/d/{c}.htm"] = TENK.encode()
    out["https://www.sec.gov/files/company_tickers.json"] = json.dumps({"0": {"cik_str": 2, "ticker": "TWO"}}).encode()
    return out


def fetcher_of(pages):
    def get(url):
        if url not in pages:
            raise FetchError(f"{url}: missing")
        return pages[url]

    return get


def settings(tmp_path, **more):
    where = dict(raw_filings_folder=f"{tmp_path}/RAW", filings_metadata_file=f"{tmp_path}/META")
    return AcquireConfig(start_year=2020, end_year=2020, quarters=(1, 2), filing_types=("10-K",), indices_folder=f"{tmp_path}/INDICES", **where, **more), ExtractConfig(extracted_filings_folder=f"{tmp_path}/OUT", filing_types=("10-K",), **where)


def test_acquire_then_extract_then_nothing_new(spark, tmp_path):
    pages = archive()
    acquiring, extracting = settings(tmp_path)
    options = dict(today="2021-01-01", companies_file=f"{tmp_path}/companies.json", batch=2, log_file=f"{tmp_path}/run.log")
    assert run.acquire(spark, acquiring, fetcher_of(pages), **options) == {"new": 5, "stored": 2, "rejected": 3}
    held = MetadataTable(spark, acquiring.filings_metadata_file)
    assert sorted((r.cik, r.filename, r.state_location) for r in held.read().collect()) == [(str(c), f"{c}_10K_2019_000{c}-20-1.htm", "CA") for c in (1, 2)]
    log = (tmp_path / "run.log").read_text()
    assert "no index from" in log and "no period of report" in log and "batch 3 of 3 committed" in log
    assert run.extract(spark, extracting) == {"extracted": 2}
    made = json.loads((tmp_path / "OUT/10-K/1_10K_2019_0001-20-1.json").read_text())
    assert made["item_2"] == "Item 2. Properties None." and made["company"] == "Company 1"
    assert run.extract(spark, extracting) == {}  # their files exist
    del pages[f"{SITE}/Archives/edgar/full-index/2020/QTR1/master.zip"]  # the index is present and not fetched again
    assert run.acquire(spark, acquiring, fetcher_of(pages), **options) == {"new": 3, "stored": 0, "rejected": 3}
    (tmp_path / "RAW/10-K/1_10K_2019_0001-20-1.htm").unlink()  # without its raw file a filing is no longer held
    assert run.acquire(spark, acquiring, fetcher_of(pages), **options)["stored"] == 1
    assert held.read().count() == 2


def test_companies_by_ticker_and_no_index(spark, tmp_path):
    acquiring, _ = settings(tmp_path, cik_tickers=("TWO", "none", "1"))
    options = dict(today="2021-01-01", companies_file=f"{tmp_path}/companies.json")
    assert run.acquire(spark, acquiring, fetcher_of({}), **options) == {"new": 0, "stored": 0, "rejected": 0}
    assert run.acquire(spark, acquiring, fetcher_of(archive()), **options) == {"new": 2, "stored": 2, "rejected": 0}

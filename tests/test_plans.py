"""Sources, acquisition, extraction, sinks and streams on small files."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sheafwork import config, schemas, sinks, sql
from sheafwork.operators import metadata as M
from sheafwork.plans import acquire, extract as E
from sheafwork.sources import fetch, files
from sheafwork.streaming import files as stream
from tests.test_text import INDEX_PAGE

FILING = "\nItem 1. Business\nWe sell.\nItem 2. Properties\nNone.\nSIGNATURES\nby"


def test_master_index(spark, tmp_path):
    lines = ["header"] * 11 + ["123|ACME É|10-K|2020-01-02|edgar/data/123/0001-20-000001.txt", "bad line"]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("master.idx", "\n".join(lines).encode("latin-1"))
    (tmp_path / "a.zip").write_bytes(packed.getvalue())
    row = files.parse_master_index(spark, str(tmp_path / "a.zip")).first()
    assert row.company == "ACME É" and row.html_index == "edgar/data/123/0001-20-000001-index.html"


def test_index_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("1", "NA", "10-K", "2020-01-01", "a.txt", "a-index.html", 2020, 1), ("2", None, "10-K", None, "b.txt", "b-index.html", None, None)], "cik string, company string, filing_type string, filing_date string, complete_text_file_link string, html_index string, year int, quarter int")
    sinks.write_index_files(rows, str(tmp_path))
    path = f"{tmp_path}/2020_QTR1.tsv"
    assert files.index_paths(spark, str(tmp_path), [(2020, 1), (2020, 2)]) == [(2020, 1, path)]
    assert files.index_paths(spark, str(tmp_path), [(2020, 1), (2020, 2)], present=False) == [(2020, 2, f"{tmp_path}/2020_QTR2.tsv")]
    row = files.read_index(spark, [path]).first()
    assert row.cik == "1" and row.company is None and row.filename is None and len(row) == 14


def test_metadata_table_commits_and_survives_an_interruption(spark, tmp_path, monkeypatch):
    table = sinks.MetadataTable(spark, f"file://{tmp_path}/META.csv")
    make = lambda key: spark.createDataFrame([tuple("x" if c != "html_index" else key for c in schemas.METADATA.names)], schemas.METADATA)
    keys = lambda: sorted(r.html_index for r in table.read().collect())
    assert keys() == []
    table.append(make("a"))
    table.append(make('b, "q"'))
    assert keys() == ["a", 'b, "q"']
    monkeypatch.setattr(table.commits, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.append(make("c"))
    monkeypatch.undo()
    assert keys() == ["a", 'b, "q"']
    table.replace(M.upsert(table.read().filter("html_index = 'a'"), make("d")))
    assert keys() == ["a", "d"]


def test_files_are_replaced_whole(tmp_path):
    from sheafwork.files import read_file, replace_file

    path = f"file://{tmp_path}/x/y/a.bin"
    assert read_file(path) is None
    replace_file(path, b"1")
    replace_file(path, b"22")
    assert read_file(path) == b"22" == read_file(f"{tmp_path}/x/y/a.bin") and [p.name for p in (tmp_path / "x/y").iterdir()] == ["a.bin"]


def test_contents_by_path(spark, tmp_path):
    folder = raw_folder(tmp_path)
    rows = E.with_contents(metadata(spark), folder)
    assert {r.filename: r.content is None for r in rows.collect()}["4_missing.txt"] is True
    status = {r.filename: r.status for r in E.extract(rows).collect()}
    assert status["1_10K_2020_a.txt"] == "extracted" and status["4_missing.txt"] == "no raw file"


def test_logger(tmp_path, capsys):
    from sheafwork.log import get_logger

    log = get_logger("sheafwork.test", str(tmp_path / "a.log"))
    assert get_logger("sheafwork.test", str(tmp_path / "a.log")) is log and len(log.handlers) == 2
    log.debug("quiet")
    log.info("loud")
    assert "quiet" in (tmp_path / "a.log").read_text() and "loud" in (tmp_path / "a.log").read_text()
    shown = capsys.readouterr().err
    assert "loud" in shown and "quiet" not in shown


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from sheafwork import session

    unset = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda k: None), _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(RuntimeError):
        session.scratch_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=context))


def test_lists_and_companies(spark, tmp_path):
    (tmp_path / "names.txt").write_text("AAA\n\n 12 \n")
    assert sorted(r.name for r in files.read_names(spark, str(tmp_path / "names.txt")).collect()) == ["12", "AAA"]
    (tmp_path / "t.json").write_text(json.dumps({"0": {"ticker": "BBB", "cik_str": 5}, "1": {"ticker": "AAA", "cik_str": 4}}))
    tickers = files.read_tickers(spark, str(tmp_path / "t.json"))
    assert [r.ticker for r in tickers.collect()] == ["AAA", "BBB"]
    resolved = M.resolve_tickers(files.read_names(spark, ["AAA", "12", "aaa"]), tickers)
    assert sorted((r.name, r.cik) for r in resolved.collect()) == [("12", "12"), ("AAA", "4")]
    assert files.read_companies(spark, str(tmp_path / "none.json")).count() == 0
    table = spark.createDataFrame([("1", "Acme", None, "CA", None, None)], schemas.COMPANY)
    sinks.write_companies(table, str(tmp_path / "c.json"))
    assert files.read_companies(spark, str(tmp_path / "c.json")).first() == table.first()


def test_periods_stop_in_the_current_year():
    assert M.periods(2023, 2024, (1, 2, 3, 4), "2024-05-01") == [(2023, 1), (2023, 2), (2023, 3), (2023, 4), (2024, 1), (2024, 2)]
    assert M.periods(2024, 2024, (4, 1), "2024-05-01") == []
    with pytest.raises(ValueError):
        M.periods(2023, 2023, (5,), "2024-05-01")
    with pytest.raises(ValueError):
        config.AcquireConfig(quarters=(0,))


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"download_filings": {"start_year": 2020, "quarters": [1]}, "extract_items": {"include_signature": True, "odd": 1}}))
    loaded = config.load(str(path))
    assert loaded.acquire.quarters == (1,) and loaded.extract.include_signature and loaded.extract.remove_tables


def test_acquire_on_stored_pages(spark):
    pages = {"https://a/1-index.html": INDEX_PAGE.encode(), "https://www.sec.gov/cgi-bin/browse-edgar?CIK=9": b'<div class="companyInfo"><p class="identInfo">State location: <a href="/x&amp;State=CA">CA</a></p></div>'}

    def fetcher(url):
        if url not in pages:
            raise fetch.FetchError("missing")
        return pages[url]

    index = spark.createDataFrame([("9", "Acme", "10-K", "2020-02-03", "x/0001-20-7.txt", "1-index.html"), ("9", "Acme", "10-K", "2020-02-03", "x/b.txt", "2-index.html"), ("8", "B", "4", "2020-01-01", "c.txt", "3-index.html")], schemas.INDEX)
    index = index.select("*", *[F.lit(None).cast("string").alias(c) for c in schemas.METADATA.names[6:]])
    chosen = acquire.select_filings(index, ["10-K"], ["9"], archive="https://a/")
    got = fetch.fetch_all(chosen.select(F.col("html_index").alias("url")), fetcher)
    companies = acquire.fetch_companies(acquire.new_companies(chosen, spark.createDataFrame([], schemas.COMPANY)), fetcher)
    result = acquire.enrich(chosen, got, companies, ["10-K"])
    row = result.filings.first()
    assert result.filings.count() == 1
    assert row.filename == "9_10K_2019_0001-20-7.htm" and row.state_location == "CA" and row.sic == "3571" and row.crawled_filing_date == "2020-02-03"
    assert row.document_link == "https://www.sec.gov/Archives/a/d2.htm"
    assert [(r.html_index, r.reason) for r in result.rejects.collect()] == [("https://a/2-index.html", "no index page")]


def raw_folder(tmp_path):
    for form, name, body in (("10-K", "1_10K_2020_a.txt", FILING), ("10-K", "2_10K_2020_b.txt", "nothing"), ("4", "3_4_2020_c.txt", FILING)):
        (tmp_path / "raw" / form).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / form / name).write_bytes(body.replace("\n", "\r\n").encode() + b"\xff")
    return str(tmp_path / "raw")


def metadata(spark):
    rows = [("1", "10-K", "1_10K_2020_a.txt"), ("2", "10-K", "2_10K_2020_b.txt"), ("3", "4", "3_4_2020_c.txt"), ("4", "10-K", "4_missing.txt")]
    return spark.createDataFrame(rows, "cik string, filing_type string, filename string").withColumn("filing_date", F.lit("2020-01-01"))


def test_extract_to_json(spark, tmp_path):
    folder = raw_folder(tmp_path)
    found = E.extract(E.with_raw(metadata(spark), files.read_raw(spark, folder)))
    status = {r.filename: r.status for r in found.collect()}
    assert status == {"1_10K_2020_a.txt": "extracted", "2_10K_2020_b.txt": "no item found", "3_4_2020_c.txt": "no item list for 4", "4_missing.txt": "no raw file"}
    sinks.write_filings(found, str(tmp_path / "out"))
    made = json.loads((tmp_path / "out/10-K/1_10K_2020_a.json").read_text())
    assert list(made)[:3] == ["cik", "company", "filing_type"] and made["company"] is None
    assert made["item_2"] == "Item 2. Properties None." and made["item_7"] == "" and "SIGNATURE" not in made
    native = json.loads(found.filter("status = 'extracted'").select(E.json_column(found)).first()[0])
    assert native == made
    wide = E.wide_items(found, ["item_1", "item_99"]).first()
    assert wide.item_1.startswith("Item 1.") and wide.item_99 is None
    assert E.not_yet_extracted(metadata(spark), spark.createDataFrame([("1_10K_2020_a.json",)], "n string")).count() == 3
    assert files.list_raw(spark, folder).count() == 3
    sinks.write_items_table(found, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1


def test_stream_handles_each_file_once(spark, tmp_path):
    folder = raw_folder(tmp_path)
    run = lambda: stream.extract_stream(stream.raw_stream(spark, folder), lambda: metadata(spark), str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
    run()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    run()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    (tmp_path / "raw/10-K/4_missing.txt").write_bytes(FILING.encode())
    run()
    assert spark.read.parquet(str(tmp_path / "s")).filter("status = 'extracted'").count() == 2


def test_sql_names(spark):
    sql.register(spark)
    assert spark.sql("SELECT collapse_lines(clean_filing_text(strip_markup('<p>a</p>b')))").first()[0] == "a\nb"
    rows = spark.createDataFrame([(FILING, "10-K", "2020-01-01"), (None, "10-K", None), (FILING, "4", None)], "c string, f string, d string")
    rows.createOrReplaceTempView("raws")
    got = spark.sql("SELECT key, value FROM raws, LATERAL filing_items(c, f, d) WHERE value <> ''").collect()
    assert {r.key for r in got} == {"item_1", "item_2"}


def test_fetcher_gives_up():
    with pytest.raises(fetch.FetchError):
        fetch.http_fetcher("x", tries=1, transport_tries=1, timeout=0.2)("http://127.0.0.1:9/none")

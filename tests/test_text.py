"""Text functions: worked vectors, and native expressions against their Python twins."""

import random

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import html as H
from sheafwork.functions import text as X
from sheafwork.plans.extract import main_document, plain_text


@pytest.mark.parametrize(
    "given, expected",
    [
        ("a\n1\n2\n3\n4\nb", "a\n4\nb"), ("a\n1\n2\n3\nb", "a\nb"), ("a\n-1-\n-2-\nb", "a\n-2-\nb"), ("see f16 and F-12 x", "see and x"),
        ("Item 1A-Risk", "Item 1A - Risk"), ("\nI T E M  1A x", "\nITEM  1A x"), ("\n S I G NATURE ( s ) \nx", "\n SIGNATURE(s) \nx"),
        ("a\n table of  contents \nb", "a\nb"), ("a\nPage 3\nb", "ab"), ("", ""),
    ],
)
def test_clean(given, expected):
    assert X.clean_text_py(given) == expected


def test_native_equals_python(spark):
    rng = random.Random(3)
    tokens = ["\n", " ", "\t", "\xa0", "\x1c", "\x85", "ITEM", "I T E M", "p art", "PART", "II", "1A", "7", "S I GNATURE", "( s )", "-", "•", "F-", "Page", "*", "TABLE OF CONTENTS", "٣", "ſ", "#NEWLINE", "x", "—"]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", X.clean_text(F.col("t")).alias("c"), X.collapse_lines(F.col("t")).alias("l")).collect()
    for r in rows:
        assert r.c == X.clean_text_py(r.t), repr(r.t)
        assert r.l == X.collapse_lines_py(r.t), repr(r.t)


def test_collapse_survives_long_runs(spark):
    df = spark.createDataFrame([("a" + "\n" * 100_000 + "b",)], "t string")
    assert df.select(X.collapse_lines(F.col("t"))).first()[0] == "a\nb"


@pytest.mark.parametrize(
    "given, expected",
    [
        ('<script>var t="</p>";</script>z', 'var t="</p>";z'), ("a<!-- never closed b", "a"), ("x <unclosed attr", "x "),
        ("&nbsp;&#145;&amp;lt;", "\xa0‘&lt;"),
    ],
)
def test_drop_tags(given, expected):
    assert H.drop_tags(given) == expected


def test_strip_marks_blocks():
    assert H.strip_markup("a</p>b</ >c</P>d</>") .startswith("a\n\nb")
    assert H.strip_markup("a<br>b<br/>c<BR>d") == "a\n\nb\n\ncd"


def test_tables_and_spans():
    html = '<table><tr bgcolor="#FFF"><td>keep</td></tr></table><table><tr><td style="background: #CCC">drop</td></tr></table><table><tr style="background-color:#eee"><td>x</td></tr><tr><td>Item 7. stays</td></tr></table>B<span>US</span>INESS<span></span>x'
    out = plain_text(html, "10-K", None, True)
    assert "keep" in out and "drop" not in out and "Item 7. stays" in out and "BUSINESS x" in out
    assert "drop" in plain_text(html, "10-K", None, False)


def test_plain_documents_use_text_rules():
    doc = 'a<TABLE>1 2</TABLE>b<TABLE x=1>c</TABLE><span style="margin-left: 2pt">gone</span>d'
    assert plain_text(doc, "10-K", None, True) == "abc d"


def test_main_document():
    content = "x<DOCUMENT>\n<TYPE>10-K\nfirst</DOCUMENT><DOCUMENT>\n<TYPE>10-K/A\nsecond</DOCUMENT><DOCUMENT>none</DOCUMENT>"
    assert "second" in main_document(content)
    assert main_document("no blocks") == "no blocks"


def test_implied_ends():
    root = H.parse("<table><tr><td>a<td>b<tr><td>c</table>d")
    assert [n.text() for n in root.find_all("tr")] == ["ab", "c"]
    assert root.text() == "abcd"


INDEX_PAGE = """<div class="infoHead">Filing Date</div>
<div class="info">2020-02-03</div><div class="infoHead">Period of Report</div> <div class="info">2019-12-31</div>
<div class="companyInfo"><p class="identInfo">State of Inc.: DE | Fiscal Year End: 1231 <a href="/x?SIC=3571">3571</a></p></div>
<table summary="Document Format Files"><tr><th>Seq</th></tr>
<tr><td>1</td><td>doc</td><td><a href="/Archives/a/d1.pdf">p</a></td><td>10-K</td></tr>
<tr><td>2</td><td>doc</td><td><a href="/ix?doc=/Archives/a/d2.htm">h</a></td><td>10-K</td></tr>
<tr><td></td><td>Complete submission text file</td><td><a href="/Archives/a/1-2-3.txt">t</a></td><td> </td></tr></table>"""


def test_index_page():
    facts = H.index_page_facts(INDEX_PAGE, ["10-K"])
    assert facts["filing_date"] == "2020-02-03" and facts["period_of_report"] == "2019-12-31"
    assert facts["state_of_inc"] == "DE" and facts["fiscal_year_end"] == "1231" and facts["sic"] == "3571"
    assert facts["htm_link"] == "/ix?doc=/Archives/a/d2.htm" and facts["document_type"] == "10-K" and facts["text_link"] is None
    assert H.index_page_facts(INDEX_PAGE, ["8-K"])["text_link"] == "/Archives/a/1-2-3.txt"
    assert H.index_page_facts("", ["10-K"])["period_of_report"] is None


def test_company_page():
    page = """<div class="companyInfo"><span class="companyName">ACME CORP <b>x</b></span><p class="identInfo"><a href="/b?action=getcompany&amp;SIC=35">35</a>
    State location: <a href="/b?x&amp;State=CA">CA</a> | State of Inc.: <strong>DE</strong> | Fiscal Year End: 1231</p></div>"""
    facts = H.company_page_facts(page)
    assert facts == {"company_name": "ACME CORP", "sic": "35", "state_location": "CA", "state_of_inc": "DE", "fiscal_year_end": "1231"}
    assert set(H.company_page_facts("<p>none</p>").values()) == {None}

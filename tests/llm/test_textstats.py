import pathlib
import random

import pytest

from sheafwork.llm import textstats as S

PROSE = "The company has several facilities that are leased from third parties, and management believes they suffice for its needs."
TABLE = ["Net sales      1,234   5,678   90.1%", "Backlog\t3,000\t(12)\t—", "| Taxes | 1,000 | 2,000 |", "Total assets: 45,171; 17,860; 22,829.", "Income taxes ........ 4,000  5,000", "Backlog 1,335,884 2,598 670,841"]
LIST = ["1. Alpha Holdings Corp, MD, No. 700970;", "• Beta Insurance Co (WA), file 361476", "- Gamma Trust - FL - 20523.", "(e) Delta Foods LP DE 114512", "Exhibit 10.4 Epsilon orders agreement, doc. 173226"]
JUNK = ["Cqv wwjvgqvv cgcsqvkhj wrjzrfp tnfb kp pjfhxqk gjchqh", "networks networks networks networks networks networks 413969", ".c834450{font:4pt;margin-left:3px;color:#ff681f}", "|^=$~&<>$<>>|>%~#=#<~%$<|$~^&_$", "MmWQurYSR7G+Incyq6zZ96SEb+nQ/tsSlRd8KeXg22SnKYHUtQUi+evsyX+QZ", "â€œâ€™Ã©t xâ€œâ€œ Ã©eâ€™eâ€œâ€œ ïttï"]


STAT = S.Statistician()


def kind(line):
    counts = [0] * len(S.COUNTS)
    STAT.count_line(line, counts)
    return ("prose", "table", "list", "junk")[max(range(4), key=lambda i: counts[10 + i])]


@pytest.mark.parametrize("expected, lines", [("prose", [PROSE, PROSE.upper(), PROSE.lower(), "Return to Table of Contents"]), ("table", TABLE), ("list", LIST), ("junk", JUNK)])
def test_line_kinds(expected, lines):
    assert {line: kind(line) for line in lines} == dict.fromkeys(lines, expected)


def test_any_chunking_gives_the_same_counts():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice([PROSE, "\n", "\n\n", " ", *TABLE, *LIST, "Item 7. Discussion. "]) for _ in range(rng.randint(0, 12)))
        whole = STAT.finish(STAT.partial(text))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(1, 6)))
        parts = [STAT.partial(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        while len(parts) > 1:  # merge neighbours in any order
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [STAT.merge(parts[i], parts[i + 1])]
        assert STAT.finish(parts[0]) == whole == STAT.finish(STAT.stretch(text, 7))


def test_operator_with_tiny_chunks(spark):
    rng = random.Random(2)
    rows = [(f"d{i}", "\n".join(rng.choice([PROSE, *TABLE, *LIST, *JUNK]) for _ in range(rng.randint(1, 9))), "x") for i in range(25)]
    rows += [rows[0], ("null", None, "x"), ("empty", "", "x"), (None, PROSE, "x")]
    df = spark.createDataFrame(rows, "doc string, text string, n_chars string")
    whole = sorted(map(tuple, S.text_statistics(df, ["doc"]).collect()), key=str)
    # a chunk of 50 characters and stretches of two: most documents leave the pass and are merged across tasks
    cut = sorted(map(tuple, S.text_statistics(df, ["doc"], chunk_chars=50, stretch=2).collect()), key=str)
    assert whole == cut and len(whole) == 28
    by = {r.doc: r for r in S.text_statistics(df, ["doc"]).collect()}
    assert by["empty"].text_kind == "prose" and by["empty"].n_chars == 0 and by["empty"].symbol_ratio == 0
    assert S.text_statistics(spark.createDataFrame([], df.schema), ["doc"]).count() == 0


def test_repeated_long_rows_stay_repeated(spark):
    long = "\n".join([PROSE] * 40)
    df = spark.createDataFrame([("a", long), ("a", long), ("b", "x" * 300)], "doc string, text string")
    for options in ({}, {"chunk_chars": 64, "stretch": 4}):
        assert sorted((r.doc, r.n_chars) for r in S.text_statistics(df, ["doc"], **options).collect()) == [("a", len(long))] * 2 + [("b", 300)]


def test_ratios_take_part_in_the_decision(spark):
    # between 45 and 50 percent stand outside prose: the ratios decide
    plain = "• Alpha Beta trust company\n" * 30 + f"{PROSE}\n" * 7
    signs = "total 1,234 5,678\n" * 46 + "Firm A/B (see §4.2) had 17 of 25 units; its plan #9 was 60% done & paid. " * 12
    found = {r.doc: r for r in S.text_statistics(spark.createDataFrame([("prose", plain), ("table", signs)], "doc string, text string"), ["doc"]).collect()}
    assert all(0.45 < 1 - r.prose_share < 0.5 for r in found.values())
    assert {k: r.text_kind for k, r in found.items()} == {"prose": "prose", "table": "table"} and found["prose"].rules_against < 2 <= found["table"].rules_against


def test_common_words_are_a_parameter(spark):
    df = spark.createDataFrame([("a", "foo bar foo")], "doc string, text string")
    assert S.text_statistics(df, ["doc"], common=["foo"]).first().common_word_share == 2 / 3


def test_kinds_of_documents(spark):
    rows = [("p", "\n".join([PROSE] * 5 + TABLE[:2])), ("t", "\n".join(TABLE * 3)), ("l", "\n".join(LIST * 3)), ("j", "\n".join(JUNK * 3)), ("stub", TABLE[0])]
    found = {r.doc: r.text_kind for r in S.text_statistics(spark.createDataFrame(rows, "doc string, text string"), ["doc"]).collect()}
    assert found == {"p": "prose", "t": "table", "l": "list", "j": "junk", "stub": "prose"}


@pytest.mark.parametrize("sf", ["sf0.01", "check_s"])
def test_labelled_sample(spark, sf):
    """The line rules were adjusted on the labels of the tables sf0.1; those of check_s hold other rows, whose labels took no part."""
    folder = pathlib.Path("/root/testdata", sf)
    if not folder.exists():
        pytest.skip("no such tables")
    from sheafwork.llm.queries import _statistics

    labels = spark.read.parquet(f"{folder}/kind_labels.parquet").withColumnRenamed("text_kind", "label")
    rows = labels.join(_statistics(spark, str(folder)).select("filename", "item_name", "text_kind").distinct(), ["filename", "item_name"]).collect()
    assert sum(r.label == r.text_kind for r in rows) >= 0.98 * len(rows) > 0

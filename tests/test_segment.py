"""Segmentation against worked vectors and against a literal model of the rules."""

import random
import re

import pytest

from sheafwork.operators import segment as S
from sheafwork.operators.items import ITEMS_10K, UnknownForm, header_core, items_for, output_key, requested_items

SHORT = ["1", "1A", "2", "3", "SIGNATURE"]


def run(text, items):
    doc, ends = S.Text(text), []
    return {item: S.find_section(doc, item, items[i + 1 :], ends, items) for i, item in enumerate(items)}


def test_table_of_contents_is_not_the_body():
    toc = "\nTABLE\nItem 1. Business 3\nItem 1A. Risk 5\nItem 2. Props 9\nItem 3. Legal 11\nSIGNATURES 20\n"
    body = "\nItem 1. Business\nWe make things and sell them.\nItem 1A. Risk\nMany risks exist here.\nItem 2. Props\nNone.\nItem 3. Legal\nNone at all.\nSIGNATURES\nJane"
    found = run(toc + body, SHORT)
    assert found["1"] == "\nItem 1. Business\nWe make things and sell them."
    assert found["3"] == "\nItem 3. Legal\nNone at all."
    assert found["SIGNATURE"] == "SIGNATURES\nJane"


@pytest.mark.parametrize(
    "text, items, expected",
    [
        ("\nItem 5.02 Departure of X. text to the end", ["5.01", "5.02", "5.03", "SIGNATURE"], {"5.02": "Item 5.02 Departure of X. text to the end"}),
        ("\nItem 9A(T). Controls. good\nItem 9B. Other. none\nSIGNATURES\nx", ["9A", "9B", "SIGNATURE"], {"9A": "\nItem 9A(T). Controls. good", "9B": "\nItem 9B. Other. none", "SIGNATURE": "SIGNATURES\nx"}),
        ("\nItem 9A(T). Controls only", ["9A", "9B", "SIGNATURE"], {}),
        ("\nItem 1. Biz aaa\nItem 1 A. Risk bbb bbb bbb bbb\nItem 2. P\nSIGNATURES\nx", SHORT, {"1": "\nItem 1. Biz aaa\nItem 1 A. Risk bbb bbb bbb bbb", "2": "\nItem 2. P", "SIGNATURE": "SIGNATURES\nx"}),
        ("\nItem 1. Biz\nItem 3. Legal z\nSIGNATURES\nx", SHORT, {"1": "\nItem 1. Biz", "3": "\nItem 3. Legal z", "SIGNATURE": "SIGNATURES\nx"}),
        ("\nItem 1. long long long reference text in toc\nITEM 1. short\nITEM 2. b\nSIGNATURES\nx", SHORT, {"1": "\nITEM 1. short", "2": "\nITEM 2. b", "SIGNATURE": "SIGNATURES\nx"}),
        ("\nItem 1. Biz\nItem 2. Props tail text", SHORT, {"1": "\nItem 1. Biz", "2": "Item 2. Props tail text"}),
        ("\nItems 1 and 2. Business and Properties abc\nItem 3. Legal d\nSIGNATURES\nx", SHORT, {"1": "\nItems 1 and 2. Business and Properties abc", "3": "\nItem 3. Legal d", "SIGNATURE": "SIGNATURES\nx"}),
        ("", SHORT, {}),
    ],
)
def test_vectors(text, items, expected):
    assert {k: v for k, v in run(text, items).items() if v} == expected


def test_equal_length_tie_follows_enumeration():
    assert run("\nItem 1. \nITEM 2. \nItem 1A. \nITEM 2. \nITEM III. \nITEM 2. \nITEM III. (", SHORT)["3"] == "ITEM III. ("


def literal_candidates(text, item, following, origin):
    """The candidate rule as one regular expression over the rest of the text."""
    pair = rf"\n[^\S\r\n]*{header_core(item)}[.*~\-:\s()].+?(\n[^\S\r\n]*{header_core(following)}[.*~\-:\s(])"
    for flags in (re.S, re.S | re.I):
        found = [(origin + m.start(), origin + m.start(1), origin + m.end()) for m in re.finditer(pair, text[origin:], flags)]
        if found:
            return found
    return []


def test_candidates_equal_the_literal_rule():
    rng = random.Random(5)
    tokens = ["\nItem 1.", "\nITEM 1.", "\nItem 1A:", "\nITEM 2 ", "\n Item II.", "\nItem 3(", "\nITEM 3)", "\nSIGNATURES\n", "\nSignature(s) ", " text", "\n", " x y", ".", "\n\n"]
    for _ in range(3000):
        text = "".join(rng.choice(tokens) for _ in range(rng.randint(2, 14)))
        doc = S.Text(text)
        for item, following in (("1", "1A"), ("1", "2"), ("2", "3"), ("3", "SIGNATURE")):
            starts = [m.start() for m in re.finditer(rf"\n[^\S\r\n]*{header_core(item)}[.*~\-:\s(]", text, re.I)]
            assert doc.listed(item) == starts
            for origin in starts:
                assert doc.candidates(item, following, origin) == literal_candidates(text, item, following, origin), text


def test_item_lists():
    assert items_for("8-K", "2004-08-23")[0] == "1" and items_for("8-K", "2004-08-24")[0] == "1.01"
    assert requested_items("10-K", None, ["7", "1A", "7", "5.02"]) == ["7", "1A", "7"]
    with pytest.raises(UnknownForm):
        items_for("10-K/A", None)
    with pytest.raises(UnknownForm):
        requested_items("10-K", None, ["5.02"])
    assert output_key("part_2__1A") == "part_2_item_1A" and output_key("SIGNATURE") == "SIGNATURE"
    assert len(ITEMS_10K) == 24


def quarterly(first, second, header="\nPART I\n"):
    return f"{header}Item 1. {first}\nItem 2. more\nPART II\nItem 1. {second}\nItem 6. last\nSIGNATURES\nby"


def test_quarterly_parts():
    found = dict(S.extract(quarterly("alpha", "beta"), "10-Q", "2010-01-01", items_for("10-Q", None)))
    assert found["part_1_item_1"] == "Item 1. alpha" and found["part_2_item_1"] == "Item 1. beta"
    assert found["part_1"].startswith("PART I Item 1.") and found["part_2"].startswith("PART II")


def test_quarterly_without_first_part_header():
    found = dict(S.extract(quarterly("alpha", "beta", "\n"), "10-Q", "2010-01-01", items_for("10-Q", None)))
    assert found["part_1_item_1"] == "Item 1. alpha" and found["part_1_item_2"].startswith("Item 2. mor")


def test_second_part_taken_from_contents_is_retried():
    toc = "\nPART I\nItem 1. a 1\nPART II\nItem 1. b 2\n"
    text = toc + "PART I\nItem 1. " + "alpha " * 2000 + "\nPART II\nItem 1. beta\nItem 6. last\nSIGNATURES\nby"
    found = dict(S.extract(text, "10-Q", "2010-01-01", items_for("10-Q", None)))
    assert found["part_2_item_1"] == "Item 1. beta"
    assert "alpha" in found["part_1"]


def test_nothing_found_is_none():
    assert S.extract("nothing here", "10-K", None, ITEMS_10K) is None

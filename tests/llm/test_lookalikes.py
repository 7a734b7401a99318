import itertools
import random
import unicodedata

import pytest

from sheafwork.llm.lookalikes import DEFAULT_VOCABULARY, Automaton, automaton, canonical_text, normalise_texts, rewritten_fields, vocabulary_words


@pytest.mark.parametrize(
    "given, expected",
    [
        ("ｅarnings ofﬁce", "earnings office"), ("cafe\u0301", "café"), ("wa\u2060\u200bs", "was"), ("a\u00a0b\u2009c\u3000d", "a b c d"),
        ("UTILIΤIES", "UTILITIES"), ("Ιnc", "Inc"), ("ѕome thе", "some the"), ("Rеаltу", "Realty"), ("№ Ⅷ", "No VIII"),
        ("\U0001d400\U0001d41b", "Ab"), ("Ångstrom", "Ångstrom"), ("so\u00adft", "soft"), ("a\u000bb", "a b"), ("ΑΒΕ", "ABE"),
    ],
)
def test_rewritten(given, expected):
    assert canonical_text(given) == expected
    assert canonical_text(expected) == expected


@pytest.mark.parametrize("text", ["café Québec Ñ ü œ æ ø", "“quotes” — dash – ’s…", "™ ½ ² ® © € § •", "Зарядье Люфтбай Ψάριδα ΓΈΦΥΡΑ", "plain\ttext\nlines", "", "Ã©râ€™"])
def test_left_alone(text):
    assert canonical_text(text) == text


def test_missing_vocabulary_is_an_error(spark):
    with pytest.raises(OSError):
        vocabulary_words("/none.json")
    with pytest.raises(OSError):
        normalise_texts(spark.createDataFrame([("thе",)], "t string"), ["t"], vocabulary="/none.json")
    assert canonical_text(None) is None


def test_the_trie_decides_where_the_table_reads_otherwise():
    bare = Automaton(())  # without spellings everything goes by table
    for given, by_trie, by_table in [("AІІ", "All", "AII"), ("wіІl", "will", "wiIl"), ("Іoan", "loan", "Ioan")]:
        assert automaton().text(given)[:3] == (by_trie, 1, 0)
        assert bare.text(given)[:3] == (by_table, 0, 1)
    # a second reading in lower case amid capitals costs, so the first reading stands
    assert Automaton(("flex",)).text("FІEX")[:3] == ("FIEX", 0, 1) and Automaton(("flex",), max_cost=1.0).text("FІEX")[:3] == ("FLEX", 1, 0)


def test_edits_cost_and_are_bounded():
    words = vocabulary_words(DEFAULT_VOCABULARY)
    assert automaton().text("Bеhavour")[:2] == ("Behavour", 0)
    assert Automaton(words, 1.0).text("Bеhavour")[:2] == ("Behaviour", 1)  # a letter missing
    small = Automaton(("company", "compass"), 1.0)
    assert small.text("соmpamy")[:2] == ("company", 1) and small.text("соmppany")[:2] == ("company", 1) and small.text("соmpaxxny")[1] == 0
    assert Automaton(("cafe",), 1.0).text("cafe\u0301")[0] == "cafe" and Automaton(("cafe",)).text("cafe\u0301")[:3] == ("café", 0, 1)


def test_cheapest_then_earliest_spelling():
    assert Automaton(("will", "wiil")).text("wіІl")[0] == "will"
    assert Automaton(("wiil", "will")).text("wіІl")[0] == "wiIl"


def test_equal_to_search_over_all_spellings():
    words = ("al", "all", "ai", "ail", "fi", "fill", "café", "cafe", "oil", "ill", "lil")
    twins = {"a": "аa", "o": "оo", "i": "іi", "c": "сc", "e": "еe", "l": "lІ", "f": "f"}
    rng = random.Random(8)
    for _ in range(400):
        word = rng.choice(words)
        given = "".join(rng.choice(twins.get(ch, ch)) + rng.choice(["", "", "\u200b", "\u00ad"]) for ch in unicodedata.normalize("NFD", word))
        form, trie, _, _ = automaton_of(words).text(given)
        if form != given:
            reached = [w for w in words if looks_like(given, w)]
            assert trie == 1 and form.lower() == reached[0], given


def automaton_of(words, known={}):
    return known.setdefault(words, Automaton(words))


def looks_like(given, word):
    readings = [{"а": "a", "о": "o", "і": "i", "с": "c", "е": "e", "І": "il"}.get(c, c) for c in given if c not in "\u200b\u00ad"]
    return any(unicodedata.normalize("NFC", "".join(x)) == word for x in itertools.product(*readings))


def test_operators(spark):
    rows = [("a", "thе end", None, "x"), ("a", "thе end", None, "x"), ("b", "plain", "", "y"), ("c", "Дружба", "q\u0323\u0307\u200b", "canonical_text"), ("d", "x\u0323\u0327", None, None)]
    df = spark.createDataFrame(rows, "k string, t string, u string, canonical_text string")
    hit = rewritten_fields(df, "k", ["t", "u"]).collect()
    assert {(r.k, r.by_trie, r.by_table) for r in hit} == {("a", 1, 0), ("c", 0, 1), ("d", 0, 1)}
    assert sorted((r.k, r.field_name) for r in hit) == [("a", "t"), ("a", "t"), ("c", "u"), ("d", "t")]
    out = {r.k: r for r in normalise_texts(df, ["t", "u"]).collect()}
    assert out["a"].t == "the end" and out["a"].u is None and out["b"].u == "" and out["c"].t == "Дружба" and out["c"].canonical_text == "canonical_text"
    assert rewritten_fields(spark.createDataFrame([], df.schema), "k", ["t"]).count() == 0

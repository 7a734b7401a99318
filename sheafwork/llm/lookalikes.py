"""One consistent form for text that looks the same but differs in its characters.

A word with suspect characters runs through a weighted edit automaton over the
trie of a vocabulary's spellings.  Dropping an ignorable character, reading a
look-alike or a presentation form as what it looks like, and joining an accent
to its letter cost nothing; other edits have a cost.  Of the spellings reached
within the bound the cheapest is the canonical one, among equals the one that
occurs earliest in the vocabulary.  Words that reach no spelling are rewritten
by table.  Genuine Greek or Cyrillic words, those with a letter that has no Latin
twin, keep their letters.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: the most spellings a vocabulary may have; it is sent to every executor (a few MB)
MAX_SPELLINGS = 500_000

#: cost of a letter replaced, added or left out, of an accent left out, and of a capital right after a second reading in lower case
EDIT, ACCENT, CASE_BREAK = 1.0, 1.0, 1.0
#: spellings that cost more are not reached; at 0 only those that look the same are
MAX_COST = 0.0

# Greek and Cyrillic letters with Latin twins.
TWINS = dict(zip(
    "АВЕЅІЈКМНОРСТУХҮԚԜаеѕіјорсухһԁԛԝүҽ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹοϲϳν",
    "ABESIJKMHOPCTYXYQWaesijopcyxhdqwye" "ABEZHIKMNOPTYXCocjv",
))
# Letters that look like a second Latin letter too.
_ALSO = {"І": "l", "Ι": "l"}

# Code point classes, written for a regular expression's brackets.
_IGNORABLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f"
    "\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e01ef"
)
_CONTROL_BLANK = "\u000b\u000c\r\u001c-\u001f"
_BLANK = _CONTROL_BLANK + "\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = "\u0300-\u034e\u0350-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f"
_FORMS = "ĲĳŉſǄ-ǌǱ-ǳ℀-⅏Ⅰ-ↈﬀ-ﬆ！-｠￠-￦\U0001d400-\U0001d7ff"
_SCRIPTS = "Ͱ-ϿЀ-ԯᲀ-\u1c8fἀ-\u1fff"

#: a superset of what may need rewriting; the JVM filters texts with it
SUSPECT = f"[{_IGNORABLE}{_BLANK}{_MARKS}{_FORMS}{_SCRIPTS}]"

_SUSPECT = re.compile(SUSPECT)
_DROP = re.compile(f"[{_IGNORABLE}]")
_MARK = re.compile(f"[{_MARKS}]")
_APART = re.compile(f"[^\\W\\d_][{_MARKS}]")
_SPACE = re.compile(f"[{_BLANK}]")
#: a token: letters, digits, marks and ignorables around at least one suspect character
_TOKEN = re.compile(rf"[\w{_IGNORABLE}{_MARKS}{_FORMS}]*[{_IGNORABLE}{_MARKS}{_FORMS}{_SCRIPTS}][\w{_IGNORABLE}{_MARKS}{_FORMS}]*")
_FOREIGN = re.compile(f"[{_SCRIPTS}]")
#: the words of a token, with the marks and ignorables on and between their letters
_WORD = re.compile(rf"((?:[^\W\d_]|[{_MARKS}{_IGNORABLE}])+)")
#: compatibility signs that are their own characters, not plain letters in disguise
_KEPT = set("™℠℗℃℉℅℞")
_FORM = re.compile(f"[{_FORMS}]")


def fold_char(ch: str) -> str:
    """The plain characters a presentation form stands for, by table; itself if it is none."""
    if ch in _KEPT or not _FORM.match(ch):
        return ch
    plain = unicodedata.normalize("NFKC", ch)
    if 0xFF01 <= ord(ch) <= 0xFFE6:
        return plain
    latin = all(c.isascii() and c.isalnum() or unicodedata.name(c, "").startswith("LATIN") for c in plain)
    return plain if latin else ch



def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def vocabulary_words(path: str) -> tuple[str, ...]:
    """The whole words of a tokenizer's vocabulary file in lower case, most frequent first.

    A missing file is an error: results must not depend on the disk of a machine.
    """
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    letters = _byte_letters()
    found: dict[str, int] = {}
    for entry, rank in entries.items():
        if entry.startswith("Ġ"):
            word = bytes(letters[c] for c in entry[1:]).decode("utf-8", "ignore").lower()
            if len(word) > 1 and word.isalpha() and not _FOREIGN.search(word):
                found[word] = min(rank, found.get(word, rank))
    if len(found) > MAX_SPELLINGS:
        raise ValueError(f"{path}: {len(found)} spellings, more than {MAX_SPELLINGS}")
    return tuple(sorted(found, key=found.get))


def build_trie(words: tuple[str, ...]) -> dict:
    """The words as nested dicts; ``""`` holds a word's rank."""
    root: dict = {}
    for rank, word in enumerate(words):
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node.setdefault("", rank)
    return root


class _State(NamedTuple):
    node: dict
    parent: dict | None  # the node before the last letter, where an accent joins it
    spelt: str
    second: bool  # the last letter is a second reading in lower case


class Automaton:
    """Weighted edit automaton over a trie."""

    def __init__(self, words: tuple[str, ...], max_cost: float = MAX_COST):
        self.root, self.max_cost = build_trie(words), max_cost
        self.seen = lru_cache(maxsize=200_000)(self._canonical)

    def _step(self, state: _State, cost: float, letter: str, second: bool, into: dict) -> None:
        """Read one letter: along the trie at no cost, or by an edit."""
        if state.second and letter.isupper():
            cost += CASE_BREAK
        self._add(into, state.node.get(letter.lower()), state.node, state.spelt + letter, second and letter.islower(), cost)
        if cost + EDIT <= self.max_cost:
            into_edit = cost + EDIT
            self._add(into, state.node, state.parent, state.spelt, False, into_edit)  # left out
            for ch, child in state.node.items():
                if ch and ch != letter.lower():
                    self._add(into, child, state.node, state.spelt + (ch.upper() if letter.isupper() else ch), False, into_edit)  # replaced

    def _add(self, into: dict, node: dict | None, parent: dict | None, spelt: str, second: bool, cost: float) -> None:
        if node is None or cost > self.max_cost:
            return
        key = (id(node), spelt)
        if key not in into or into[key][1] > cost:
            into[key] = (_State(node, parent, spelt, second), cost)
        if cost + EDIT <= self.max_cost:  # a letter of the spelling is missing
            for ch, child in node.items():
                if ch:
                    self._add(into, child, node, spelt + ch, False, cost + EDIT)

    def match(self, word: str) -> str | None:
        """The canonical spelling of a word with suspect characters, None if no spelling is within the bound."""
        states: dict = {}
        self._add(states, self.root, None, "", False, 0.0)
        for ch in word:
            if _DROP.match(ch):
                continue  # ignorable: every state stays at no cost
            following: dict = {}
            for state, cost in states.values():
                if _MARK.match(ch):
                    joined = unicodedata.normalize("NFC", state.spelt[-1:] + ch)
                    if len(joined) == 1 and state.parent is not None:
                        self._add(following, state.parent.get(joined.lower()), state.parent, state.spelt[:-1] + joined, False, cost)
                    self._add(following, state.node, state.parent, state.spelt, state.second, cost + ACCENT)
                    continue
                first = TWINS.get(ch) or fold_char(ch)
                run = {(id(state.node), state.spelt): (state, cost)}
                for letter in first:
                    ahead: dict = {}
                    for s, c in run.values():
                        self._step(s, c, letter, False, ahead)
                    run = ahead
                for key, (s, c) in run.items():
                    if key not in following or following[key][1] > c:
                        following[key] = (s, c)
                for letter in _ALSO.get(ch, ""):
                    self._step(state, cost, letter, True, following)
            if not following:
                return None
            states = following
        ends = [(cost, state.node[""], state.spelt) for state, cost in states.values() if "" in state.node]
        return min(ends)[2] if ends else None

    def word(self, word: str) -> tuple[str, str]:
        """(form, what decided: ``trie``, ``table`` or ``kept``) of one word."""
        if not _SUSPECT.search(word):
            return word, "kept"
        plain = unicodedata.normalize("NFC", "".join(map(fold_char, _DROP.sub("", word))))
        genuine = any(_FOREIGN.match(c) and c not in TWINS for c in plain)
        if not genuine:
            spelling = self.match(word)
            if spelling is not None:
                return spelling, "trie"
            plain = unicodedata.normalize("NFC", "".join(TWINS.get(c, c) for c in plain))
        disguised = plain != word or _APART.search(word)
        return plain, "table" if disguised else "kept"

    def _canonical(self, token: str) -> tuple[str, int, int]:
        """(form, words decided by the trie, words and signs decided by table) of one token."""
        parts = _WORD.split(token)
        counts = {"trie": 0, "table": 0, "kept": 0}
        for i, part in enumerate(parts):
            if i % 2:
                parts[i], by = self.word(part)
            else:
                parts[i] = unicodedata.normalize("NFC", "".join(map(fold_char, part)))
                by = "table" if parts[i] != part else "kept"
            counts[by] += 1
        return unicodedata.normalize("NFC", "".join(parts)), counts["trie"], counts["table"]

    def text(self, text: str | None) -> tuple[str | None, int, int, int]:
        """(form, by trie, by table, blanks replaced) of a text; line feeds and tabs stay, other blanks become spaces."""
        if not text or not _SUSPECT.search(text):
            return text, 0, 0, 0
        trie = table = 0

        def rewrite(m: re.Match) -> str:
            nonlocal trie, table
            form, a, b = self.seen(m.group())
            trie, table = trie + a, table + b
            return form

        out, blanks = _SPACE.subn(" ", _TOKEN.sub(rewrite, text))
        return out, trie, table, blanks


@lru_cache(maxsize=4)
def automaton(path: str = DEFAULT_VOCABULARY, max_cost: float = MAX_COST) -> Automaton:
    return Automaton(vocabulary_words(path), max_cost)


def canonical_text(text: str | None, path: str = DEFAULT_VOCABULARY) -> str | None:
    """The consistent form of one text."""
    return automaton(path).text(text)[0]


_BUILT: dict[tuple, tuple] = {}


def _shared_automaton(shared: Broadcast, max_cost: float) -> Automaton:
    """The automaton of the words sent with the job; a worker builds it once."""
    key = (id(shared.value), max_cost)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = (shared.value, Automaton(shared.value, max_cost))  # the words are kept, so their id stays theirs
    return _BUILT[key][1]


_FORM_TYPE = "form string, by_trie int, by_table int, blanks int"


def _rewriting(column: Column, vocabulary: str, max_cost: float) -> Column:
    """The rewriting of a column as a struct of ``_FORM_TYPE``; the words of the vocabulary travel with the job."""
    shared = SparkSession.active().sparkContext.broadcast(vocabulary_words(vocabulary))

    @F.pandas_udf(_FORM_TYPE)
    def rewrite(texts: pd.Series) -> pd.DataFrame:
        machine = _shared_automaton(shared, max_cost)
        return pd.DataFrame([machine.text(t if isinstance(t, str) else None) for t in texts], columns=["form", "by_trie", "by_table", "blanks"])

    # nondeterministic, so that a filter on its result does not evaluate it once more
    return rewrite.asNondeterministic()(column)


def is_suspect(text: Column) -> Column:
    """A superset of the texts that need rewriting, decided in the JVM.

    The pattern looks first whether a character is ASCII, which nearly all are, so the many ranges are tried on few.
    """
    return (F.length(text) != F.octet_length(text)) & text.rlike(rf"(?=[^\x00-\x7f]){SUSPECT}") | text.rlike(f"[{_CONTROL_BLANK}]")


def normalise_texts(df: DataFrame, columns: list[str], vocabulary: str = DEFAULT_VOCABULARY, max_cost: float = MAX_COST) -> DataFrame:
    """``df`` with each of ``columns`` in canonical form; null stays null, empty stays empty.

    Texts without any suspect character, nearly all, stay in the JVM.
    """
    out = df
    for c in columns:
        text = F.col(f"`{c}`")
        form = _rewriting(F.when(is_suspect(text), text), vocabulary, max_cost).getField("form")
        out = out.withColumn(c, F.when(is_suspect(text), form).otherwise(text))
    return out


def rewritten_fields(df: DataFrame, key: str, columns: list[str], vocabulary: str = DEFAULT_VOCABULARY, max_cost: float = MAX_COST) -> DataFrame:
    """(key, field_name, text, canonical_text, by_trie, by_table, blanks) of every field that holds characters in disguise.

    A field is one if the automaton led a word of it to a spelling, the table
    rewrote what led to none (a letter with an accent that has no joined form
    counts), or a blank was replaced.  The JVM leaves out texts without suspect
    characters before any goes to Python; repeated rows stay repeated.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in columns])
    fields = df.select(key, F.inline(pairs)).filter(is_suspect(F.col("text")))
    made = fields.withColumn("_made", _rewriting(F.col("text"), vocabulary, max_cost))
    found = made.filter(F.col("_made.by_trie") + F.col("_made.by_table") + F.col("_made.blanks") > 0)
    return found.select(key, "field_name", "text", F.col("_made.form").alias("canonical_text"), "_made.by_trie", "_made.by_table", "_made.blanks")

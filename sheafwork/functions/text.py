"""Text functions as native column expressions, with Python twins for use inside kernels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks a Unicode-aware \s covers, written out because Java's \s covers fewer.
_WS = r"\t\n\x0B\f\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS_SAME_LINE = r"\t\x0B\f \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS, HWS = f"[{_WS}]", f"[{_WS_SAME_LINE}]"


def _letter(c: str) -> str:
    """A letter in either case as a class: spelt out, because Java compares far slower under its case flags."""
    return f"[{c.upper()}{c.lower()}{_ODD_CASE.get(c.upper(), '')}]" if c.isalpha() else c


# Letters outside ASCII that equal an ASCII letter when case is ignored.
_ODD_CASE = {"S": "\u017f", "I": "\u0130\u0131", "K": "\u212a"}


def any_case(word: str) -> str:
    return "".join(_letter(c) for c in word)


# Characters replaced by others, in order.
_FROM = "\u00a0\u200b\u2009\u0091\u0092\u0093\u0094\u0095\u0096\u0097\u0098\u0099\u2010\u2011\u2012\u2013\u2014\u2015"
_TO = "   ‘’“”•--˜™------"
_CHARACTERS = dict(zip(_FROM, _TO))
_CHARACTER = re.compile(f"[{_FROM}]")


def _spaced(word: str) -> str:
    """A group per letter of ``word``, with blanks allowed between them."""
    return f"{HWS}*".join(f"({_letter(c)})" for c in word)


def _groups(n: int, start: int = 1) -> str:
    return "".join(f"${i}" for i in range(start, start + n))


def _words(phrase: str) -> str:
    return f"{WS}+".join(any_case(w) for w in phrase.split())


_AB = f"[{_letter('A')[1:-1]}{_letter('B')[1:-1]}]?"
_IV = f"[{_letter('I')[1:-1]}{_letter('V')[1:-1]}]"

#: the steps of cleaning, in order: Java pattern and replacement
CLEANING: list[tuple[str, str]] = [
    # headers whose letters were set apart
    (rf"(\n{HWS}*){_spaced('PART')}({HWS}+)((?:\p{{Nd}}{{1,2}}|{_IV}{{1,2}}){_AB})", _groups(7)),
    (rf"(\n{HWS}*){_spaced('ITEM')}({HWS}+)(\p{{Nd}}{{1,2}}{_AB})", _groups(7)),
    (rf"(\n{HWS}*){_spaced('SIGNATURE')}{HWS}*(?:({_letter('S')})|(\(){HWS}*({_letter('S')}){HWS}*(\)))?({HWS}+)({HWS}?)", _groups(16)),
    (rf"({any_case('ITEM')}|{any_case('PART')})({WS}+\p{{Nd}}{{1,2}}{_AB})([-•])", "$1$2 $3 "),
    # lines of navigation
    (rf"\n{HWS}*(?:{_words('TABLE OF CONTENTS')}|{_words('INDEX TO FINANCIAL STATEMENTS')}|{_words('BACK TO CONTENTS')}|{_words('QUICKLINKS')}){HWS}*\n", "\n"),
    # page numbers
    (rf"\n{HWS}*[-‒–—]*\p{{Nd}}+[-‒–—]*{HWS}*\n", "\n"),
    (rf"\n{HWS}*\p{{Nd}}+{HWS}*\n", "\n"),
    (rf"{WS}{_letter('F')}[-‒–—]*\p{{Nd}}+", ""),
    (rf"\n{HWS}*{any_case('PAGE')}{WS}[\p{{Nd}}*]+{HWS}*\n", ""),
]


def clean_text(text: Column) -> Column:
    """Unify characters, mend broken headers, drop navigation lines and page numbers; all in the JVM."""
    out = F.translate(text, _FROM, _TO)
    for pattern, replacement in CLEANING:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def _python(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace(r"\p{Nd}", r"\d").replace(HWS, r"[^\S\r\n]").replace(WS, r"\s"))


_CLEANING_PY = [(_python(p), re.sub(r"\$(\d+)", r"\\g<\1>", r)) for p, r in CLEANING]


def clean_text_py(text: str) -> str:
    """The same steps for a single string."""
    out = _CHARACTER.sub(lambda m: _CHARACTERS[m.group()], text)
    for pattern, replacement in _CLEANING_PY:
        out = pattern.sub(replacement, out)
    return out


def collapse_lines(text: Column) -> Column:
    """Blank-line runs become one line feed, single line feeds a blank; trimmed, then blank runs become one.

    The literal token ``#NEWLINE`` in a text becomes a line feed.
    """
    out = F.regexp_replace(text, r" *\n *\n[ \n]*", "#NEWLINE")
    out = F.regexp_replace(F.translate(out, "\n", " "), "(?:#NEWLINE)+", "\n")
    out = F.regexp_replace(out, rf"^{WS}+|{WS}+$", "")
    return F.regexp_replace(out, " {2,}", " ")


_BLANK_LINES = re.compile(r" *\n *\n[ \n]*")
_TOKENS = re.compile("(?:#NEWLINE)+")
_BLANKS = re.compile(" {2,}")


def collapse_lines_py(text: str) -> str:
    out = _TOKENS.sub("\n", _BLANK_LINES.sub("#NEWLINE", text).replace("\n", " "))
    return _BLANKS.sub(" ", out.strip())


def mark_block_ends(html: Column) -> Column:
    """Line feeds after closing block tags and breaks, blanks around closing cells; letter case and attributes matter."""
    out = F.regexp_replace(html, rf"(<{WS}*/{WS}*(?:div|tr|p|li|){WS}*>)", "$1\n\n")
    out = F.regexp_replace(out, rf"(<br{WS}*>|<br{WS}*/>)", "$1\n\n")
    return F.regexp_replace(out, rf"(<{WS}*/{WS}*(?:th|td){WS}*>)", " $1 ")


def drop_pdf(content: Column) -> Column:
    return F.regexp_replace(content, "(?isu)<PDF>.*?</PDF>", "")


def sub_documents(content: Column) -> Column:
    """The ``<DOCUMENT>`` blocks of a submission."""
    return F.regexp_extract_all(content, F.lit("(?isu)<DOCUMENT>.*?</DOCUMENT>"), F.lit(0))


def document_type(block: Column) -> Column:
    """The type line of a block, null if it has none."""
    found = F.regexp_extract(block, rf"(?isu)\n{HWS}*<TYPE>(.*?)\n", 1)
    return F.nullif(found, F.lit(""))


def main_document(content: Column) -> Column:
    """The last block whose type starts with 10 or 8, else the whole content; a block without type is passed over."""
    blocks = F.filter(sub_documents(content), lambda b: F.coalesce(document_type(b).startswith("10") | document_type(b).startswith("8"), F.lit(False)))
    return F.coalesce(F.try_element_at(blocks, F.lit(-1)), content)


def drop_text_tables(text: Column) -> Column:
    """Plain-text tables: tags without attributes only."""
    return F.regexp_replace(text, "(?isu)<TABLE>.*?</TABLE>", "")


def resolve_text_spans(text: Column) -> Column:
    """Spans with a horizontal margin become a blank, with a vertical one a line feed; margins in points only."""

    def margin(sides: str) -> str:
        return rf'(?iu)<span[^>]*style="[^"]*(?:{sides}):{WS}*[\p{{Nd}}.]+pt[^"]*"[^>]*>.*?</span>'

    out = F.regexp_replace(text, margin("margin-left|margin-right"), " ")
    return F.regexp_replace(out, margin("margin-top|margin-bottom"), "\n")


def looks_like_html(document: Column) -> Column:
    """Whether there are table rows and cells; the kernel decides on the parsed document."""
    return document.rlike(r"(?i)<td[\s>/]") & document.rlike(r"(?i)<tr[\s>/]")


def number_ratio(text: Column) -> Column:
    """Digits per character that is no blank; 0 without any."""
    solid = F.length(F.regexp_replace(text, WS, ""))
    digits = F.length(text) - F.length(F.regexp_replace(text, r"\p{Nd}", ""))
    return F.when(solid > 0, digits / solid).otherwise(F.lit(0.0))


def blank_ratio(text: Column) -> Column:
    """Blanks per character; 0 for an empty text."""
    blanks = F.length(text) - F.length(F.regexp_replace(text, WS, ""))
    return F.when(F.length(text) > 0, blanks / F.length(text)).otherwise(F.lit(0.0))


def universal_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")

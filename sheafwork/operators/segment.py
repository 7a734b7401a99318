"""Cutting a cleaned filing text into its items.

All header positions are found once per item and letter-case mode; sections are
then chosen by binary search over positions.  The kernel is pure Python over one
text and runs inside an Arrow UDF, see :mod:`sheafwork.plans.extract`.

Rules.  A header is a line feed, blanks, the item's header and one closing
character.  The first following item with any candidate decides.  A candidate
runs from a header to the nearest later header of the following item; upper-case
headers are tried first.  The longest candidate not before the end of the
previous section wins, the first found on ties.  An item without candidates may
run to the end of the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

from sheafwork.functions.text import collapse_lines_py
from sheafwork.operators.items import header_core, items_for, output_key

_BLANKS = r"[^\S\r\n]*"
# What may follow a header where starts are listed, where a candidate starts, and where the tail is sought.
_AFTER_LISTED = r"[.*~\-:\s(]"
_AFTER_START = r"[.*~\-:\s()]"
_AFTER_TAIL = r"[.\-:\s]"

# The thresholds of the repairs of quarterly reports.
#: a part this much longer than the one before it was cut wrongly
PART_EXCESS = 5000
#: a gap of more characters between two parts belongs to the first
PART_GAP = 200


class Headers(NamedTuple):
    starts: list[int]
    ends: list[int]


@lru_cache(maxsize=512)
def _pattern(item: str, after: str, any_case: bool) -> re.Pattern:
    # the line feed alone is consumed, so headers that share one are all seen
    return re.compile(rf"\n(?={_BLANKS}{header_core(item)}{after}())", re.IGNORECASE if any_case else 0)


class Section(NamedTuple):
    text: str
    end: int | None  # where the following header begins, None if nothing was found


class Text:
    """One text with its header positions, found when first asked for."""

    def __init__(self, text: str):
        self.text = text
        self._found: dict[tuple[str, str, bool], Headers] = {}

    def headers(self, item: str, after: str, any_case: bool) -> Headers:
        key = (item, after, any_case)
        if key not in self._found:
            hits = [(m.start(), m.start(1)) for m in _pattern(*key).finditer(self.text)]
            self._found[key] = Headers([a for a, _ in hits], [b for _, b in hits])
        return self._found[key]

    def listed(self, item: str) -> list[int]:
        """Starts of the item's headers that do not overlap one another."""
        out, free = [], 0
        for a, b in zip(*self.headers(item, _AFTER_LISTED, True)):
            if a >= free:
                out.append(a)
                free = b
        return out

    def candidates(self, item: str, following: str, origin: int) -> list[tuple[int, int, int]]:
        """(start, start and end of the following header) from ``origin`` on, one after the other."""
        for any_case in (False, True):
            begin = self.headers(item, _AFTER_START, any_case)
            stop = self.headers(following, _AFTER_LISTED, any_case)
            out, at = [], origin
            while (i := bisect_left(begin.starts, at)) < len(begin.starts):
                j = bisect_left(stop.starts, begin.ends[i] + 1)
                if j == len(stop.starts):
                    break
                out.append((begin.starts[i], stop.starts[j], stop.ends[j]))
                at = stop.ends[j]
            if out:
                return out
        return []

    def tail(self, item: str, floor: int | None) -> str:
        """From the first header at or after ``floor`` to the end; of signatures only the last counts."""
        found, free = [], 0
        for a, b in zip(*self.headers(item, _AFTER_TAIL, True)):
            if a >= free and b < len(self.text):
                found.append(a)
                free = b + 1
        if item == "SIGNATURE":
            found = found[-1:]
        for a in found:
            if floor is None or a >= floor:
                return self.text[a:].strip()
        return ""


def find_section(doc: Text, item: str, rest: Sequence[str], ends: list[int], known: Sequence[str], skip: int = 0) -> str:
    """The item's section; appends its end to ``ends`` if a following header bounds it.

    ``rest`` are the items after it, ``known`` those that may run to the end of
    the text, ``skip`` the number of listed starts to pass over.
    """
    candidates: list[tuple[int, int, int]] = []
    final = True
    for following in rest:
        final = False
        if candidates:
            break
        final = following == rest[-1]
        if "__" in following and following.partition("__")[0] != item.partition("__")[0]:
            final = True
            break
        for origin in doc.listed(item)[skip:]:
            candidates += doc.candidates(item, following, origin)
    floor = ends[-1] if ends else None
    best = None
    for start, stop, after in candidates:
        if (floor is None or start >= floor) and (best is None or after - start > best[2] - best[0]):
            best = (start, stop, after)
    section = ""
    if best is not None:
        section = doc.text[best[0] : best[1]]
        ends.append(best[1] - 1)
    if ends:
        if item in known and section == "" or item == "SIGNATURE":
            section = doc.tail(item, ends[-1])
    elif final and item in known:
        section = doc.tail(item, None)
    return section


def _cut_parts(doc: Text, parts: list[str], skip: int) -> tuple[dict[str, str], list[int]]:
    ends: list[int] = []
    return {p: find_section(doc, p, parts[i + 1 :], ends, parts, skip) for i, p in enumerate(parts)}, ends


def _mend_parts(text: str, found: dict[str, str], ends: list[int]) -> None:
    """Part one missing: all before part two.  A wide gap before part two: it belongs to part one."""
    if not ends:
        return
    second = len(found["part_2"])
    if not found["part_1"]:
        found["part_1"] = text[: ends[0] - second]
    elif len(ends) > 1 and ends[1] - second - ends[0] > PART_GAP:
        found["part_1"] = text[ends[0] - len(found["part_1"]) : ends[1] - second]


def report_parts(text: str, items: Sequence[str]) -> dict[str, str]:
    """The parts of a quarterly report.

    If part two is far longer than part one, its header was taken from the table
    of contents: headers are passed over until the excess is gone or stays the same.
    """
    parts = list(dict.fromkeys(i.partition("__")[0] for i in items))
    doc = Text(text)

    def attempt(skip: int, blank_first: bool) -> dict[str, str]:
        found, ends = _cut_parts(doc, parts, skip)
        if blank_first:
            found["part_1"] = ""
        _mend_parts(text, found, ends)
        return found

    found = attempt(0, False)
    excess, skip = len(found["part_2"]) - len(found["part_1"]), 1
    while excess > PART_EXCESS:
        found = attempt(skip, True)
        now = len(found["part_2"]) - len(found["part_1"])
        if now == excess:
            return attempt(0, False)
        excess, skip = now, skip + 1
    return found


def sections(text: str, form: str, date: str | None) -> list[tuple[str, str]]:
    """(item, raw section) of all items of the form in order, preceded by ``part_n`` for each part of a quarterly report."""
    items = items_for(form, date)
    parts = report_parts(text, items) if form == "10-Q" else {}
    whole, ends, out, current = Text(text), [], [], None
    for i, item in enumerate(items):
        part, _, number = item.partition("__")
        if number:
            if part != current:
                current, ends, whole = part, [], Text(parts[part])
                out.append((part, parts[part]))
        if item in parts:
            out.append((item, parts[item]))
        else:
            out.append((item, find_section(whole, item, items[i + 1 :], ends, items)))
    return out


def extract(text: str, form: str, date: str | None, wanted: Sequence[str], include_signature: bool = False) -> list[tuple[str, str]] | None:
    """(output key, value) of the wanted items in the form's order; None if all of them are empty.

    Whole parts are always given.  The signature counts as found even where it is not given out.
    """
    out, anything = [], False
    for item, raw in sections(text, form, date):
        if item in ("part_1", "part_2"):
            out.append((item, collapse_lines_py(raw)))
        elif item in wanted:
            value = collapse_lines_py(raw.strip())
            anything |= value != ""
            if item != "SIGNATURE" or include_signature:
                out.append((output_key(item), value))
    return out if anything else None

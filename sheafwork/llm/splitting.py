"""Splitting oversized items at natural boundaries.

The cuts of an item are found by dynamic programming over its boundary
positions: the cost of a plan is the sum of its cuts' penalties plus, for each
piece, the squared deviation of its length from the even share.  No piece
exceeds the limit and each repeats exactly ``overlap`` characters of the last.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: boundary classes from strongest to weakest, with the penalty of a cut there
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, BARE = 0.0, 0.15, 0.3, 0.8, 1.5, 6.0
#: weight of a piece's squared relative deviation from the even share
IMBALANCE = 2.0
#: a weaker class is used only in stretches longer than this share of a piece that hold no stronger boundary
STRETCH = 1 / 8

_STRONG = re.compile(r"\n[ \t]*\n\s*|\n+|[.!?][\"'”’)\]]*\s+(?=\S)")
_CLAUSE = re.compile(r"[;:,—–]\s+(?=\S)")
_WORD = re.compile(r"\s+(?=\S)")


def _fill(text: str, known: dict[int, float], pattern: re.Pattern, penalty: float, gap: int) -> None:
    """Add ``pattern``'s boundaries inside the stretches of ``known`` longer than ``gap``."""
    marks = [0, *sorted(known), len(text)]
    for a, b in zip(marks, marks[1:]):
        if b - a > gap:
            for m in pattern.finditer(text, a, b):
                if a < m.end() < b:
                    known.setdefault(m.end(), penalty)


def boundaries(text: str, gap: int) -> dict[int, float]:
    """Cut positions with their penalties; a cut lies before the character at its position."""
    known: dict[int, float] = {}
    for m in _STRONG.finditer(text):
        found = m.group()
        lines = found.count("\n")
        if 0 < m.end() < len(text):
            known[m.end()] = PARAGRAPH if lines > 1 else LINE if lines else SENTENCE
    _fill(text, known, _CLAUSE, CLAUSE, gap)
    _fill(text, known, _WORD, WORD, gap)
    marks = [0, *sorted(known), len(text)]
    for a, b in zip(marks, marks[1:]):
        # no blank for a whole stretch: cut between characters, not before a combining mark
        step = max(1, gap // 8)
        at = a + step if b - a > gap else b
        while at < b:
            cut = at
            while cut > a + 1 and unicodedata.combining(text[cut]):
                cut -= 1
            if cut == a + 1:
                cut = at
            known.setdefault(cut, BARE)
            at += step
    return known


def plan_cuts(text: str | None, limit: int, overlap: int) -> list[int]:
    """Positions where new text begins in each piece after the first; none if the text fits.

    Piece k holds ``text[c[k] - overlap : c[k + 1]]``, the first ``text[: c[1]]``.
    """
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("need 0 <= overlap < limit")
    n = 0 if text is None else len(text)
    if n <= limit:
        return []
    room = limit - overlap
    gap = max(1, int(room * STRETCH))
    found = boundaries(text, gap)
    cuts = np.array([0, *sorted(c for c in found if c > overlap), n])
    penalty = np.array([0.0, *[found[c] for c in cuts[1:-1].tolist()], 0.0])
    pieces = -(-(n - overlap) // room)
    even = (n + (pieces - 1) * overlap) / pieces
    best = np.full(len(cuts), np.inf)
    best[0] = 0.0
    back = np.zeros(len(cuts), dtype=np.int64)
    for j in range(1, len(cuts)):
        i = int(np.searchsorted(cuts, cuts[j] - room))
        starts = np.arange(i, j)
        length = cuts[j] - cuts[i:j] + overlap
        if i == 0:
            length[0] = cuts[j]
        cost = best[i:j] + penalty[j] + IMBALANCE * (length / even - 1.0) ** 2
        if i <= 0 or overlap == 0:
            pass
        elif cuts[j] <= limit:  # the first piece has no overlap, so it may reach further
            first = penalty[j] + IMBALANCE * (cuts[j] / even - 1.0) ** 2
            cost, starts = np.append(cost, first), np.append(starts, 0)
        k = int(np.argmin(cost))
        best[j], back[j] = cost[k], starts[k]
    out, j = [], len(cuts) - 1
    while j > 0:
        j = int(back[j])
        if j:
            out.append(int(cuts[j]))
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _cuts(text: pd.Series, limit: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([plan_cuts(t, int(n), int(o)) for t, n, o in zip(text, limit, overlap)])


# else filters on the cuts, also inferred ones, evaluate the plan once more
_cuts = _cuts.asNondeterministic()


def split_items(items: DataFrame, text: str = "text", limit: str = "max_chars", overlap: str = "overlap_chars") -> DataFrame:
    """Pieces of each row's text: the input's columns but ``text``, then piece_no, n_pieces, piece_start, piece_end, piece.

    ``piece_start`` and ``piece_end`` count characters from 0, end exclusive.  A
    text within its limit, also an empty one, is one piece and never leaves the
    JVM; a null text or null limit gives no piece; a null overlap is 0.  Repeated
    rows give repeated pieces.  Input columns named like an output column keep
    their values under ``<name>_in``.
    """
    made = ["piece_no", "n_pieces", "piece_start", "piece_end", "piece"]
    kept = [c for c in items.columns if c != text]
    shown = {c: f"{c}_in" if c in made else c for c in kept}
    rows = items.filter(F.col(text).isNotNull() & F.col(limit).isNotNull()).select(
        F.struct(*[F.col(c).alias(shown[c]) for c in kept]).alias("_kept"), F.col(text).alias("_text"), F.col(limit).alias("_limit"), F.coalesce(F.col(overlap), F.lit(0)).alias("_overlap")
    )
    fits = F.length("_text") <= F.col("_limit")
    none = F.array().cast("array<int>")
    whole = rows.filter(fits).withColumn("_cuts", none)
    long = rows.filter(~fits).withColumn("_cuts", _cuts("_text", "_limit", "_overlap"))
    cut = []
    for part in (whole, long):
        single = part is whole
        pieces = part.withColumn("n_pieces", F.lit(1) if single else F.size("_cuts") + 1)
        if single:
            spans = pieces.withColumn("piece_no", F.lit(1)).withColumn("piece_start", F.lit(0)).withColumn("piece_end", F.length("_text"))
        else:
            ends = pieces.select("*", F.posexplode(F.concat("_cuts", F.array(F.length("_text")))).alias("_at", "piece_end"))
            spans = ends.withColumn("piece_no", F.col("_at") + 1).withColumn("piece_start", F.when(F.col("_at") == 0, 0).otherwise(F.element_at("_cuts", F.greatest(F.col("_at"), F.lit(1))) - F.col("_overlap")))
        piece = F.substring(F.col("_text"), F.col("piece_start") + 1, F.col("piece_end") - F.col("piece_start"))
        cut.append(spans.select("_kept.*", "piece_no", "n_pieces", "piece_start", "piece_end", piece.alias("piece")))
    return cut[0].unionByName(cut[1])

"""Per-document text statistics that tell natural prose from tables, lists and junk.

Every document is cut into chunks of bounded size at arbitrary positions.  A chunk
gives associative partial counts over the lines that lie wholly inside it, and
its boundary state: the unfinished text before its first line feed and after its
last.  Neighbouring partials merge by joining the left tail with the right head
into lines and counting those, so any grouping of merges gives the counts of the
whole document.  Partials merge in a tree: those of a stretch of chunks within a
task, those of the stretches of a huge document across tasks.  Ratios and rule
outcomes are derived from the root, and the rules decide the kind of the text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import scan_arrow
from sheafwork.session import materialise

#: characters of a chunk
CHUNK_CHARS = 1 << 14
#: chunks of a stretch; a document of several stretches is counted by as many tasks
STRETCH = 64
#: stretches merged per task row in one round of the tree
FAN_IN = 16

COUNTS = [
    "n_chars", "n_lines", "n_words", "word_chars", "n_symbols", "n_digits", "n_upper", "end_punct_lines", "common_hits",
    "body_chars", "prose_chars", "table_chars", "list_chars", "junk_chars",
]
_N = len(COUNTS)

# Frequent English words, where no table of them is given.
COMMON = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one we were all "
    "her she there would their has when who will no more if out so can our its any may these other such than during under".split()
)

_NUMBER = re.compile(r"^[$€£(+\-–—]*\d[\d,.]*[)%]*[;,.]?$|^[—–]+[;.]?$")
_GAP = re.compile(r"\S(?: {2,}|\t)\S|\t|\.{4,}| \| ")
_MARKER = re.compile(r"(?:[•·▪◦‣*–-]|\(?(?:\d{1,4}|[A-Za-z]|[ivxlc]{1,5}|[IVXLC]{1,5})[.)]|(?:exhibit|ex\.|schedule|annex|appendix)\s+[\dA-Z][\w.\-]*)\s+\S", re.I)
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_MOJIBAKE = re.compile("[ÃÂ][\x80-\xbfŒœŠšŸŽžƒˆ˜–-…‰‹›€™]|â€|ï¿½|�")
_CODE = re.compile(r"[{}<>=;\\^~|#&_*$@%/+\[\]]")
_VOWEL = re.compile(r"[aeiouyà-åæè-ïò-öøù-üýÿāēīōūœаеиоуыэюяαεηιουω]", re.I)
_SENTENCE_END = re.compile(r"[.!?:;][\"'”’)\]]*$")
_HEADING = re.compile(r"^(?:item|part|note|exhibit)\s+\w{1,5}[.:]?(?=\s|$)", re.I)


#: of a token: its facts as one number, in fields of 32 bits, so that those of a line add up in one sum
Packed = Callable[[str], int]


def pack_facts(facts: Iterable[int]) -> int:
    values = tuple(facts)
    return int.from_bytes(struct.pack(f"<{len(values)}I", *values), "little")


def summed_facts(tokens: Iterable[str], packed: Packed, fields: int = 11) -> tuple[int, ...]:
    """The facts of a line: no field exceeds the characters of a string, which 32 bits hold."""
    return struct.unpack(f"<{fields}I", sum(map(packed, tokens)).to_bytes(4 * fields, "little"))


def token_facts(token: str, common: frozenset[str] = COMMON) -> tuple[int, ...]:
    """Facts of one blank-free token that add up over a line.

    Words, their letters, common words, letters, digits, capitals, length,
    numbers, words without a vowel, code signs, traces of a wrong decoding.
    """
    words = _WORD.findall(token)
    return (
        len(words), sum(map(len, words)), sum(w.lower() in common for w in words),
        sum(map(str.isalpha, token)), sum(map(str.isdigit, token)), sum(map(str.isupper, token)), len(token),
        _NUMBER.match(token) is not None, sum(not _VOWEL.search(w) for w in words), len(_CODE.findall(token)), len(_MOJIBAKE.findall(token)),
    )


@lru_cache(maxsize=4)
def packed_facts(common: frozenset[str] = COMMON) -> Packed:
    """The function of a token's packed facts; it remembers tokens."""
    return lru_cache(maxsize=200_000)(lambda token: pack_facts(token_facts(token, common)))


#: words of a line are compared with each other within windows of this many
REPEAT_WINDOW = 40


def _repeats(tokens: list[str]) -> bool:
    """Whether the same few words come again and again: of each window on average at most a third are different."""
    different = sum(len(set(tokens[i : i + REPEAT_WINDOW])) for i in range(0, len(tokens), REPEAT_WINDOW))
    return 3 * different <= len(tokens)


def line_kind(body: str, tokens: list[str], facts: tuple[int, ...]) -> str:
    """What a stripped non-blank line is: prose, table, list or junk.  Independent of letter case."""
    words, _, _, letters, _, _, solid, numeric, voiceless, code, wrong = facts
    n = len(tokens)
    if not letters:
        if numeric and 2 * numeric >= n:
            return "table"
        return "junk" if solid > 3 and not set(body) <= set("-=_*.~# ") else "table"
    if wrong * 8 > solid:
        return "junk"
    longest = max(map(len, tokens))
    if longest >= 30 and 2 * longest > solid and not tokens[0].lower().startswith(("http", "www.")):
        return "junk"
    if n < 4 and solid >= 12 and code * 5 > solid:
        return "junk"
    if numeric >= 2 and (2 * numeric >= n or 3 * numeric >= n and _GAP.search(body)):
        return "table"
    bars = body.count("|")
    if bars >= 2 and (body[0] == "|" or bars * 6 > n):
        return "table"
    if numeric and words <= 6 and 4 * numeric >= n and _GAP.search(body):
        return "table"
    if words >= 4:
        if _repeats(tokens) or 2 * voiceless > words:
            return "junk"
    elif letters * 3 < solid and numeric * 2 < n and code * 3 > solid:
        return "junk"
    return "list" if _MARKER.match(body) else "prose"


#: a partial: counts, whether it holds a line feed, head (before the first), tail (after the last)
Partial = tuple[list[int], bool, str, str]

_KIND_AT = {"prose": 10, "table": 11, "list": 12, "junk": 13}


def _first_line(line: str) -> list[str]:
    """A document's first line with its heading, if it has one, as a line of its own."""
    m = _HEADING.match(line)
    if not m:
        return [line]
    rest = line[m.end() :]
    stop = re.search(r"[.:]\s+", rest)
    return [line[: m.end() + stop.start() + 1], rest[stop.end() :]] if stop and stop.start() < 60 else [line]


class Statistician:
    """Partial counts of chunks, their merging, and the counts of whole documents."""

    def __init__(self, common: Iterable[str] = COMMON):
        self.packed = packed_facts(frozenset(common))

    def count_line(self, line: str, counts: list[int]) -> None:
        """Add one whole line, without its line feed, to ``counts``."""
        counts[1] += 1
        tokens = line.split()
        if not tokens:
            return
        facts = summed_facts(tokens, self.packed)
        words, word_chars, common, letters, digits, capitals, solid = facts[:7]
        counts[2] += words
        counts[3] += word_chars
        counts[4] += solid - digits - letters
        counts[5] += digits
        counts[6] += capitals
        counts[7] += _SENTENCE_END.search(tokens[-1]) is not None
        counts[8] += common
        body = line.strip()
        counts[9] += len(body)
        counts[_KIND_AT[line_kind(body, tokens, facts)]] += len(body)

    def partial(self, chunk: str) -> Partial:
        """Counts of the lines wholly inside the chunk, with the boundary state."""
        counts = [0] * _N
        counts[0] = len(chunk)
        lines = chunk.split("\n")
        if len(lines) == 1:
            return counts, False, chunk, ""
        for line in lines[1:-1]:
            self.count_line(line, counts)
        return counts, True, lines[0], lines[-1]

    def merge(self, a: Partial, b: Partial) -> Partial:
        """The partial of two neighbouring stretches; associative."""
        counts = [x + y for x, y in zip(a[0], b[0])]
        if not a[1] and not b[1]:
            return counts, False, a[2] + b[2], ""
        if not a[1]:
            return counts, True, a[2] + b[2], b[3]
        if not b[1]:
            return counts, True, a[2], a[3] + b[2]
        self.count_line(a[3] + b[2], counts)
        return counts, True, a[2], b[3]

    def tree(self, partials: list[Partial]) -> Partial:
        """Neighbours merged pair by pair, round by round, until one is left."""
        while len(partials) > 1:
            pairs = [self.merge(a, b) for a, b in zip(partials[::2], partials[1::2])]
            partials = pairs + partials[2 * len(pairs) :]
        return partials[0]

    def stretch(self, text: str, chunk_chars: int) -> Partial:
        """The partial of a text by its chunks."""
        return self.tree([self.partial(text[i : i + chunk_chars]) for i in range(0, max(len(text), 1), chunk_chars)])

    def finish(self, p: Partial) -> list[int]:
        """Counts of the whole document: the remaining head and tail are its first and last line."""
        counts = list(p[0])
        if not counts[0]:
            return counts
        first = _first_line(p[2])
        for line in first:
            self.count_line(line, counts)
        counts[1] -= len(first) - 1
        if len(first) > 1:
            counts[9] += 1  # the blank between heading and text
            counts[10] += 1
        if p[1]:
            self.count_line(p[3], counts)
        return counts


_NODE = {"row": pa.int64(), "part": pa.int64(), "parts": pa.int64(), "piece": pa.string(), "counts": pa.list_(pa.int64()), "broken": pa.bool_(), "head": pa.string(), "tail": pa.string()}
_NODE_SQL = "row bigint, part bigint, parts bigint, piece string, counts array<bigint>, broken boolean, head string, tail string"


def _nodes(keys: list[pa.Array], key_names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_NODE)
    return pa.RecordBatch.from_arrays([*keys, *[pa.array(c, t) for c, t in zip(columns, _NODE.values())]], names=[*key_names, *_NODE])


def text_counts(rows: DataFrame, keys: list[str], text: str = "text", common: Iterable[str] = COMMON, chunk_chars: int = CHUNK_CHARS, stretch: int = STRETCH) -> DataFrame:
    """``keys`` and the columns of ``COUNTS`` for every row with a text; repeated rows stay repeated.

    One pass cuts every text into chunks and merges the partials of up to
    ``stretch`` chunks where the text is.  A longer document leaves that pass as
    stretches of text, which are counted by other tasks and merged by row number,
    ``FAN_IN`` a round.  The pass is written once, so row numbers stay the same
    whatever is computed again.  Null texts give no row; an empty text gives zeros.
    """
    n = len(keys)
    names = [f"k{i}" for i in range(n)]
    types = dict(rows.dtypes)
    key_sql = "".join(f"k{i} {types[k]}, " for i, k in enumerate(keys))
    plain = rows.filter(F.col(text).isNotNull()).select(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, names)], F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text"))
    words = frozenset(common)
    room = chunk_chars * stretch

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Statistician(words)
        for batch in batches:
            out, at = [], []
            for i, (row, t) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())):
                parts = max(1, -(-len(t) // room))
                if parts == 1:
                    out.append((row, 0, 1, None, s.finish(s.stretch(t, chunk_chars)), None, None, None))
                else:
                    out += [(row, p, parts, t[p * room : (p + 1) * room], None, None, None, None) for p in range(parts)]
                at += [i] * parts
            yield _nodes([batch.column(i).take(pa.array(at, pa.int64())) for i in range(n)], names, out)

    nodes = materialise(scan_arrow(plain, cut, key_sql + _NODE_SQL), "partials")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Statistician(words)
        for batch in batches:
            out = [(r["row"], r["part"], r["parts"], None, *s.stretch(r["piece"], chunk_chars)) for r in batch.to_pylist()]
            yield _nodes([batch.column(i) for i in range(n)], names, out)

    level = scan_arrow(nodes.filter(F.col("parts") > 1).repartition("row", "part"), count, key_sql + _NODE_SQL, 4)

    def fold(table: pa.Table) -> pa.Table:
        inner = sorted(table.to_pylist(), key=lambda r: r["part"])
        root = Statistician(words).tree([(r["counts"], r["broken"], r["head"], r["tail"]) for r in inner])
        made = _nodes([table.column(k).slice(0, 1).combine_chunks() for k in names], names, [(inner[0]["row"], inner[0]["part"] // FAN_IN, inner[0]["parts"], None, *root)])
        return pa.Table.from_batches([made])

    # 2 ** 31 characters, the most a string holds, are at most FAN_IN ** rounds stretches
    reach = 1
    while reach * room < 2**31:
        level = level.withColumn("_g", F.floor(F.col("part") / FAN_IN)).groupBy("row", "_g").applyInArrow(fold, key_sql + _NODE_SQL)
        reach *= FAN_IN

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Statistician(words)
        for batch in batches:
            out = [(r["row"], 0, 1, None, s.finish((r["counts"], r["broken"], r["head"], r["tail"])), None, None, None) for r in batch.to_pylist()]
            yield _nodes([batch.column(i) for i in range(n)], names, out)

    whole = nodes.filter(F.col("parts") == 1).unionByName(scan_arrow(level, done, key_sql + _NODE_SQL))
    return whole.select(*[F.col(a).alias(k) for k, a in zip(keys, names)], *[F.col("counts")[i].alias(c) for i, c in enumerate(COUNTS)])


#: rule: more than this share of the characters stands outside prose
NOT_PROSE = 0.5
#: rule: the share that is enough if the ratios too speak against prose (captions and headings of tables read as running lines)
NOT_PROSE_BY_RATIOS = 0.45
#: rules of the ratios: fewer common words, more signs or more digits than running text has, or hardly a line that ends like a sentence
FEW_COMMON, MANY_SYMBOLS, MANY_DIGITS, FEW_ENDS = 0.15, 0.06, 0.12, 0.1
#: so many rules of the ratios speak against prose
RULES_AGAINST = 2
#: documents with fewer characters are stubs, which count as prose
STUB_CHARS = 120


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def text_statistics(rows: DataFrame, keys: list[str], text: str = "text", common: Iterable[str] = COMMON, chunk_chars: int = CHUNK_CHARS, stretch: int = STRETCH) -> DataFrame:
    """Counts, ratios and rule outcomes of every row's text; ``common`` are the language's frequent words.

    Ratios are 0 where there is nothing to divide by.  ``rules_against`` counts
    the rules of the ratios that speak against prose.  A text is not prose if
    more than ``NOT_PROSE`` of the characters of its non-blank lines stand
    outside prose, or more than ``NOT_PROSE_BY_RATIOS`` and ``RULES_AGAINST``
    rules agree; ``text_kind`` then is the kind that holds most of them.  Short
    stubs and empty texts are prose.  Null texts give no row, repeated rows stay
    repeated.
    """
    c = text_counts(rows, keys, text, common, chunk_chars, stretch).select(
        "*",
        _share("word_chars", "n_words").alias("mean_word_chars"),
        _share("n_symbols", "n_chars").alias("symbol_ratio"),
        _share("n_digits", "n_chars").alias("digit_ratio"),
        _share("end_punct_lines", "n_lines").alias("end_punct_share"),
        _share("common_hits", "n_words").alias("common_word_share"),
        F.when(F.col("body_chars") > 0, F.col("prose_chars") / F.col("body_chars")).otherwise(F.lit(1.0)).alias("prose_share"),
    )
    rules = [F.col("common_word_share") < FEW_COMMON, F.col("symbol_ratio") > MANY_SYMBOLS, F.col("digit_ratio") > MANY_DIGITS, F.col("end_punct_share") < FEW_ENDS]
    against = rules[0].cast("int") + rules[1].cast("int") + rules[2].cast("int") + rules[3].cast("int")
    outside = 1 - F.col("prose_share")
    most = F.greatest("table_chars", "list_chars", "junk_chars")
    odd = (F.col("body_chars") >= STUB_CHARS) & ((outside > NOT_PROSE) | (outside > NOT_PROSE_BY_RATIOS) & (F.col("rules_against") >= RULES_AGAINST))
    kind = F.when(~odd, "prose").when(F.col("table_chars") == most, "table").when(F.col("list_chars") == most, "list").otherwise("junk")
    return c.withColumn("rules_against", against).withColumn("text_kind", kind)

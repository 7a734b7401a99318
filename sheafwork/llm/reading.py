"""Reading level of each document.

Words of all documents are ranked by frequency.  A document's coverage rank is
the size of the smallest frequency-ranked vocabulary that covers a fixed share of
its running words: plain texts are covered by few frequent words, demanding ones
need rarer ones.  Coverage rank and sentence complexity are calibrated on a
labelled sample by SQL aggregates: levels have centres, every centre has its spread,
and the level of a document is that of the nearest centre, a SQL expression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import scan_arrow
from sheafwork.llm.textstats import COMMON, NOT_PROSE, STUB_CHARS, line_kind, pack_facts, summed_facts, token_facts
from sheafwork.session import broadcast_if_small, materialise

#: share of a document's running words its vocabulary must cover
COVERED = 0.8
#: the most frequent words given to every task (about 1 MB); documents that need rarer ones are looked up by a join
HEAD_WORDS = 65_536
#: running text is English if more than this share of its words are frequent English ones
ENGLISH = 0.15
#: up to so many different word frequencies their ranks are broadcast (16 bytes each); beyond it they join by shuffle
FREQUENCY_ROWS = 1_000_000

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_HIDDEN = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]")
_ENDS = re.compile(r"[.!?][\"'”’)\]]*$")
_VOWELS = re.compile(r"[aeiouyà-öø-ý]+")
_HEADING = re.compile(r"^\s*(?:item|part|note|exhibit)\s+\w{1,5}[.:]?(?:\s+\S+){0,8}\s*$", re.I)
# Abbreviations whose full stop ends no sentence.
_SHORT = frozenset("inc corp co ltd no mr mrs ms dr vs e.g i.e u.s st llc plc fig sec art approx jr sr n.v l.p".split())


def words_of(token: str) -> list[str]:
    return _WORD.findall(token)


def syllables(word: str) -> int:
    """Groups of vowels, without a silent final e; at least one."""
    low = word.lower()
    n = len(_VOWELS.findall(low))
    if n > 1 and low.endswith("e") and not low.endswith(("le", "ee", "ie", "ye")) or n > 1 and low.endswith("ed") and not low.endswith(("ted", "ded")):
        n -= 1
    return max(n, 1)


@lru_cache(maxsize=200_000)
def token_reading(token: str) -> tuple[int, int, int, bool]:
    """Words, words of three and more and of five and more syllables, whether a sentence ends with the token."""
    words = words_of(token)
    ends = _ENDS.search(token)
    stop = ends is not None and not (ends.group()[0] == "." and (token[: ends.start()].lower().lstrip("(\"'“") in _SHORT or len(token) == 2 and token[0].isupper() and token[0] not in "IA"))
    lengths = [syllables(w) for w in words]
    return len(words), sum(n >= 3 for n in lengths), sum(n >= 5 for n in lengths), stop


@lru_cache(maxsize=4)
def packed_reading(common: frozenset[str]):
    """The function of a token's packed facts: those of a line's kind, then long words, longest words, sentence ends."""
    return lru_cache(maxsize=200_000)(lambda token: pack_facts((*token_facts(token, common), *token_reading(token)[1:])))


def word_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all documents; tasks count first, so only their totals are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            total: Counter = Counter()
            for token, n in seen.items():
                for word in words_of(token):
                    total[word] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update((t if t.isascii() else _HIDDEN.sub("", t)).lower().split())
            if len(seen) > 500_000:
                yield flush()
        if seen:
            yield flush()

    counted = scan_arrow(docs.select(F.col(text).alias("text")).filter(F.col("text").isNotNull()), count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def ranked(frequencies: DataFrame) -> DataFrame:
    """(word, n, rank): words of equal frequency share the rank of the last of them.

    Ranks come from the number of words per frequency, a table far smaller than
    the vocabulary (frequencies that all differ add up to the square of their
    number), so no window runs over all words.  It is broadcast if it is small,
    as most words share the frequency 1.
    """
    counted = materialise(frequencies, "frequencies")
    sizes = counted.groupBy("n").agg(F.count("*").alias("words"))
    ranks, _ = broadcast_if_small(materialise(sizes.select("n", F.expr("sum(words) OVER (ORDER BY n DESC)").alias("rank")), "ranks"), FREQUENCY_ROWS)
    return counted.join(ranks, "n").select("word", "n", "rank")


_FEATURES = "n_words bigint, n_sentences bigint, n_long_words bigint, n_longest_words bigint, n_common bigint, body_chars bigint, prose_chars bigint"


class Reader:
    """Features of one text's running prose, headings aside."""

    def __init__(self, head: dict[str, int], covered: float, common: Iterable[str] = COMMON):
        self.head, self.covered, self.packed = head, covered, packed_reading(frozenset(common))

    def __call__(self, text: str) -> tuple:
        body_chars = prose_chars = words = long_words = longest_words = sentences = common = 0
        running: list[str] = []
        open_words = 0
        for line in (text if text.isascii() else _HIDDEN.sub("", text)).split("\n"):
            tokens = line.split()
            if not tokens:
                continue
            body = line.strip()
            if _HEADING.match(body):
                continue
            facts = summed_facts(tokens, self.packed, 14)
            body_chars += len(body)
            if line_kind(body, tokens, facts[:11]) != "prose":
                continue
            prose_chars += len(body)
            running += tokens
            words += facts[0]
            common += facts[2]
            long_words += facts[11]
            longest_words += facts[12]
            if facts[13]:
                sentences += facts[13]
                last = next(i for i in range(len(tokens), 0, -1) if token_reading(tokens[i - 1])[3])
                open_words = sum(token_reading(t)[0] for t in tokens[last:])
            else:
                open_words += facts[0]
        sentences += open_words > 0
        rank, need, rare = None, 0, Counter()
        if words:
            # the rank of each distinct token's words, weighted by how often it occurs
            counted = Counter(running)
            ranks: list[int] = []
            times: list[int] = []
            for token, n in counted.items():
                for word in self.split(token):
                    r = self.head.get(word)
                    if r is None:
                        rare[word] += n
                    else:
                        ranks.append(r)
                        times.append(n)
            target = -(-words * self.covered // 1)
            held = sum(times)
            if held >= target:
                order = np.argsort(ranks, kind="stable")
                rank = int(np.asarray(ranks)[order][np.searchsorted(np.cumsum(np.asarray(times)[order]), target)])
                rare = Counter()
            else:
                need = int(target - held)
        return (words, sentences, long_words, longest_words, common, body_chars, prose_chars), rank, need, rare

    @staticmethod
    @lru_cache(maxsize=200_000)
    def split(token: str) -> tuple[str, ...]:
        return tuple(w.lower() for w in words_of(token))


def complexity(docs: DataFrame, key: str = "doc_id", text: str = "text", covered: float = COVERED, head_words: int = HEAD_WORDS, common: Iterable[str] = COMMON) -> DataFrame:
    """Features of every document: key, counts, coverage_rank, mean_sentence_words, long_word_share, longest_word_share, prose_share, english_share.

    Shares and means are 0 and the rank is null for a text without running words;
    null texts count as empty.  Repeated rows stay repeated.
    """
    spark = docs.sparkSession
    vocabulary = materialise(ranked(word_frequencies(docs, text)), "vocabulary")
    # a word of rank r is one of the r most frequent, so at most head_words words are collected
    head = {r.word: r.rank for r in vocabulary.filter(F.col("rank") <= head_words).select("word", "rank").collect()}
    shared = spark.sparkContext.broadcast(head)
    types = dict(docs.dtypes)
    frequent = frozenset(common)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, covered, frequent)
        for batch in batches:
            found = [reader(t or "") for t in batch.column(1).to_pylist()]
            counts = list(zip(*[f[0] for f in found])) if found else [[]] * 7
            rare = [[{"word": w, "n": n} for w, n in f[3].items()] or None for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
                 pa.array(rare, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                names=["k", "n_words", "n_sentences", "n_long_words", "n_longest_words", "n_common", "body_chars", "prose_chars", "rank", "need", "rare"],
            )

    schema = f"k {types[key]}, {_FEATURES}, rank bigint, need bigint, rare array<struct<word string, n bigint>>"
    features = scan_arrow(docs.select(F.col(key).alias("k"), F.col(text).alias("text")), read, schema)
    features = materialise(features.withColumn("row", F.monotonically_increasing_id()), "features")
    # documents whose share reaches beyond the head: their rarer words are looked up by a shuffled join
    words = features.filter(F.col("rare").isNotNull()).select("row", "need", F.inline("rare")).join(vocabulary.select("word", F.col("rank").alias("at")), "word")
    upto = words.withColumn("held", F.expr("sum(n) OVER (PARTITION BY row ORDER BY at)"))
    beyond = upto.filter(F.col("held") >= F.col("need")).groupBy("row").agg(F.min("at").alias("tail_rank"))
    full = features.join(beyond, "row", "left")

    def share(a: str, b: str):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return full.select(
        F.col("k").alias(key), "n_words", "n_sentences", "n_long_words", "body_chars", F.coalesce("rank", "tail_rank").alias("coverage_rank"),
        share("n_words", "n_sentences").alias("mean_sentence_words"), share("n_long_words", "n_words").alias("long_word_share"),
        share("n_longest_words", "n_words").alias("longest_word_share"), share("prose_chars", "body_chars").alias("prose_share"), share("n_common", "n_words").alias("english_share"),
    )


_TERMS = ["ln(1.0 + coverage_rank)", "ln(1.0 + mean_sentence_words)", "long_word_share", "longest_word_share"]
#: least spread of a term around a first and around a later centre, so that a term that never varies does not decide alone
FIRST_SPREAD, LEAST_SPREAD = 0.02, 0.004
#: a centre's spread counts as if so many labels more had the spread that all share
SHARED_LABELS = 20

#: texts of one level may be demanding in different ways (long sentences of plain words, short ones of long words): centres are kept per cell of these terms
_CELL = "concat_ws(' ', cast(round(x1) AS int), cast(round(4 * x2) AS int))"
#: a level that fewer of a cell's labels have is taken for wrong labels
LEAST_SHARE = 0.15

#: of a centre: its level, and constant, weights of the terms and of their products in a sum that is greatest for the nearest
Discriminants = list[tuple[int, float, list[float], list[list[float]]]]


def _nearest(found: Discriminants, terms: list[str]) -> str:
    """The number from 1 of the centre with the greatest discriminant as a SQL expression."""
    sums = []
    for at, (_, constant, weights, products) in enumerate(found, 1):
        parts = [f"({constant!r})", *[f"({w!r}) * {t}" for w, t in zip(weights, terms)]]
        parts += [f"({w!r}) * {a} * {b}" for a, row in zip(terms, products) for b, w in zip(terms, row) if w]
        sums.append(f"named_struct('sum', {' + '.join(parts)}, 'at', {at})")
    return f"greatest({', '.join(sums)}).at" if len(sums) > 1 else "1"


def _level(found: Discriminants, terms: list[str]) -> str:
    return f"element_at(array({', '.join(str(f[0]) for f in found)}), {_nearest(found, terms)})"


def _discriminant(level: int, centre: np.ndarray, spread: np.ndarray) -> tuple:
    """The log density of a normal distribution around the centre, up to a constant common to all."""
    inverse = np.linalg.inv(spread)
    constant = -0.5 * centre @ inverse @ centre - 0.5 * np.linalg.slogdet(spread)[1]
    products = np.triu(-inverse, 1) - 0.5 * np.diag(np.diag(inverse))
    return level, float(constant), [float(w) for w in inverse @ centre], [[float(w) for w in row] for row in products]


def calibrate(features: DataFrame, labels: DataFrame, key: str = "doc_id", level: str = "reading_level", rounds: int = 4, max_labels: int = 100_000) -> Discriminants:
    """Discriminants of the levels' centres among at most ``max_labels`` labelled documents; none without labels.

    ``features`` holds the terms as _x0, _x1, ...

    The first centres are the medians of a level's labels in a cell, as some
    labels are wrong.  Every round after takes means and products of the terms,
    one SQL aggregate with a row per centre, over the labels the last round agreed
    with.
    """
    sample = labels.select(F.col(key).alias("_k"), F.col(level).cast("int").alias("y")).filter(F.col("y").isNotNull()).distinct().limit(max_labels)
    rows = sample.join(features.filter(F.col("coverage_rank").isNotNull()), F.col("_k") == F.col(key))
    n, names = len(_TERMS), [f"x{i}" for i in range(len(_TERMS))]
    rows = materialise(rows.select(*[F.col(f"_{x}").alias(x) for x in names], "y").withColumn("cell", F.expr(_CELL)), "labels")
    middle = [F.expr(f"percentile_approx({x}, array(0.25, 0.5, 0.75))").alias(x) for x in names]
    cells = rows.groupBy("y", "cell").agg(F.count("*").alias("n"), *middle).withColumn("share", F.expr("n / sum(n) OVER (PARTITION BY cell)"))
    kept = cells.filter(F.col("share") >= LEAST_SHARE).orderBy("y", "cell").collect()
    if not kept:
        return []
    levels, centres = [r.y for r in kept], [np.array([r[x][1] for x in names]) for r in kept]
    wide = np.average([[((r[x][2] - r[x][0]) / 1.35) ** 2 for x in names] for r in kept], axis=0, weights=[r.n for r in kept])
    found = [_discriminant(y, m, np.diag(wide + FIRST_SPREAD**2)) for y, m in zip(levels, centres)]
    for _ in range(rounds):
        placed = rows.withColumn("at", F.expr(_nearest(found, names))).filter(F.expr(_level(found, names)) == F.col("y"))
        sums = placed.groupBy("at").agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(names)], *[F.expr(f"avg(x{i} * x{j})").alias(f"p{i}_{j}") for i in range(n) for j in range(n)]).collect()
        if not sums:
            break
        own = {}
        for r in sums:
            mean = np.array([r[f"m{i}"] for i in range(n)])
            centres[r["at"] - 1] = mean
            own[r["at"] - 1] = (r.n, r.n * (np.array([[r[f"p{i}_{j}"] for j in range(n)] for i in range(n)]) - np.outer(mean, mean)))
        shared = sum(c for _, c in own.values()) / sum(k for k, _ in own.values())
        found = []
        for at, (y, m) in enumerate(zip(levels, centres)):
            k, c = own.get(at, (0, np.zeros((n, n))))
            found.append(_discriminant(y, m, (c + SHARED_LABELS * shared) / (k + SHARED_LABELS) + LEAST_SPREAD**2 * np.eye(n)))
    return found


def reading_levels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", common: Iterable[str] = COMMON, **options) -> DataFrame:
    """Features and reading_level (of the labels' levels, 1 easy to 5 demanding) of every document.

    ``reading_level`` is null for a text without running words, and for all if
    there are no labels.  ``is_english_prose`` tells running English text, by the
    frequent words in ``common``, from tables, lists, junk and other languages,
    whose level is that of the little running text they have.
    """
    # the terms are written with the features, as every discriminant uses them
    features = complexity(docs, key, text, common=common, **options)
    scored = materialise(features.withColumns({f"_x{i}": F.expr(t).cast("double") for i, t in enumerate(_TERMS)}), "complexity")
    found = calibrate(scored, labels, key)
    prose = (F.col("prose_share") >= 1 - NOT_PROSE) & (F.col("english_share") > ENGLISH) & (F.col("body_chars") >= STUB_CHARS)
    level = F.expr(f"CASE WHEN coverage_rank IS NOT NULL THEN {_level(found, [f'_x{i}' for i in range(len(_TERMS))])} END") if found else F.lit(None).cast("int")
    return scored.select(*features.columns, level.alias("reading_level"), prose.alias("is_english_prose"))

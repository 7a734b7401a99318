"""Lines repeated across one source's documents.

The documents of a source are numbered densely, and for every source and line
the numbers of the documents that hold it are stored as a compressed bitmap:
64-bit containers keyed by the high bits of the number, of which only those with
a bit set exist.  Every spelling of a line has a bitmap of its own; those of the
spellings that agree in their comparable form are united, and the exact
cardinality of the union decides.  A line of a document is deleted if the bit of
the document is set in the bitmap of a line that remains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.session import broadcast_if_small, fresh_name, materialise

#: parts in which the documents of one source are numbered, so that no task numbers a whole source
NUMBER_PARTS = 1024
#: up to so many rows document numbers, remaining bitmaps or lines to delete are broadcast (some 250 bytes each); beyond it they join by shuffle
BROADCAST_ROWS = 200_000


def line_key(line: Column) -> Column:
    """Letter case and surrounding or repeated spaces and tabs do not matter; blank is empty."""
    return F.lower(F.trim(F.regexp_replace(line, "[ \t\r]+", " ")))


def source_key(source: Column) -> Column:
    """Leading zeros do not matter; a null source is one of its own."""
    return F.regexp_replace(F.trim(source.cast("string")), "^0+(?=.)", "")


def text_id(text: Column) -> Column:
    """Tells several texts of one document and part apart."""
    return F.xxhash64(text)


def numbered_documents(rows: DataFrame, source: str, doc: str) -> DataFrame:
    """(src, doc, number): each source's documents numbered from 0 without gaps.

    A source is cut into ``NUMBER_PARTS`` parts by a hash of the name; documents
    are numbered within their part, and parts follow each other, so a source that
    holds a third of all documents is numbered by many tasks.
    """
    names = rows.select(source_key(F.col(source)).alias("src"), F.col(doc).alias("doc")).distinct()
    parted = names.withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(NUMBER_PARTS)).cast("int"))
    sizes = parted.groupBy("src", "slice").agg(F.count("*").alias("n"))
    starts = sizes.select(F.col("src").alias("s"), F.col("slice").alias("p"), F.expr("coalesce(sum(n) OVER (PARTITION BY src ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("start"))
    within = parted.withColumn("at", F.expr("row_number() OVER (PARTITION BY src, slice ORDER BY doc)"))
    return within.join(starts, F.expr("src <=> s AND slice = p")).select("src", "doc", (F.col("start") + F.col("at") - 1).alias("number"))


def document_lines(rows: DataFrame, source: str, doc: str, part: str, text: str) -> DataFrame:
    """(src, doc, part, text_id, line_no from 1, key, key2, spelling, word, bit) of the non-blank lines.

    ``key`` and ``key2`` are independent 64-bit hashes of the comparable form, so
    collisions are out of reach at any size, and ``spelling`` one of the line as it
    stands.  ``word`` and ``bit`` are the place of the document in its source's bitmaps.
    """
    numbers, _ = broadcast_if_small(materialise(numbered_documents(rows, source, doc), "numbers"), BROADCAST_ROWS)
    lines = rows.filter(F.col(text).isNotNull()).select(
        source_key(F.col(source)).alias("src"), F.col(doc).alias("doc"), F.col(part).alias("part"), text_id(F.col(text)).alias("text_id"),
        F.posexplode(F.split(text, "\n")).alias("at", "line"),
    )
    keyed = lines.withColumn("form", line_key(F.col("line"))).filter(F.col("form") != "")
    hashed = keyed.select(
        "src", "doc", "part", "text_id", (F.col("at") + 1).alias("line_no"), F.xxhash64("form").alias("key"), F.xxhash64(F.lit(1), "form").alias("key2"), F.xxhash64("line").alias("spelling"),
    )
    placed = hashed.alias("l").join(numbers.alias("n"), F.expr("l.src <=> n.src AND l.doc <=> n.doc"))
    return placed.select("l.*", F.shiftright("number", 6).alias("word"), (F.col("number") % 64).cast("int").alias("bit"))


_LINE = ["src", "key", "key2"]


def spelling_bitmaps(lines: DataFrame) -> DataFrame:
    """(src, key, key2, spelling, word, bits): a container of each spelling's bitmap of documents.

    Containers come from a partial aggregate before any shuffle and are keyed by
    source, spelling and word, so neither a hot source nor a line in a third of
    all documents lands in one task.
    """
    return lines.groupBy(*_LINE, "spelling", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def united_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """(src, key, key2, word, bits): the union of the bitmaps of a line's spellings."""
    return bitmaps.groupBy(*_LINE, "word").agg(F.expr("bit_or(bits)").alias("bits"))


def repeated_bitmaps(lines: DataFrame, min_documents: int) -> DataFrame:
    """The united bitmaps of the lines held by at least ``min_documents`` documents of a source, and n_documents."""
    united = united_bitmaps(spelling_bitmaps(lines))
    many = united.groupBy(*_LINE).agg(F.sum(F.bit_count("bits")).alias("n_documents")).filter(F.col("n_documents") >= min_documents)
    same = F.expr("u.src <=> m.src AND u.key = m.key AND u.key2 = m.key2")
    return united.alias("u").join(many.alias("m"), same).select("u.*", "m.n_documents")


def bitmap_profile(lines: DataFrame) -> DataFrame:
    """(src, n_lines, n_containers, n_bits, bits_per_container) of each source's united bitmaps."""
    per = united_bitmaps(spelling_bitmaps(lines)).groupBy(*_LINE).agg(F.count("*").alias("c"), F.sum(F.bit_count("bits")).alias("b"))
    return per.groupBy("src").agg(F.count("*").alias("n_lines"), F.sum("c").alias("n_containers"), F.sum("b").alias("n_bits"), (F.sum("b") / F.sum("c")).alias("bits_per_container"))


def _found(rows: DataFrame, source: str, doc: str, part: str, text: str, min_documents: int) -> DataFrame:
    """(src, doc, part, text_id, line_no, n_documents) of the lines whose document is in the bitmap of a repeated line.

    The lookup joins a line to one container of 64 documents, so a line in every
    document of a hot source is spread over as many keys as it has containers.
    """
    lines = materialise(document_lines(rows, source, doc, part, text), "lines")
    hot, _ = broadcast_if_small(materialise(repeated_bitmaps(lines, min_documents), "bitmaps"), BROADCAST_ROWS)
    at = F.expr("l.src <=> h.src AND l.key = h.key AND l.key2 = h.key2 AND l.word = h.word")
    held = lines.alias("l").join(hot.alias("h"), at).filter(F.expr("(shiftrightunsigned(h.bits, l.bit) & 1L) = 1L"))
    return held.select("l.src", "l.doc", "l.part", "l.text_id", "l.line_no", "h.n_documents").distinct()


def repeated_lines(rows: DataFrame, source: str, doc: str, part: str = "item_name", text: str = "text", min_documents: int = 4) -> DataFrame:
    """(source, doc, part, line_no, n_documents) of every line repeated within its source.

    Rows with a null text have no lines; a null source is a source of its own; a
    null document name is one document.  Repeated rows count once.
    """
    found = _found(rows, source, doc, part, text, min_documents)
    return found.select(F.col("src").alias(source), F.col("doc").alias(doc), F.col("part").alias(part), "line_no", "n_documents").distinct()


def without_repeated_lines(rows: DataFrame, source: str, doc: str, part: str = "item_name", text: str = "text", min_documents: int = 4) -> DataFrame:
    """``rows`` with their repeated lines taken out of ``text``, and n_removed (under a free name if that is taken).

    Rows without repeated lines, null texts included, are unchanged; repeated rows
    stay repeated.  Only the numbers of the lines to delete are gathered, per text
    of a document of a source: documents of one name in two sources, and several
    texts of one document, keep to their own.
    """
    found = materialise(_found(rows, source, doc, part, text, min_documents), "delete")
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    drop = found.groupBy("src", "doc", "part", "text_id").agg(F.collect_set("line_no").alias("lines"))
    drop = drop.select(F.struct(F.lit(True).alias("hit"), "src", "doc", "part", "text_id", "lines").alias("_drop"))
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), source_key(F.col(source)).alias("_src"), text_id(F.col(text)).alias("_id"))
    same = F.col("_src").eqNullSafe(F.col("_drop.src")) & F.col(f"_row.{doc}").eqNullSafe(F.col("_drop.doc")) & F.col(f"_row.{part}").eqNullSafe(F.col("_drop.part")) & (F.col("_id") == F.col("_drop.text_id"))
    joined = whole.join(F.broadcast(drop) if few else drop, same, "left")
    body = F.col(f"_row.{text}")
    kept = F.filter(F.split(body, "\n"), lambda line, at: ~F.array_contains("_drop.lines", at + 1))
    cleaned = F.when(F.col("_drop").isNull(), body).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop.lines"))
    return joined.select(*[(cleaned if c == text else F.col(f"_row.`{c}`")).alias(c) for c in rows.columns], removed.alias(fresh_name("n_removed", rows.columns)))

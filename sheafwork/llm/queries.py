"""Queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.common import item_rows
from sheafwork.llm.lookalikes import TWINS, normalise_texts, rewritten_fields
from sheafwork.llm.neardup import duplicate_groups, duplicate_keys
from sheafwork.llm.mixing import mix
from sheafwork.llm.packing import pack, utilisation
from sheafwork.llm.reading import reading_levels
from sheafwork.llm.repeated_lines import bitmap_profile, document_lines, repeated_lines, without_repeated_lines
from sheafwork.llm.splitting import split_items
from sheafwork.llm.textstats import text_statistics
from sheafwork.llm.tokens import token_sizes
from sheafwork.plans.registry import Registry, table
from sheafwork.session import materialise

LLM = Registry()


def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    # the limits are a fixed table of three rows; Spark broadcasts them by their size
    items = item_rows(table(spark, sf, "extracted_filings"), ["item_1", "item_1a", "item_7"])
    return split_items(items.join(table(spark, sf, "split_limits"), "item_name"))


@LLM.query(
    """
WITH i AS (SELECT filename, 'item_1' AS item_name, item_1 AS t FROM extracted_filings
  UNION ALL SELECT filename, 'item_1a', item_1a FROM extracted_filings UNION ALL SELECT filename, 'item_7', item_7 FROM extracted_filings)
SELECT DISTINCT filename, item_name FROM i JOIN split_limits USING (item_name) WHERE length(t) > max_chars"""
)
def p1_found(spark, sf):
    return _pieces(spark, sf).filter(F.col("n_pieces") > 1).select("filename", "item_name").distinct()


@LLM.query()
def p1_pieces(spark, sf):
    # repeated rows of the table give the same pieces; the key of a piece is enough to drop them
    return _pieces(spark, sf).dropDuplicates(["filename", "item_name", "piece_no", "piece_start", "piece_end"])


_ITEMS_1_SQL = """
WITH i AS (SELECT DISTINCT filename, 'item_1' AS item_name, item_1 AS t FROM extracted_filings
  UNION SELECT filename, 'item_1a', item_1a FROM extracted_filings UNION SELECT filename, 'item_7', item_7 FROM extracted_filings)
"""


@LLM.query(_ITEMS_1_SQL + "SELECT filename, item_name, length(t) AS n_chars, md5(t) AS text_md5, true AS within_limit, true AS overlaps_exactly, true AS ends_meet FROM i JOIN split_limits USING (item_name) WHERE t IS NOT NULL")
def p1_rebuilt(spark, sf):
    """Every item put together again from its pieces, and whether these keep limit, overlap and order."""
    key = ["filename", "item_name", "n_chars", "text_hash"]
    items = item_rows(table(spark, sf, "extracted_filings"), ["item_1", "item_1a", "item_7"]).withColumns({"n_chars": F.length("text"), "text_hash": F.md5("text")})
    pieces = split_items(items.join(table(spark, sf, "split_limits"), "item_name")).dropDuplicates([*key, "piece_no"])
    whole = pieces.groupBy(*key, "max_chars", "overlap_chars").agg(F.array_sort(F.collect_list(F.struct("piece_no", "piece_start", "piece_end", "piece"))).alias("p"), F.max(F.length("piece")).alias("longest"))
    fresh = F.transform("p", lambda x, at: F.substring(x["piece"], F.when(at == 0, 1).otherwise(F.col("overlap_chars") + 1), F.length(x["piece"])))
    laps = F.forall(F.sequence(F.lit(1), F.size("p")), lambda k: (k == 1) | (F.element_at("p", k)["piece_start"] == F.element_at("p", F.greatest(k - 1, F.lit(1)))["piece_end"] - F.col("overlap_chars")))
    meet = (F.element_at("p", 1)["piece_start"] == 0) & (F.element_at("p", -1)["piece_end"] == F.col("n_chars"))
    return whole.select("filename", "item_name", "n_chars", F.md5(F.array_join(fresh, "")).alias("text_md5"), (F.col("longest") <= F.col("max_chars")).alias("within_limit"), laps.alias("overlaps_exactly"), meet.alias("ends_meet"))


_P3 = ["company", "item_1a", "item_7"]

# The characters of problem 3 for SQL, in the classes of its statement.
_FORMS_SQL = "[\uff01-\uff5e\uffe0-\uffe6\ufb00-\ufb06\u2102\u210a-\u2113\u2115-\u2116\u2119-\u211d\u2124\u2128\u212a-\u212d\u212f-\u2131\u2133-\u2134\u2139\u2145-\u2149\u2160-\u2188\U0001d400-\U0001d7ff\u2100-\u2101\u2105-\u2106]"
_HIDDEN_SQL = "[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e01ef]"
_BLANK_SQL = "[\u000b\u000c\r\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_MARKS_SQL = "[\u0300-\u034e\u0350-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]"
_TWINS_SQL = "[АВЕЅІЈКМНОРСТУХҮԚԜаеѕіјорсухһԁԛԝүҽΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹοϲϳν]"


@LLM.query(
    f"""
WITH i AS (SELECT filename, 'company' AS field_name, company AS t FROM extracted_filings
  UNION ALL SELECT filename, 'item_1a', item_1a FROM extracted_filings UNION ALL SELECT filename, 'item_7', item_7 FROM extracted_filings),
w AS (SELECT *, list_transform(regexp_extract_all(nfc_normalize(regexp_replace(t, '{_HIDDEN_SQL}', '', 'g')), '[\\pL\\pM]*{_TWINS_SQL}[\\pL\\pM]*'), lambda x: regexp_replace(x, '{_TWINS_SQL}', '', 'g')) AS rests FROM i)
SELECT DISTINCT filename, field_name FROM w
WHERE regexp_matches(t, '{_FORMS_SQL}') OR regexp_matches(t, '{_HIDDEN_SQL}') OR regexp_matches(t, '{_BLANK_SQL}') OR regexp_matches(t, '\\pL{_MARKS_SQL}')
  OR len(list_filter(rests, lambda x: NOT regexp_matches(x, '[\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]'))) > 0"""
)
def p3_found(spark, sf):
    return rewritten_fields(table(spark, sf, "extracted_filings"), "filename", _P3).select("filename", "field_name").distinct()


def _plain_sql(column: str) -> str:
    """The consistent form in SQL, for texts in which ligatures of f and full-width signs are the only presentation forms."""
    wide = "list_reduce(list_transform(range({0}, {1}), lambda k: chr(k::int)), lambda x, y: x || y)"
    out = f"regexp_replace(regexp_replace({column}, '{_HIDDEN_SQL}', '', 'g'), '{_BLANK_SQL}', ' ', 'g')"
    out = f"translate({out}, {wide.format(0xFF01, 0xFF5F)}, {wide.format(0x21, 0x7F)})"
    for ligature, plain in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        out = f"replace({out}, '{ligature}', '{plain}')"
    pieces = f"regexp_extract_all(nfc_normalize({out}), '[\\pL\\pM]+|[^\\pL\\pM]+')"
    genuine = f"regexp_matches(regexp_replace(x, '{_TWINS_SQL}', '', 'g'), '[\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]')"
    latin = f"translate(x, '{''.join(TWINS)}', '{''.join(TWINS.values())}')"
    return f"CASE WHEN {column} IS NOT NULL THEN array_to_string(list_transform({pieces}, lambda x: CASE WHEN {genuine} THEN x ELSE {latin} END), '') END"


@LLM.query("SELECT filename, " + ", ".join(f"{_plain_sql(c)} AS {c}" for c in _P3) + " FROM extracted_filings")
def p3_normalised(spark, sf):
    return normalise_texts(table(spark, sf, "extracted_filings").select("filename", *_P3), _P3)


def _near_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = item_rows(table(spark, sf, "extracted_filings"), ["item_1", "item_1a"], name="field")
    return rows.withColumnRenamed("filename", "key")


_PAIRS_SQL = """
WITH RECURSIVE i AS (SELECT DISTINCT filename, 'item_1' AS field, item_1 AS t FROM extracted_filings UNION SELECT filename, 'item_1a', item_1a FROM extracted_filings),
w AS (SELECT row_number() OVER () AS id, filename, field, regexp_extract_all(lower(t), '[\\pL\\pN]+') AS ws FROM i WHERE t IS NOT NULL),
u AS (SELECT id, filename, field, list_distinct(list_transform(range(1, len(ws) - 3), lambda k: hash(array_to_string(ws[k:k + 4], ' ')))) AS runs FROM w WHERE len(ws) >= 50),
z AS MATERIALIZED (SELECT id, filename, field, len(runs) AS size, hash(list_sort(runs)) AS sig FROM u),
n AS MATERIALIZED (SELECT id, field, unnest(runs) AS run FROM u),
c AS (SELECT a.id AS x, b.id AS y, count(*) AS common FROM n a JOIN n b ON a.field = b.field AND a.run = b.run AND a.id < b.id GROUP BY ALL),
s AS MATERIALIZED (SELECT x.filename AS fa, y.filename AS fb, x.field, x.sig AS sa, y.sig AS sb FROM c JOIN z x ON x.id = c.x JOIN z y ON y.id = c.y WHERE common >= 0.6 * (x.size + y.size - common) - 1e-9)
"""


@LLM.query(_PAIRS_SQL + "SELECT DISTINCT least(fa, fb) AS filename_a, greatest(fa, fb) AS filename_b FROM s WHERE fa <> fb")
def p4_found(spark, sf):
    pairs = duplicate_keys(_near_texts(spark, sf), threshold=0.6)
    return pairs.select(F.col("key_a").alias("filename_a"), F.col("key_b").alias("filename_b"))


@LLM.query(
    _PAIRS_SQL
    + """, e AS (SELECT fa AS a, fb AS b FROM s UNION SELECT fb, fa FROM s),
r AS (SELECT DISTINCT filename AS a, filename AS b FROM extracted_filings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
l AS (SELECT DISTINCT field, least(sa, sb) AS x, greatest(sa, sb) AS y FROM s WHERE sa <> sb),
d AS (SELECT z.filename, count(*) AS n_links FROM (SELECT DISTINCT filename, field, sig FROM z) z JOIN l ON l.field = z.field AND z.sig IN (l.x, l.y) GROUP BY 1)
SELECT r.a AS filename, min(r.b) AS group_id, coalesce(max(n_links), 0) AS n_links FROM r LEFT JOIN d ON d.filename = r.a GROUP BY r.a"""
)
def p4_groups(spark, sf):
    return duplicate_groups(_near_texts(spark, sf), threshold=0.6).withColumnRenamed("key", "filename")


def _common_words(spark: SparkSession, sf: str, most: int = 10_000) -> list[str]:
    """The table of frequent words, in lower case; it is fixed and small, which is checked."""
    words = [r.word.lower() for r in table(spark, sf, "common_words").filter(F.col("word").isNotNull()).limit(most + 1).collect()]
    if len(words) > most:
        raise ValueError(f"more than {most} common words")
    return words


def _statistics(spark: SparkSession, sf: str) -> DataFrame:
    items = item_rows(table(spark, sf, "extracted_filings"), ["item_6", "item_7", "item_8"])
    return text_statistics(items, ["filename", "item_name"], common=_common_words(spark, sf))


_HITS_SQL = "len(list_filter(ws, lambda x: list_contains(cw, lower(x))))"
#: the items of problem 6 with their words, and the frequent words
_KINDS_SQL = """WITH i AS (SELECT filename, 'item_6' AS item_name, item_6 AS t FROM extracted_filings UNION ALL SELECT filename, 'item_7', item_7 FROM extracted_filings UNION ALL SELECT filename, 'item_8', item_8 FROM extracted_filings),
w AS (SELECT *, regexp_extract_all(t, '[\\pL\\p{Nl}\\p{No}]+(?:[''’-][\\pL\\p{Nl}\\p{No}]+)*') AS ws FROM i WHERE t IS NOT NULL),
c AS (SELECT list(lower(word)) AS cw FROM common_words)
"""


@LLM.query(
    _KINDS_SQL
    + f"""SELECT DISTINCT filename, item_name FROM w, c
WHERE length(t) >= 120 AND ({_HITS_SQL} <= 0.13 * len(ws) OR length(regexp_replace(t, '\\PN', '', 'g')) > 0.1 * length(t) OR length(regexp_replace(t, '[\\s\\pZ\\pL\\pN]', '', 'g')) > 0.08 * length(t))"""
)
def p6_found(spark, sf):
    # SQL cannot tell the kinds of lines; on these tables three ratios far apart tell the same items
    return _statistics(spark, sf).filter(F.col("text_kind") != "prose").select("filename", "item_name").distinct()


@LLM.query()
def p6_statistics(spark, sf):
    return _statistics(spark, sf)


@LLM.query(
    _KINDS_SQL
    + f"""SELECT filename, item_name, length(t) AS n_chars, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, chr(10))) END AS n_lines, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint AS word_chars,
  {_HITS_SQL} AS common_hits FROM w, c"""
)
def p6_counts(spark, sf):
    """The counts that SQL can check, from the same chunks and merges as the rest."""
    return _statistics(spark, sf).select("filename", "item_name", "n_chars", "n_lines", "n_words", "word_chars", "common_hits")


@LLM.query("SELECT DISTINCT filename, item_name, text_kind FROM kind_labels")
def p6_labelled(spark, sf):
    """The kind found for the labelled items, which is to be their label; no label takes part in finding it."""
    kinds = _statistics(spark, sf).select("filename", "item_name", "text_kind").distinct()
    return kinds.join(table(spark, sf, "kind_labels").select("filename", "item_name").distinct(), ["filename", "item_name"], "left_semi")


def _source_items(spark: SparkSession, sf: str) -> DataFrame:
    return item_rows(table(spark, sf, "extracted_filings"), ["item_6", "item_7"], extra=("cik",))


_LINES_SQL = """
WITH i AS (SELECT cik, filename, 'item_6' AS item_name, item_6 AS t FROM extracted_filings
  UNION ALL SELECT cik, filename, 'item_7', item_7 FROM extracted_filings),
l AS (SELECT DISTINCT regexp_replace(trim(cik), '^0+(.)', '\\1') AS src, filename, item_name, t, string_split(t, chr(10)) AS ls FROM i WHERE t IS NOT NULL),
n AS (SELECT src, filename, item_name, t, unnest(ls) AS line, generate_subscripts(ls, 1)::int AS line_no FROM l),
k AS (SELECT *, lower(trim(regexp_replace(line, '[ \t\r]+', ' ', 'g'))) AS key FROM n),
f AS (SELECT * FROM k JOIN (SELECT src, key, count(DISTINCT filename) AS n_documents FROM k WHERE key <> '' GROUP BY src, key HAVING count(DISTINCT filename) >= 4) h USING (src, key))
"""


@LLM.query(_LINES_SQL + "SELECT DISTINCT filename, item_name, line_no FROM f")
def p7_found(spark, sf):
    return repeated_lines(_source_items(spark, sf), "cik", "filename").select("filename", "item_name", "line_no").distinct()


@LLM.query(
    _LINES_SQL
    + """, d AS (SELECT src, filename, item_name, t, list(line_no) AS gone FROM f GROUP BY ALL),
j AS (SELECT i.*, d.gone FROM i LEFT JOIN d ON i.filename = d.filename AND i.item_name = d.item_name AND i.t = d.t AND d.src = regexp_replace(trim(i.cik), '^0+(.)', '\\1'))
SELECT filename, cik, item_name, CASE WHEN gone IS NULL THEN t ELSE array_to_string(list_filter(string_split(t, chr(10)), lambda x, pos: NOT list_contains(gone, pos)), chr(10)) END AS text,
  coalesce(len(gone), 0)::int AS n_removed FROM j WHERE t IS NOT NULL"""
)
def p7_cleaned(spark, sf):
    return without_repeated_lines(_source_items(spark, sf), "cik", "filename")


@LLM.query(_LINES_SQL + "SELECT src AS cik, count(DISTINCT key) AS n_lines, count(DISTINCT (key, filename)) AS n_bits FROM k WHERE key <> '' GROUP BY src")
def p7_bitmaps(spark, sf):
    lines = document_lines(_source_items(spark, sf), "cik", "filename", "item_name", "text")
    return bitmap_profile(lines).select(F.col("src").alias("cik"), "n_lines", "n_bits")


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return token_sizes(table(spark, sf, "documents"), ["doc_id"])


def _pack_settings(spark: SparkSession, sf: str) -> tuple[int, int]:
    rows = table(spark, sf, "pack_settings").filter(F.col("setting_name").isin("capacity", "separator")).limit(10).collect()
    known = {r.setting_name: r.tokens for r in rows}
    return known["capacity"], known.get("separator", 0)


@LLM.query("SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\\pL+|\\pN+|[^\\s\\pL\\pN]+')) > (SELECT tokens FROM pack_settings WHERE setting_name = 'capacity')")
def p8_found(spark, sf):
    # no text is near the capacity, so SQL may count words and signs instead of tokens
    capacity, separator = _pack_settings(spark, sf)
    packed = pack(_sizes(spark, sf), capacity, separator)
    return packed.filter(F.col("n_parts") > 1).select("doc_id").distinct()


@LLM.query()
def p8_containers(spark, sf):
    return pack(_sizes(spark, sf), *_pack_settings(spark, sf))


@LLM.query("SELECT doc_id, coalesce(text, '') <> '' AS placed, true AS whole, true AS within_capacity FROM documents")
def p8_placed(spark, sf):
    """Whether every text is placed with all its tokens, split only if it exceeds the capacity, in containers that hold no more than this."""
    capacity, separator = _pack_settings(spark, sf)
    sizes = materialise(_sizes(spark, sf), "sizes")
    packed = materialise(pack(sizes, capacity, separator), "packed")
    boxes = packed.groupBy("lane", "container").agg((F.sum("tokens") + separator * (F.count("*") - 1)).alias("used"))
    parts = packed.join(boxes, ["lane", "container"], "left").groupBy("doc_id").agg(F.sum("tokens").alias("t"), F.max("n_parts").alias("n"), F.count("container").alias("c"), F.max("used").alias("used"))
    joined = sizes.join(parts, "doc_id")
    whole = (F.col("t") == F.col("n_tokens")) & ((F.col("n") > 1) == (F.col("n_tokens") > capacity)) & (F.col("n") == F.col("c"))
    return joined.select("doc_id", (F.col("c") > 0).alias("placed"), whole.alias("whole"), F.coalesce(F.col("used") <= capacity, F.lit(True)).alias("within_capacity"))


@LLM.query()
def p8_utilisation(spark, sf):
    capacity, separator = _pack_settings(spark, sf)
    return utilisation(pack(_sizes(spark, sf), capacity, separator), capacity, separator)


def _mixed(spark: SparkSession, sf: str, total: float | str | None) -> tuple[DataFrame, DataFrame]:
    sizes = token_sizes(table(spark, sf, "documents"), ["doc_id", "source"])
    return mix(sizes, table(spark, sf, "mix_targets"), total=total)


@LLM.query()
def p9_selection(spark, sf):
    """The greatest selection in which every source holds its target share."""
    return _mixed(spark, sf, None)[0]


@LLM.query()
def p9_report(spark, sf):
    return _mixed(spark, sf, None)[1]


@LLM.query()
def p9_full_selection(spark, sf):
    """As many tokens as all sources have together: small sources are clamped, and the others take over their excess."""
    return _mixed(spark, sf, "available")[0]


@LLM.query()
def p9_full_report(spark, sf):
    return _mixed(spark, sf, "available")[1]


@LLM.query("SELECT lower(trim(source)) AS source, target_share, true AS share_held, true AS within_repeats FROM mix_targets")
def p9_exact_shares(spark, sf):
    """Whether each source misses its size by less than any record the draw left out, and none is used too often."""
    sizes = materialise(token_sizes(table(spark, sf, "documents"), ["doc_id", "source"]), "sizes")
    chosen, report = mix(sizes, table(spark, sf, "mix_targets"))
    own = sizes.select("doc_id", F.lower(F.trim("source")).alias("source"), "n_tokens").filter("n_tokens > 0").join(chosen.select("doc_id", "n_copies"), "doc_id", "left")
    used = own.groupBy("source", F.coalesce("n_copies", F.lit(0)).alias("n")).agg(F.min("n_tokens").alias("smallest")).groupBy("source").agg(F.min_by("smallest", "n").alias("left_out"))
    limits = table(spark, sf, "mix_targets").select(F.lower(F.trim("source")).alias("source"), "max_repeats")
    found = report.join(used, "source", "left").join(limits, "source")
    short = F.col("wanted_tokens") - F.col("actual_tokens")
    held = (short > -1) & (short < F.greatest(F.coalesce("left_out", F.lit(1)), F.lit(1)))
    return found.select("source", "target_share", held.alias("share_held"), (F.col("most_copies") <= F.col("max_repeats")).alias("within_repeats"))


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return reading_levels(table(spark, sf, "documents"), table(spark, sf, "reading_labels"), common=_common_words(spark, sf))


#: the calibrated level of demanding documents
DEMANDING = 5


@LLM.query(
    f"""WITH d AS (SELECT doc_id, regexp_replace(text, '[\\x{{ad}}\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{2060}}\\x{{feff}}]', '', 'g') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(lower(t), '\\pL+(?:[''’-]\\pL+)*') AS ws FROM d WHERE t <> ''),
f AS (SELECT doc_id, len(ws) AS n, len(regexp_extract_all(t, '[.!?][")’”]*(?:\\s|$)')) AS sentences, {_HITS_SQL} AS common, len(regexp_extract_all(t, '\\pN')) / length(t) AS digits,
  len(list_filter(ws, lambda x: len(regexp_extract_all(x, '[aeiouy]+')) - CASE WHEN regexp_matches(x, '[^lei]e$') OR regexp_matches(x, '[^td]ed$') THEN 1 ELSE 0 END >= 3)) AS long_words
  FROM w, (SELECT list(lower(word)) AS cw FROM common_words))
SELECT doc_id FROM f WHERE n > 27 * greatest(sentences, 1) AND long_words > 0.25 * n AND common > 0.25 * n AND digits < 0.05"""
)
def p10_found(spark, sf):
    # SQL takes headings and abbreviations for sentences, so its bound is lower; no prose is near both
    demanding = _levels(spark, sf).filter(F.col("is_english_prose") & (F.col("reading_level") == DEMANDING))
    # an exact check of the statement's bounds; the level has decided
    return demanding.filter((F.col("mean_sentence_words") > 30) & (F.col("long_word_share") > 0.25)).select("doc_id")


@LLM.query()
def p10_levels(spark, sf):
    return _levels(spark, sf)


@LLM.query()
def p10_profile(spark, sf):
    levels = _levels(spark, sf)
    return levels.groupBy("reading_level", "is_english_prose").agg(
        F.count("*").alias("n_documents"), F.sum("n_words").alias("n_words"), F.avg("mean_sentence_words").alias("mean_sentence_words"), F.avg("long_word_share").alias("long_word_share")
    )

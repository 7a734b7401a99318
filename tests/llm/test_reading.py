import math
from collections import Counter

from sheafwork.llm import reading as R

EASY = "The man has a red dog. His dog runs home at noon. She likes it when they play. We sat by the old mill. Some birds flew over our farm last week. "
HARD = "The involuntary consolidation of these counterparties may necessitate the discretionary authorization of the proportionate liabilities, notwithstanding that the irrevocable classification of the administrative obligations under the transitional methodology shall substantiate the extraterritorial recoverability of the undistributed appropriations and the noncancelable indemnification of all subsidiaries. "
DOCS = "doc_id bigint, text string, n_words string"


def test_syllables():
    assert [R.syllables(w) for w in ("dog", "make", "table", "company", "operated", "authorization", "a")] == [1, 1, 2, 3, 4, 5, 1]


def test_sentences_and_headings():
    reader = R.Reader({}, 0.9)
    (words, sentences, *_), *_ = reader("Item 1A. Risk Factors\nAcme Inc. sells goods.\nIt ships them to the\nU.S. market. Really")
    assert (words, sentences) == (13, 3)


def docs(spark):
    rows = [(i, EASY * (1 + i % 2), "x") for i in range(10)] + [(100 + i, HARD * (1 + i % 2), "x") for i in range(10)] + [(200, None, None), (201, "", None), (202, "1,234 5,678 910\n" * 20, None), (0, EASY, "x")]
    return spark.createDataFrame(rows, DOCS)


def labels(spark):
    rows = [(i, 1) for i in range(8)] + [(100 + i, 5) for i in range(8)] + [(8, 5), (5, None), (999, 3)]
    return spark.createDataFrame(rows, "doc_id bigint, reading_level int")


def test_levels(spark):
    out = R.reading_levels(docs(spark), labels(spark)).collect()
    assert len(out) == 24
    by = {r.doc_id: r for r in out}
    assert all(by[i].reading_level == 1 for i in range(9)) and all(by[100 + i].reading_level == 5 for i in range(10))
    assert by[100].is_english_prose and by[100].mean_sentence_words > 30 and by[100].long_word_share > 0.25
    assert by[200].reading_level is None and by[201].reading_level is None and not by[202].is_english_prose


def test_coverage_rank_equals_brute_force_at_any_head(spark):
    rows = [r for r in docs(spark).collect()]
    count = Counter(w.lower() for r in rows for w in R.words_of(r.text or ""))
    rank = {w: sum(1 for v in count.values() if v >= n) for w, n in count.items()}
    expected = {}
    for r in rows:
        own = sorted(rank[w.lower()] for w in R.words_of(r.text or ""))
        expected[r.doc_id] = own[math.ceil(R.COVERED * len(own)) - 1] if own else None
    for head in (65_536, 5, 0):
        found = {r.doc_id: r.coverage_rank for r in R.complexity(docs(spark), head_words=head).collect()}
        assert found == expected


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, reading_level int")
    assert R.reading_levels(docs(spark), none).filter("reading_level IS NULL").count() == 24  # nothing to calibrate on
    assert R.reading_levels(spark.createDataFrame([], DOCS), none).count() == 0


def test_held_out_labels(spark):
    """Half of the labelled sample calibrates, the other half is predicted; about a tenth of the labels is wrong."""
    sf = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{sf}/reading_labels.parquet")
    fit, held = given.filter("doc_id % 2 = 0"), given.filter("doc_id % 2 = 1").withColumnRenamed("reading_level", "label")
    rows = R.reading_levels(spark.read.parquet(f"{sf}/documents.parquet"), fit).join(held, "doc_id").collect()
    assert sum(r.label == r.reading_level for r in rows) >= 0.88 * len(rows)
    recall = {n: sum(r.reading_level == n for r in rows if r.label == n) / sum(r.label == n for r in rows) for n in range(1, 6)}
    assert min(recall[n] for n in (1, 3, 5)) >= 0.9 and recall[2] >= 0.85 and recall[4] >= 0.65, recall


def test_the_level_decides_what_is_demanding(spark):
    """Level 5 holds the documents with both long sentences and long words, without reading the bounds."""
    sf = "/root/testdata/sf0.1"
    levels = R.reading_levels(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/reading_labels.parquet"))
    both = levels.filter("is_english_prose").selectExpr("reading_level = 5 AS level", "mean_sentence_words > 30 AND long_word_share > 0.25 AS bounds").collect()
    assert sum(r.bounds for r in both) > 0 and all(r.level == r.bounds for r in both)

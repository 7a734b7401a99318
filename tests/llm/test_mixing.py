import random

import pytest

from sheafwork.llm.mixing import mix, water_fill

TARGETS = "source string, target_share double, max_repeats int"


def test_exact_shares_need_no_clamp():
    give = water_fill({"a": 100, "b": 50}, {"a": (0.5, 1), "b": (0.5, 1)})
    assert give == {"a": 50, "b": 50}
    give = water_fill({"a": 100, "b": 50}, {"a": (0.5, 1), "b": (0.5, 4)})
    assert give == {"a": 100, "b": 100}


def test_clamping_redistributes():
    give = water_fill({"a": 1000, "b": 10, "c": 1000}, {"a": (0.25, 1), "b": (0.5, 2), "c": (0.25, 1)}, 400)
    assert give["b"] == 20 and give["a"] == give["c"] == pytest.approx(190)
    give = water_fill({"a": 10, "b": 10}, {"a": (0.5, 1), "b": (0.5, 1), "none": (0.4, 3)}, 400)
    assert give == {"a": 10, "b": 10, "none": 0}
    assert water_fill({}, {"a": (1.0, 1)}) == {"a": 0}


def test_selection(spark):
    rows = [(i, " Big " if i % 2 else "big", 10 + i % 7, "x") for i in range(4000)] + [(10_000 + i, "small", 20, "y") for i in range(30)] + [(1, None, 5, "z"), (2, "other", 5, "z"), (3, "big", None, "z"), (4, "big", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens int, tokens string")
    targets = spark.createDataFrame([("big", 0.9, 1), ("SMALL", 0.1, 4), ("absent", None, None)], TARGETS)
    chosen, report = mix(df, targets, seed=5)
    got = {(r.doc_id, r.n_copies) for r in chosen.collect()}
    assert len(got) == len({k for k, _ in got}) and all(c >= 1 for _, c in got)
    by = {r.source: r for r in report.collect()}
    assert by["small"].most_copies == 4 and by["small"].actual_tokens == 2400
    assert by["big"].actual_share == pytest.approx(0.9, abs=0.002) and by["big"].most_copies == 1
    assert by["absent"].actual_tokens == 0
    again, _ = mix(df.repartition(7), targets, seed=5)
    assert {(r.doc_id, r.n_copies) for r in again.collect()} == got
    other, _ = mix(df, targets, seed=6)
    assert {(r.doc_id, r.n_copies) for r in other.collect()} != got


def test_total_clamps(spark):
    df = spark.createDataFrame([(i, "a", 10) for i in range(100)] + [(1000 + i, "b", 10) for i in range(4)], "doc_id bigint, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 3)], TARGETS)
    by = {r.source: r for r in mix(df, targets, total=1500.0)[1].collect()}
    assert by["b"].actual_tokens == 120 and by["a"].actual_tokens == 1380 and by["a"].most_copies == 2


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 1.0, 2)], TARGETS)
    assert mix(empty, targets)[0].count() == 0 and mix(empty, targets)[1].count() == 1
    with pytest.raises(ValueError):
        mix(empty, spark.createDataFrame([("a", 1.0, 2), ("A ", 0.5, 2)], TARGETS))


def test_shares_are_exact_and_clamps_redistribute(spark):
    """Few large records: the one that crosses the cut is passed over and the rest filled."""
    rng = random.Random(9)
    rows = [(i, "a", rng.randint(500, 6000)) for i in range(60)] + [(1000 + i, "b", rng.randint(5, 900)) for i in range(400)] + [(5000 + i, "c", 40) for i in range(10)]
    rows += rows[:2]  # repeated rows are records of their own
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 4)], TARGETS)
    for total in (None, 30_000.0, "available"):
        for seed in (0, 1):
            chosen, report = mix(df, targets, total=total, seed=seed)
            by = {r.source: r for r in report.collect()}
            copies = {r.doc_id: r.n_copies for r in chosen.collect()}
            for r in by.values():
                own = [(copies.get(k, 0), t) for k, s, t in rows if s == r.source]
                least = min(own)[0]  # copies of the records the fractional repetition leaves out
                assert 0 <= r.wanted_tokens - r.actual_tokens < min(t for n, t in own if n == least), r
            assert by["c"].clamped and by["c"].most_copies == 4
            if total is None:
                assert all(abs(r.actual_share - r.target_share) < 0.015 for r in by.values())
            else:
                assert by["c"].actual_share < 0.1 and sum(r.wanted_tokens for r in by.values()) == pytest.approx(total if isinstance(total, float) else sum(t for _, _, t in rows))

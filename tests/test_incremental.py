"""Change capture: replay against brute force, and the job across failures."""

import random
from datetime import datetime, timedelta

import pytest

from sheafwork.operators.incremental import FILING_FIELDS, CommitLog, IncrementalJob, replay_runs

START = datetime(2024, 1, 1)
SCHEMA = ", ".join(f"{f} string" for f in FILING_FIELDS) + ", modified_at timestamp, received_at timestamp, run_id int, note string"
RUNS = "run_id int, started_at timestamp, finished_at timestamp, seen_until timestamp, run_status string"


def row(key, value, modified, received):
    fields = {f: "x" for f in FILING_FIELDS} | {"html_index": key, "sic": value}
    at = lambda h: None if h is None else START + timedelta(hours=h)
    return (*[fields[f] for f in FILING_FIELDS], at(modified), at(received), 7, "clashing run_id column")


def runs(*bounds, status=None):
    return [(i, START + timedelta(days=i), None, START + timedelta(hours=h), (status or {}).get(i, "succeeded")) for i, h in enumerate(bounds, 1)]


def brute(rows, ledger):
    out, before = set(), {}
    high = None
    for run_id, _, _, bound, state in sorted(ledger, key=lambda r: r[1]):
        if state != "succeeded":
            continue
        high = bound if high is None else max(high, bound)
        now = {}
        for r in rows:
            if r[15] is not None and r[15] <= high:
                key = r[5]
                rank = (r[14] or datetime.min, r[15], tuple(r[:14]))
                if key not in now or rank > now[key][0]:
                    now[key] = (rank, r[:14])
        out |= {(run_id, k) for k, (_, fields) in now.items() if k not in before or before[k][1] != fields}
        before = now
    return out


def found(spark, rows, ledger):
    result = replay_runs(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(ledger, RUNS))
    listed = [(r.run_id, r.html_index) for r in result.collect()]
    assert len(listed) == len(set(listed))
    return set(listed)


def test_replay_equals_brute_force(spark):
    rng = random.Random(1)
    for _ in range(3):
        rows = [row(rng.choice("abcde"), rng.choice([None, "1", "2"]), rng.randint(0, 90), rng.randint(0, 100)) for _ in range(60)]
        rows += rng.sample(rows, 10)
        ledger = runs(10, 20, 20, 35, 30, 60, 80, status={4: "failed", 6: "killed"})
        assert found(spark, rows, ledger) == brute(rows, ledger)


def test_edges(spark):
    assert found(spark, [], runs(10)) == set()
    assert found(spark, [row("a", "1", 1, 1)], []) == set()
    rows = [row("a", "1", 1, None), row(None, "1", 1, 2), row("b", "1", None, 3), row("b", "2", 1, 3)]
    assert found(spark, rows, runs(10)) == {(1, None), (1, "b")}


def test_hot_key(spark):
    rows = [row("hot", str(i % 3), i, i) for i in range(3000)] + [row(f"k{i}", "1", 1, 1) for i in range(20)]
    ledger = runs(500, 1000, 3000)
    assert found(spark, rows, ledger) == brute(rows, ledger)


def test_job_survives_failures(spark, tmp_path):
    rows = [row("a", "1", 1, 1), row("b", "1", 1, 5)]
    job = IncrementalJob(spark, f"file://{tmp_path}/t")
    df = spark.createDataFrame(rows, SCHEMA)
    at = lambda h: START + timedelta(hours=h)
    assert job.run(df, at(2))["number"] == 1
    with pytest.raises(ZeroDivisionError):
        job.run(df, at(10), transform=lambda d: 1 / 0)
    assert [r.html_index for r in job.committed().collect()] == ["a"]
    more = spark.createDataFrame([*rows, row("a", "2", 2, 6), row("b", "1", 2, 7)], SCHEMA)
    job.run(more, at(10))
    assert sorted((r.html_index, r.sic, r.change) for r in job.committed().collect()) == [("a", "1", "added"), ("a", "2", "changed"), ("b", "1", "added")]
    assert job.run(more, at(10)) is None
    assert job.run(more, at(4)) is None


def test_output_without_commit_is_not_read(spark, tmp_path, monkeypatch):
    job = IncrementalJob(spark, f"file://{tmp_path}/t")
    df = spark.createDataFrame([row("a", "1", 1, 1)], SCHEMA)
    monkeypatch.setattr(CommitLog, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        job.run(df)
    assert job.committed() is None
    monkeypatch.undo()
    job.run(df)
    assert job.committed().count() == 1


def test_two_runs_cannot_commit_the_same_number(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/t")
    log.commit(1, {"number": 1, "watermark": START.isoformat(), "data": "x"})
    with pytest.raises(RuntimeError):
        log.commit(1, {"number": 1, "watermark": START.isoformat(), "data": "y"})
    assert log.last()["data"] == "x"


def test_equal_arrival_at_the_bound_is_neither_lost_nor_repeated(spark, tmp_path):
    job = IncrementalJob(spark, f"file://{tmp_path}/t")
    first = [row("a", "1", 1, 5)]
    assert job.run(spark.createDataFrame(first, SCHEMA))["number"] == 1
    late = [*first, row("b", "1", 1, 5), row("a", "2", 2, 5)]  # land after the run, at the watermark's own tick
    assert job.run(spark.createDataFrame(late, SCHEMA))["number"] == 2
    assert job.run(spark.createDataFrame(late, SCHEMA)) is None
    assert sorted((r.html_index, r.sic, r.run_id) for r in job.committed().collect()) == [("a", "1", 1), ("a", "2", 2), ("b", "1", 2)]


def test_a_run_reads_its_window_only(spark, tmp_path):
    path = f"file://{tmp_path}/source"
    spark.createDataFrame([row(f"k{i}", "1", i, i) for i in range(200)], SCHEMA).write.parquet(path)
    job = IncrementalJob(spark, f"file://{tmp_path}/t")
    assert job.run(spark.read.parquet(path))["n_read"] == 200
    spark.createDataFrame([row("k3", "2", 300, 300), row("new", "1", 301, 301)], SCHEMA).write.mode("append").parquet(path)
    second = job.run(spark.read.parquet(path))
    assert second["n_read"] == 3  # two new ones and the one at the watermark
    out = job.committed().filter("run_id = 2").collect()
    assert sorted((r.html_index, r.change) for r in out) == [("k3", "changed"), ("new", "added")]


def test_job_equals_replay(spark, tmp_path):
    rng = random.Random(3)
    rows = [row(rng.choice("abcde"), rng.choice([None, "1", "2"]), rng.choice([None, rng.randint(0, 9)]), rng.randint(0, 60)) for _ in range(80)]
    ledger = runs(10, 20, 35, 50, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    job = IncrementalJob(spark, f"file://{tmp_path}/t", compact_every=3)
    commits = [job.run(df, START + timedelta(hours=h)) for h in (10, 20, 35, 50, 60)]
    assert [len(c["state"]) for c in commits] == [1, 2, 1, 2, 1]
    expected = replay_runs(df, spark.createDataFrame(ledger, RUNS))
    assert sorted(map(tuple, job.committed().select(expected.columns).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)

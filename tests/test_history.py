"""Attribute history against a plain reading of the rules."""

import random
from datetime import datetime, timedelta

from sheafwork.operators.history import HistoryStore, build_log, entity_history, state_at

SCHEMA = "cik string, company string, sic string, state_location string, state_of_inc string, fiscal_year_end string, snapshot_date string, loaded_at timestamp, version_no int"
T0 = datetime(2024, 1, 1)


def snap(cik, date, company="Acme", sic="100", state="CA", loaded=0):
    return (cik, company, sic, state, None, None, date, T0 + timedelta(hours=loaded), 9)


def brute(rows):
    last = {}
    for r in rows:
        key = (r[0].strip().lstrip("0") or "0", r[6])
        if key not in last or r[7] > last[key][7]:
            last[key] = r
    out, known = [], {}
    for (cik, date), r in sorted(last.items()):
        opens = cik not in known
        state = known.setdefault(cik, [None] * 3)
        for i, v in enumerate(r[1:4]):
            v = " ".join(v.split()).lower() if v else ""
            v = (v.lstrip("0") or "0") if i == 1 and v else v
            if v:
                opens |= state[i] is not None and state[i] != v
                state[i] = v
        if opens:
            out.append((cik, date))
    return out


def test_versions_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [
        snap(rng.choice(["1", "01", "2", "0003"]), f"2020-{rng.randint(1, 12):02d}-01", rng.choice(["Acme", " acme ", "ACME  ", "Beta", None, " "]), rng.choice(["100", "0100", None, "", "200"]), rng.choice(["CA", "ca", "NY", None]), i)
        for i in range(120)
    ]
    rows += rows[:10]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = sorted(brute(rows))
    for every in (1, 2, 8):
        found = entity_history(df, every=every)
        assert sorted((r.cik, r.valid_from) for r in found.collect()) == expected
    first = sorted(map(tuple, entity_history(df, every=1).collect()), key=str)
    assert first == sorted(map(tuple, entity_history(df, every=8).collect()), key=str)


def test_periods_and_values(spark):
    rows = [snap("7", "2020-01-01", "Acme", None, None), snap("7", "2020-02-01", "Acme", "10", None), snap("7", "2020-03-01", "ACME ", "10", "NY"), snap("7", "2020-04-01", "Beta", None, None)]
    versions = {r.valid_from: r for r in entity_history(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(versions) == {"2020-01-01", "2020-04-01"}
    assert versions["2020-01-01"].valid_to == "2020-04-01" and versions["2020-01-01"].sic == "10" and versions["2020-01-01"].state_location == "NY"
    assert versions["2020-04-01"].company == "Beta" and versions["2020-04-01"].sic == "10" and versions["2020-04-01"].valid_to is None


def test_log_holds_patches_and_checkpoints(spark):
    rows = [snap("7", f"2020-{m:02d}-01", f"Name {m}") for m in range(1, 10)]
    log = {r.seq: r for r in build_log(spark.createDataFrame(rows, SCHEMA), every=4).collect()}
    assert [s for s, r in sorted(log.items()) if r.is_checkpoint] == [1, 5, 9]
    assert log[2]["values"] == ["Name 2", None, None] and log[5]["values"] == ["Name 5", "100", "CA"]
    at = state_at(build_log(spark.createDataFrame(rows, SCHEMA), every=4), "2020-07-15", every=4).first()
    assert (at.company, at.sic, at.known_since) == ("Name 7", "100", "2020-07-01")


def test_empty_and_null_keys(spark):
    assert entity_history(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [snap(None, "2020-01-01"), snap("  ", "2020-01-01"), snap("1", None), snap("000", "2020-01-01", None, None, None)]
    assert [r.cik for r in entity_history(spark.createDataFrame(rows, SCHEMA)).collect()] == ["0"]


def test_fold_decides_the_versions(spark):
    """Versions come from folded states: entries cut off from their checkpoint would lose them."""
    rows = [snap("7", f"2020-{m:02d}-01", "Acme" if m < 4 else "Beta", str(100 + m // 2)) for m in range(1, 10)]
    log = build_log(spark.createDataFrame(rows, SCHEMA), every=4)
    assert "opens" not in " ".join(log.columns)
    plan = entity_history(spark.createDataFrame(rows, SCHEMA), every=4).select("cik", "valid_from")._jdf.queryExecution().optimizedPlan().toString()
    assert "block" in plan and "values" in plan


def test_store_appends_like_one_log(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        snap(rng.choice(["1", "01", "2", "3", "4"]), f"2020-{rng.randint(1, 12):02d}-{rng.randint(1, 3):02d}", rng.choice(["Acme", " acme ", "Beta", None]), rng.choice(["100", "0100", None, "200"]), rng.choice(["CA", "NY", None]), i)
        for i in range(90)
    ]
    in_order = sorted(rows, key=lambda r: r[6])
    for n, given in enumerate((rows, in_order)):  # late and corrected snapshots, and none but later ones
        store = HistoryStore(spark, f"file://{tmp_path}/h{n}", every=3, compact_every=4)
        assert store.versions() is None
        for i in range(0, 90, 15):
            commit = store.append(spark.createDataFrame(given[i : i + 15], SCHEMA))
        assert commit["number"] == 6 and len(commit["live"]) < 4
        whole = spark.createDataFrame(rows, SCHEMA)
        assert sorted(map(tuple, store.versions().collect()), key=str) == sorted(map(tuple, entity_history(whole, every=3).collect()), key=str)
        for when in ("2020-06-02", None):
            assert sorted(map(tuple, store.at(when).collect()), key=str) == sorted(map(tuple, state_at(build_log(whole, every=3), when, every=3).collect()), key=str)
    store.append(spark.createDataFrame(rows[:5], SCHEMA))  # held already
    assert store.versions().count() == entity_history(whole).count()


def test_store_goes_on_from_the_nearest_checkpoint(spark, tmp_path):
    store = HistoryStore(spark, f"file://{tmp_path}/h", every=4)
    for m in range(1, 8):
        store.append(spark.createDataFrame([snap("7", f"2020-{m:02d}-01", f"Name {m}")], SCHEMA))
    log = {r.seq: r for r in store.log().collect()}
    assert sorted(log) == list(range(1, 8)) and {r.written for r in log.values()} == {1}
    assert log[5].is_checkpoint and log[5]["values"] == ["Name 5", "100", "CA"] and log[6]["values"] == ["Name 6", None, None]


def test_append_that_dies_leaves_nothing(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, f"file://{tmp_path}/h")
    store.append(spark.createDataFrame([snap("7", "2020-01-01")], SCHEMA))
    monkeypatch.setattr(store.commits, "commit", lambda *a: 1 / 0)
    try:
        store.append(spark.createDataFrame([snap("7", "2020-02-01", "Other")], SCHEMA))
    except ZeroDivisionError:
        pass
    assert store.versions().count() == 1

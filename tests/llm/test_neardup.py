import itertools
import random

import numpy as np
import pyarrow as pa

from sheafwork import session
from sheafwork.llm import neardup as N
from sheafwork.llm.common import scan_arrow

SCHEMA = "key string, field string, text string"


def brute(rows, t, k=5, least=50):
    sets = {}
    for key, field, text in rows:
        words = N.words_of(text or "")
        if len(words) >= least:
            sets[key, field, text] = frozenset(zip(*(words[i:] for i in range(k))))
    out = set()
    for (a, f, u), (b, g, v) in itertools.combinations(sorted(sets), 2):
        if f == g and a != b:
            x, y = sets[a, f, u], sets[b, g, v]
            if len(x & y) >= t * len(x | y) - 1e-12:
                out.add((f, *sorted((a, b))))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = rng.choice(rows)[2].split()
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(base))
                base[at : at + rng.randint(0, 2)] = [rng.choice(words) for _ in range(rng.randint(0, 2))]
            text = " ".join(base)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(45, 160)))
        rows.append((f"k{i:03d}", rng.choice("AB"), text))
    return rows


def test_pairs_equal_brute_force(spark):
    for seed, t in ((1, 0.6), (2, 0.8), (3, 0.5)):
        rows = corpus(seed)
        rows += [("k000", rows[1][1], rows[1][2]), rows[2], ("nul", "A", None), ("emp", "A", ""), ("sho", "B", "too few words")]
        found = N.duplicate_pairs(spark.createDataFrame(rows, SCHEMA), t)
        assert {(r.field, r.key_a, r.key_b) for r in found.collect()} == brute(list(dict.fromkeys(rows)), t)


TINY = N.Limits(batch_texts=9, bucket_runs=500, heavy=2, list_block=7, partners=3, broadcast_rows=0, bitmap_bits=1 << 10)


def test_small_pieces_change_nothing(spark):
    rng = random.Random(7)
    shared = " ".join(f"s{i}" for i in range(60))
    # one run list shared by many different texts, so that lists are cut into blocks
    rows = [(f"k{i:03d}", "A", shared + " " + " ".join(f"u{i}x{j}" for j in range(rng.randint(5, 40)))) for i in range(60)]
    rows += [(f"c{i}", "A", rows[0][2]) for i in range(5)] + corpus(4, 40)
    expected = brute(rows, 0.6)
    found = N.duplicate_pairs(spark.createDataFrame(rows, SCHEMA).repartition(3), 0.6, limits=TINY)
    assert {(r.field, r.key_a, r.key_b) for r in found.collect()} == expected and expected


def test_a_run_in_every_text_brings_its_bucket_few_entries(spark):
    """One task counts a run in all texts: it gets an entry per batch, not one per text."""
    rng = random.Random(2)
    hot = "notice to all holders of the securities named in this report"
    rows = [(f"k{i}", "A", hot + " " + " ".join(f"u{rng.getrandbits(40)}" for _ in range(45))) for i in range(6000)]
    texts = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    packed = [pa.RecordBatch.from_pylist(x) for x in packed_rows(texts, N.Limits(batch_texts=1000))]
    entries = {}
    for row in (r for batch in packed for r in batch.to_pylist()):
        if row["bucket"] >= 0:
            for run in np.frombuffer(row["a"], np.uint32).tolist():
                entries[row["bucket"], run] = entries.get((row["bucket"], run), 0) + 1
    assert max(entries.values()) <= 7  # batches, of 6,000 texts
    assert N.duplicate_pairs(texts, 0.6).count() == 0


def packed_rows(texts, limits):
    yield scan_arrow(texts, lambda b: N._pack(b, 5, 50, 4, limits), N._PACKED).toArrow().to_pylist()


def test_blocks_of_a_list_pair_like_the_list():
    rng = np.random.default_rng(1)
    m = 50
    n = np.sort(rng.integers(10, 30, m))
    facts = (np.arange(m) * 3, n, n.copy(), np.minimum(rng.integers(1, 4, m), n))
    lo, hi = np.arange(m) + 1, np.full(m, m)
    whole = {tuple(p) for p in N._list_pairs(lo, hi, facts, 0.6)}
    blocks = [np.stack([f[i : i + 8] for f in facts]) for i in range(0, m, 8)]
    reach = np.array([(x[1, 0], x[1, -1]) for x in blocks], np.int64).tobytes()
    sent = pa.RecordBatch.from_pylist([{"batch": "x", "bucket": i, "a": x.tobytes(), "b": reach} for i, x in enumerate(blocks)])
    cells = {}
    for out in N._cells(iter([sent]), 0.6):
        r = out.to_pylist()[0]
        cells.setdefault((r["low"], r["high"]), []).append(r)
    parts = set()
    for rows in cells.values():
        out = N._pair_cell(pa.Table.from_pylist(rows), 0.6)
        parts |= set(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    assert parts == whole and whole and len(cells) <= 28


def test_groups(spark):
    base = " ".join(f"a{i}" for i in range(100))
    rows = [("1", "A", base), ("2", "A", base + " tail"), ("3", "A", base), ("4", "B", base), ("3", "B", " ".join(f"b{i}" for i in range(80))), ("5", "B", " ".join(f"b{i}" for i in range(79))), ("6", "A", None)]
    got = {r.key: r for r in N.duplicate_groups(spark.createDataFrame(rows, SCHEMA), 0.8).collect()}
    assert {k: r.group_id for k, r in got.items()} == {"1": "1", "2": "1", "3": "1", "5": "1", "4": "4", "6": "6"}
    assert got["6"].n_links == 0 and got["2"].n_links == 1 and len(got) == 6


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.duplicate_pairs(empty).count() == 0 and N.duplicate_groups(empty).count() == 0


def crowded(seed, n=200):
    """Texts of few words, in which most runs are rare but in some other text, so nearly all pairs share one and few are similar."""
    rng = random.Random(seed)
    rows = [(f"k{i:03d}", "A", " ".join(rng.choice("abcdef") for _ in range(100))) for i in range(n)]
    for i in range(0, 40, 2):  # copies with a few words changed
        words = rows[i][2].split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = rng.choice("abcdef")
        rows.append((f"n{i:03d}", "A", " ".join(words)))
    return rows


def test_pairs_with_a_rare_run_in_common_are_no_candidates(spark, monkeypatch):
    rows, counts, write = crowded(5), {}, N.materialise

    def counted(df, label):
        out = write(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(N, "materialise", counted)
    found = N.duplicate_pairs(spark.createDataFrame(rows, SCHEMA), 0.6)
    expected = brute(rows, 0.6)
    assert {(r.field, r.key_a, r.key_b) for r in found.collect()} == expected and expected
    assert counts["candidates"] <= 2 * len(expected)


def test_steps_leave_no_tables_or_shuffles(spark):
    before = {path for _, path in session._SCRATCH}
    N.similar_sets(spark.createDataFrame(crowded(6, 60), SCHEMA), 0.6)
    left = [path for _, path in session._SCRATCH if path not in before]
    assert {path.rpartition("/")[2].partition("-")[0] for path in left} == {"members", "links"}
    assert spark.conf.get(session._CLEANUP) == "false"


def test_owners_take_a_byte_a_run_however_few_have_one():
    rng = np.random.default_rng(3)
    for runs, owners in ((5000, 300), (200, 4000), (3, 60_000), (1, 1)):
        owner = np.sort(rng.integers(0, owners, runs))
        blob = N._owners(owner)
        assert (N._unowners(blob) == owner).all() and len(blob) <= 2 + runs * (1 if runs > 100 else 2)

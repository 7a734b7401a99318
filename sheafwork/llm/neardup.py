"""Near-duplicate texts by a grouped prefix join.

A text's set is its distinct runs of consecutive words, as 64-bit hashes.  With
the runs in one global order, two sets of Jaccard similarity ``t`` or more share
a member of their prefixes: the first ``n - ceil(t * n) + 1`` runs of the larger
and the first ``n - ceil(2 * t / (1 + t) * n) + 1`` of the smaller.  The order is
by the number of texts a run occurs in, so prefixes are rare runs; runs of a
single text come first and can match nothing, so they need no posting.

1.  Texts are cut into runs once.  Runs travel as packed arrays to the bucket of
    their hash, where occurrences are counted, and the counts of the shared ones
    travel back to the batch of texts they came from.  A run that many texts of a
    batch share is counted there and travels once, so even a run in every text
    brings its bucket a few entries per batch of texts.
2.  Texts with equal size and equal posted prefix, all exact copies among them,
    collapse into one group.  Groups, not texts, are posted, again as packed
    arrays, and joined on the posted runs, filtered by size and position.  Two
    sets must share not one but up to ``SHARED`` runs of prefixes longer by as
    many, so that pairs with one rare run in common, whose number grows as the
    square of the texts, go no further than a line of two numbers.
3.  Members of the groups are expanded to their different sets, and each pair of
    sets is verified exactly: a set meets up to ``partners`` of its partners at a
    time, so it travels once per so many pairs.

Nothing is sampled or capped and no list of a run's texts is dropped.  A list
longer than ``list_block`` is cut into blocks, each sent once, whose pairs are
made and compared by separate tasks.  Shuffle files and tables are dropped as
soon as the step that reads them is done.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import scan_arrow
from sheafwork.session import broadcast_if_small, drop_table, materialise, shuffles_dropped

_WORDS = re.compile(r"[^\W_]+")
#: cells in which a batch's runs are counted to find those that may be frequent
LOW_BITS = 1 << 20
#: the most runs asked of a pair's prefixes; VOTES can be divided by one less and all below
SHARED = 8
VOTES = 420
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


@dataclass(frozen=True)
class Limits:
    """Sizes of the pieces in which the work is done; none changes the result."""

    #: texts whose runs are packed together, by number (at most 65,536) and by characters
    batch_texts: int = 4096
    batch_chars: int = 8_000_000
    #: runs counted together in one bucket, about
    bucket_runs: int = 1_500_000
    #: a run in at least so many texts of a batch is counted within the batch
    heavy: int = 8
    #: entries of one run's list that are paired at a time
    list_block: int = 16_384
    #: partners a set is compared with in one task row
    partners: int = 32
    #: up to so many rows (24 bytes each) the list of texts to verify is broadcast; beyond it a bitmap of their hashes is
    broadcast_rows: int = 500_000
    #: bits of that bitmap (16 MB), a power of two; texts it lets pass by chance find no partner in the join
    bitmap_bits: int = 1 << 27


def words_of(text: str) -> list[str]:
    """Lower-case stretches of letters and digits."""
    return _WORDS.findall(text.lower())


class RunHasher:
    """Distinct hashes of the runs of ``k`` words of a text; remembers the hashes of words."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            hashed = [known[w] for w in words]
        except KeyError:
            if len(known) > 2_000_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            hashed = [known[w] for w in words]
        a = np.array(hashed, dtype=np.uint64)
        m = len(a) - self.k + 1
        h = a[:m].copy()
        for i in range(1, self.k):
            h = h * _MIX + a[i : m + i]
            h ^= h >> _SHIFT
        return np.unique(h)


def least_overlap(n: int, threshold: float) -> int:
    """The fewest shared runs a partner of a set of ``n`` must have: ceil(threshold * n)."""
    return math.ceil(threshold * n - 1e-9)


def _signature(runs: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(runs.tobytes())


def field_salt(field: str) -> np.uint64:
    """Runs of different fields never meet."""
    return np.uint64(xxhash.xxh64_intdigest(field))


_PACKED = "kind int, bucket bigint, batch string, a binary, b binary"
_KINDS = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
#: kinds of packed rows: the texts of a batch, runs of a bucket, blocks of a long list, runs counted within the batch
TEXTS, RUNS, BLOCKS, COUNTED = 0, 1, 2, 3


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=["kind", "bucket", "batch", "a", "b"])


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _by_bucket(values: np.ndarray, owner: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, positions of its values, their owners in order); ``owner`` must ascend."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        at = order[ends[b] : ends[b + 1]]
        if len(at):
            yield b, at, owner[at]


def _short(runs: np.ndarray, buckets: int) -> np.ndarray:
    """Runs as they come back from their buckets: 32 bits and the bucket tell them apart."""
    n = np.uint64(buckets)
    return (runs // n).astype(np.uint32).astype(np.uint64) * n + runs % n


def _small(counts: np.ndarray) -> bytes:
    """Counts in the least number of bytes, which the first byte tells."""
    width = 1 if counts.max(initial=0) < 256 else 2 if counts.max() < 65536 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unsmall(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def _owners(owner: np.ndarray) -> bytes:
    """Ascending owners as counts per owner or, where most owners have none, as steps from one to the next (first byte 0)."""
    steps, counts = _small(np.diff(owner, prepend=0)), _small(np.bincount(owner))
    return counts if len(counts) <= len(steps) else b"\0" + steps


def _unowners(blob: bytes) -> np.ndarray:
    if blob[0] == 0:
        return np.cumsum(_unsmall(blob[1:]))
    counts = _unsmall(blob)
    return np.repeat(np.arange(len(counts)), counts)


def _joined(*blobs: bytes) -> bytes:
    return np.array([len(x) for x in blobs], np.uint32).tobytes() + b"".join(blobs)


def _parted(blob: bytes, n: int) -> list[bytes]:
    ends = np.cumsum(np.r_[4 * n, np.frombuffer(blob, np.uint32, n)])
    return [blob[x:y] for x, y in zip(ends, ends[1:])]


def _pack(batches: Iterator[pa.RecordBatch], k: int, min_words: int, buckets: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Texts to rows of packed runs per bucket, and one row with the batch's texts."""
    hasher = RunHasher(k)
    task = TaskContext.get().partitionId()
    number = 0

    def flush(docs: list[tuple], sets: list[np.ndarray]) -> pa.RecordBatch:
        nonlocal number
        name = f"{task}-{number}"
        number += 1
        runs = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        table = pa.table({"key": [d[0] for d in docs], "field": [d[1] for d in docs], "n": pa.array([len(s) for s in sets], pa.int32()), "sig": [_signature(s) for s in sets]})
        # only runs whose low bits are frequent can be, so few are compared
        low = (runs & np.uint64(LOW_BITS - 1)).astype(np.int64)
        maybe = np.flatnonzero(np.bincount(low, minlength=LOW_BITS)[low] >= limits.heavy)
        found, at, times = np.unique(runs[maybe], return_inverse=True, return_counts=True)
        many = np.flatnonzero(times[at] >= limits.heavy)
        many = many[np.argsort(at[many], kind="stable")]
        shared, times = found[times >= limits.heavy], times[times >= limits.heavy].astype(np.uint32)
        # a run's owners stay with the texts; bucket -1 - x keeps this row apart from runs
        held = np.uint32(len(shared)).tobytes() + _short(shared, buckets).tobytes() + times.tobytes() + owner[maybe[many]].astype(np.uint16).tobytes()
        rows = [(TEXTS, -1 - xxhash.xxh32_intdigest(name) % buckets, name, _ipc(table), held)]
        light = np.ones(len(runs), bool)
        light[maybe[many]] = False
        runs, owner = runs[light], owner[light]
        rest = (runs // np.uint64(buckets)).astype(np.uint32)
        rows += [(RUNS, b, name, rest[at].tobytes(), _owners(own)) for b, at, own in _by_bucket(runs, owner, buckets)]
        rest = (shared // np.uint64(buckets)).astype(np.uint32)
        rows += [(COUNTED, b, name, rest[at].tobytes(), times[at].tobytes()) for b, at, _ in _by_bucket(shared, np.zeros(len(shared), np.int64), buckets)]
        return _packed(rows)

    docs, sets, chars = [], [], 0
    for batch in batches:
        for key, field, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = words_of(text)
            if len(words) < max(min_words, k):
                continue
            docs.append((key, field))
            sets.append(hasher(words) ^ field_salt(field))
            chars += len(text)
            if len(docs) == limits.batch_texts or chars > limits.batch_chars:
                yield flush(docs, sets)
                docs, sets, chars = [], [], 0
    if docs:
        yield flush(docs, sets)


def _count(table: pa.Table) -> pa.Table:
    """One bucket: how often each run occurs; the runs of more than one text go back to their batches.

    ``a`` then holds the runs' remainders (4 bytes each) followed by a byte each
    that grades the count, a function of the run alone.
    """
    bucket = table.column("bucket")[0].as_py()
    if bucket < 0:
        return table
    kinds, names, blobs = (table.column(c).to_pylist() for c in ("kind", "batch", "b"))
    runs = [np.frombuffer(x, np.uint32) for x in table.column("a").to_pylist()]
    every = np.concatenate(runs)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[starts, len(ordered)])
    grown, kept = counts.copy(), ordered[starts]
    for kind, r, blob in zip(kinds, runs, blobs):
        if kind == COUNTED:  # counts as often as it occurs in its batch
            np.add.at(grown, np.searchsorted(kept, r), np.frombuffer(blob, np.uint32).astype(np.int64) - 1)
    # small counts stay exact, large ones are told apart by eighths of a power of two
    level = np.where(grown < 32, grown, np.minimum(255, 32 + np.floor(8 * np.log2(np.maximum(grown, 32) / 32)))).astype(np.uint8)
    grade = np.empty(len(every), dtype=np.uint8)
    grade[order] = np.repeat(level, counts)
    out, at = [], 0
    for kind, name, r, blob in zip(kinds, names, runs, blobs):
        g = grade[at : at + len(r)]
        at += len(r)
        if kind == COUNTED:
            out.append((COUNTED, bucket, name, r.tobytes() + g.tobytes(), None))
            continue
        keep = g > 1
        if keep.any():
            out.append((RUNS, bucket, name, r[keep].tobytes() + g[keep].tobytes(), _owners(_unowners(blob)[keep])))
    return pa.Table.from_batches([_packed(out)])


def _choose(table: pa.Table, threshold: float, buckets: int, posting_buckets: int) -> pa.Table:
    """One batch: each text's group and posted prefix, from the counts that came back; texts that can have no partner drop out."""
    docs, held, parts, counted, name = None, b"", [], [], table.column("batch")[0].as_py()
    for kind, bucket, a, b in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "a", "b"))):
        if kind == TEXTS:
            docs, held = pa.ipc.open_stream(a).read_all(), b
            continue
        n = len(a) // 5
        r = np.frombuffer(a, np.uint32, n).astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
        g = np.frombuffer(a, np.uint8, n, 4 * n)
        if kind == COUNTED:
            counted.append((r, g))
        else:
            parts.append((r, _unowners(b), g))
    if counted:
        m = int(np.frombuffer(held, np.uint32, 1)[0])
        shared, times = np.frombuffer(held, np.uint64, m, 4), np.frombuffer(held, np.uint32, m, 4 + 8 * m)
        r, g = (np.concatenate(x) for x in zip(*counted))
        order = np.argsort(r)
        g = g[order[np.searchsorted(r[order], shared)]]
        parts.append((np.repeat(shared, times), np.frombuffer(held, np.uint16, offset=4 + 12 * m).astype(np.int64), np.repeat(g, times)))
    if not parts:
        return pa.Table.from_batches([_packed([])])
    runs, owner, grade = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((runs, grade, owner))
    runs = runs[order]
    ends = np.searchsorted(owner[order], np.arange(docs.num_rows + 1))
    sizes = docs.column("n").to_pylist()
    groups: dict[int, tuple] = {}
    placed = []
    for d, n in enumerate(sizes):
        shared = int(ends[d + 1] - ends[d])
        free, need = n - shared, least_overlap(n, threshold)
        posted = n - need + 1 - free
        if posted > 0 and shared >= need:
            prefix = runs[ends[d] : ends[d] + posted]
            gid = xxhash.xxh64_intdigest(prefix.tobytes(), seed=n) - 2**63
            placed.append((d, gid))
            groups.setdefault(gid, (gid, n, shared, free, prefix))
    if not placed:
        return pa.Table.from_batches([_packed([])])
    members = docs.select(["key", "field", "sig"]).take(pa.array([d for d, _ in placed], pa.int64())).append_column("gid", pa.array([g for _, g in placed], pa.int64()))
    rows = [(TEXTS, 0, name, _ipc(members), None)]
    facts = np.array([g[:4] for g in groups.values()], dtype=np.int64)
    prefixes = [g[4] for g in groups.values()]
    runs = np.concatenate(prefixes)
    owner = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    position = np.concatenate([np.arange(f + 1, f + 1 + len(p)) for f, p in zip(facts[:, 3], prefixes)])
    rest = (runs // np.uint64(posting_buckets)).astype(np.uint32)
    for b, at, own in _by_bucket(runs, owner, posting_buckets):
        held, counts = np.unique(own, return_counts=True)
        gid, n, shared, _ = facts[held].T
        rows.append((RUNS, b, name, _joined(rest[at].tobytes(), _small(position[at])), _joined(gid.tobytes(), _small(n), _small(shared), _small(counts))))
    return pa.Table.from_batches([_packed(rows)])


def _post_entries(table: pa.Table) -> tuple[np.ndarray, ...]:
    """run, gid, n, shared, position of all postings of a bucket, each group once per run."""
    out = []
    for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist()):
        runs, position = _parted(a, 2)
        gid, *facts = _parted(b, 4)
        n, shared, counts = map(_unsmall, facts)
        at = np.repeat(np.arange(len(n)), counts)
        out.append((np.frombuffer(runs, np.uint32), np.frombuffer(gid, np.int64)[at], n[at], shared[at], _unsmall(position)))
    run, gid, n, shared, pos = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((gid, n, run))
    run, gid, n, shared, pos = (x[order] for x in (run, gid, n, shared, pos))
    first = np.r_[True, (run[1:] != run[:-1]) | (gid[1:] != gid[:-1])]  # batches may post the same group
    return tuple(x[first] for x in (run, gid, n, shared, pos))


def _asked(na: np.ndarray, nb: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sizes na <= nb: the least overlap, and how many runs their prefixes must share.

    The first x common runs stand among the first ``n - need + x`` runs of both
    sets, which are posted while they are no more than ``n - ceil(t * n) + 1``.
    """
    need = np.ceil(t / (1 + t) * (na + nb) - 1e-9)
    return need, np.clip(need - np.ceil(t * nb - 1e-9) + 1, 1, SHARED)


def _passes(a: np.ndarray, b: np.ndarray, gid, n, shared, pos, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (a is the smaller) may reach the threshold by this run, and the run's share of the VOTES they need."""
    na, nb = n[a], n[b]
    need, asked = _asked(na, nb, t)
    reach = asked + np.minimum(na - pos[a], nb - pos[b])
    ok = (na >= t * nb - 1e-9) & (reach >= need) & (np.minimum(shared[a], shared[b]) >= need) & (gid[a] != gid[b])
    # runs of a set are told apart by 32 bits in a bucket: two of them may be one here, so one less is asked
    return ok, (VOTES // np.maximum(asked - 1, 1)).astype(np.int64)


def _added(pairs: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, with the sum of its votes, no more than it needs."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs, votes = pairs[order], votes[order]
    first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)][: len(pairs)])
    return pairs[first], np.minimum(np.add.reduceat(votes, first), VOTES) if len(first) else votes


def _list_votes(lo: np.ndarray, hi: np.ndarray, facts: tuple, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with i in 0..len(lo), lo[i] <= j < hi[i], that pass, and their votes; made in bounded steps."""
    out = [(np.empty((0, 2), np.int64), np.empty(0, np.int64))]
    width = np.maximum(hi - lo, 0)
    steps = np.searchsorted(np.cumsum(width), np.arange(0, width.sum() + 1, 2_000_000)[1:]) if width.sum() > 2_000_000 else []
    marks = [0, *[int(s) + 1 for s in steps], len(lo)]
    for x, y in zip(marks, marks[1:]):
        if y <= x:
            continue
        w = width[x:y]
        a = np.repeat(np.arange(x, y), w)
        b = np.arange(len(a)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(lo[x:y], w)
        ok, votes = _passes(a, b, *facts, t)
        g = facts[0]
        out.append(_added(np.stack([np.minimum(g[a[ok]], g[b[ok]]), np.maximum(g[a[ok]], g[b[ok]])], axis=1), votes[ok]))
    return _added(*(np.concatenate(x) for x in zip(*out)))


def _list_pairs(lo: np.ndarray, hi: np.ndarray, facts: tuple, t: float) -> np.ndarray:
    return _list_votes(lo, hi, facts, t)[0]


def _pair_up(table: pa.Table, t: float, block: int) -> pa.Table:
    """One bucket: pairs of groups sharing a posted run.  Lists over ``list_block`` leave as blocks, each once."""
    bucket = table.column("bucket")[0].as_py()
    run, *facts = _post_entries(table)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(run)])
    ends = np.repeat(starts + sizes, sizes)
    lo, hi = np.arange(len(run)) + 1, ends.copy()
    long = np.repeat(sizes > block, sizes)
    hi[long] = 0
    pairs, votes = _list_votes(lo, hi, tuple(facts), t)
    rows = [(RUNS, 0, "", pairs.tobytes(), _small(votes))]
    for s, size in zip(starts[sizes > block], sizes[sizes > block]):
        blocks = [np.stack([f[i : min(i + block, s + size)] for f in facts]) for i in range(s, s + size, block)]
        reach = np.array([(x[1, 0], x[1, -1]) for x in blocks], np.int64).tobytes()  # least and greatest size of each block
        rows += [(BLOCKS, i, f"{bucket} {run[s]}", x.tobytes(), reach) for i, x in enumerate(blocks)]
    return pa.Table.from_batches([_packed(rows)])


_PAIRS = "gid_a bigint, gid_b bigint, votes int"


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, votes in zip(*(c.to_pylist() for c in batch.columns)):
            yield _as_pairs(np.frombuffer(pairs, np.int64).reshape(-1, 2), _unsmall(votes))


def _as_pairs(pairs: np.ndarray, votes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(votes.astype(np.int32))], names=["gid_a", "gid_b", "votes"])


_CELLS = "list string, low bigint, high bigint, at bigint, block binary"


def _cells(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[pa.RecordBatch]:
    """A block of a list goes to the cells it shares with every block not too far from it in size, one at a time."""
    for batch in batches:
        for name, i, block, reach in zip(*(batch.column(c).to_pylist() for c in ("batch", "bucket", "a", "b"))):
            sizes = np.frombuffer(reach, np.int64).reshape(-1, 2)
            for j in range(len(sizes)):
                low, high = min(i, j), max(i, j)
                if sizes[low, 1] >= t * sizes[high, 0] - 1e-9:  # sizes ascend
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, low, high, i, block)], names=["list", "low", "high", "at", "block"])


def _pair_cell(table: pa.Table, t: float) -> pa.Table:
    """Two blocks of a list, or one with itself: their pairs that pass."""
    blocks = [np.frombuffer(b, np.int64).reshape(4, -1) for _, b in sorted(zip(table.column("at").to_pylist(), table.column("block").to_pylist()), key=lambda x: x[0])]
    m = blocks[0].shape[1]
    if len(blocks) == 1:
        facts, lo, hi = blocks[0], np.arange(m) + 1, np.full(m, m)
    else:
        facts = np.concatenate(blocks, axis=1)
        lo, hi = np.full(m, m), np.full(m, facts.shape[1])
    return pa.Table.from_batches([_as_pairs(*_list_votes(lo, hi, tuple(facts), t))])


_SETS = "sig binary, runs array<bigint>"


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            yield from pa.ipc.open_stream(blob).read_all().to_batches()


def _fetch_sets(batches: Iterator[pa.RecordBatch], k: int, bitmap: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """(sig, runs) of the texts whose hash is in the bitmap, if there is one; a set once per task, however many copies it has."""
    hasher = RunHasher(k)
    sent: set[bytes] = set()
    for batch in batches:
        if bitmap is not None:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) & (64 * len(bitmap) - 1)
            batch = batch.filter(pa.array((bitmap[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1))
        sets = [hasher(w) ^ field_salt(f) for f, w in zip(batch.column(1).to_pylist(), map(words_of, batch.column(2).to_pylist())) if len(w) >= k]
        # a key may have several texts in a field, so sets are told apart by their signature
        fresh = {sig: runs for sig, runs in ((_signature(x), x) for x in sets) if sig not in sent}
        sent.update(fresh)
        yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.binary()), pa.array([x.view(np.int64) for x in fresh.values()], pa.list_(pa.int64()))], names=["sig", "runs"])


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits of the column h; at most one row per 64 bits is collected."""
    low = hashes.select(F.col("h").bitwiseAND(bits - 1).alias("b"))
    words = low.groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63L AS int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return out


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    """One set and some of its partners: the partners at or above the threshold."""
    hub = table.column("hub")[0].as_py()
    sets = dict(zip(table.column("sig").to_pylist(), zip(table.column("left").to_pylist(), (np.asarray(x) for x in table.column("runs").to_numpy()))))
    own = sets[hub][1]
    found = []
    for sig, (left, runs) in sets.items():
        if not left:
            common = len(np.intersect1d(own, runs, assume_unique=True))
            similarity = common / (len(own) + len(runs) - common)
            if similarity >= threshold - 1e-12:
                found.append((min(hub, sig), max(hub, sig), similarity))
    a, b, x = zip(*found) if found else ([], [], [])
    return pa.table({"sig_a": pa.array(a, pa.binary()), "sig_b": pa.array(b, pa.binary()), "similarity": pa.array(x, pa.float64())})


#: the most partitions a grouping is spread over
MOST_PARTITIONS = 50_000


def _sized(df: DataFrame, groups: int, key: str) -> DataFrame:
    """``df`` in a partition per group where the session's number of partitions is lower, so tasks keep their size as the data grows."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(groups, MOST_PARTITIONS), key) if groups > usual else df


def _settle(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read back; the shuffle files behind it go at once, not when the driver collects its garbage."""
    with shuffles_dropped(df.sparkSession):
        return materialise(df, label)


def similar_sets(texts: DataFrame, threshold: float = 0.8, k: int = 5, min_words: int = 50, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` of texts(key, field, text); similarity only within a field.

    ``members``: key, field, sig for every text that may have a partner; texts
    with the same ``sig`` have the same set.  ``links``: sig_a, sig_b (different
    sets, smaller first), similarity, for every pair of sets at or above
    ``threshold``.  Null texts and those under ``min_words`` words have no set.
    Repeated rows count once.
    """
    plain = texts.select(F.col("key").cast("string"), F.col("field").cast("string"), "text").filter(F.col("text").isNotNull())
    # about one run per six characters
    chars = plain.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    buckets = max(4, int(chars / 6 / limits.bucket_runs) + 1)
    posting_buckets = max(4, buckets // 4)
    packed = scan_arrow(plain, lambda b: _pack(b, k, min_words, buckets, limits), _PACKED)
    counted = _sized(packed, buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _count(t), _PACKED)
    batches = int(chars / limits.batch_chars) + 1
    chosen = _settle(_sized(counted, batches, "batch").groupBy("batch").applyInArrow(lambda t: _choose(t, threshold, buckets, posting_buckets), _PACKED), "posted")

    member_schema = "key string, field string, sig binary, gid bigint"
    members = _settle(chosen.filter(F.col("kind") == TEXTS).select("a").mapInArrow(_open_members, member_schema), "members")
    sets = members.groupBy("sig").agg(F.min("gid").alias("gid"), F.min(F.struct("key", "field")).alias("first"))
    sets = _settle(sets.select("sig", "gid", F.xxhash64("first.key", "first.field").alias("h")), "sets")

    paired = _settle(_sized(chosen.filter(F.col("kind") == RUNS), posting_buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _pair_up(t, threshold, limits.list_block), _PACKED), "paired")
    drop_table(chosen)
    short = paired.filter(F.col("kind") == RUNS).select("a", "b").mapInArrow(_open_pairs, _PAIRS)
    cells = paired.filter(F.col("kind") == BLOCKS).repartition("batch", "bucket").mapInArrow(lambda b: _cells(b, threshold), _CELLS)
    long = cells.groupBy("list", "low", "high").applyInArrow(lambda t: _pair_cell(t, threshold), _PAIRS)
    # the runs that a pair shares are in many buckets; most pairs share too few of them
    groups = _settle(short.unionByName(long).groupBy("gid_a", "gid_b").agg(F.sum("votes").alias("votes")).filter(F.col("votes") >= VOTES).select("gid_a", "gid_b"), "groups")
    drop_table(paired)
    left, right = (sets.select(F.col("gid").alias(f"gid_{s}"), F.col("sig").alias(f"sig_{s}"), F.col("h").alias(f"h_{s}")) for s in "ab")
    across = groups.join(left, "gid_a").join(right, "gid_b").select("sig_a", "h_a", "sig_b", "h_b")
    same = left.join(right, (F.col("gid_a") == F.col("gid_b")) & (F.col("sig_a") < F.col("sig_b"))).select("sig_a", "h_a", "sig_b", "h_b")
    candidates = _settle(across.unionByName(same), "candidates")
    drop_table(groups)
    drop_table(sets)

    wanted = _settle(candidates.select(F.explode(F.array("h_a", "h_b")).alias("h")).distinct(), "wanted")
    small, few = broadcast_if_small(wanted, limits.broadcast_rows)
    hashed = plain.select(F.xxhash64("key", "field").alias("h"), "field", "text")
    if few:
        fetched = scan_arrow(hashed.join(small, "h", "left_semi"), lambda b: _fetch_sets(b, k), _SETS)
    else:  # texts are not shuffled to find the wanted ones
        shared = plain.sparkSession.sparkContext.broadcast(_bitmap(wanted, limits.bitmap_bits))
        fetched = scan_arrow(hashed, lambda b: _fetch_sets(b, k, shared.value), _SETS)
    # a set meets its partners in rows of ``partners``, so it travels once for so many of its pairs
    hubs = candidates.select(F.col("sig_a").alias("hub"), "sig_b", F.expr(f"cast(floor((row_number() OVER (PARTITION BY sig_a ORDER BY sig_b) - 1) / {limits.partners}) AS int)").alias("chunk"))
    hubs = _settle(hubs, "hubs")
    drop_table(candidates)
    sides = hubs.select("hub", "chunk", F.col("sig_b").alias("sig"), F.lit(False).alias("left")).unionByName(hubs.select("hub", "chunk", F.col("hub").alias("sig"), F.lit(True).alias("left")).distinct())
    sides, _ = broadcast_if_small(sides, limits.broadcast_rows)
    links = fetched.join(sides, "sig").groupBy("hub", "chunk").applyInArrow(lambda t: _verify(t, threshold), "sig_a binary, sig_b binary, similarity double").distinct()
    links = _settle(links, "links")
    drop_table(wanted)
    drop_table(hubs)
    return members.select("key", "field", "sig").distinct(), links


def _every_pair(texts: DataFrame, threshold: float, k: int, min_words: int, limits: Limits) -> DataFrame:
    """The pairs of ``duplicate_pairs``; one of keys with several texts in a field may come more than once."""
    members, links = similar_sets(texts, threshold, k, min_words, limits)
    m = _settle(members, "members")
    a, b = (m.select("field", F.col("sig").alias(f"sig_{s}"), F.col("key").alias(f"k{s}")) for s in "ab")
    across = links.join(a, "sig_a").join(b.drop("field"), "sig_b").select("field", "ka", "kb", "similarity")
    copies = m.alias("x").join(m.alias("y"), F.expr("x.sig = y.sig AND x.key < y.key")).select("x.field", F.col("x.key").alias("ka"), F.col("y.key").alias("kb"), F.lit(1.0).alias("similarity"))
    every = across.unionByName(copies).filter(F.col("ka") != F.col("kb"))
    return every.select("field", F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"), "similarity")


def duplicate_pairs(texts: DataFrame, threshold: float = 0.8, k: int = 5, min_words: int = 50, limits: Limits = Limits()) -> DataFrame:
    """Every pair of different keys (key_a < key_b) similar in some field, copies included; one row per pair and field."""
    return _every_pair(texts, threshold, k, min_words, limits).distinct()


def duplicate_keys(texts: DataFrame, threshold: float = 0.8, k: int = 5, min_words: int = 50, limits: Limits = Limits()) -> DataFrame:
    """(key_a, key_b) of ``duplicate_pairs`` once, in however many fields they are similar; the pairs are shuffled once."""
    return _every_pair(texts, threshold, k, min_words, limits).select("key_a", "key_b").distinct()


def duplicate_groups(texts: DataFrame, threshold: float = 0.8, k: int = 5, min_words: int = 50, limits: Limits = Limits()) -> DataFrame:
    """One row per key: group_id (the smallest key of its connected group) and n_links (links to other sets).

    Keys that are similar to none form their own group with 0 links.  Groups are
    the connected components of the links over all fields, by repeated
    minimum propagation with pointer jumping; labels stay in tables.
    """
    members, links = similar_sets(texts, threshold, k, min_words, limits)
    m = _settle(members, "members")
    ends = links.select(F.hex("sig_a").alias("a"), F.hex("sig_b").alias("b"))
    ends = _settle(ends, "links")
    # only texts with a link or a copy can be in a group with others
    copied = m.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1").select(F.hex("sig").alias("set"))
    active = ends.select(F.col("a").alias("set")).union(ends.select("b")).union(copied).distinct()
    node = _settle(m.select("key", F.hex("sig").alias("set")).join(active, "set", "left_semi").select("key", "set"), "nodes")
    edges = _settle(ends.union(ends.select("b", "a")).union(node.select(F.col("key").alias("a"), F.col("set").alias("b"))).union(node.select("set", "key")).distinct(), "edges")
    label = _settle(edges.groupBy("a").agg(F.min(F.least("a", "b")).alias("label")), "label")
    while True:
        near = edges.join(label.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, "a").select("a", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        jump = label.select(F.col("a").alias("new"), F.col("label").alias("far"))
        step = _settle(step.join(jump, "new", "left").select("a", F.least("new", F.coalesce("far", "new")).alias("label"), "old"), "step")
        label = step.select("a", "label")
        if step.filter(F.col("label") != F.col("old")).limit(1).count() == 0:
            break
    first = node.join(label.withColumnRenamed("a", "key"), "key").groupBy("label").agg(F.min("key").alias("group_id"))
    degree = node.join(ends.union(ends.select("b", "a")).withColumnRenamed("a", "set"), "set").groupBy("key").agg(F.count("*").alias("n_links"))
    all_keys = texts.select(F.col("key").cast("string")).distinct()
    placed = all_keys.join(label.withColumnRenamed("a", "key"), "key", "left").join(first, "label", "left").join(degree, "key", "left")
    return placed.select("key", F.coalesce("group_id", "key").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))

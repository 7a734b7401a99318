import random

import pytest

from sheafwork.llm.packing import BestFit, pack, pack_lane, parts_of, utilisation
from sheafwork.llm.tokens import DEFAULT_RANKS, TokenCounter, encoding, read_ranks, token_sizes


def test_counter_equals_encoding():
    ranks, rng = read_ranks(DEFAULT_RANKS), random.Random(1)
    count = TokenCounter(ranks)
    tokens = ["word", "Word's", " ", "  ", "   ", "\n", "\n\n", "\t", "12,345.6", "é", "Ж", "—", "'s", "½", " don't", "  x", "\xa0", "\u200b", "!?", "_", "日本"]
    encode = encoding(ranks).encode_ordinary
    for _ in range(4000):
        text = "".join(rng.choice(tokens) for _ in range(rng.randint(0, 20)))
        assert count(text) == len(encode(text)), repr(text)


def test_sizes(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in token_sizes(df, ["doc_id"]).collect()) == [(1, 2), (1, 2), (2, 0), (3, 0)]
    assert token_sizes(spark.createDataFrame([], df.schema), ["doc_id"]).count() == 0
    with pytest.raises(OSError):
        token_sizes(df, ["doc_id"], ranks="/none.tiktoken")


def test_best_fit_picks_the_tightest_and_closes_the_fullest():
    lane = BestFit(10, 0, places=2)
    assert [lane.place(s)[0] for s in (6, 7, 3, 4)] == [0, 1, 1, 0]  # 3 fits box 1 exactly, then 4 box 0
    lane = BestFit(10, 0, places=2)
    lane.place(5), lane.place(8)
    assert lane.place(6)[0] == 2 and lane.place(5)[0] == 0  # box 1, the fullest, was closed
    assert list(parts_of(25, 10)) == [10, 10, 5] and list(parts_of(20, 10)) == [10, 10] and list(parts_of(0, 10)) == []
    with pytest.raises(ValueError):
        BestFit(0)


def check(rows, sizes, capacity, separator):
    boxes, total = {}, {}
    for key, no, n, tokens, box, at in rows:
        boxes.setdefault(box, []).append((at, tokens))
        total[key] = total.get(key, 0) + tokens
        assert tokens <= capacity and (n == 1) == (sizes[key] <= capacity)
    for items in boxes.values():
        assert sorted(a for a, _ in items) == list(range(len(items)))
        assert sum(t for _, t in items) + separator * (len(items) - 1) <= capacity
    assert total == {k: s for k, s in sizes.items() if s}
    return len(boxes)


def test_lane_is_valid_and_tight():
    rng = random.Random(3)
    sizes = {i: rng.choice([0, 1, 5, rng.randint(1, 300), rng.randint(1, 60)]) for i in range(3000)}
    n = check(pack_lane(sizes.items(), 100, 1, 64), sizes, 100, 1)
    assert n <= 1.05 * (sum(sizes.values()) / 100) + 64
    check(pack_lane(sizes.items(), 100, 0, 1), sizes, 100, 0)


def test_operator(spark):
    rng = random.Random(4)
    rows = [(f"d{i}", rng.choice([None, 0, rng.randint(1, 250)]), "clash") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id string, n_tokens int, lane string")
    out = pack(df, 100, 1, lane_items=100)
    found = out.collect()
    sizes = {k: s or 0 for k, s, _ in rows}
    check([(r.doc_id, r.part_no, r.n_parts, r.tokens, (r.lane, r.container), r.position) for r in found if r.container is not None], sizes, 100, 1)
    assert {r.doc_id for r in found if r.container is None} == {k for k, s in sizes.items() if not s}
    assert utilisation(out, 100, 1).first().used_share > 0.8
    assert pack(spark.createDataFrame([], df.schema), 100).count() == 0
    assert [r.n_parts for r in pack(spark.createDataFrame([("x", 250, "")] * 2, df.schema), 100).collect()] == [3] * 6

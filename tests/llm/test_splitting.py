import random
from functools import lru_cache

import pytest

from sheafwork.llm.splitting import plan_cuts, split_items

SCHEMA = "k int, text string, max_chars int, overlap_chars int, piece_no string"


def pieces_of(text, limit, overlap):
    cuts = plan_cuts(text, limit, overlap)
    ends = [*cuts, len(text)]
    return [text[(cuts[i - 1] - overlap if i else 0) : e] for i, e in enumerate(ends)]


def test_pieces_fit_overlap_and_rebuild():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice(["alpha", "b", "gamma-delta", "ε", "x" * rng.randint(1, 60)]) + rng.choice([" ", " ", ". ", "\n", "\n\n", ", ", ""]) for _ in range(rng.randint(0, 300))]
        text, limit = "".join(words), rng.randint(2, 200)
        overlap = rng.randint(0, limit - 1)
        found = pieces_of(text, limit, overlap)
        assert all(len(p) <= limit for p in found)
        rebuilt = found[0]
        for before, piece in zip(found, found[1:]):
            assert before.endswith(piece[:overlap]) and len(piece) > overlap
            rebuilt += piece[overlap:]
        assert rebuilt == text


def test_cuts_prefer_natural_boundaries():
    text = "\n\n".join("Sentence one here. Sentence two there, with a clause." for _ in range(40))
    for c in plan_cuts(text, 400, 0):
        assert text[:c].endswith("\n\n")
    prose = " ".join("This is sentence number %d of the text." % i for i in range(200))
    for c in plan_cuts(prose, 500, 50):
        assert prose[:c].rstrip().endswith(".")


def test_no_boundary_and_combining_marks():
    assert len(plan_cuts("x" * 1000, 100, 10)) == 10
    text = "e\u0301" * 300
    assert all(text[c] != "\u0301" for c in plan_cuts(text, 50, 0))
    with pytest.raises(ValueError):
        plan_cuts("abc", 5, 5)


def test_cost_is_minimal_on_small_texts():
    from sheafwork.llm import splitting as S

    rng = random.Random(9)
    for _ in range(40):
        text = "".join(rng.choice(["ab", "c", "d "]) + rng.choice(["", " ", ". ", "\n"]) for _ in range(8)) + "e"
        limit, overlap = rng.randint(8, 14), rng.randint(0, 3)
        if len(text) <= limit:
            continue
        gap = max(1, int((limit - overlap) * S.STRETCH))
        known = {c: p for c, p in S.boundaries(text, gap).items() if c > overlap}
        n = len(text)
        even = (n + (-(-(n - overlap) // (limit - overlap)) - 1) * overlap) / -(-(n - overlap) // (limit - overlap))

        def cost(cuts):
            total, last = 0.0, 0
            for i, c in enumerate([*cuts, n]):
                size = c - last + (overlap if i else 0)
                if size > limit:
                    return float("inf")
                total += S.IMBALANCE * (size / even - 1) ** 2 + (known.get(c, 0.0) if c < n else 0.0)
                last = c
            return total

        marks = sorted(known)

        @lru_cache(None)
        def rest(last):
            """The least cost of the text from the cut ``last`` on, trying every next cut."""
            out = []
            for c in [*[m for m in marks if m > last], n]:
                size = c - last + (overlap if last else 0)
                if size <= limit:
                    out.append(S.IMBALANCE * (size / even - 1) ** 2 + (known[c] + rest(c) if c < n else 0.0))
            return min(out, default=float("inf"))

        best = rest(0)
        assert cost(plan_cuts(text, limit, overlap)) == pytest.approx(best)


def test_operator(spark):
    long = "One two three. " * 40
    rows = [(1, long, 100, 10, "mine"), (1, long, 100, 10, "mine"), (2, "short", 100, 10, None), (3, None, 100, 10, None), (4, "", 100, None, None), (5, "x", None, 1, None)]
    found = split_items(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {}
    for r in found:
        by.setdefault(r.k, []).append(r)
    assert set(by) == {1, 2, 4} and by[2][0].piece == "short" and by[4][0].piece == "" and by[4][0].n_pieces == 1
    one = sorted(by[1], key=lambda r: r.piece_no)
    assert len(one) == 2 * one[0].n_pieces and all(r.piece == long[r.piece_start : r.piece_end] and r.piece_no_in == "mine" for r in one)
    assert split_items(spark.createDataFrame([], SCHEMA)).count() == 0

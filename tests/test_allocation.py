import random

import pytest

from termpulse.operators import allocation
from termpulse.session import stage


def one_by_one(rows, budget):
    taken, out = set(), set()
    for taker in sorted({r[0] for r in rows}):
        left, own = budget, set()
        for _, pos, target in sorted(r for r in rows if r[0] == taker):
            if left and target not in taken:
                out.add((taker, pos, target))
                own.add(target)
                left -= 1
        taken |= own
    return out


def granted(spark, rows, budget):
    wishes = stage(spark.createDataFrame(rows, "taker bigint, pos int, target string"), "wishes")
    return {tuple(r) for r in allocation.serve_in_order(wishes, budget).collect()}


def wishes(seed, takers, pool):
    rng = random.Random(seed)
    return [(t, p, f"u{rng.randrange(pool)}") for t in range(takers) if rng.random() < 0.9 for p in range(rng.randrange(1, 9))]


@pytest.mark.parametrize(("at_once", "piece", "apart"), [(10**6, 4096, 8), (0, 3, 8), (0, 2, 3), (25, 5, 8)])
def test_rounds_equal_serving_in_order(spark, monkeypatch, at_once, piece, apart):
    """In order at once; in rounds alone, with targets in pieces and rounds written as one; in rounds with a served rest."""
    monkeypatch.setattr(allocation, "SERVED_AT_ONCE", at_once)
    monkeypatch.setattr(allocation, "PIECE", piece)
    monkeypatch.setattr(allocation, "APART", apart)
    # a target may be named twice by one taker
    rows = [(t + 100 * k, p, f"{k}/{u}") for k in range(12) for t, p, u in wishes(k, 9, 4 + 3 * k)]
    assert granted(spark, rows, 2) == one_by_one(rows, 2)


def test_very_many_takers_of_the_same_targets_end_in_few_rounds(spark, monkeypatch):
    """200 takers with one list: the rounds' rest is served at once."""
    calls = []
    serve = allocation._serve
    monkeypatch.setattr(allocation, "_serve", lambda *a: calls.append(1) or serve(*a))
    monkeypatch.setattr(allocation, "SERVED_AT_ONCE", 9000)
    rows = [(t, p, f"u{p}") for t in range(200) for p in range(50)]
    assert granted(spark, rows, 4) == one_by_one(rows, 4) and calls == [1]


def test_no_wishes(spark):
    assert granted(spark, [], 3) == set()

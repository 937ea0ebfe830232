"""ALS for many settings at once against its equations written out."""

import random

import numpy as np
import pytest

from tidemill.operators import als, few_items
from tidemill.operators.few_items import Setting


def made(seed, users, items, values):
    """Ratings that repeat, ordered at random; every user has some."""
    pick = random.Random(seed)
    rows = [(u, i, pick.choice(values)) for u in range(users) for i in pick.choices(range(items), k=pick.randrange(1, 8))]
    rows += [(0, i, values[-1]) for i in range(items)]
    pick.shuffle(rows)
    return rows


def expected(rows, users, items, setting, iterations, seed):
    mode, rank, reg, alpha = setting
    own, other = few_items.drawn(np.arange(users), rank, seed), np.zeros((items, rank))

    def solved(fixed, count, side):
        found = np.zeros((count, rank))
        for key in range(count):
            rated = [(r[1 - side], r[2]) for r in rows if r[side] == key]
            left, right = np.zeros((rank, rank)) if mode == "explicit" else fixed.T @ fixed, np.zeros(rank)
            for at, value in rated:
                v = fixed[at]
                left = left + (1 if mode == "explicit" else alpha * abs(value)) * np.outer(v, v)
                right = right + (value if mode == "explicit" else (value > 0) * (1 + alpha * value)) * v
            counted = len(rated) if mode == "explicit" else sum(value > 0 for _, value in rated)
            found[key] = np.linalg.solve(left + reg * counted * np.eye(rank), right) if counted else 0
        return found

    for _ in range(iterations):
        other = solved(own, items, 1)
        own = solved(other, users, 0)
    return np.mean([(value - own[u] @ other[i]) ** 2 for u, i, value in rows])


@pytest.mark.parametrize("values", [(1.0, 2.5, 5.0), (-1.0, 0.0, 2.0, 4.0)])
def test_errors_are_those_of_the_equations(spark, monkeypatch, values):
    monkeypatch.setattr(few_items, "BLOCK_USERS", 4)
    rows = made(2, 30, 5, values)
    settings = [Setting("explicit", rank, reg, None) for rank in (3, 9) for reg in (1.0, 0.05)]
    settings += [Setting("implicit", rank, reg, alpha) for rank in (3, 9) for reg in (1.0, 0.05) for alpha in (1.0, 10.0)]
    df = spark.createDataFrame(rows, "user_code int, item_code int, rating double")
    found = few_items.mean_squared_errors(df, 5, settings, iterations=3, seed=5)
    assert found == pytest.approx([expected(rows, 30, 5, s, 3, 5) for s in settings], rel=1e-6)


def test_packed_blocks_do_not_hang_on_the_batches():
    import pyarrow as pa

    rows = sorted(made(3, 11, 4, (1.0, -2.0)))
    whole = pa.record_batch([pa.array(c) for c in zip(*rows)], ["user_code", "item_code", "rating"])
    for size in (1, 5, len(rows)):
        batches = [whole.slice(at, size) for at in range(0, len(rows), size)]
        blocks = list(few_items._unpacked(few_items._packed(4)(iter(batches)), 4))
        assert [u for b in blocks for u in b.users] == list(range(11))
        assert sum(b.n.sum() for b in blocks) == len(rows)
        assert sum((b.n * b.mean).sum() for b in blocks) == pytest.approx(sum(r[2] for r in rows))


def test_grid_of_few_items_fits_all_settings_in_the_same_passes(spark, monkeypatch):
    """Before, each setting was a fit of its own that sent every user's factors in every iteration."""
    rows = [(f"u{u}", f"i{i}", v) for u, i, v in made(4, 40, 6, (1.0, 3.0, 4.0))]
    coded = als.code_ratings(spark.createDataFrame(rows, "user_id string, item_id string, rating double"))
    monkeypatch.setattr(als, "ALS", lambda **settings: pytest.fail("a fit of its own"))
    found = als.grid(coded, iterations=2).collect()
    assert [(r.mode, r["rank"], r.reg, r.alpha) for r in found][:2] == [("explicit", 10, 1.0, None), ("explicit", 10, 0.01, None)]
    assert len(found) == 18 and all(r.mse >= 0 for r in found)


def test_grid_of_many_items_uses_the_solver(spark, monkeypatch):
    rows = [(f"u{u}", f"i{i}", v) for u, i, v in made(4, 20, 6, (1.0, 3.0, 4.0))]
    coded = als.code_ratings(spark.createDataFrame(rows, "user_id string, item_id string, rating double"))
    settings = {"ranks": (2,), "regs": (0.1,), "alphas": (1.0,), "iterations": 10}
    few = als.grid(coded, **settings).collect()
    monkeypatch.setattr(few_items, "MOST_ITEMS", 5)
    many = als.grid(coded, **settings).collect()
    assert [r.mse for r in few] == pytest.approx([r.mse for r in many], rel=0.3)

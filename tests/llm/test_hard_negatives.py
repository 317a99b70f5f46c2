"""Hard negatives against all pairs, on clustered, random and odd vectors; certified stops; shards of crowded cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, key long, cell int, score string"


def by_all_pairs(rows, k=5, m=10):
    """Expected rows of anchors with ids divisible by 10."""
    rows = [(i, np.floor(256 * np.array(v)).astype(np.int64), c) for i, v, c in rows]
    out = []
    for i, q, c in rows:
        if i % 10:
            continue
        scored = [(-int(q @ v), j, d) for j, v, d in rows if j != i]
        for s, p, _ in sorted(x for x in scored if x[2] == c)[:k]:
            near = sorted(x for x in scored if x[2] != c and 30 * -s <= 100 * -x[0] <= 90 * -s)[:m]
            out += [(i, p, r, j, -s, -t) for r, (t, j, _) in enumerate(near, 1)]
    return sorted(out)


def clustered(n, seed=1, width=8, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    which = rng.integers(0, 12, n)
    x = centres[which] + spread * rng.normal(size=(n, width))
    return [(i, x[i].round(4).tolist(), int(rng.integers(0, 3))) for i in range(n)]


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, 5, 6, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(table, F.col("id") % 10 == 0, **options).collect())


@pytest.mark.parametrize("rows", [clustered(400), clustered(300, 2, 6, 3.0)], ids=["clustered", "spread"])
def test_equals_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "SHARD", 32)
    assert mined(spark, rows, n_codes=4) == by_all_pairs(rows)


def test_copies_ties_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "SHARD", 16)
    good = [(i, [1.0, 0.5, 0.25, 0.0], i % 2) for i in range(60)]  # one crowded cell
    good += [(100 + i, [0.5 + 0.001 * i, 0.5, 0.0, 0.1], i % 3) for i in range(40)]
    good += [(200 + i, [0.0, 0.0, 0.0, 0.0], i % 2) for i in range(12)] + [(300, [-1.0, -1.0, 0.0, 0.0], 7)]
    odd = [(None, [1.0] * 4, 1), (900, None, 1), (910, [], 1), (920, [1.0, None, 1.0, 1.0], 1), (930, [float("nan")] * 4, 1)]
    odd += [(940, [float("inf"), 0.0, 0.0, 0.0], 1), (950, [1.0] * 4, None), (960, [1.0] * 3, 1)]
    assert mined(spark, good + odd, n_codes=3) == by_all_pairs(good)


def test_repeated_ids_and_empty_tables(spark):
    rows = [(10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.1], 1), (12, [0.5, 0.0], 2), (12, [0.5, 0.0], 2)]
    found = mined(spark, rows)
    # each row of anchor 10 finds 11 and, once for each row, 12
    assert found == sorted([(10, 11, r, 12, 65536, 32768) for r in (1, 2)] * 2)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(10, [1.0], 1)]) == []


def test_order_bounds_and_stops():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = np.floor(256 * (centres[rng.integers(0, 40, 6000)] + 0.02 * rng.normal(size=(6000, 16)))).astype(np.int64)
    words = tuple(hard_negatives.fit_codewords(h, 40) for h in (x[:2000, :8], x[:2000, 8:]))
    m = len(words[1])
    own = hard_negatives.MultiIndex(words, (np.zeros(len(words[0])), np.zeros(m)), np.zeros(len(words[0]) * m, np.int64)).cells_of(x)
    radii = []
    for h, w, c in ((x[:, :8], words[0], own // m), (x[:, 8:], words[1], own % m)):
        radii.append(np.array([np.sqrt(((h[c == i] - w[i]) ** 2).sum(axis=1)).max(initial=0) for i in range(len(w))]))
    index = hard_negatives.MultiIndex(words, tuple(radii), np.bincount(own, minlength=len(words[0]) * m))
    visited = 0
    for q in x[:20]:
        score, walk = x @ q, list(index.visit(q))
        assert sum(int(index.sizes[c]) for c, _, _ in walk) == len(x)
        assert [u for _, u, _ in walk] == sorted((u for _, u, _ in walk), reverse=True)
        for cell, upper, lower in walk:
            assert lower <= score[own == cell].min() and score[own == cell].max() <= upper
        floor = np.sort(score)[-6]
        cells = index.route(q, False, -np.inf, np.inf) + index.route(q, True, float(floor), np.inf)
        assert np.isin(own[score >= floor], cells).all()
        visited += sum(int(index.sizes[c]) for c in cells)
    assert visited < 0.6 * 20 * len(x)  # the bound ends the searches

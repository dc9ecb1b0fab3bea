import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import negatives

SCHEMA = "vec_id bigint, embedding array<bigint>, label int"


def brute(rows, anchor=lambda i: i % 5 == 0):
    seen = {(i, tuple(v), l) for i, v, l in rows if i is not None and v is not None and l is not None and None not in v}
    out = set()

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    for i, v, l in seen:
        if not anchor(i):
            continue
        near = sorted((-dot(v, w), j) for j, w, m in seen if m == l and j != i)[:5]
        for neg, j in near:
            s = -neg
            hard = sorted((-dot(v, w), n) for n, w, m in seen if m != l and 50 * s <= 100 * dot(v, w) <= 95 * s)[:3]
            out |= {(i, j, rank + 1, n, s, -t) for rank, (t, n) in enumerate(hard)}
    return out


def found(df, **how):
    rows = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, n, dim=6, spread=40):
    chance = np.random.default_rng(seed)
    centres = chance.integers(-100, 100, (4, dim))
    return [(int(i), (centres[i % 4] + chance.integers(-spread, spread, dim)).tolist(), int(chance.integers(0, 5)))
            for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"part_points": 40}, {"part_points": 40, "sample": 30, "cells": 4}])
def test_all_pairs_agree(spark, how):
    rows = made(3, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert len(want) > 300
    assert found(df, **how) == want


def test_copies_of_one_vector(spark):
    rows = made(5, 120) + [(i, [50, 20, -30, 4, 5, 60], i % 2) for i in range(200, 500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, part_points=30) == brute(rows)


def test_scores_beyond_doubles(spark):
    rows = [(i, [x * 2_000_001 + i % 3 for x in v], l) for i, v, l in made(7, 150, dim=4, spread=9)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, part_points=50) == brute(rows)


def test_awkward_rows(spark):
    rows = [(0, [1, 2], 1), (0, [1, 2], 1), (5, [2, 4], 1), (10, [2, 4], 1), (1, [1, 1, 7], 2), (2, [], 2), (3, None, 1),
            (None, [1, 2], 1), (4, [1, None], 1), (6, [1, 3], None), (15, [0, 0], 1), (7, [0, 0], 2), (8, [2, 3], 2),
            (20, [-5, 1], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("id", "key", "q", "part", "turn", "cell", "windows", "score", "place", "ids")})
    want = brute(rows)
    assert want and found(df) == want
    assert found(df.where("vec_id = 5")) == set()
    assert found(df.where("false")) == set()


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("leaf", [1, 4, 30])
def test_search_of_a_part_against_all_its_points(monkeypatch, leaf, same):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    rows = made(11, 300, dim=5) + [(i, [3, 3, 3, 3, 3], 0) for i in range(900, 910)]
    part = negatives.Part(np.array([v for _, v, _ in rows]), np.array([l for *_, l in rows]), [[i] for i, *_ in rows], True)
    assert leaf == 30 or len(part.tree.levels) > 2
    asked = rows[::7]
    windows = [[{"score": n, "lo": lo, "hi": hi} for n, (lo, hi) in enumerate([(-10**9, 10**9), (2000, 9000), (5, 4), (9, 9)])]
               for _ in asked]
    got = list(part.rows([str(i) for i, *_ in asked], windows, np.array([v for _, v, _ in asked]),
                         np.array([l for *_, l in asked]), 4, same))
    want = []
    for i, v, l in asked:
        for w in windows[0]:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), j) for j, x, m in rows if (m == l) == same)
            want += [(str(i), w["score"], -s, j) for s, j in [p for p in scored if w["lo"] <= -p[0] <= w["hi"]][:4]]
    assert got == want


def test_tree_bounds_hold_and_leave_out_far_leaves(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 32)
    chance = np.random.default_rng(1)
    x = np.vstack([chance.normal(c, 3, (400, 8)) for c in chance.normal(0, 100, (6, 8))])
    tree = negatives.CoverTree(x)
    assert sorted(np.concatenate(tree.leaves)) == list(range(len(x)))
    q = x[::50]
    unit, lengths = negatives.directions(q)
    scores = q @ x.T
    of = np.arange(len(q))
    lo, hi = scores.max(axis=1) * 0.5, scores.max(axis=1) * 0.9
    reach = tree.reach(unit, lengths, lo, hi, of)
    for leaf, rows in enumerate(tree.leaves):
        inside = ((scores[:, rows] >= lo[:, None]) & (scores[:, rows] <= hi[:, None])).any(axis=1)
        assert (np.isfinite(reach[:, leaf]) | ~inside).all()
        assert (reach[:, leaf][inside] >= scores[:, rows].max(axis=1)[inside]).all()
    assert np.isinf(reach).mean() > 0.3

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators.intervals import grid_level, holders, locate
from marquee.operators.running import running_total


@pytest.mark.parametrize("ranges", [1, 5, None])
def test_running_total_over_many_ranges(spark, ranges):
    rng = random.Random(3)
    weights = {f"t{n:04}": rng.choice([0, 1, 5, 1000, None]) for n in range(300)}
    df = spark.createDataFrame(list(weights.items()), "title_id string, votes long")
    found = {r.title_id: r.running for r in running_total(df, ["title_id"], "votes", ranges=ranges).collect()}
    total, want = 0, {}
    for title in sorted(weights):
        total += weights[title] or 0
        want[title] = total
    assert found == want


def test_points_on_bounds_belong_to_the_next_interval(spark):
    """Short intervals, an empty one and one that covers most of the line by itself."""
    lengths = [1, 2, 0, 3, 5_000_000_000, 1, 4, 7_000, 1]
    bounds, at = [], 0
    for n, length in enumerate(lengths):
        bounds.append((f"i{n}", at, at + length))
        at += length
    intervals = spark.createDataFrame(bounds, "name string, lo long, hi long")
    rng = random.Random(5)
    at_bounds = [b for _, lo, hi in bounds for b in (lo, hi - 1, hi) if 0 <= b < at]
    chosen = sorted(set(at_bounds + [rng.randrange(at) for _ in range(100)]))
    points = spark.createDataFrame([(p,) for p in chosen + [at, -1]], "point long")
    width = F.lit(2)
    used = intervals.agg(F.collect_set(grid_level(F.col("hi") - F.col("lo"), width))).first()[0]
    assert len(used) > 2
    found = locate(points, intervals, width, F.array(*[F.lit(n) for n in used]))
    assert found.count() == len(chosen)
    want = {p: next(n for n, lo, hi in bounds if lo <= p < hi) for p in chosen}
    assert {r.point: r.name for r in found.collect()} == want


def test_every_number_below_the_sum_has_one_holder(spark):
    weights = spark.createDataFrame([("a", 1), ("hot", 700), ("none", 0), ("z", 299)], "title_id string, votes long")
    points = spark.range(-2, 1003).withColumnRenamed("id", "point")
    found = {r.point: r.title_id for r in holders(points, weights, "title_id", "votes", ranges=2).collect()}
    assert found == {p: "a" if p < 1 else "hot" if p < 701 else "z" for p in range(1000)}

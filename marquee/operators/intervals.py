"""Find the interval that holds a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.running import running_total

SPAN = 1_024
_LEVELS = 6  # SPAN ** 6 cells exceed the BIGINT range


def _cell_width(width: Column, level: Column) -> Column:
    return width.cast("bigint") * F.element_at(F.array(*[F.lit(SPAN ** n) for n in range(_LEVELS)]), level + 1)


def grid_level(length: Column, width: Column) -> Column:
    """The grid on which an interval of this length covers few cells of ``width * SPAN ** level``."""
    cells = F.call_function("div", length - 1, width)
    level = F.lit(_LEVELS - 1)
    for n in reversed(range(_LEVELS - 1)):
        level = F.when(cells < F.lit(SPAN ** (n + 1)), F.lit(n)).otherwise(level)
    return level


def locate(points: DataFrame, intervals: DataFrame, width: Column, levels: Column, point: str = "point",
           lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Join each point to the half-open interval ``[lo, hi)`` that holds it.

    Both sides meet on grid cells, so this is an equality join. ``width`` is the
    cell width, best the mean interval length. An interval longer than ``SPAN``
    cells goes to a grid ``SPAN`` times coarser, until it covers at most ``SPAN +
    1`` cells, so a single huge interval does not explode. Points look at each
    grid in use: ``levels`` is the array of the values of ``grid_level``.
    """
    gridded = (
        intervals.where(F.col(lo) < F.col(hi))
        .withColumn("_level", grid_level(F.col(hi) - F.col(lo), width))
        .withColumn("_width", _cell_width(width, F.col("_level")))
        .withColumn("_cell", F.explode(F.expr(f"sequence({lo} div _width, ({hi} - 1) div _width)")))
        .drop("_width")
    )
    placed = (
        points.withColumn("_level", F.explode(levels))
        .withColumn("_width", _cell_width(width, F.col("_level")))
        .withColumn("_cell", F.expr(f"{point} div _width"))
        .drop("_width")
    )
    held = (F.col(point) >= F.col(lo)) & (F.col(point) < F.col(hi))
    return placed.join(gridded, ["_level", "_cell"]).where(held).drop("_level", "_cell")


def holders(points: DataFrame, weights: DataFrame, key: str, weight: str, ranges: int | None = None) -> DataFrame:
    """Join each point to the row that holds it when all rows are laid end to end by key.

    A row of weight w covers w whole numbers; the first starts at 0. Points past the end, or
    below 0, are in no row.
    """
    lengths = weights.where(F.col(weight) > 0)
    width = lengths.agg(F.greatest(F.lit(1), F.expr(f"sum({weight}) div count(1)"))).scalar()
    levels = lengths.agg(F.collect_set(grid_level(F.col(weight), width))).scalar()
    laid = running_total(lengths, [key], weight, "hi", ranges).withColumn("lo", F.col("hi") - F.col(weight))
    return locate(points, laid, width, levels)

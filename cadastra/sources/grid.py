"""Tables of boxes and points clustered by grid cell, so that a box query opens only files near it.

Every box belongs to one cell: that of its lower left corner, on the finest level whose cells are not
smaller than the box. Boxes therefore reach into the next cell at most, whatever borders they cross,
and a query asks for a range of cells on each level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]
WORLD: Box = (-180.0, -90.0, 180.0, 90.0)
LEVELS = 8
#: Bits of each coordinate by which rows are ordered inside a cell.
FINE = 16
LEVEL, CELL_X, CELL_Y = "_level", "_cell_x", "_cell_y"


def interleaved(x: Column, y: Column, bits: int = FINE) -> Column:
    """The Z-order number of two whole numbers below 2**bits."""
    one = lambda v, to: reduce(lambda a, i: a.bitwiseOR(F.shiftleft(F.shiftright(v, i).bitwiseAND(F.lit(1).cast("long")), 2 * i + to)), range(1, bits), F.shiftleft(v.bitwiseAND(F.lit(1).cast("long")), to))
    return one(x.cast("long"), 0).bitwiseOR(one(y.cast("long"), 1))


class GridTable:
    """A clustered table at ``path``: ``cells`` holds the rows, ``grid`` the extent and number of levels."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, df: DataFrame, box: list[str], key: str | list[str], world: Box = WORLD, levels: int = LEVELS) -> None:
        """Write ``df``, with ``box`` the columns (or expressions) of minx, miny, maxx, maxy; a point names its two columns twice.

        ``key``, columns that tell rows apart, parts rows at one place, so a very common place goes to several
        files. Rows with a null in the box are kept on a level of their own, which no query asks for; they are
        all at one place too.
        """
        minx, miny, maxx, maxy = (F.expr(c).cast("double") for c in box)
        wide, high = world[2] - world[0], world[3] - world[1]
        extent = F.greatest((maxx - minx) / wide, (maxy - miny) / high)
        # a hair larger than it is, so that rounding never makes a box look smaller than its cell
        level = reduce(lambda a, b: a + b, [(extent * (1 + 1e-9) <= 2.0**-k).cast("int") for k in range(1, levels + 1)])
        there = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in (minx, miny, maxx, maxy)])
        across = lambda v, low, size, n: F.greatest(F.lit(0), F.least(n - 1, F.floor((v - low) / size * n))).cast("int")
        n = F.expr(f"shiftleft(1, {LEVEL})")
        z = interleaved(across(minx, world[0], wide, F.lit(1 << FINE)), across(miny, world[1], high, F.lit(1 << FINE)))
        dealt = df.withColumn(LEVEL, F.when(there, level).otherwise(-1))
        dealt = dealt.withColumns({CELL_X: F.when(there, across(minx, world[0], wide, n)).otherwise(0), CELL_Y: F.when(there, across(miny, world[1], high, n)).otherwise(0), "_z": z, "_part": F.xxhash64(*([key] if isinstance(key, str) else key))})
        order = [LEVEL, CELL_X, CELL_Y, "_z", "_part"]
        spread = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("_z", "_part")
        spread.write.mode("overwrite").partitionBy(LEVEL, CELL_X, CELL_Y).parquet(f"{self.path}/cells")
        head = self.spark.createDataFrame([([float(v) for v in world], levels, box)], "world array<double>, levels int, box array<string>")
        head.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/grid")

    def read(self, box: Box | None = None) -> DataFrame:
        """Rows whose box shares a point with ``box`` (touching counts), or all rows.

        Folders of cells out of reach are pruned, the rest is filtered exactly.
        """
        rows = self.spark.read.parquet(f"{self.path}/cells")
        if box is None:
            return rows.drop(LEVEL, CELL_X, CELL_Y)
        head = self.spark.read.parquet(f"{self.path}/grid").first()
        minx, miny, maxx, maxy = (F.expr(c) for c in head["box"])
        near = reduce(lambda a, b: a | b, [self._cells(k, box, head["world"]) for k in range(head["levels"] + 1)])
        exact = (minx <= box[2]) & (maxx >= box[0]) & (miny <= box[3]) & (maxy >= box[1])
        return rows.where(near & exact).drop(LEVEL, CELL_X, CELL_Y)

    @staticmethod
    def _cells(level: int, box: Box, world: list[float]) -> Column:
        n = 1 << level

        def span(low: float, high: float, start: float, size: float) -> tuple[int, int]:
            cell = lambda v: int(max(0, min(n - 1, (v - start) / size * n // 1)))
            # what begins in the cell before may reach into the first
            return max(0, cell(low) - 1), cell(high)

        x = span(box[0], box[2], world[0], world[2] - world[0])
        y = span(box[1], box[3], world[1], world[3] - world[1])
        return (F.col(LEVEL) == level) & F.col(CELL_X).between(*x) & F.col(CELL_Y).between(*y)

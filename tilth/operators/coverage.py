"""The area that a layer of overlapping polygons covers, on a grid of square cells.

A cell is covered if its centre is inside.  A polygon becomes spans of cells, a few for each row of cells that it
meets, by the crossings of its edges with the row's middle; spans stay spans, however long.  The union's length in a row
is a sweep over the spans' ends: a running sum of +1 and -1.  The area is off by at most the cells that the
outlines pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators.outlines import edge_rows

#: Columns of one block of a row; a row is swept block by block.
BLOCK = 1 << 16


def _first_centre(v: Column, cell: float) -> Column:
    """The first cell whose centre is not before ``v``."""
    return F.ceil(v / cell - 0.5)


def cell_spans(layer: DataFrame, keys: Sequence[str], cell: float) -> DataFrame:
    """(keys, poly, row, first, stop): the cells of each polygon, by even-odd rule over its rings; ``keys`` are unique.

    An outline's left ends belong to it and its right ends do not, so edge-matched polygons share no cell.
    """
    if cell <= 0:
        raise ValueError("the cell size must be positive")
    rows = F.sequence(_first_centre(F.col("miny"), cell), _first_centre(F.col("maxy"), cell) - 1)
    e = edge_rows(layer, keys).filter(_first_centre(F.col("miny"), cell) < _first_centre(F.col("maxy"), cell))
    e = e.select(*keys, "poly", "a", "b", F.explode(rows).alias("row"))
    y = (F.col("row") + 0.5) * cell
    x = (F.col("b.x") - F.col("a.x")) * ((y - F.col("a.y")) / (F.col("b.y") - F.col("a.y"))) + F.col("a.x")
    line = W.partitionBy(*keys, "poly", "row").orderBy("x")
    at = e.select(*keys, "poly", "row", x.alias("x")).select("*", F.lead("x").over(line).alias("to"), F.row_number().over(line).alias("n"))
    return at.filter("n % 2 = 1").select(*keys, "poly", "row", _first_centre(F.col("x"), cell).alias("first"), _first_centre(F.col("to"), cell).alias("stop")).filter("stop > first")


def union_area(layer: DataFrame, by: Sequence[str], keys: Sequence[str], cell: float) -> DataFrame:
    """(by, cells, area): what the polygons of each group cover together; ``keys`` name a feature in its group."""
    spans = cell_spans(layer, [*by, *keys], cell)
    # a span is cut where it passes from one block of columns into the next
    blocks = F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("stop") - 1) / BLOCK))
    spans = spans.select(*by, "row", F.explode(blocks).alias("block"), "first", "stop")
    spans = spans.select(*by, "row", "block", F.greatest("first", F.col("block") * BLOCK).alias("first"), F.least("stop", (F.col("block") + 1) * BLOCK).alias("stop"))
    ends = F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("step")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("step")))
    # ends at one place are summed before the sweep, so a row has no more of them than columns
    at = spans.select(*by, "row", "block", F.explode(ends).alias("e")).groupBy(*by, "row", "block", "e.at").agg(F.sum("e.step").alias("step"))
    sweep = W.partitionBy(*by, "row", "block").orderBy("at")
    at = at.select(*by, "at", F.lead("at").over(sweep).alias("to"), F.sum("step").over(sweep).alias("over"))
    cells = at.filter("over > 0").groupBy(*by).agg(F.sum(F.col("to") - F.col("at")).alias("cells"))
    return cells.withColumn("area", F.col("cells") * (cell * cell))

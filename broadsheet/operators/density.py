"""Hexagonal density of two projection axes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

XBINS = 30


def hexbin_counts(points: DataFrame, xbins: int = XBINS) -> DataFrame:
    """``(lattice, i, j, n)`` of points ``(x, y)``: a hexagon grid is two shifted rectangular lattices, and a
    point belongs to the nearer of its two candidate centres, the first on ties. An axis on which all points agree
    has one row of cells."""
    lows = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    bounds = lows.select(F.struct("x0", "x1", "y0", "y1").alias("b")).scalar()
    placed = points.where("x IS NOT NULL AND y IS NOT NULL").withColumn("b", bounds)
    placed = placed.select(
        F.expr(f"coalesce({xbins} * (x - b.x0) / nullif(b.x1 - b.x0, 0), 0D)").alias("sx"),
        F.expr(f"coalesce({xbins} * (y - b.y0) / (nullif(b.y1 - b.y0, 0) * sqrt(3D)), 0D)").alias("sy"),
    )
    near = placed.selectExpr(
        "floor(sx + 0.5D) AS j1", "floor(sy + 0.5D) AS i1", "floor(sx) AS j2", "floor(sy) AS i2", "sx", "sy"
    )
    first = "pow(sx - j1, 2) + 3 * pow(sy - i1, 2)"
    second = "pow(sx - j2 - 0.5D, 2) + 3 * pow(sy - i2 - 0.5D, 2)"
    cells = near.withColumn("lattice", F.when(F.expr(f"{first} <= {second}"), 0).otherwise(1))
    cells = cells.selectExpr("lattice", "if(lattice = 0, i1, i2) AS i", "if(lattice = 0, j1, j2) AS j")
    return cells.groupBy("lattice", "i", "j").agg(F.count("*").alias("n"))


def cell_centers(cells: DataFrame) -> DataFrame:
    """Adds the grid position of each cell's centre; the second lattice is shifted by half a step."""
    shift = F.col("lattice") * 0.5
    return cells.withColumn("cx", F.col("j") + shift).withColumn("cy", F.col("i") + shift)

"""Projected lead positions: bounds and fit to a drawing box."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import albers_xy
from ..session import stage_table
from .features import attach
from .lists import located


def projected(leads: DataFrame) -> DataFrame:
    """x, y of every located lead, y pointing up."""
    return located(leads).withColumn("_p", albers_xy(F.col("lat"), F.col("lon"))).withColumns(
        {"x": F.col("_p.x"), "y": F.col("_p.y")}).drop("_p")


def bounds(points: DataFrame) -> DataFrame:
    return points.agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"),
                      F.min("y").alias("min_y"), F.max("y").alias("max_y"))


def fitted(points: DataFrame, width: float = 1000.0, pad: float = 10.0) -> DataFrame:
    """Positions in a box of the given width, y pointing down, and the box height."""
    points = stage_table(points, "points")  # read for its bounds and for its rows
    span = lambda lo, hi: F.coalesce(F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)), F.lit(1.0))
    box = bounds(points).withColumn("scale", F.lit(width - 2 * pad) / span("min_x", "max_x"))
    box = box.withColumn("height", F.floor(span("min_y", "max_y") * F.col("scale") + 2 * pad + 0.5))
    return attach(points, box).withColumns({
        "px": F.lit(pad) + (F.col("x") - F.col("min_x")) * F.col("scale"),
        "py": F.lit(pad) + (F.col("max_y") - F.col("y")) * F.col("scale")})

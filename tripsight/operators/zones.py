"""Zone dimension: polygon centroids, look-up join, zone-pair estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def polygon_centroids(vertices: DataFrame) -> DataFrame:
    """SRC-08: area-weighted centroid per zone from closed rings (shoelace).

    cx = sum((x0+x1)*c) / (3*sum(c)), c = x0*y1 - x1*y0 over consecutive
    vertices. The window partitions by (zone, ring): a ring is a few hundred
    vertices at most.
    """
    # coordinates relative to the zone's lower-left vertex bound: the shoelace
    # terms stay small instead of cancelling between products near 74 * 40
    z = Window.partitionBy("LocationID")
    v = vertices.select("*", F.min("x").over(z).alias("_ox"), F.min("y").over(z).alias("_oy"))
    v = v.select("LocationID", "ring", "seq", "x", "y", "_ox", "_oy",
                 (F.col("x") - F.col("_ox")).alias("dx"), (F.col("y") - F.col("_oy")).alias("dy"))
    w = Window.partitionBy("LocationID", "ring").orderBy("seq")
    e = v.select("LocationID", "seq", "x", "y", "_ox", "_oy", F.col("dx").alias("x0"), F.col("dy").alias("y0"),
                 F.lead("dx").over(w).alias("x1"), F.lead("dy").over(w).alias("y1"),
                 F.lead("seq").over(w).isNotNull().alias("_edge"))
    c = F.when(F.col("_edge"), F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0"))
    # the closing vertex repeats the first one: the vertex mean counts open rings
    g = e.groupBy("LocationID").agg(
        F.sum(c).alias("_c2"), F.sum((F.col("x0") + F.col("x1")) * c).alias("_sx"),
        F.sum((F.col("y0") + F.col("y1")) * c).alias("_sy"), F.max("_ox").alias("_ox"), F.max("_oy").alias("_oy"),
        F.avg(F.when(F.col("_edge"), F.col("x"))).alias("vertex_mean_x"),
        F.avg(F.when(F.col("_edge"), F.col("y"))).alias("vertex_mean_y"))
    # a degenerate ring (zero area) has no centroid: null instead of a division error
    return g.select("LocationID", (F.col("_ox") + F.try_divide(F.col("_sx"), F.lit(3.0) * F.col("_c2"))).alias("longitude"),
                    (F.col("_oy") + F.try_divide(F.col("_sy"), F.lit(3.0) * F.col("_c2"))).alias("latitude"),
                    F.abs(F.col("_c2") / 2.0).alias("area"), "vertex_mean_x", "vertex_mean_y")


def zone_dimension(lookup: DataFrame, centroids: DataFrame) -> DataFrame:
    """SRC-07 / JOIN-02: look-up LEFT JOIN centroids (zones without a polygon keep nulls)."""
    return lookup.join(centroids.select("LocationID", "longitude", "latitude"), "LocationID", "left")

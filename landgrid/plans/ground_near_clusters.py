"""Ground polygons near the centre of a rooftop cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landgrid.operators import clusters


def ground_near_clusters(ground: DataFrame, rooftops: DataFrame, radius: float = 150.0,
                         key: str = "gid", square: float = 256.0) -> DataFrame:
    """``geom, cluster`` of the ground polygons at most ``radius`` from a cluster centre."""
    centers = clusters.cluster_centers(rooftops)
    return clusters.around_clusters(ground, centers, key, "cluster", radius, square).select("geom", "cluster")

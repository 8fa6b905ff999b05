"""Grids, inverse-distance interpolation and map feature tables."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m

MARGIN = 0.05
CELLS = 200


def _box(points: DataFrame):
    """Bounding box plus margin, as a scalar subquery."""
    return points.agg(
        F.struct(
            (F.min("longitude") - MARGIN).alias("x0"),
            (F.max("longitude") + MARGIN).alias("x1"),
            (F.min("latitude") - MARGIN).alias("y0"),
            (F.max("latitude") + MARGIN).alias("y1"),
        )
    ).scalar()


def _node(low, high, index, cells):
    return low + index * ((high - low) / (cells - 1))


def grid_mesh(points: DataFrame, cells: int = CELLS) -> DataFrame:
    """Regular grid over the box of the points, one row per cell; no join of axes."""
    box = _box(points)
    mesh = points.sparkSession.range(cells * cells).select(
        (F.col("id") % cells).cast("int").alias("ix"), F.floor(F.col("id") / cells).cast("int").alias("iy")
    )
    return mesh.select(
        "ix",
        "iy",
        _node(box["x0"], box["x1"], F.col("ix"), cells).alias("longitude"),
        _node(box["y0"], box["y1"], F.col("iy"), cells).alias("latitude"),
    )


def interpolate(points: DataFrame, value: str, cells: int = CELLS, power: float = 2.0) -> DataFrame:
    """Inverse-distance weighting of every station on every grid cell.

    Stations stay where they are: each task adds its stations into a raster of running
    sums (weight, weighted value and the exact hit of lowest zone), so only one raster per
    task is shuffled and summed by cell. Stations are neither broadcast nor paired with
    cells as rows. A cell that a station hits exactly takes the station's value.
    """
    box = _box(points)
    placed = points.select(
        "zone",
        F.col("longitude").alias("x"),
        F.col("latitude").alias("y"),
        F.col(value).alias("v"),
        *[box[c].alias(c) for c in ["x0", "x1", "y0", "y1"]],
    ).filter("x is not null and y is not null and v is not null")

    def rasters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = weighted = None
        hits: dict[int, tuple[str, float]] = {}
        index = np.arange(cells, dtype=np.float64)
        for batch in batches:
            for zone, x, y, v, x0, x1, y0, y1 in batch.itertuples(index=False):
                if weight is None:
                    gx = x0 + index * ((x1 - x0) / (cells - 1))
                    gy = y0 + index * ((y1 - y0) / (cells - 1))
                    weight = np.zeros((cells, cells))
                    weighted = np.zeros((cells, cells))
                distance = np.sqrt((x - gx)[None, :] ** 2 + (y - gy)[:, None] ** 2)
                exact = distance == 0
                if exact.any():
                    for cell in np.flatnonzero(exact.ravel()):
                        hits[int(cell)] = min(hits.get(int(cell), (zone, v)), (zone, v))
                    distance[exact] = np.inf
                w = 1.0 / distance**power
                weight += w
                weighted += w * v
        if weight is None:
            return
        out = pd.DataFrame(
            {"cell": np.arange(cells * cells), "w": weight.ravel(), "wv": weighted.ravel()}
        )
        out["hit_zone"] = [hits[c][0] if c in hits else None for c in range(cells * cells)]
        out["hit_value"] = [hits[c][1] if c in hits else None for c in range(cells * cells)]
        yield out

    schema = "cell long, w double, wv double, hit_zone string, hit_value double"
    sums = placed.mapInPandas(rasters, schema).groupBy("cell").agg(
        F.sum("w").alias("w"),
        F.sum("wv").alias("wv"),
        F.min_by("hit_value", "hit_zone").alias("hit"),
    )
    return sums.select(
        (F.col("cell") % cells).cast("int").alias("ix"),
        F.floor(F.col("cell") / cells).cast("int").alias("iy"),
        F.coalesce("hit", F.try_divide("wv", "w")).alias("value"),
    )


def map_features(summary: DataFrame) -> DataFrame:
    """Marker rows: position, colour, popup and tooltip text, heat weight."""
    highest = summary.agg(F.max("gw_level")).scalar()
    text = lambda c, d: F.format_string(f"%.{d}f", m.rounded(F.col(c), d))
    colour = m.risk_colour(F.col("risk_label"))
    return summary.select(
        "zone",
        "latitude",
        "longitude",
        colour.alias("colour"),
        F.concat(
            F.lit("GW Level: "),
            text("gw_level", 2),
            F.lit(" m; Risk: "),
            F.col("risk_label"),
            F.lit("; Rainfall: "),
            text("rainfall", 1),
            F.lit(" mm; Urban Frac: "),
            text("urban_frac", 2),
        ).alias("popup"),
        F.concat("zone", F.lit(" ("), "risk_label", F.lit(")")).alias("tooltip"),
        (F.col("gw_level") / highest).alias("heat"),
    )


def write_map(features: DataFrame, path: str) -> DataFrame:
    """The map table as JSON lines, and the same table read back from them."""
    features.write.mode("overwrite").json(path)
    return features.sparkSession.read.schema(features.schema).json(path)


def risk_points(summary: DataFrame) -> DataFrame:
    return summary.select(
        "zone",
        "longitude",
        "latitude",
        "risk_label",
        m.risk_colour(F.col("risk_label")).alias("colour"),
        F.element_at(
            F.create_map(*[F.lit(x) for i, n in enumerate(fixed.RISK_LABELS) for x in (n, i)]), F.col("risk_label")
        ).alias("risk_order"),
    )

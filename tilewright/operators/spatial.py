"""Range joins of points with boxes, as equi-joins on grid cells.

A box is covered by the cells of one level of a grid over longitude and latitude, the finest at which a few cells suffice; a point is in
one cell of each level that boxes use (21 at most). Box and point meet on level and cell, and the exact comparison follows. No pair is tried that
shares no cell, so no nested loop is needed, however many boxes there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINEST = 20


def cell(degrees: Column, origin: float, span: float, level: Column) -> Column:
    """The number of the cell that holds a coordinate; level 0 is one cell over the span."""
    return F.floor((degrees - origin) / span * F.pow(F.lit(2.0), level)).cast("long")


def box_level(bbox: Column, across: int = 4) -> Column:
    """The finest level at which neither side of the box is longer than ``across`` cells."""
    fits = lambda span, side: F.when(side > 0, F.floor(F.log2(F.lit(across * span) / side))).otherwise(F.lit(FINEST))
    wide, high = bbox["max_lon"] - bbox["min_lon"], bbox["max_lat"] - bbox["min_lat"]
    return F.greatest(F.lit(0), F.least(F.lit(FINEST), fits(360.0, wide), fits(180.0, high))).cast("int")


def covering_cells(boxes: DataFrame, bbox: str = "bbox", across: int = 4) -> DataFrame:
    """``boxes`` once for each cell that covers them: ``level, cell_x, cell_y`` beside their columns. A box with a null or non-finite bound, or
    whose least exceeds its largest, has none."""
    b = F.col(bbox)
    known = [b[c].isNotNull() & ~F.isnan(b[c]) & (F.abs(b[c]) < 1e6) for c in ("min_lon", "min_lat", "max_lon", "max_lat")]
    whole = (b["min_lon"] <= b["max_lon"]) & (b["min_lat"] <= b["max_lat"])
    df = boxes.where(known[0] & known[1] & known[2] & known[3] & whole).withColumn("level", box_level(b, across))
    run = lambda low, high, origin, span: F.explode(F.sequence(cell(b[low], origin, span, F.col("level")), cell(b[high], origin, span, F.col("level"))))
    df = df.withColumn("cell_x", run("min_lon", "max_lon", -180.0, 360.0))
    return df.withColumn("cell_y", run("min_lat", "max_lat", -90.0, 180.0))


def points_in_boxes(points: DataFrame, boxes: DataFrame, lon: str = "lon", lat: str = "lat", bbox: str = "bbox", across: int = 4) -> DataFrame:
    """A row for each point and box that holds it, edges included: the columns of both, which must differ in name.

    A box in ``across`` by ``across`` cells takes up at least a quarter of the cells that cover it, so candidates are bounded by a small multiple of
    the points in and around boxes. Points with null or non-finite coordinates are in no box; repeated rows each count.
    """
    clash = set(points.columns) & set(boxes.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    cells = covering_cells(boxes, bbox, across)
    levels = sorted(r["level"] for r in covering_cells(boxes, bbox, across).select("level").distinct().collect())  # 21 at most
    x, y, b = F.col(lon), F.col(lat), F.col(bbox)
    placed = points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < 1e6) & (F.abs(y) < 1e6))
    placed = placed.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    placed = placed.withColumns({"cell_x": cell(x, -180.0, 360.0, F.col("level")), "cell_y": cell(y, -90.0, 180.0, F.col("level"))})
    met = placed.join(cells, ["level", "cell_x", "cell_y"])
    return met.where(x.between(b["min_lon"], b["max_lon"]) & y.between(b["min_lat"], b["max_lat"])).drop("level", "cell_x", "cell_y")

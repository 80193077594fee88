"""Range joins against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilewright.operators import spatial

BOX = "box_id int, bbox struct<min_lon: double, min_lat: double, max_lon: double, max_lat: double>"


@pytest.mark.parametrize("across", [1, 4, 9])
def test_points_in_boxes(spark, across):
    rng = random.Random(across)
    points = [(i, rng.uniform(-181, 181), rng.uniform(-91, 91)) for i in range(400)] + [(i, 4.9, 52.37) for i in range(400, 700)]  # a hot place
    points += [(700, None, 1.0), (701, math.nan, 1.0), (702, math.inf, 0.0), (703, 180.0, 90.0), (704, -180.0, -90.0), (704, -180.0, -90.0)]
    boxes = []
    for i in range(60):
        w, s = rng.uniform(-180, 170), rng.uniform(-90, 80)
        boxes.append((i, (w, s, w + 10 ** rng.uniform(-4, 2.2), s + 10 ** rng.uniform(-4, 1.8))))
    boxes += [(60, (-180.0, -90.0, 180.0, 90.0)), (61, (4.9, 52.37, 4.9, 52.37)), (62, (-180.0, 0.0, 180.0, 1e-9)), (63, (5.0, 1.0, 4.0, 2.0)), (64, (None, 1.0, 4.0, 2.0)), (65, None), (61, (4.9, 52.37, 4.9, 52.37))]
    found = spatial.points_in_boxes(spark.createDataFrame(points, "id int, lon double, lat double"), spark.createDataFrame(boxes, BOX))
    assert found.columns == ["id", "lon", "lat", "box_id", "bbox"]
    ok = lambda v: v is not None and math.isfinite(v)
    expected = sorted((p, k) for p, x, y in points for k, b in boxes if b and ok(x) and ok(y) and None not in b and b[0] <= x <= b[2] and b[1] <= y <= b[3])
    assert sorted((r["id"], r["box_id"]) for r in found.collect()) == expected
    assert {(700, 60), (701, 60)}.isdisjoint(expected) and (703, 60) in expected


def test_no_nested_loop_and_few_candidates(spark):
    points = spark.range(2000).select("id", (F.rand(1) * 360 - 180).alias("lon"), (F.rand(2) * 180 - 90).alias("lat"))
    boxes = spark.range(500).select(F.col("id").cast("int").alias("box_id"), F.struct((F.rand(3) * 300 - 180).alias("min_lon"), (F.rand(4) * 150 - 90).alias("min_lat")).alias("p"))
    boxes = boxes.select("box_id", F.struct("p.min_lon", "p.min_lat", (F.col("p.min_lon") + 3).alias("max_lon"), (F.col("p.min_lat") + 2).alias("max_lat")).alias("bbox"))
    plan = spatial.points_in_boxes(points, boxes)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" in plan
    assert spatial.covering_cells(boxes).groupBy("box_id").count().agg(F.max("count")).first()[0] <= 25
    with pytest.raises(ValueError):
        spatial.points_in_boxes(points.withColumn("box_id", F.lit(1)), boxes)


def test_empty_sides(spark):
    points, boxes = spark.createDataFrame([], "id int, lon double, lat double"), spark.createDataFrame([(1, (0.0, 0.0, 1.0, 1.0))], BOX)
    assert spatial.points_in_boxes(points, boxes).count() == 0 == spatial.points_in_boxes(spark.createDataFrame([(1, 0.5, 0.5)], "id int, lon double, lat double"), boxes.where("false")).count()
